"""Cross-tokenizer alignment against a plain walk over both token lists."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from llm_fixtures import SF_SMALL, duck, odd_docs, small_docs  # noqa: F401
from tokenizers import Tokenizer

from adpulse.llm import alignment
from adpulse.llm.queries import QUERIES

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
ODD = [None, "", " ", "a", "<|endoftext|> and <s> </s> <unk>", "line\nbreaks\r\n\ttabs", "déjà vu 中文字 \U0001f600\U0001f9d1‍\U0001f4bb",
       "▁ a text that holds the space mark", "ﬁ ligature Ⅳ ＡＢＣ", "\x00\x01 control", "ab" * 3000, "x" * 5000, "  leading and trailing  ",
       "same same same same", "same same same same"]


@pytest.fixture(scope="module")
def plain_tokens():
    bs = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars = [chr(b) for b in bs]
    for b in range(256):
        if b not in bs:
            bs.append(b)
            chars.append(chr(256 + len(bs) - 189))
    byte = dict(zip(chars, bs))
    words = {i: w for w, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True

    def tokens(text):
        """[(id, bytes)] of both, or two empty lists."""
        if not text:
            return [], []
        x = [(i, bytes(byte[c] for c in words[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            y.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == raw == b"".join(t for _, t in y) else ([], [])
    return tokens


def plain(docs, tokens):
    """Rows by document position."""
    parsed, holds = [], Counter()
    for text in docs:
        x, y = tokens(text)
        groups, i, j, at_a, at_b = [], 0, 0, 0, 0
        left, right = [], []
        while i < len(x) or j < len(y):
            if at_a <= at_b and i < len(x):
                left.append(x[i][0])
                at_a += len(x[i][1])
                i += 1
            else:
                right.append(y[j][0])
                at_b += len(y[j][1])
                j += 1
            if at_a == at_b and left and right:
                groups.append((left, right))
                left, right = [], []
        links = Counter((p, q) for left, right in groups for p in left for q in right)
        holds.update(links.keys())
        parsed.append((x, y, groups, links))
    top = defaultdict(int)
    for (p, _), n in holds.items():
        top[p] = max(top[p], n)
    out = []
    for x, y, groups, links in parsed:
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((len(x), len(y), len(groups), sum(links.values()), sum(n for k, n in links.items() if holds[k] == top[k[0]]),
                    sum(n * holds[k] for k, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                                        "groups_sha256").collect())))


@pytest.mark.parametrize("small_blocks", [False, True])
def test_odd_texts(spark, plain_tokens, monkeypatch, small_blocks):
    if small_blocks:
        for name, value in (("BLOCK", 100), ("HELD", 50), ("SLICE_BYTES", 40)):
            monkeypatch.setattr(alignment, name, value)
    ids = [None if i == 3 else i % 12 for i in range(len(ODD))]  # a null and repeated ids
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in zip(ids, ODD)],
                               "doc_id long, text string, row string, pairs string").repartition(3)
    assert rows_of(alignment.align(df, A, B)) == sorted(str((i, *r)) for i, r in zip(ids, plain(ODD, plain_tokens)))


def test_fixture_documents(spark, odd_docs, plain_tokens):  # noqa: F811
    docs = [(r.doc_id, r.text) for r in odd_docs.where("length(text) < 250000 or text is null").collect()]
    want = sorted(str((i, *r)) for (i, _), r in zip(docs, plain([t for _, t in docs], plain_tokens)))
    assert rows_of(alignment.align(odd_docs.where("length(text) < 250000 or text is null"), A, B)) == want
    assert rows_of(alignment.align(odd_docs.where("false"), A, B)) == []
    assert rows_of(alignment.align(odd_docs.where("doc_id = 2"), A, B)) == ["(2, 0, 0, 0, 0, 0, 0, '')"]


def test_query(spark, small_docs, plain_tokens):  # noqa: F811
    want = plain([t for _, t, _, _ in small_docs], plain_tokens)
    assert rows_of(QUERIES["op13_alignment"](spark, SF_SMALL)) == sorted(str((i, *r)) for (i, _, _, _), r in zip(small_docs, want))
    assert sum(r[0] > 0 for r in want) > 150


def test_ranks_give_the_ids_of_the_merges(duck):  # noqa: F811
    """Random words, texts made of awkward boundaries, very long runs and whole documents."""
    plain = Tokenizer.from_file(A)
    plain.encode_special_tokens = True
    rng = random.Random(2)
    parts = ["'s", "'S", "'", "!'", "ll", " ", "  ", "\n", "\t ", "a", "É", "ß", "1", "²", "½", "-", "—", "…", "€", "«x»", "I'm", "we've",
             "don't'", "\u00ad", "\u00a0", "\x1c", "\x85", "中", "ª", "º", "_", "<|endoftext|>", "\r\n", "„", "’s", "\x0b"]
    texts = [" " + "".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(4000)]
    texts += [" " + t for (t,) in duck.execute("SELECT text FROM read_parquet('/root/testdata/sf0.01/documents.parquet') WHERE text <> ''").fetchall()]
    texts += ["".join(rng.choices("etaoinshrdlucmfwypvbgkqjxzéèüßÅŽ", k=rng.randint(1, 25))) for _ in range(30_000)]
    texts += [" " * 3000 + "x", "x" * 20_001, "x" * 19_000, "ab" * 900, "\n" * 150 + "a", "é" * 1999]
    encode = alignment.ByteLevelEncoder(A)
    for lo in range(0, len(texts), 50):
        got = encode(texts[lo:lo + 50]).to_pylist()
        assert got == [e.ids for e in plain.encode_batch(texts[lo:lo + 50], add_special_tokens=False)]
    assert encode.ranked and sum(encode.common(t) is not None for t in texts) > 1000


def test_groups_as_text(spark, plain_tokens):
    text = "Interoperability, naïvely"
    row = alignment.groups(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).collect()[0]
    x, y = plain_tokens(text)
    assert row["groups"].replace("|", ",").replace(";", ",").count(",") + 1 == len(x) + len(y)
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"]


def test_a_group_of_many_repeats_is_not_multiplied_out():
    """3,000 equal tokens against 2,000 in one group: one pair, six million links."""
    import numpy as np
    import pyarrow as pa

    a = alignment.Aligner.__new__(alignment.Aligner)
    lists = lambda ids: lambda texts: pa.array([ids for _ in texts], pa.list_(pa.int32()))
    a.encode_a, a.encode_b = lists([1] * 3000), lists([0] * 2000)
    a.bytes_a, a.bytes_b = pa.array([b"", b"zz"], pa.binary()), pa.array([b"zzz"], pa.binary())
    a.len_a, a.len_b = pa.array([0, 2], pa.int64()), pa.array([3], pa.int64())
    a.names, a.n_b, a.pair_type = pa.array(["0", "1"]), 1, np.uint32
    a._same_bytes = lambda lists, entries, texts: np.ones(len(texts), dtype=bool)
    out = a.align(["z" * 5999])
    assert out["n_groups"].to_pylist() == [1000] and out["n_links"].to_pylist() == [6000]
    a.bytes_b, a.len_b = pa.array([b"zzz"], pa.binary()), pa.array([3], pa.int64())
    a.encode_b = lists([0])
    a.len_b = pa.array([6000], pa.int64())
    out = a.align(["z" * 5999])
    assert out["n_groups"].to_pylist() == [1] and out["n_links"].to_pylist() == [3000]
    assert len(out["pairs"][0].as_py()) == 4
