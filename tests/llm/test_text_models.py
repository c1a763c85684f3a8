"""Toxicity, perplexity and decontamination."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from llm_fixtures import SF_CHECK, SF_SMALL, duck, odd_docs, small_docs  # noqa: F401

from adpulse.llm import charlm, decontam, perplexity, toxicity
from adpulse.llm.queries import QUERIES


def counted(texts):
    low, c = charlm.symbol_table(), Counter()
    for part in charlm.chunks(texts):
        w, ends = charlm.encode(part, low)
        keep = np.ones(len(w), dtype=bool)
        keep[charlm.lead(ends, len(part))] = False
        c.update(w[keep].tolist())
    return c


def test_ngram_counts_and_distribution(spark, small_docs):
    texts = [t for _, t, _, _ in small_docs][:60]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "text string").repartition(5)
    got = {r.gram: r.n for r in charlm.count_ngrams(df).collect()}
    plain = Counter()
    for t in texts:
        s = [0] * 3 + [charlm.symbol(c) for c in t]
        for i in range(3, len(s)):
            plain[((s[i - 3] * 64 + s[i - 2]) * 64 + s[i - 1]) * 64 + s[i]] += 1
    assert got == dict(plain)
    model = charlm.Model(np.array(list(got)), np.array(list(got.values())))
    for context in [0, 5 << 12 | 3 << 6 | 9, 63 << 12 | 63 << 6 | 63, next(iter(got)) >> 6]:
        p = 2.0 ** model.log2p(np.arange(64, dtype=np.int32) + (context << 6))
        assert abs(p.sum() - 1) < 0.02, (context, p.sum())


def test_empty_model():
    model = charlm.Model(np.empty(0, dtype=np.int32), np.empty(0))
    assert np.isfinite(model.log2p(np.array([0, 5], dtype=np.int32))).all()


def test_quality_base_counts_and_labels(spark, duck):
    got = {r.doc_id: r for r in QUERIES["op2_perplexity"](spark, SF_SMALL).collect()}
    rows = duck.execute("SELECT doc_id, text, quality FROM documents LEFT JOIN labels USING (doc_id)").fetchall()
    assert len(got) == len(rows)
    for doc_id, text, _ in rows:
        w, seen, dup = re.findall(r"[^\x20\x09-\x0D]+", text or ""), set(), 0
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        c, marked = Counter(zip(w, w[1:], w[2:])), set()
        for i in range(len(w) - 2):
            if c[tuple(w[i:i + 3])] > 1:
                marked |= {i, i + 1, i + 2}
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(marked))
        assert r.base_failed == (len(w) < 50 or 100 * len(marked) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_bands_reject_noise_and_keep_clean(spark, duck):
    import duckdb
    con = duckdb.connect()
    rows = con.execute(f"SELECT doc_id, quality FROM read_parquet('{SF_CHECK}/labels.parquet')").fetchall()
    got = {r.doc_id: r for r in QUERIES["op2_perplexity"](spark, SF_CHECK).collect()}
    good = [got[i] for i, q in rows if q == 1 and not got[i].base_failed]
    bad = [got[i] for i, q in rows if q == 0 and not got[i].base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.4 * len(bad)


def test_nearly_all_junk_is_rejected(spark):
    import duckdb
    rows = duckdb.connect().execute(f"SELECT doc_id, quality FROM read_parquet('{SF_CHECK}/labels.parquet')").fetchall()
    got = {r.doc_id: r for r in QUERIES["op2_perplexity"](spark, SF_CHECK).collect()}
    good = [got[i] for i, q in rows if q == 1 and not got[i].base_failed]
    bad = [got[i] for i, q in rows if q == 0 and not got[i].base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)


def test_exact_medians(spark):
    rng = random.Random(5)
    rows = [(lang, rng.gauss(2, 0.3)) for lang in ("a", "b", None) for _ in range(101)]
    got = {r.lang: r for r in perplexity.bands(spark.createDataFrame(rows, "lang string, bits_per_char double")).collect()}
    for lang in ("a", "b", None):
        v = np.array([b for x, b in rows if x == lang])
        assert abs(got[lang].median - np.median(v)) <= perplexity.STEP
        assert abs(got[lang].mad - np.median(abs(v - np.median(v)))) <= 3 * perplexity.STEP


def test_quality_odd_rows(spark, odd_docs):
    rows = perplexity.quality(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_words == 0 and not by_id[2].kept and by_id[9].n_words == 50_000 and by_id[9].n_repeat_words == 50_000
    assert perplexity.quality(odd_docs.limit(0)).count() == 0


def test_held_out_toxicity(spark):
    import duckdb
    labels = duckdb.connect().execute(
        f"SELECT doc_id, toxic, lang FROM read_parquet('{SF_CHECK}/labels.parquet') l JOIN read_parquet('{SF_CHECK}/documents.parquet') d"
        " USING (doc_id)").fetchall()
    got = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, SF_CHECK).collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i].score, y) for i, y, lang in labels if got[i].held_out and lang == "en"]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.85, auc


def test_viterbi_restores_disguised_words(small_docs):
    c = counted([t for _, t, _, _ in small_docs])
    decoder = toxicity.Decoder(charlm.Model(np.array(list(c)), np.array(list(c.values()))))
    for word, plain in (("1d10t", "idiot"), ("m0r0n", "moron"), ("stuuuupid", "stupid"), ("m o r o n", "moron"),
                        ("$tupid", "stupid"), ("s.t.u.p.i.d", "stupid"), ("tr4sh", "trash")):
        text = f"you are {word} today"
        assert word in toxicity.disguised(text), word
        assert plain in toxicity.restored_words(text, decoder)[0], (word, toxicity.restore_text(text, decoder))
    assert toxicity.disguised("Plain words, with 42 numbers and the end.") == {}
    assert toxicity.restored_words(None, decoder) == (set(), 0)


def test_viterbi_restores_disguise_of_any_length(small_docs):
    import time
    c = counted([t for _, t, _, _ in small_docs])
    decoder = toxicity.Decoder(charlm.Model(np.array(list(c)), np.array(list(c.values()))))
    for word, plain in (("st" + "u" * 60 + "pid", "stupid"), ("a_perfectly_ordinary_and_long_word_m0r0n_in_it", "moron"),
                        ("idio7", "idiot"), ("5tup1d", "stupid"), ("-".join("what a very long and tr4sh filled name".split()), "trash")):
        assert plain in toxicity.restored_words(f"you are {word} today", decoder)[0], (word, decoder.restore(word))
    for word in ("a$$", "a55", "5h17"):
        assert word in toxicity.disguised(f"you are {word} today"), word
    spaced = " ".join("thisisaverylongspacedsentencethatsayssomebodyisamoron")
    assert spaced in toxicity.disguised(spaced) and len(decoder.restore(spaced)) < len(spaced)
    for text in ("m0r0n" * 20_000, "a " * 50_000, "u" * 200_000, "a1_" * 50_000, "$" * 100_000 + "a"):
        start = time.perf_counter()
        toxicity.restored_words(text, decoder)
        assert time.perf_counter() - start < 30, text[:10]


def test_toxicity_sees_through_disguise(spark):
    plain = [(i, "what a lovely day in the quiet garden " * 3, 0) for i in range(60)]
    toxic = [(100 + i, "you are a stupid moron and an idiot " * 2, 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in plain + toxic] + [(500, "you st0opid m0r0n, 1d1ot"), (501, None), (502, "")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in plain + toxic] + [(None, 1), (7, None)], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, scorer).collect()}
    assert got[500].score > 0.5 and got[500].n_restored >= 2 and got[501].score < 0.5 and got[502].score < 0.5
    assert got[0].score < 0.5 < got[100].score
    none = toxicity.fit(docs, labels.limit(0))
    assert all(r.score < 0.5 for r in toxicity.score(docs, none).collect())
    assert toxicity.score(docs.limit(0), scorer).count() == 0


def test_toxicity_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, 1), (6, 0)], "doc_id long, toxic int")
    assert toxicity.score(odd_docs, toxicity.fit(odd_docs, labels)).count() == odd_docs.count()


def brute_tiles(a, b, m):
    am, bm, out = [0] * len(a), [0] * len(b), []
    while True:
        best, found = m - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while (i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] >= 0 and not am[i + k] and not bm[j + k]):
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best and k >= m:
                    found.append((i, j))
        if best < m:
            return out
        for i, j in found:
            if not any(am[i:i + best]) and not any(bm[j:j + best]):
                am[i:i + best] = bm[j:j + best] = [1] * best
                out.append((i, j, best))


def test_tiling_against_brute_force():
    rng = random.Random(2)
    for _ in range(800):
        a = [rng.randint(0, 5) for _ in range(rng.randint(4, 22))]
        b = [rng.randint(-1, 5) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            c = rng.randint(0, len(a))
            b += a[c:] + a[:c]
        assert sorted(decontam.tile(a, b, 3)) == sorted(brute_tiles(a, b, 3))


def test_contamination_query_against_brute_force(spark, duck, small_docs):
    got = {(r.doc_id, r.item_id): r.covered for r in QUERIES["op3_decontam"](spark, SF_SMALL).collect()}
    items = [(i, decontam.words_of(t)) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()]
    want = {}
    for doc_id, text, _, _ in small_docs:
        words = decontam.words_of(text)
        grams = set(zip(words, words[1:], words[2:], words[3:]))
        for item_id, item in items:
            if not grams.isdisjoint(zip(item, item[1:], item[2:], item[3:])):
                ids = {w: k for k, w in enumerate(dict.fromkeys(item))}
                # every word the item lacks ends a match: only runs of item words matter
                covered = sum(n for *_, n in brute_tiles([ids[w] for w in item], [ids.get(w, -1) for w in words], 4)) \
                    if len(words) < 1500 else sum(n for *_, n in decontam.tile([ids[w] for w in item], [ids.get(w, -1) for w in words], 4))
                if covered >= 0.5 * len(item):
                    want[doc_id, item_id] = covered
    assert got == want and want


def test_reordered_passages_and_blocks(spark):
    item = "the quick brown fox jumps over the lazy dog while seven small birds sing near the old stone bridge at dawn"
    w = item.split()
    moved = " ".join(w[14:] + ["filler"] + w[7:14] + ["more"] + w[:7])
    docs = spark.createDataFrame([(1, "x y z " + item.upper()), (2, moved), (3, "nothing like it at all"), (4, None), (5, "")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, None), (12, "too short"), (13, ""), (14, item)], "item_id long, text string")
    one = {r.doc_id: sorted(h.item_id for h in r.hits) for r in decontam.find_contamination(docs, bench).collect()}
    many = {r.doc_id: sorted(h.item_id for h in r.hits) for r in decontam.find_contamination(docs, bench, block_bytes=30).collect()}
    assert one == many == {1: [10, 14], 2: [10, 14], 3: [], 4: [], 5: []}
    assert decontam.find_contamination(docs, bench.limit(0)).where("size(hits) > 0").count() == 0
    assert decontam.find_contamination(docs.limit(0), bench).count() == 0


def test_contamination_odd_rows(spark, odd_docs):
    bench = spark.createDataFrame([(1, "tok tok tok tok tok tok tok tok"), (2, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    got = {r.doc_id: [h.item_id for h in r.hits] for r in decontam.find_contamination(odd_docs, bench).collect()}
    assert got[1] == got[5] == [2] and got[9] == [1] and got[2] == []
