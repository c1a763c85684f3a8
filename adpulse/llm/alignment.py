"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same text.

Tokenizer A is a byte-level BPE (``tokenizers`` JSON), B a piece model
(``sentencepiece``). A document is encoded by both as space + text; where a
token of A and one of B end at the same byte, a group ends. All A-B pairs of
occurrences inside a group are links. The count of an id pair is the number of
documents that hold it linked.

1. *Groups*, per Arrow slice and without a loop over tokens: the id lists are
   flattened with their parent indices, token lengths summed up within each
   document (a running sum less its value at the document's start), and the
   keys (document, end) of both sides met by an Acero hash join.
2. *Links*: equal ids of a group are counted first, so a group in which a token
   is repeated n times yields one row, then multiplied out and grouped by
   (document, pair). A document keeps its distinct pairs and their multiples.
3. *Counts*: tasks count documents per pair with ``Table.group_by``, holding at
   most ``HELD`` pairs; Spark adds the partial counts up.
4. *Per document sums* over the pair counts. Counts go to the tasks in blocks
   of ``BLOCK`` pairs, one job a block, so a broadcast is bounded (some 70 MB).

The vocabulary files are read where the tasks run; their paths are parameters.

Defined results: null and empty texts, and texts whose joined token bytes
differ from space + text (one that holds U+2581, or that a piece model's
normalization changes) have no tokens: zeros and an empty ``groups_sha256``.
Repeated rows and ids, null ids included, are documents of their own. Ties for
an A id's highest count all count as best. Very long texts are encoded whole,
in a slice of their own. An empty table gives no rows. Only the id and text
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored

BLOCK = 1 << 22  # id pairs whose counts are broadcast at once
HELD = 1 << 21  # id pairs that a task counts before it passes them on
SLICE_BYTES = 1 << 20  # text that a task aligns at once (one document, if it is longer)

_GROUPS = ("id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
           "pairs binary, times binary")


def byte_level_entries(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE vocabulary file. Printable
    bytes stand for themselves, the others in order for the characters from 256."""
    import json

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte_of.values())}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    whole = {t["content"]: t["id"] for t in spec["added_tokens"]}
    entries = [b""] * (1 + max([*spec["model"]["vocab"].values(), *whole.values()]))
    for word, i in spec["model"]["vocab"].items():
        entries[i] = word.encode() if word in whole else bytes(byte_of[c] for c in word)
    for word, i in whole.items():
        entries[i] = word.encode()
    return entries


def piece_entries(model) -> list[bytes]:
    """The bytes of each piece: U+2581 is a space, <0xHH> the byte HH."""
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]


class _Side:
    """The tokens of one tokenizer for the valid documents of a slice."""

    def __init__(self, lists, lengths):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        self.ids = pc.list_flatten(lists)
        self.doc = pc.list_parent_indices(lists).to_numpy()
        total = pc.cumulative_sum(lengths.take(self.ids)).to_numpy()
        before = np.concatenate([[0], total])[lists.offsets.to_numpy()[:-1]]
        self.per_doc = np.diff(lists.offsets.to_numpy())
        self.key = (self.doc << 32) + total - before[self.doc]
        self.table = pa.table({"key": self.key, "at": np.arange(len(self.key))})

    def cut(self, last, names) -> None:
        """Group numbers of the tokens, given the positions of groups' last tokens."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        ends = np.zeros(len(self.key), dtype=np.int64)
        ends[last] = 1
        self.group = np.cumsum(ends) - ends
        offsets = np.concatenate([[0], last + 1]).astype(np.int32)
        self.text = pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(self.ids)), ",")

    def distinct(self, n_groups: int):
        """(group, id, times) of the ids of a group, in order of groups; rows and first row of each group."""
        import numpy as np
        import pyarrow as pa

        ids = self.ids.to_numpy()
        alone = np.bincount(self.group, minlength=n_groups)[self.group] == 1  # most groups: nothing to count
        t = pa.table({"g": self.group[~alone], "id": ids[~alone]}).group_by(["g", "id"], use_threads=False).aggregate([([], "count_all")])
        g, i, n = (np.concatenate([a, t.column(c).to_numpy()]) for a, c in
                   ((self.group[alone], "g"), (ids[alone], "id"), (np.ones(int(alone.sum()), dtype=np.int64), "count_all")))
        order = np.argsort(g, kind="stable")
        g, i, n = g[order], i[order], n[order]
        rows = np.bincount(g, minlength=n_groups)
        return g, i.astype(np.int64), n, rows, np.concatenate([[0], np.cumsum(rows)])[:-1]


def _pair_type(n_a: int, n_b: int):
    import numpy as np
    return np.uint32 if n_a * n_b <= 1 << 32 else np.int64


# The pattern by which byte-level BPE splits a text before its merges, and texts that are left to
# the tokenizer's own splitter: characters on whose classes versions of Unicode differ, and very long runs.
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_COMMON = "[\\t\\n\\r\\x20-\\x7e\\u00a1-\\u017f\\u2013-\\u201e\\u2026\\u20ac]*"
_RUN, _RUN_IN = r"\s{2000}|\S{2000}", 20_000  # looked for in texts of that length


class ByteLevelEncoder:
    """Ids of texts by the vocabulary file of a byte-level BPE. Where the file's
    merges come in the order of the ids they make, merging by rank (tiktoken, made
    from the same file) gives the same ids in a quarter of the time."""

    def __init__(self, path: str):
        import json

        import re

        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        self.encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        self.common, self.run = re.compile(_COMMON).fullmatch, re.compile(_RUN).search
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, vocab = spec["pre_tokenizer"] or {}, spec["model"]["vocab"]
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        self.ranked = None
        if (spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                and not split.get("add_prefix_space") and all(x < y for x, y in zip(made, made[1:]))):
            added = {t["id"] for t in spec["added_tokens"]}
            ranks = {e: i for i, e in enumerate(byte_level_entries(path)) if i not in added}
            self.ranked = tiktoken.Encoding("own", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, texts: list[str]):
        """One list of ids per text."""
        import pyarrow as pa

        whole = [self.ranked is None or not self.common(t) or (len(t) > _RUN_IN and self.run(t) is not None) for t in texts]
        rest = iter(self.encode([t for t, w in zip(texts, whole) if w], add_special_tokens=False))
        return pa.array([next(rest).ids if w else self.ranked(t) for t, w in zip(texts, whole)], pa.list_(pa.int32()))


class Aligner:
    """Encodes and aligns slices of texts; made inside a task."""

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import pyarrow as pa
        import sentencepiece

        b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.encode_a = ByteLevelEncoder(a_path)
        self.encode_b = lambda texts: pa.array(b.encode(texts, num_threads=1), pa.list_(pa.int32()))
        self.bytes_a, self.bytes_b = (pa.array(e, pa.binary()) for e in (byte_level_entries(a_path), piece_entries(b)))
        self.len_a, self.len_b = (pa.array([len(x) for x in e.to_pylist()], pa.int64()) for e in (self.bytes_a, self.bytes_b))
        self.names = pa.array([str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))])
        self.n_b = len(self.bytes_b)
        self.pair_type = _pair_type(len(self.bytes_a), self.n_b)

    def _same_bytes(self, lists, entries, texts: list[bytes]):
        """Which documents' joined token bytes are their text."""
        import numpy as np

        joined = entries.take(lists.flatten())
        if not len(joined):
            return np.array([not t for t in texts], dtype=bool)
        starts = np.frombuffer(joined.buffers()[1], dtype=np.int32)[:len(joined) + 1][lists.offsets.to_numpy()]
        data = joined.buffers()[2].to_pybytes()
        return np.array([data[x:y] == t for x, y, t in zip(starts.tolist(), starts[1:].tolist(), texts)], dtype=bool)

    def align(self, texts: list[str | None]) -> dict:
        """Columns of ``_GROUPS`` but the id, as Arrow arrays in row order."""
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        n = len(texts)
        counts = {c: np.zeros(n, dtype=np.int64) for c in ("n_a", "n_b", "n_groups", "n_links", "pairs")}
        written = [""] * n
        at = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
        spaced = [" " + texts[i] for i in at]
        a, b = self.encode_a(spaced), self.encode_b([texts[i] for i in at])
        raw = [t.encode() for t in spaced]
        valid = self._same_bytes(a, self.bytes_a, raw) & self._same_bytes(b, self.bytes_b, raw)
        at, a, b = at[valid], a.filter(pa.array(valid)), b.filter(pa.array(valid))
        pairs, times = np.empty(0, dtype=self.pair_type), np.empty(0, dtype=np.int32)
        if len(at):
            x, y = _Side(a, self.len_a), _Side(b, self.len_b)
            met = x.table.join(y.table, "key", join_type="inner", right_suffix="_b", use_threads=False).sort_by("key")
            x.cut(met.column("at").to_numpy(), self.names)
            y.cut(met.column("at_b").to_numpy(), self.names)
            doc = met.column("key").to_numpy() >> 32
            counts["n_a"][at], counts["n_b"][at] = x.per_doc, y.per_doc
            groups = np.bincount(doc, minlength=len(at))
            counts["n_groups"][at] = groups
            sides = pc.binary_join_element_wise(x.text, y.text, "|")
            texts_ = pc.binary_join(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(groups)]).astype(np.int32), sides), ";")
            for i, t in zip(at, texts_.to_pylist()):
                written[i] = t

            ga, ia, na, _, _ = x.distinct(len(doc))
            _, ib, nb, rows_b, first_b = y.distinct(len(doc))
            partners = rows_b[ga]
            left = np.repeat(np.arange(len(ga)), partners)
            right = np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners) + first_b[ga][left]
            links = pa.table({"doc": doc[ga][left], "pair": ia[left] * self.n_b + ib[right], "times": na[left] * nb[right]})
            links = links.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")]).sort_by([("doc", "ascending"), ("pair", "ascending")])
            of, much = links.column("doc").to_numpy(), links.column("times_sum").to_numpy()
            ends = np.concatenate([[0], np.cumsum(much)])
            bounds = np.searchsorted(of, np.arange(len(at) + 1))
            counts["n_links"][at] = np.diff(ends[bounds])
            counts["pairs"][at] = np.diff(bounds)
            pairs, times = links.column("pair").to_numpy().astype(self.pair_type), much.astype(np.int64)
        held = np.concatenate([[0], np.cumsum(counts.pop("pairs"))])
        out = {c: pa.array(v) for c, v in counts.items()}
        out["groups_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in written])
        out["groups"] = pa.array(written)
        for name, values in (("pairs", pairs), ("times", times)):
            offsets = (held * values.itemsize).astype(np.int32)
            out[name] = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])
        return out


def _slices(batch, column: int) -> Iterator:
    """Slices of a batch, each with at most SLICE_BYTES of text or one row."""
    import numpy as np
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin, done = 0, 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(size, done + SLICE_BYTES, side="right")))
        yield batch.slice(begin, end - begin)
        begin, done = end, int(size[end - 1])


def groups(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
           with_text: bool = True) -> DataFrame:
    """One row per document: counts, the groups as text (``with_text``) and
    digest, and the distinct linked pairs with their multiples, packed."""
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = _GROUPS if with_text else _GROUPS.replace("groups string, ", "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        aligner = Aligner(a_path, b_path)
        for piece in (s for whole in batches for s in _slices(whole, 1)):
            columns = aligner.align(piece.column(1).to_pylist()) | {"id": piece.column(0)}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return src.mapInArrow(run, schema)


def pair_counts(packed: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """(pair, docs): how many documents hold a pair linked; pair is a * n_b + b."""
    kind = _pair_type(n_a, n_b)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def merged(tables):
            t = pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("docs", "sum")])
            return t.rename_columns({"docs_sum": "docs"}).select(["pair", "docs"])

        held = []
        for b in batches:
            pair = np.frombuffer(b"".join(b.column(0).to_pylist()), dtype=kind).astype(np.int64)
            held.append(pa.table({"pair": pair, "docs": np.ones(len(pair), dtype=np.int64)}))
            if sum(t.num_rows for t in held) > HELD:
                held = [merged(held)]
                if held[0].num_rows > HELD // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from merged(held).to_batches()

    return packed.select("pairs").mapInArrow(run, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))


def _looked_up(packed: DataFrame, block: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """(row, n_best, count_sum) over the links whose pair is in ``block`` (pair, docs, best)."""
    import numpy as np

    kind, table = _pair_type(n_a, n_b), block.toArrow().sort_by("pair")
    known = packed.sparkSession.sparkContext.broadcast(
        (table.column("pair").to_numpy().astype(kind), table.column("docs").to_numpy(), table.column("best").to_numpy().astype(np.int64)))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keys, docs, best = known.value
        for b in batches:
            packs = b.column(1).to_pylist()
            pair = np.frombuffer(b"".join(packs), dtype=kind)
            times = np.frombuffer(b"".join(b.column(2).to_pylist()), dtype=np.int64)
            at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            times = np.where(keys[at] == pair, times, 0)
            ends = np.concatenate([[0], np.cumsum([len(p) // np.dtype(kind).itemsize for p in packs], dtype=np.int64)])
            per_doc = lambda v: pa.array(np.diff(np.concatenate([[0], np.cumsum(v)])[ends]))
            yield pa.RecordBatch.from_arrays([b.column(0), per_doc(times * best[at]), per_doc(times * docs[at])],
                                             names=["row", "n_best", "count_sum"])

    return packed.select("row", "pairs", "times").mapInArrow(run, "row long, n_best long, count_sum long")


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id_col, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    import sentencepiece

    n_a = len(byte_level_entries(a_path))
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    docs = Stored(groups(df, a_path, b_path, id_col, text_col, with_text=False).withColumn("row", F.monotonically_increasing_id()),
                  "aligned").df
    counts = Stored(pair_counts(docs, n_a, n_b).withColumn("a", F.expr(f"pair div {n_b}")), "pair-counts").df
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    blocks = max(1, -(-counts.count() // BLOCK))
    ranked = Stored(counts.join(top, "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"),
                                                 F.pmod(F.xxhash64("pair"), F.lit(blocks)).alias("block")), "pair-ranks").df
    sums = None
    for j in range(blocks):
        block = ranked.where(F.col("block") == j).select("pair", "docs", "best")
        if block.isEmpty():
            continue
        found = Stored(_looked_up(docs, block, n_a, n_b), "pair-sums").df
        sums = found if sums is None else sums.unionByName(found)
    head = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    if sums is None:
        summed = docs.select(*head, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    else:
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        summed = docs.select("row", *head).join(sums, "row")
    return summed.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
