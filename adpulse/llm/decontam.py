"""Benchmark decontamination by greedy string tiling.

1. *Seeds.* Every run of ``MIN_MATCH`` words of a benchmark item is a seed.
   The benchmark is taken in blocks of at most ``BLOCK_BYTES`` of text; a
   block's seeds are broadcast (their size is bounded by the block) and each
   block meets all documents, whose words never pass a shuffle.
2. *Bound.* The item positions that shared seeds reach bound what tiles can
   cover; a pair whose bound is below the threshold is left out.
3. *Tiling.* Running Karp-Rabin matching with greedy string tiling: unmarked
   windows of length s are hashed, equal windows extended to maximal matches,
   the longest matches marked first, then s shrinks to MIN_MATCH. Tiles never
   overlap in either text, and their order does not matter: a passage whose
   sentences were rearranged is covered all the same.
4. A document is contaminated by an item of which tiles cover at least
   ``THRESHOLD``.

Words: the lower-cased text's maximal runs of ASCII digits, letters and
non-ASCII characters. Defined results: null and empty texts have no words and no hits;
an item of fewer than MIN_MATCH words cannot be told from chance and matches
nothing; repeated items and documents are reported each.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches
from .licenses import _FOLD

MIN_MATCH = 4
THRESHOLD = 0.5
BLOCK_BYTES = 16 << 20

HITS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("item_words", T.IntegerType()),
    T.StructField("covered", T.IntegerType()), T.StructField("coverage", T.DoubleType()),
    T.StructField("tiles", T.ArrayType(T.StructType([
        T.StructField("item_start", T.IntegerType()), T.StructField("doc_start", T.IntegerType()),
        T.StructField("length", T.IntegerType())])))]))

_BASE, _MOD = 1_000_003, (1 << 61) - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _windows(ids: list[int], marked: bytearray, s: int):
    """(hash, start) of every unmarked window of length s, by a rolling hash.
    Negative ids (words the other text lacks) end a window."""
    top = pow(_BASE, s - 1, _MOD)
    h = run = 0
    for i, x in enumerate(ids):
        if x < 0 or marked[i]:
            h = run = 0
            continue
        if run == s:
            h -= ids[i - s] * top
            run -= 1
        h = (h * _BASE + x) % _MOD
        run += 1
        if run == s:
            yield h, i - s + 1


def tile(item: list[int], doc: list[int], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (item start, doc start, length), the longest first; both texts as
    word numbers, -1 for a word the other text lacks."""
    a_mark, b_mark = bytearray(len(item)), bytearray(len(doc))
    tiles: list[tuple[int, int, int]] = []
    s = max(min_match, len(item) // 2)
    while True:
        table = defaultdict(list)
        for h, i in _windows(item, a_mark, s):
            table[h].append(i)
        matches: list[tuple[int, int, int]] = []
        if table:
            for h, j in _windows(doc, b_mark, s):
                for i in table.get(h, ()):
                    if (i and j and item[i - 1] == doc[j - 1] and not a_mark[i - 1] and not b_mark[j - 1]
                            and item[i - 1] >= 0):
                        continue  # inside a longer match that starts earlier
                    n = 0
                    while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] >= 0
                           and not a_mark[i + n] and not b_mark[j + n]):
                        n += 1
                    if n >= s:
                        heapq.heappush(matches, (-n, i, j))
        while matches:
            n, i, j = heapq.heappop(matches)
            n = -n
            # what earlier tiles took of this match splits it
            free = [k for k in range(n) if not a_mark[i + k] and not b_mark[j + k]]
            if len(free) == n:
                a_mark[i:i + n] = b_mark[j:j + n] = b"\x01" * n
                tiles.append((i, j, n))
                continue
            begin = None
            for k in range(n + 1):
                open_ = k < n and not a_mark[i + k] and not b_mark[j + k]
                if open_ and begin is None:
                    begin = k
                elif not open_ and begin is not None:
                    if k - begin >= s:
                        heapq.heappush(matches, (begin - k, i + begin, j + begin))
                    begin = None
        if s <= min_match:
            return tiles
        s = max(min_match, s // 2)


class Block:
    """Seeds of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], min_match: int):
        self.m, self.items = min_match, []
        self.seeds: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if len(words) < min_match:
                continue
            k = len(self.items)
            numbers: dict[bytes, int] = {}
            ids = [numbers.setdefault(w, len(numbers)) for w in words]
            self.items.append((item_id, ids, numbers))
            for p, seed in enumerate(zip(*[words[q:] for q in range(min_match)])):
                self.seeds[seed].append((k, p))
        self.keys = frozenset(self.seeds)

    def hits(self, text: str | None, threshold: float) -> list[tuple]:
        words = words_of(text)
        grams = lambda: zip(*[words[q:] for q in range(self.m)])
        if self.keys.isdisjoint(grams()):
            return []
        reach = defaultdict(set)
        for seed in self.keys.intersection(grams()):
            for k, p in self.seeds[seed]:
                reach[k].update(range(p, p + self.m))
        out = []
        for k, positions in reach.items():
            item_id, ids, numbers = self.items[k]
            if len(positions) < threshold * len(ids):
                continue
            tiles = tile(ids, [numbers.get(w, -1) for w in words], self.m)
            covered = sum(n for _, _, n in tiles)
            if covered >= threshold * len(ids):
                out.append((item_id, len(ids), covered, covered / len(ids), sorted(tiles)))
        return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[4]))


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The items in blocks of about block_bytes (an item longer than that is a block)."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").alias("t")).where(
        F.col("t").isNotNull())
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes)
    number = F.pmod(F.xxhash64("i", "t"), F.lit(max(n, 1)))
    for b in range(n):
        yield [(r["i"], r["t"]) for r in items.where(number == b).collect()]


def find_contamination(df: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                       item_id: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH,
                       threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES, out_col: str = "hits") -> DataFrame:
    """``keep`` columns plus ``out_col``: the items that contaminate the document."""
    sc = df.sparkSession.sparkContext
    keep = tuple(c for c in keep if c.lower() != out_col.lower())
    columns = list(dict.fromkeys((*keep, text_col)))
    out = df.select(*[f"`{c}`" for c in columns], F.array().cast(HITS).alias("__hits"))
    for items in _blocks(benchmark, item_id, item_text, block_bytes):
        block = sc.broadcast(Block(items, min_match))

        def start(block=block):
            b = block.value
            return lambda texts: ((b.hits(t, threshold),) for t in texts)

        out = map_batches(out, [text_col], [*columns, "__hits"], T.StructType([T.StructField("__new", HITS)]), start)
        out = out.select(*[f"`{c}`" for c in columns], F.concat("__hits", "__new").alias("__hits"))
    return out.select(*[f"`{c}`" for c in keep], F.col("__hits").alias(out_col))
