"""Modified Kneser-Ney character model, counted by Spark.

Characters fall into 64 symbols, so an n-gram of order 4 is a number below
2 ** 24: a hash free of collisions. All texts are counted (each task sends its
distinct n-grams with counts, which grow with the corpus); the summed table
has at most 2 ** 24 rows, whatever the corpus, and in practice some tens of
thousands. The model keeps, per order, a sorted array of these hashes beside
arrays of probabilities and back-off weights, and is looked up by binary
search; its size is bounded by the alphabet and so may be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE

ORDER = 4
SYMBOLS = 64
BITS = 6
CHUNK = 1 << 20  # characters that are worked on at once

# Symbols (fixed values): 0 space and controls, 1-26 a-z, 27 capitals, 28 digits, 29-34 marks below,
# 35 quotes, 36 brackets, 37 dashes, 38 bar, 39 other signs, 40-63 other letters by code point.
MARKS, QUOTES, BRACKETS, DASHES, BAR = ".,!?:;", "'\"`’“”«»", "()[]{}", "-–—_/", "|"
UPPER, DIGIT, MARK, QUOTE, BRACKET, DASH, BAR_SYMBOL, SIGN, OTHER = 27, 28, 29, 35, 36, 37, 38, 39, 40


def symbol(ch: str) -> int:
    if "a" <= ch <= "z":
        return ord(ch) - 96
    if ch <= " " or ch.isspace():
        return 0
    if ch.isupper():
        return UPPER
    if ch.isdigit():
        return DIGIT
    if ch in MARKS:
        return MARK + MARKS.index(ch)
    for signs, s in ((QUOTES, QUOTE), (BRACKETS, BRACKET), (DASHES, DASH), (BAR, BAR_SYMBOL)):
        if ch in signs:
            return s
    return OTHER + ord(ch) % (SYMBOLS - OTHER) if ch.isalpha() else SIGN


def symbol_table():
    import numpy as np
    low = np.array([symbol(chr(c)) for c in range(0x3000)], dtype=np.int32)
    return low


def encode(texts: list[str], low):
    """(windows, ends): the order-4 hash that ends at every character of the
    concatenated texts, each led by ORDER - 1 spaces, and each text's end."""
    import numpy as np
    pad = " " * (ORDER - 1)
    big = np.frombuffer((pad + "".join(pad + t for t in texts)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    s = low[np.minimum(big, 0x2FFF)]
    far = big >= 0x3000
    if far.any():
        s[far] = OTHER + big[far] % (SYMBOLS - OTHER)
    w = s[:len(s) - ORDER + 1].copy()
    for k in range(1, ORDER):
        w <<= BITS
        w |= s[k:len(s) - ORDER + 1 + k]
    ends = np.cumsum([len(t) + ORDER - 1 for t in texts])
    return w, ends


def chunks(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts in order, in lists of about CHUNK characters."""
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1]) + ORDER
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def lead(ends, n: int):
    """Positions of the leading spaces (they end no n-gram of their text)."""
    import numpy as np
    starts = np.concatenate([[0], ends[:-1]]) if n else np.empty(0, dtype=np.int64)
    return (starts[:, None] + np.arange(ORDER - 1)[None, :]).ravel()


def count_ngrams(df: DataFrame, text_col: str = "text", others: tuple[str, ...] = (), start=None) -> DataFrame:
    """(gram, n): order-4 counts of all texts. ``start()``, if given, runs once
    per task and returns a function that takes one list per column, text and
    ``others``, and gives the texts to count."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        low = symbol_table()
        pick = start() if start else lambda texts: texts
        grams, counts, held = [], [], 0

        def merged():
            g, inv = np.unique(np.concatenate(grams), return_inverse=True)
            return g, np.bincount(inv, weights=np.concatenate(counts)).astype(np.int64)

        for b in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            for texts in chunks(pick(*[c.to_pylist() for c in b.columns])):
                w, ends = encode(texts, low)
                keep = np.ones(len(w), dtype=bool)
                keep[lead(ends, len(texts))] = False
                g, c = np.unique(w[keep], return_counts=True)
                grams.append(g)
                counts.append(c.astype(np.int64))
                held += len(g)
                if held > 1_000_000:
                    g, c = merged()
                    grams, counts, held = [g], [c], 0
        if grams:
            g, c = merged()
            for i in range(0, len(g), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(g[i:i + 100_000].astype(np.int32)),
                                                  pa.array(c[i:i + 100_000])], names=["gram", "n"])

    return (df.select(F.col(f"`{text_col}`").alias("t"), *[F.col(f"`{c}`") for c in others]).mapInArrow(run, "gram int, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")))


class Model:
    """Interpolated modified Kneser-Ney probabilities of the orders 1 to 4."""

    def __init__(self, grams, counts):
        import numpy as np
        order = np.argsort(grams)
        grams, counts = np.asarray(grams, dtype=np.int32)[order], np.asarray(counts, dtype=np.float64)[order]
        by_order = {ORDER: (grams, counts)}
        for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
            g, c = np.unique(by_order[n + 1][0] & ((1 << BITS * n) - 1), return_counts=True)
            by_order[n] = (g, c.astype(np.float64))
        self.grams, self.logp, self.contexts, self.backoff = {}, {}, {}, {}
        lower = None
        for n in range(1, ORDER + 1):
            g, c = by_order[n]
            n1, n2, n3, n4 = (float((c == k).sum()) for k in (1, 2, 3, 4))
            y = n1 / max(1.0, n1 + 2 * n2)
            d = [0.0] + [min(max(k - (k + 1) * y * b / max(a, 1.0), 0.0), float(k))
                         for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
            if not any(d):
                d = [0.0, 0.5, 0.5, 0.5]
            cut = np.array(d)[np.minimum(c, 3).astype(np.int64)]
            ctx, inv = np.unique(g >> BITS, return_inverse=True)
            total = np.bincount(inv, c) if len(g) else np.empty(0)
            free = np.bincount(inv, cut) / total if len(g) else np.empty(0)
            p = (c - cut) / total[inv]
            if n == 1:
                p = p + free[0] / SYMBOLS if len(g) else p
                self.floor = float(np.log2(free[0] / SYMBOLS)) if len(g) and free[0] > 0 else -20.0
            else:
                below, lp = lower
                p = p + free[inv] * lp[np.searchsorted(below, g & ((1 << BITS * (n - 1)) - 1))]
            lower = (g, p)
            self.grams[n], self.logp[n] = g, np.log2(p).astype(np.float32)
            self.contexts[n], self.backoff[n] = ctx.astype(np.int32), np.log2(np.maximum(free, 1e-12)).astype(np.float32)

    @staticmethod
    def _find(keys, x):
        import numpy as np
        if not len(keys):
            return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
        pos = np.searchsorted(keys, x)
        pos[pos == len(keys)] = 0
        return pos, keys[pos] == x

    def dense(self):
        """The order-4 probabilities laid out by hash, 64 MB whatever the
        corpus, for ``log2p`` over whole texts; NaN: not counted."""
        import numpy as np
        out = np.full(1 << BITS * ORDER, np.nan, dtype=np.float32)
        out[self.grams[ORDER]] = self.logp[ORDER]
        return out

    def log2p(self, windows, dense=None):
        """log2 probability of the last symbol of each order-4 hash."""
        import numpy as np
        if dense is not None:
            out = dense[windows].astype(np.float64)
            left = np.flatnonzero(np.isnan(out))
            out[left] = 0.0
        else:
            pos, hit = self._find(self.grams[ORDER], windows)
            out = np.zeros(len(windows), dtype=np.float64)
            if len(self.grams[ORDER]):
                out[hit] = self.logp[ORDER][pos[hit]]
            left = np.flatnonzero(~hit)
        weight = np.zeros(len(left))
        for n in range(ORDER, 0, -1):
            if n < ORDER:
                x = windows[left] & ((1 << BITS * n) - 1)
                pos, hit = self._find(self.grams[n], x)
                if hit.any():
                    out[left[hit]] = weight[hit] + self.logp[n][pos[hit]]
                left, weight = left[~hit], weight[~hit]
            if n > 1 and len(left):
                x = (windows[left] & ((1 << BITS * n) - 1)) >> BITS
                pos, known = self._find(self.contexts[n], x)
                if known.any():
                    weight[known] += self.backoff[n][pos[known]]
        out[left] = weight + self.floor
        return out


def train(df: DataFrame, text_col: str = "text", others: tuple[str, ...] = (), start=None) -> Model:
    """The model of all texts of ``df``, or of those that ``start`` picks; at
    most 2 ** 24 counted n-grams."""
    import numpy as np
    t = count_ngrams(df, text_col, others, start).toArrow()
    return Model(t.column("gram").to_numpy().astype(np.int32), t.column("n").to_numpy())
