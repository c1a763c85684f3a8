"""Toxicity of deobfuscated text.

1. *Noisy channel.* Disguised words are found by their shape: signs or digits
   inside a word (leetspeak), a letter three times or more in a row, single
   letters with the same separator between them. Each becomes a lattice: every observed
   character may stand for its own letter or for those it resembles, a
   repeated letter may be written once or twice, a separator may be dropped. Viterbi
   decoding takes the path with the best sum of channel and language model
   log-probabilities; the model is the character model of all documents
   (``charlm``). Every other word is a lattice with one path.
2. *Evidence.* Features of the restored text are its distinct words and their
   prefixes of 3 to 6 letters. From the labelled documents' counts each gets the lower
   95 % bound of its log likelihood ratio; features that favour toxic
   documents by less than ``MIN_EVIDENCE`` are dropped. A document's evidence
   is the sum of squares over its ``TOP`` strongest words, a word counted by its
   strongest feature: one word that only toxic documents have outweighs
   several that are a little more frequent there.
3. *Score.* A logistic curve fitted to the training documents' evidence.

Only labels, and only of rows chosen for training, enter the weights. At most
``MAX_TRAIN`` labelled documents (those with the smallest id hashes, a documented bound) are used to fit;
the language model counts all documents.

Defined results: null and empty texts have no evidence and the score of none;
rows without a label train nothing; with no toxic training row every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import charlm
from .common import SLICE, map_batches, stored

MAX_TRAIN = 40_000
TOP = 4
UNIT = 20.0  # scale of the squared weights
MIN_EVIDENCE = 0.7
MIN_SEEN = 4
PREFIXES = (3, 4, 5, 6)
Z = 1.64

RESULT = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("evidence", T.DoubleType()),
    T.StructField("n_restored", T.IntegerType())])

# What a sign or digit may stand for, with its channel cost in bits (fixed values).
LEET = {
    "0": {"o": 1.0}, "1": {"i": 1.5, "l": 1.5}, "2": {"z": 2.0}, "3": {"e": 1.0}, "4": {"a": 1.0}, "5": {"s": 1.0},
    "6": {"g": 2.0, "b": 2.0}, "7": {"t": 1.0}, "8": {"b": 1.0}, "9": {"g": 1.5}, "@": {"a": 0.5}, "$": {"s": 0.5},
    "!": {"i": 0.5, "l": 2.0}, "|": {"i": 1.5, "l": 1.5}, "+": {"t": 1.0}, "€": {"e": 0.5},
    "*": {"a": 3.0, "e": 3.0, "i": 3.0, "o": 3.0, "u": 3.0},
}
AS_IS, AT_END = 6.0, 0.5  # a sign inside a word, or at its end, that stands for itself
DROP_REPEAT, DROP_SEPARATOR, KEEP_SEPARATOR = 0.5, 0.5, 3.0

_SIGNS = "0-9@$!|+€*"
_LEET = re.compile(rf"[{_SIGNS}]{{1,3}}(?=[A-Za-z])")
_LEET_END = re.compile(rf"(?<=[A-Za-z])[{_SIGNS}]+(?![A-Za-z{_SIGNS}])")
_REPEAT = re.compile(r"([A-Za-z])\1\1")
_JOINTS = re.compile(r"[.\-_/]+")
_SIGN_OR_REPEAT = re.compile(rf"[{_SIGNS}]|{_REPEAT.pattern}")
_LONG_REPEAT = re.compile(r"([a-z])\1{3,}")
_SPACED = re.compile(rf"(?<!\S)[A-Za-z{_SIGNS}](?:([ .\-_])[A-Za-z{_SIGNS}])(?:\1[A-Za-z{_SIGNS}]){{2,}}(?![A-Za-z0-9])")
_RUN = re.compile(rf"[ .\-_][A-Za-z{_SIGNS}][ .\-_][A-Za-z{_SIGNS}][ .\-_]")  # inside every spaced word
_LETTERS = bytes(i if i >= 0x80 or chr(i).isalpha() else 0x20 for i in range(256))
_WIDE_MARKS = "“”‘’«»…—–¿¡"
_EDGE = ".,;:?\"'()[]{}<>#%&~`^=/\\"
CACHED = 64  # readings of longer tokens are not kept for the next text


class Decoder:
    """Viterbi decoding of one token's character lattice."""

    def __init__(self, model):
        self.model, self.cache, self.known, self.readings = model, {}, {}, {}

    def _costs(self, context: int) -> list[float]:
        """Cost in bits of every symbol after a context of three."""
        import numpy as np
        got = self.known.get(context)
        if got is None:
            if len(self.known) > 10_000:
                self.known.clear()
            after = np.arange(charlm.SYMBOLS, dtype=np.int32) + (context << charlm.BITS)
            got = self.known[context] = (-self.model.log2p(after)).tolist()
        return got

    def restore(self, token: str) -> str:
        """The most probable reading of a disguised token, in lower case."""
        if len(token) > CACHED:
            return self._decode(token.lower())
        out = self.cache.get(token)
        if out is None:
            if len(self.cache) > 50_000:
                self.cache.clear()
            out = self.cache[token] = self._decode(token.lower())
        return out

    def _readings(self, ch: str, at_end: bool, long_run: bool) -> tuple:
        """(letter, symbol, channel cost) of everything that a character may stand for; '' drops it."""
        got = self.readings.get((ch, at_end, long_run))
        if got is None:
            if ch in " .-_":
                options = {" ": KEEP_SEPARATOR, "": DROP_SEPARATOR}
            elif ch in LEET:
                options = {**LEET[ch], ch: AT_END if at_end else AS_IS}
            else:
                options = {ch: 0.0}
            if long_run:
                options = {**options, "": DROP_REPEAT}
            if len(self.readings) > 10_000:
                self.readings.clear()
            got = self.readings[ch, at_end, long_run] = tuple((x, charlm.symbol(x) if x else -1, c) for x, c in options.items())
        return got

    def _decode(self, obs: str) -> str:
        mask = (1 << charlm.BITS * (charlm.ORDER - 1)) - 1
        obs = _LONG_REPEAT.sub(r"\1\1\1", obs)
        tail = len(obs.rstrip("0123456789@$!|+€*"))
        # state: context of three symbols -> (cost, path); the best path to each, linked backwards:
        # linear in a token of any length
        beam: dict[int, tuple] = {0: (0.0, None)}
        known, bits = self.known, charlm.BITS
        for i, ch in enumerate(obs):
            run = ch.isalpha() and i and obs[i - 1] == ch
            long_run = bool(run and (i >= 2 and obs[i - 2] == ch or obs[i + 1:i + 2] == ch))
            options = self._readings(ch, i >= tail, long_run)
            step: dict[int, tuple] = {}
            best = step.get
            if len(options) == 1:  # a letter that stands for itself
                letter, s, channel = options[0]
                for context, (cost, path) in beam.items():
                    state = ((context << bits) | s) & mask
                    total = cost + channel + (known.get(context) or self._costs(context))[s]
                    old = best(state)
                    if old is None or total < old[0]:
                        step[state] = (total, (path, letter))
                beam = step
                continue
            for context, (cost, path) in beam.items():
                costs, shifted = known.get(context) or self._costs(context), context << bits
                for letter, s, channel in options:
                    if s >= 0:
                        state, total = (shifted | s) & mask, cost + channel + costs[s]
                    else:
                        state, total = context, cost + channel
                    old = best(state)
                    if old is None or total < old[0]:
                        step[state] = (total, (path, letter) if letter else path)
            beam = step
        path = min([(cost + (known.get(c) or self._costs(c))[0], c) for c, (cost, _) in beam.items()])[1]
        path, out = beam[path][1], []
        while path is not None:
            path, letter = path
            out.append(letter)
        return "".join(reversed(out))


def words_of(text: str) -> set[str]:
    """Distinct lower-cased runs of letters."""
    text = text.lower()
    for mark in _WIDE_MARKS:
        if mark in text:
            text = text.replace(mark, " ")
    return set(text.encode("utf-8", "surrogatepass").translate(_LETTERS).decode("utf-8", "surrogatepass").split())


def _disguised_at(text: str) -> Iterator[int]:
    """Places of signs inside, before or after a word's letters, and of repeats."""
    for m in _LEET.finditer(text):
        a = m.start()
        before = text[a - 1:a]
        if before.isalpha() and before.isascii() or (not before or before.isspace()) and text[m.end() + 1:m.end() + 2].isalpha():
            yield a
    for m in _LEET_END.finditer(text):
        if m[0].strip("!"):  # a word's exclamation marks are its punctuation
            yield m.start()
    yield from _repeats_at(text)


def _repeats_at(text: str) -> list[int]:
    """Places where an ASCII letter stands three times in a row."""
    import numpy as np

    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    same = c[1:] == c[:-1]
    at = np.flatnonzero(same[1:] & same[:-1])
    return at[((c[at] | 32) - 97) < 26].tolist()


def disguised(text: str) -> dict[str, None]:
    """The disguised tokens of a text, each once."""
    out: dict[str, None] = {}
    n, b = len(text), 0
    for at in sorted(_disguised_at(text)):
        if at < b:
            continue
        a = b = at
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        while b < n and not text[b].isspace():
            b += 1
        token = text[a:b].strip(_EDGE).rstrip("!|")
        if len(token) >= 3 and "@" not in token[1:-1].replace("@", "", 1) and any(c.isalpha() for c in token):
            out[token] = None
            for part in _JOINTS.split(token):  # words joined by marks, each on its own too
                if 3 <= len(part) < len(token) and any(c.isalpha() for c in part) and _SIGN_OR_REPEAT.search(part):
                    out[part] = None
    if _RUN.search(text):
        for m in _SPACED.finditer(text):
            out[m[0]] = None
    return out


def restored_words(text: str | None, decoder: Decoder) -> tuple[set[str], int]:
    """Distinct words of the restored text and the number of words restored."""
    text = text or ""
    words, n = words_of(text), 0
    for token in disguised(text):
        plain = decoder.restore(token)
        if plain != token.lower():
            n += 1
            words |= words_of(plain)
    return words, n


def restore_text(text: str | None, decoder: Decoder) -> str:
    """The whole text with its disguised tokens replaced by their readings."""
    text = text or ""
    for token in sorted(disguised(text), key=len, reverse=True):
        text = text.replace(token, decoder.restore(token))
    return text


def features_of(word: str) -> list[str]:
    return ["=" + word] + [word[:k] + "~" for k in PREFIXES if len(word) > k]


def _weights(docs: DataFrame, lm) -> tuple[dict[str, float], int, int]:
    """Evidence weights from the documents that each feature occurs in.

    Counts are combined per task; features that fewer than MIN_SEEN training
    documents have are left out before anything reaches the driver. What
    does is at most MAX_TRAIN documents' features."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        decoder = Decoder(lm.value)
        counts: dict[str, list[int]] = {}

        def batch():
            f, c = list(counts), list(counts.values())
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(f), pa.array([x[0] for x in c], type=pa.int64()), pa.array([x[1] for x in c], type=pa.int64())],
                names=["f", "neg", "pos"])

        for b in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words, _ = restored_words(text, decoder)
                found = {f for w in words for f in features_of(w)}
                found.add("")
                for f in found:
                    counts.setdefault(f, [0, 0])[toxic] += 1
                if len(counts) > 150_000:
                    yield batch()
        yield batch()

    rows = (docs.select("text", "toxic").mapInArrow(run, "f string, neg long, pos long").groupBy("f")
            .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")))
    total = stored(rows.where((F.col("neg") + F.col("pos") >= MIN_SEEN) | (F.col("f") == "")), "feature-counts")
    sums = total.where(F.col("f") == "").first()
    neg, pos = (sums["neg"], sums["pos"]) if sums else (0, 0)
    if not pos or not neg:
        return {}, neg, pos
    a, b = F.col("pos") + 0.5, F.col("neg") + 0.5
    lower = F.log(a / (pos + 1)) - F.log(b / (neg + 1)) - Z * F.sqrt(1 / a + 1 / b)
    kept = total.where(F.col("f") != "").select("f", lower.alias("w")).where(F.col("w") >= MIN_EVIDENCE)
    return {r["f"]: r["w"] for r in kept.toLocalIterator()}, neg, pos


class Evidence:
    """Evidence of a set of words: looks up only words that begin like a feature."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        names = [f[1:] if f[0] == "=" else f[:-1] for f in weights]
        self.heads = frozenset(n[:k] for n in names for k in (1, 2, 3) if k == 3 or len(n) == k)

    def __call__(self, words: set[str]) -> float:
        heads, weights = self.heads, self.weights
        near = [w for w in words if w[:3] in heads]
        found = sorted((max(weights.get(f, 0.0) for f in features_of(w)) for w in near), reverse=True)
        return sum(v * v for v in found[:TOP]) / UNIT


def _curve(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of the logistic curve over (evidence, label, count)."""
    import numpy as np
    x, y, n = (np.array(v, dtype=float) for v in zip(*points))
    a, b, ridge = 0.0, 0.0, 1e-2

    def loss(a, b):
        z = a * x + b
        return (n * (np.logaddexp(0.0, z) - y * z)).sum() + ridge * (a * a + b * b) / 2

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, w = n * (p - y), n * p * (1 - p)
        hess = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + ridge]])
        step, size = np.linalg.solve(hess, [(g * x).sum() + ridge * a, g.sum() + ridge * b]), 1.0
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > loss(a, b):
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        if abs(size * step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        train=None, max_train: int = MAX_TRAIN) -> dict:
    """The scorer: language model, weights and curve. ``train``: condition on
    the id, as a Column, that a labelled row must meet to be learned from."""
    spark = df.sparkSession
    lm = spark.sparkContext.broadcast(charlm.train(df, text_col))
    # one label per id: of contradicting rows the largest
    lab = labels.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where(
        "i IS NOT NULL AND toxic IN (0, 1)").groupBy("i").agg(F.max("toxic").alias("toxic"))
    if train is not None:
        lab = lab.where(train(F.col("i")))
    lab = stored(lab.orderBy(F.xxhash64("i"), "i").limit(max_train), "labels")
    texts = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("text"))
    # at most max_train ids and labels: bounded, so the texts need no shuffle
    docs = stored(texts.join(F.broadcast(lab), "i").select("text", "toxic"), "training")
    weights, neg, pos = _weights(docs, lm)
    scorer = {"lm": lm, "weights": spark.sparkContext.broadcast(weights), "curve": (0.0, -20.0)}
    if weights:
        flag = T.StructType([T.StructField("e", T.DoubleType())])

        def start():
            decoder, evidence = Decoder(lm.value), Evidence(scorer_weights.value)
            return lambda batch: ((round(evidence(restored_words(t, decoder)[0]), 3),) for t in batch)

        scorer_weights = scorer["weights"]
        hist = (map_batches(docs, ["text"], ["toxic"], flag, start).groupBy("e", "toxic").agg(F.count("*").alias("c")))
        scorer["curve"] = _curve([(r["e"], r["toxic"], r["c"]) for r in hist.collect()])
    elif pos and not neg:
        scorer["curve"] = (0.0, 20.0)
    return scorer


def score(df: DataFrame, scorer: dict, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
          prefix: str = "") -> DataFrame:
    """``keep`` columns plus score (0 to 1), evidence and n_restored."""
    lm, weights, (slope, offset) = scorer["lm"], scorer["weights"], scorer["curve"]

    def start():
        decoder, evidence = Decoder(lm.value), Evidence(weights.value)

        def run(texts):
            for t in texts:
                words, n = restored_words(t, decoder)
                e = evidence(words)
                yield 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * e + offset)))), e, n
        return run

    return map_batches(df, [text_col], list(keep), RESULT, start, prefix)


def held_out(doc_id):
    """The fifth of the ids that nothing is learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
