"""Licence scan over a positional rare-token index.

The index holds, for every word of the licence templates, its postings
(template, position) and its IDF over the scanned corpus (document
frequencies are counted over all texts, one count per distinct index word
and text). For each text:

1. its distinct index words are ranked by IDF; the rarest ones that occur in
   it are looked up first;
2. every occurrence votes, weighted by IDF, for (template, text position -
   template position): a template whose words keep their relative positions
   collects its votes on one offset (neighbouring offsets within ``SLACK`` are
   added, for inserted or dropped words);
3. an alignment whose votes reach ``COVERAGE`` of the template's weight is
   confirmed only if the template's mandatory key phrase stands inside it.

Words: A-Z lower-cased, maximal runs of ASCII digits, letters and non-ASCII
characters. Beside the aligned templates the scan reports every place of the
base phrases. Defined results: a null or empty text has no words, places or
labels and score 0.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches

# Base phrases and their labels (fixed values).
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Notice templates: label, text, mandatory key phrase (fixed values).
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at",
     "except in compliance with the license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files", "permission is hereby granted free of charge"),
    ("gpl", "licensed under the gnu general public license version 3", "general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
     " public license", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution 4 0"),
    ("cc0", "released under cc0 1 0 universal", "cc0 1 0"),
)
COVERAGE = 0.7
SLACK = 2

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("places", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType())]))),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType()),
        T.StructField("coverage", T.DoubleType())])))])

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_FOLD = bytes(i + 32 if 0x41 <= i <= 0x5A else i if i in _KEEP else 0x20 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    out, i = [], -1
    last, n = phrase[-1], len(phrase)
    while True:
        try:
            i = words.index(last, i + 1)
        except ValueError:
            return out
        if i >= n - 1 and words[i - n + 1:i + 1] == phrase:
            out.append(i - n + 1)


class Index:
    """Postings and weights of the templates; bounded by the template text."""

    def __init__(self, df_counts: dict[str, int], n_texts: int):
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.idf: dict[bytes, float] = {}
        self.templates = []
        for t, (label, text, key) in enumerate(TEMPLATES):
            words = [w.encode() for w in text.split()]
            for p, w in enumerate(words):
                self.postings[w].append((t, p))
                self.idf[w] = math.log((n_texts + 1) / (df_counts.get(w.decode(), 0) + 1)) + 1.0
            self.templates.append((label, words, [w.encode() for w in key.split()]))
        self.weight = [sum(self.idf[w] for w in words) for _, words, _ in self.templates]
        self.vocabulary = frozenset(self.postings)
        # a template needs its rarest words: those without which the rest cannot reach the coverage
        self.rare = []
        for t, (_, words, _) in enumerate(self.templates):
            left, need = self.weight[t], set()
            for w in sorted(set(words), key=lambda w: (-self.idf[w], w)):
                if left < COVERAGE * self.weight[t]:
                    break
                need.add(w)
                left -= self.idf[w] * words.count(w)
            self.rare.append(need)
        self.rare_words = frozenset(w for need in self.rare for w in need)

    def match(self, words: list[bytes]) -> list[tuple[str, int, float]]:
        present = self.vocabulary.intersection(words)
        rare = present & self.rare_words
        live = {t for t, need in enumerate(self.rare) if need & rare}
        if not live:
            return []
        at = defaultdict(list)
        wanted = frozenset(w for t in live for w in self.templates[t][1]) & present
        for i, w in enumerate(words):
            if w in wanted:
                at[w].append(i)
        votes: dict[tuple[int, int], float] = defaultdict(float)
        for w in sorted(rare, key=lambda w: (-self.idf[w], w)):  # the rarest words open the alignments
            for t, p in self.postings[w]:
                if t in live and w in self.rare[t]:
                    for i in at[w]:
                        votes[t, i - p] = 0.0
        for t, off in votes:
            got = set()
            for p, w in enumerate(self.templates[t][1]):
                for d in range(-SLACK, SLACK + 1):
                    i = off + p + d
                    if 0 <= i < len(words) and words[i] == w and i not in got:
                        got.add(i)
                        votes[t, off] += self.idf[w]
                        break
        best: dict[tuple[str, int], float] = {}
        for (t, off), v in votes.items():
            label, tw, key = self.templates[t]
            cover = v / self.weight[t]
            lo = max(0, off - SLACK)
            if cover >= COVERAGE and _places(words[lo:off + len(tw) + SLACK], key):
                best[label, max(0, off)] = max(best.get((label, max(0, off)), 0.0), min(1.0, cover))
        out: list[tuple[str, int, float]] = []
        for (label, start), cover in sorted(best.items(), key=lambda x: (-x[1], x[0][1], x[0][0])):
            if not any(m[0] == label and abs(m[1] - start) <= SLACK for m in out):
                out.append((label, start, round(cover, 6)))
        return sorted(out, key=lambda m: (m[1], m[0]))


def document_frequencies(df: DataFrame, text_col: str = "text") -> tuple[dict[str, int], int]:
    """Texts holding each template word, and all texts, over the whole table.
    One row per task and word reaches the shuffle; the result has at most as
    many rows as the templates have words."""
    vocabulary = frozenset(w.encode() for _, text, _ in TEMPLATES for w in text.split())

    def count(batches):
        import pyarrow as pa
        seen: Counter = Counter()
        n = 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(vocabulary.intersection(words_of(t)))
                n += 1
        seen[b""] = n
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in seen]), pa.array(list(seen.values()), type=pa.int64())], names=["w", "n"])

    rows = (df.select(F.col(f"`{text_col}`").alias("t")).mapInArrow(count, "w string, n long")
            .groupBy("w").agg(F.sum("n").alias("n")).collect())
    got = {r["w"]: r["n"] for r in rows}
    return got, got.pop("", 0)


def scan_licenses(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus n_words, places (base phrases: label, first word)
    and matches (aligned templates: label, first word, coverage)."""
    counts, n = document_frequencies(df, text_col)
    index = df.sparkSession.sparkContext.broadcast(Index(counts, n))
    phrases = [([w.encode() for w in p.split()], label) for p, label in PHRASES.items()]

    def start():
        ix = index.value

        def scan(texts):
            for t in texts:
                words = words_of(t)
                places = sorted(((label, i) for ph, label in phrases for i in _places(words, ph)),
                                key=lambda x: (x[1], x[0]))
                yield len(words), places, ix.match(words)
        return scan

    return map_batches(df, [text_col], list(keep), RESULT, start)
