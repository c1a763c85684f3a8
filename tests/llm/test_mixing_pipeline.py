"""Entropy balancing and the pipeline."""

import math
import random
import re

import corpus_pipeline
import pytest
from llm_fixtures import SF_SMALL, duck, odd_docs, small_docs  # noqa: F401
from test_near_dedup import all_pairs

from adpulse.llm import blob_ledger, decontam, mixing
from adpulse.llm.queries import QUERIES


def plain_targets(sizes):
    """{source: target}: shares by weight, excess over twice the size reshared until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else share[s] for s in order}
        capped |= over


def check_mix(rows, docs):
    sizes = {}
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
    for n, (_, _, s) in zip(words, docs):
        sizes[s] = sizes.get(s, 0) + n
    want, largest = plain_targets(sizes), {}
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(d[0]), n) for d, n in zip(docs, words))
    taken = dict.fromkeys(sizes, 0)
    for n, (_, _, s) in zip(words, docs):
        largest[s] = max(largest.get(s, 0), n)
    by_id = {d[0]: d[2] for d in docs}
    for r in rows:
        s = by_id[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-6)
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.03 * want[s], largest[s]), (s, taken[s], want[s])


def test_mixing_query(spark, small_docs):
    build = QUERIES["op10_mixing"]
    first = build(spark, SF_SMALL).collect()
    check_mix(first, [(i, t, s) for i, t, _, s in small_docs])
    assert sorted(map(str, build(spark, SF_SMALL).repartition(3).collect())) == sorted(map(str, first))


def test_rates_solve_the_dual(spark):
    rng = random.Random(9)
    docs = [(i, " ".join("w" * 1 for _ in range(int(rng.paretovariate(1.2) * 5))), f"s{i % 4}") for i in range(1200)]
    docs += [(2000 + i, "a b", None) for i in range(700)] + [(5000, "one", "zz"), (5001, None, "zz"), (5002, "", "tiny")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    check_mix(rows, docs)
    by = {}
    for r in rows:
        if r.size:
            by.setdefault((r.source, r.target, r.source_size), []).append(r)
    for (source, target, size), part in by.items():
        got = sum(r.rate * r.size for r in part)
        assert abs(got - target) <= 1e-6 * target + 0.05, (source, got, target)
        free = [r for r in part if r.rate < 2 - 1e-12]
        tilts = {round(math.log(r.rate) / r.size, 9) for r in free}  # one multiplier per source
        assert len(tilts) <= 1 or max(tilts) - min(tilts) < 1e-6


def test_mixing_odd_rows(spark, odd_docs):
    rows = mixing.mix(odd_docs.drop("size", "rate")).collect()
    assert len(rows) == odd_docs.count()
    assert mixing.mix(odd_docs).count() == odd_docs.count()
    assert mixing.mix(odd_docs.limit(0)).count() == 0


def test_many_sources(spark):
    docs = [(i, "w " * (1 + i % 13), f"source{i % 400:04d}") for i in range(2000)]
    check_mix(mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect(), docs)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "x")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_stages_against_brute_force(stages, duck):
    assert [n for n, _, _ in stages] == ["toxicity", "near_dedup", "decontaminate", "secrets", "mix"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, _, after in stages[:-1]:
        assert after.columns == columns, name
    tables = {n: ({r.doc_id: r for r in b.collect()}, a.collect()) for n, b, a in stages}
    toxic = dict(duck.execute("SELECT doc_id, toxic FROM labels").fetchall())
    before, after = tables["toxicity"]
    kept = {r.doc_id for r in after}
    clean = [i for i in before if toxic.get(i) == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)

    before, after = tables["near_dedup"]
    comps = all_pairs([(i, r.text) for i, r in before.items()], 5)
    assert sorted(r.doc_id for r in after) == sorted(i for i, (_, c) in comps.items() if i == c)

    before, after = tables["decontaminate"]
    block = decontam.Block(duck.execute("SELECT item_id, text FROM benchmark").fetchall(), decontam.MIN_MATCH)
    assert sorted(r.doc_id for r in after) == sorted(i for i, r in before.items() if not block.hits(r.text, decontam.THRESHOLD))

    before, after = tables["secrets"]
    assert len(after) == len(before)
    for r in after:
        old = before[r.doc_id].text
        spans = blob_ledger.find_secrets(old)
        assert r.text == blob_ledger.mask(old, spans) and r.n_chars == len(r.text)
        assert not spans or r.text != old

    before, after = tables["mix"]
    copies = {}
    for r in after:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert r.text == before[r.doc_id].text
    assert max(copies.values()) <= 2
    sizes, taken = {}, {}
    for i, r in before.items():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        sizes[r.source] = sizes.get(r.source, 0) + n
        taken[r.source] = taken.get(r.source, 0) + n * copies.get(i, 0)
    want = plain_targets(sizes)
    assert abs(sum(taken.values()) - sum(want.values())) < 0.1 * sum(want.values())


def test_stages_on_odd_and_empty_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name
        n = out.count()
        assert n > 0, name
        if name != "mix":
            assert out.columns == docs.columns, name
            docs = out
    ids = [r.doc_id for r in docs.collect()]
    assert ids.count(6) == 1 and ids.count(None) == 1 and 5 not in ids and 1 in ids


def test_mix_stage_keeps_columns_of_any_name(spark):
    rows = [(i, "some words of a text", "en", "s", 20, -i, f"c{i}", 2.0 * i, "x", i, 7) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, size long, "
                                       "copies string, target double, `Copy` string, taken long, `odd.name` int")
    out = corpus_pipeline.mix_sources(spark, docs, SF_SMALL)
    assert out.columns == docs.columns + ["copy_2"]
    given = {r[0]: r for r in rows}
    got = out.collect()
    assert got and all(tuple(r)[:-1] == given[r.doc_id] and r.copy_2 in (1, 2) for r in got)
