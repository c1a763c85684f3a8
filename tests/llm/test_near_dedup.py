"""Near duplicates against all pairs."""

import random
import re
from collections import defaultdict

from llm_fixtures import SF_SMALL, duck, odd_docs, small_docs  # noqa: F401

from adpulse.llm import near_dedup
from adpulse.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def all_pairs(docs, width):
    """{doc_id: (size, component)} by comparing all pairs that share a shingle."""
    sets, by_shingle = {i: shingles(t, width) for i, t in docs}, defaultdict(list)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in sorted(sets.items()):
        near = defaultdict(int)
        for x in s:
            for j in by_shingle[x]:
                near[j] += 1
            by_shingle[x].append(i)
        for j, n in near.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_query_against_all_pairs(spark, small_docs):
    got = {r.doc_id: r for r in QUERIES["op9_near_dedup"](spark, SF_SMALL).collect()}
    want = all_pairs([(i, t) for i, t, _, _ in small_docs], 4)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def cloud(rng, base, n, most):
    out = []
    for _ in range(n):
        w = base[:]
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 9)}"
        out.append(" ".join(w))
    return out


def test_clouds_of_edits_chains_and_copies(spark):
    """Groups whose members are linked only in part, or only through others,
    around and beyond the sketch size, beside a passage that many texts share."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    texts = []
    for size in (5, 12, 40, 70, 150, 700):
        texts += cloud(rng, [word() for _ in range(size)], 60, max(1, size // 12))
    chain = [word() for _ in range(120)]
    for _ in range(30):
        texts.append(" ".join(chain))
        chain = chain[2:] + [word() for _ in range(2)]
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(rng.choice((10, 40, 90)))) for _ in range(150)]
    texts += ["one two", "one two", "ONE two", "one", "", None, " \n", texts[0], texts[70]] + [texts[200]] * 40
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, width=4).collect()}
    want = all_pairs(docs, 4)
    assert {i: (got[i], want[i]) for i in want if got[i] != want[i]} == {}
    assert len({c for _, c in want.values()}) < len(docs) - 150


def test_cloud_just_apart_gives_few_candidates(spark):
    """Members that differ from their reference by slightly more than a link allows:
    nearly every pair shares most of its values, hardly one is looked at."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(400)]
    texts = [" ".join(base)]
    for _ in range(300):
        w = base[:]
        for at in rng.sample(range(0, 400, 5), 12):
            w[at] = f"e{rng.randrange(10 ** 9)}"
        texts.append(" ".join(w))
    texts += [texts[7] + " tail one", texts[7] + " tail two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "cid long, text string")
    members = docs.where("cid > 0").selectExpr("0L as ref", "cid", "cid as comp")
    pairs = {(r.a, r.b) for r in near_dedup._across(members, docs, 4).collect()}
    sets = [shingles(t, 4) for t in texts]
    linked = {(a, b) for a in range(1, len(sets)) for b in range(a + 1, len(sets))
              if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert linked <= pairs and len(pairs) < len(texts) * 2


def test_texts_longer_than_whole_sets(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(10 ** 7)}" for _ in range(45_000)]
    texts = cloud(rng, base, 8, 1500) + [" ".join(base[:34_000]), " ".join(base[:28_000]), " ".join(base[:26_500] + ["x"])]
    texts += cloud(rng, base[:27_000], 6, 900)
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, width=4).collect()}
    assert got == all_pairs(docs, 4)


def test_odd_rows(spark, odd_docs):
    rows = near_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[5].component_id == 1 and by_id[2].n_shingles == 0 and by_id[2].component_id == 2
    assert [r.component_id for r in rows if r.doc_id == 6] == [6, 6] and by_id[None].component_id is None
    assert near_dedup.near_duplicates(odd_docs.limit(0)).count() == 0


def test_connected_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [
        (rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    links = [(a, b) for a, b in links if a != b]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.comp for r in near_dedup.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
