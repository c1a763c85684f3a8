"""Nearest neighbours by the k-means tree against all inner products."""

import numpy as np
from pyspark.sql import functions as F

from adpulse.llm import kmeans_tree

SCHEMA = "vec_id long, embedding array<float>, score string, leaf string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], SCHEMA).repartition(3)


def exact(ids, x, i, k):
    s = (x * x[i]).sum(axis=1)
    s[i] = -np.inf
    order = np.lexsort((ids, -s))[:k]
    return [(int(ids[j]), s[j]) for j in order if j != i]


def by_query(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_row, []).append(r)
    return [sorted(v, key=lambda r: r["rank"]) for v in out.values()]


def vectors(n, dim, seed, norms=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) + 2 * rng.normal(size=(12, dim))[rng.integers(0, 12, n)]
    return (x * rng.uniform(0.2, 3, (n, 1)) if norms else x).astype(np.float32).astype(np.float64)


def test_recall_scores_and_order(spark):
    """Rows of unequal norms: the largest inner product is not the smallest angle."""
    x = vectors(3000, 12, 1)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    ids = np.arange(len(x))
    rows = kmeans_tree.nearest(df, F.col("id") % 20 == 0, leaf=40, probes=100).collect()
    hit = total = 0
    groups = by_query(rows)
    assert len(groups) == 150
    for g in groups:
        assert [r["rank"] for r in g] == list(range(1, 21))
        assert all((a.score, -a.vec_id) >= (b.score, -b.vec_id) for a, b in zip(g, g[1:]))
        want = exact(ids, x, g[0].query_id, 20)
        hit += len({r.vec_id for r in g} & {i for i, _ in want})
        total += 20
        assert all(abs(r.score - x[r.vec_id] @ x[r.query_id]) < 1e-9 * 100 and r.vec_id != r.query_id for r in g)
    assert hit / total >= 0.9


def test_full_recall_is_exact_with_ties(spark, monkeypatch):
    """A third of the rows are one vector: its leaf is cut into many parts, ties go to the smaller id."""
    for name, value in (("PART", 64), ("HELD", 500), ("SLAB", 7)):
        monkeypatch.setattr(kmeans_tree, name, value)
    x = vectors(900, 6, 2, norms=False)
    x[::3] = x[0]
    x[1::9] = -x[0]
    ids = np.random.default_rng(1).permutation(len(x)) * 3
    df = frame(spark, [(int(i), v.tolist()) for i, v in zip(ids, x)])
    rows = kmeans_tree.nearest(df, F.col("id") % 20 == 0, recall=1.0, probes=10 ** 6, leaf=30).collect()
    place = {int(i): j for j, i in enumerate(ids)}
    groups = by_query(rows)
    assert len(groups) == sum(i % 20 == 0 for i in ids)
    for g in groups:
        want = exact(ids, x, place[g[0].query_id], 20)
        assert [r.vec_id for r in g] == [i for i, _ in want]
        assert np.allclose([r.score for r in g], [s for _, s in want], rtol=1e-12)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, inf]), (7, [1.0, None]),
            (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0]), (-20, [-1.0, 0.0]), (9, [0.0, -0.0])]
    got = by_query(kmeans_tree.nearest(frame(spark, rows), F.col("id") % 20 == 0).collect())
    assert sorted((g[0].query_id, [(r.vec_id, r.score) for r in g]) for g in got) == [
        (-20, [(1, -0.5), (0, -1.0), (20, -2.0), (20, -2.0)]),
        (0, [(20, 2.0), (20, 2.0), (1, 0.5), (-20, -1.0)]),
        (20, [(20, 5.0), (0, 2.0), (1, 1.5), (-20, -2.0)]),
        (20, [(20, 5.0), (0, 2.0), (1, 1.5), (-20, -2.0)])]


def test_empty_single_and_identical(spark):
    is_query = F.col("id") % 20 == 0
    assert kmeans_tree.nearest(frame(spark, []), is_query).collect() == []
    assert kmeans_tree.nearest(frame(spark, [(0, None)]), is_query).collect() == []
    assert kmeans_tree.nearest(frame(spark, [(0, [1.0])]), is_query).collect() == []
    assert kmeans_tree.nearest(frame(spark, [(1, [1.0]), (2, [1.0])]), is_query).collect() == []
    same = kmeans_tree.nearest(frame(spark, [(i, [0.25, 0.5]) for i in range(600)]), F.col("id") == 40, leaf=50).collect()
    assert [r.vec_id for r in sorted(same, key=lambda r: r["rank"])] == list(range(20))


def test_visits_open_the_nearest_bin_first():
    """Every leaf once; the first leaf is the one that a greedy descent ends in, and
    an opened branch is never farther than the ones still queued."""
    x = vectors(2000, 5, 4)
    tree = kmeans_tree.build_tree(x, float(np.sqrt((x * x).sum(axis=1).max())), leaf=30)
    near = tree.distances(tree.lift(x[:20], query=True))
    for row in near:
        order = list(tree.visits(row.tolist()))
        assert sorted(order) == list(range(tree.leaves))
        node = 0
        while tree.children[node]:
            node = min(tree.children[node], key=lambda c: row[c])
        assert order[0] == tree.leaf[node]
    assert set(tree.assign(x)) <= set(range(tree.leaves))


def test_wider_visits_raise_recall(spark):
    x = vectors(2000, 10, 6)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    index = kmeans_tree.Index(kmeans_tree.usable(df, "vec_id", "embedding"), leaf=40)
    queries = index.vectors.where(F.col("id") % 20 == 0)
    low, share_low = index.calibrate(queries, 20, 0.5, 10 ** 6)
    high, share_high = index.calibrate(queries, 20, 0.97, 10 ** 6)
    assert low < high <= index.leaves and 0.5 <= share_low < share_high
    ids = np.arange(len(x))
    for leaves, share in ((low, share_low), (high, share_high)):
        rows = by_query(index.search(queries, leaves, 20).collect())
        hit = sum(len({r.vec_id for r in g} & {i for i, _ in exact(ids, x, g[0].query_id, 20)}) for g in rows)
        # calibrated on all queries; a search visits more leaves only while they hold too few rows
        assert hit / (20 * len(rows)) >= share - 1e-9


def test_a_task_returns_k_rows_a_query_however_many_leaves_it_scores(monkeypatch):
    """Rows leave a task early only if k a query are too many to hold, not because many leaves have been visited."""
    rng = np.random.default_rng(3)
    q, ids = rng.normal(size=(10, 4)), np.arange(10)

    def rows(held, leaves):
        monkeypatch.setattr(kmeans_tree, "HELD", held)
        found, out = kmeans_tree._Found(3), []
        for leaf in range(leaves):
            x = np.random.default_rng(leaf).normal(size=(6, 4))
            found.score(q, ids, ids, x, np.arange(6) + 100 * leaf + 100, np.arange(6) + 100 * leaf + 100)
            out += found.full()
            assert found.size <= held + 30
        return [r for b in [*out, *found.rest()] for r in b.to_pylist()]

    want, early = rows(100_000, 50), rows(100, 50)
    assert len(want) == 30 and early == want
    few = rows(40, 50)  # 30 rows are more than half of 40: they leave, and the best of them are the same
    assert len(few) > 30
    for i in ids:
        mine = sorted((r for r in few if r["query_row"] == i), key=lambda r: (-r["score"], r["vec_id"]))[:3]
        assert mine == [r for r in want if r["query_row"] == i]
