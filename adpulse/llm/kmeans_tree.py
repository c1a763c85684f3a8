"""Approximate nearest neighbours by a hierarchical k-means tree.

Nearness is the largest inner product. Vectors get one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm, queries are scaled to norm M and get
a zero there: the order of inner products is then that of distances, which
k-means and the tree need.

1. *Tree*: recursive k-means (``BRANCH`` ways) over a sample of about
   ``SAMPLE`` rows, drawn by a hash of the row, until a node has at most
   ``LEAF`` of them. Tree and sample are bounded by these parameters; nothing
   else goes through the driver.
2. *Index*: every row descends to a leaf. Leaves are dealt out to parts of about
   ``PART`` rows, a leaf with many rows to many of them.
3. *Traversal*: best-bin-first. A priority queue holds the branches not taken
   by the distance of their centre; the nearest is opened next, until the
   wanted number of leaves has been visited (and they hold k rows besides the query's own).
4. *Calibration*: for about ``PROBES`` queries the exact neighbours among all
   rows are found, and the leaf of each; leaf visits are widened from one until
   the share of these neighbours that the traversal meets reaches ``RECALL``.
5. *Search*: queries are sent to the parts of the leaves that they visit; a part
   scores its rows by matrix products, rescores those near the cut in a fixed
   order of additions (equal vectors get equal scores wherever they stand), and
   keeps k rows a query; Spark merges them.

Defined results: null, empty and zero vectors and those that hold null or
non-finite components take no part, nor do rows without an id or of another
length than most (of equally many, the shorter). Ties go to the smaller id.
Rows that repeat an id are rows of their own: as queries each gives its own
neighbours, numbered by ``query_row``, and they find each other. An empty table,
or one with a single vector, gives no rows. With at most k candidates all are
returned. Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored

SAMPLE = 1 << 16
BRANCH = 8
LEAF = 192
ITERATIONS = 8
PART = 4096
PROBES = 256
RECALL = 0.95
SLAB = 64  # queries scored against a part at once
HELD = 1 << 20  # found rows that a task holds before it reduces them to k a query


@dataclass
class Tree:
    """``children[i]`` are node i's children (none: a leaf), ``leaf[i]`` its number as a leaf."""

    centre: object  # (nodes, dim + 1) float64
    children: list
    leaf: list
    leaves: int
    norm: float

    def lift(self, x, query: bool):
        import numpy as np

        squares = (x * x).sum(axis=1)
        if query:
            return np.hstack([x * (self.norm / np.sqrt(squares))[:, None], np.zeros((len(x), 1))])
        return np.hstack([x, np.sqrt(np.maximum(self.norm ** 2 - squares, 0.0))[:, None]])

    def distances(self, x):
        """Squared distances of lifted rows to all centres, less the rows' own squares."""
        return (self.centre * self.centre).sum(axis=1) - 2.0 * (x @ self.centre.T)

    def assign(self, x):
        """The leaf of each row of ``x``, descending to the nearest child."""
        import numpy as np

        near = self.distances(self.lift(x, query=False))
        at, out = np.zeros(len(x), dtype=np.int64), np.full(len(x), -1, dtype=np.int64)
        while (todo := np.flatnonzero(out < 0)).size:
            for node in np.unique(at[todo]):
                rows = todo[at[todo] == node]
                if kids := self.children[node]:
                    at[rows] = np.array(kids)[near[np.ix_(rows, kids)].argmin(axis=1)]
                else:
                    out[rows] = self.leaf[node]
        return out

    def visits(self, near) -> Iterator[int]:
        """Leaves in best-bin-first order, given a query's distances to all centres."""
        import heapq

        queue = [(near[0], 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while kids := self.children[node]:
                kids = sorted(kids, key=lambda c: (near[c], c))
                for c in kids[1:]:
                    heapq.heappush(queue, (near[c], c))
                node = kids[0]
            yield self.leaf[node]


def build_tree(x, norm: float, branch: int = BRANCH, leaf: int = LEAF) -> Tree:
    """Hierarchical k-means over the rows of ``x``."""
    import numpy as np

    tree = Tree(None, [], [], 0, norm)
    rng, centres = np.random.default_rng(7), []
    lifted = tree.lift(x, query=False)

    def split(rows):
        c = lifted[rng.choice(rows, branch, replace=False)]
        for _ in range(ITERATIONS):
            near = ((c * c).sum(axis=1) - 2.0 * (lifted[rows] @ c.T)).argmin(axis=1)
            c = np.array([lifted[rows[near == i]].mean(axis=0) if np.any(near == i) else c[i] for i in range(branch)])
        near = ((c * c).sum(axis=1) - 2.0 * (lifted[rows] @ c.T)).argmin(axis=1)
        return [rows[near == i] for i in range(branch) if np.any(near == i)]

    def grow(rows) -> int:
        node = len(centres)
        centres.append(lifted[rows].mean(axis=0))
        tree.children.append([])
        tree.leaf.append(-1)
        parts = split(rows) if len(rows) > max(leaf, branch) else []
        if len(parts) > 1:
            tree.children[node] = [grow(p) for p in parts]
        else:  # small enough, or all rows alike
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
        return node

    grow(np.arange(len(x)))
    tree.centre = np.array(centres)
    return tree


def _matrix(column, dim: int):
    """The packed vectors as doubles; single ones are packed as they are."""
    import numpy as np

    data = column.to_pylist()
    kind = np.float32 if data and len(data[0]) == 4 * dim else np.float64
    return np.frombuffer(b"".join(data), dtype=kind).reshape(-1, dim).astype(np.float64)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(row, id, vec, dim): the vectors that take part, packed."""
    single = df.schema[vec_col].dataType.elementType.typeName() == "float"
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                    F.col(f"`{vec_col}`").cast("array<float>" if single else "array<double>").alias("v"))
    src = src.where(F.col("id").isNotNull() & F.col("v").isNotNull())

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids, packs, dims = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                x = v.values.to_numpy(zero_copy_only=False) if v.values.null_count == 0 else np.array([np.nan])
                if len(x) and np.isfinite(x).all() and x.any():
                    ids.append(i)
                    packs.append(np.ascontiguousarray(x, dtype=np.float32 if single else np.float64).tobytes())
                    dims.append(len(x))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packs, pa.binary()), pa.array(dims, pa.int32())],
                                             names=["id", "vec", "dim"])

    packed = Stored(src.mapInArrow(pack, "id long, vec binary, dim int").withColumn("row", F.monotonically_increasing_id()), "vectors").df
    most = packed.groupBy("dim").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "dim").limit(1)
    return packed.join(F.broadcast(most.select("dim")), "dim").select("row", "id", "vec", "dim")


class Index:
    """The tree and the rows (leaf, part, row, id, vec) of every vector."""

    def __init__(self, vectors: DataFrame, sample: int = SAMPLE, leaf: int = LEAF):
        self.spark, self.vectors = vectors.sparkSession, vectors

        def norms(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa
            for b in batches:
                if b.num_rows:
                    x = _matrix(b.column(0), b.column(1)[0].as_py())
                    yield pa.RecordBatch.from_arrays([pa.array(np.sqrt((x * x).sum(axis=1).max(keepdims=True))), pa.array([len(x)]),
                                                      pa.array([x.shape[1]])], names=["norm", "n", "dim"])

        top = vectors.select("vec", "dim").mapInArrow(norms, "norm double, n long, dim long").agg(
            F.max("norm").alias("norm"), F.sum("n").alias("n"), F.max("dim").alias("dim")).collect()[0]
        self.n, self.dim = top["n"] or 0, top["dim"]
        if not self.n:
            return
        share = min(1.0, sample / self.n)
        drawn = vectors.where(F.pmod(F.xxhash64("row", "id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
        rows = drawn.select("row", "vec").toArrow().sort_by("row")
        if not rows.num_rows:  # an unlucky hash of a few rows
            rows = vectors.orderBy("row").limit(1).select("row", "vec").toArrow()
        tree = build_tree(_matrix(rows.column("vec"), self.dim), top["norm"], leaf=leaf)
        self.leaves = tree.leaves
        self.tree = self.spark.sparkContext.broadcast((tree.centre, tree.children, tree.leaf, tree.leaves, tree.norm))
        self.rows = self._assigned()

    def _assigned(self) -> DataFrame:
        tree, dim = self.tree, self.dim

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa
            t = Tree(*tree.value)
            for b in batches:
                leaf = t.assign(_matrix(b.column(2), dim)) if b.num_rows else []
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), *b.columns], names=["leaf", "row", "id", "vec"])

        placed = Stored(self.vectors.select("row", "id", "vec").mapInArrow(run, "leaf long, row long, id long, vec binary"), "leaves").df
        self.sizes = {r["leaf"]: r["c"] for r in placed.groupBy("leaf").agg(F.count("*").alias("c")).collect()}  # one row a leaf
        sizes = self.spark.createDataFrame([(x, -(-c // PART)) for x, c in self.sizes.items()], "leaf long, parts long")
        self.parts = F.broadcast(sizes)
        return placed.join(self.parts, "leaf").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts")

    def visits(self, queries: DataFrame, leaves: int | None, k: int) -> DataFrame:
        """(query_row, query_id, vec, leaf, rank): the first ``leaves`` leaves of
        each query's traversal (None: all), more while they hold fewer than k + 1 rows."""
        tree, dim, sizes = self.tree, self.dim, self.sizes

        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa
            t = Tree(*tree.value)
            for b in (whole.slice(i, 512) for whole in batches for i in range(0, whole.num_rows, 512)):
                x = _matrix(b.column(2), dim)
                near = t.distances(t.lift(x, query=True))
                at, leaf, rank = [], [], []
                for i in range(len(x)):
                    met = 0
                    for n, which in enumerate(t.visits(near[i].tolist())):
                        if leaves is not None and n >= leaves and met > k:
                            break
                        met += sizes.get(which, 0)
                        at.append(i)
                        leaf.append(which)
                        rank.append(n)
                for lo in range(0, len(at), 1 << 14):
                    take = pa.array(np.array(at[lo:lo + (1 << 14)], dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [*[c.take(take) for c in b.columns], pa.array(leaf[lo:lo + (1 << 14)], pa.int64()),
                         pa.array(rank[lo:lo + (1 << 14)], pa.int64())], names=["query_row", "query_id", "vec", "leaf", "rank"])

        return queries.select("row", "id", "vec").mapInArrow(run, "query_row long, query_id long, vec binary, leaf long, rank long")

    def calibrate(self, queries: DataFrame, k: int, recall: float, probes: int) -> tuple[int, float]:
        """(leaves to visit, the share of exact neighbours that they hold) on a hashed sample of the queries."""
        n = queries.count()
        some = Stored(queries.where(F.pmod(F.xxhash64("id", "row"), F.lit(1 << 30)) <= int(min(1.0, probes / max(n, 1)) * (1 << 30))), "probes").df
        exact = Stored(_merged(_brute_force(self.vectors, some, self.dim, k), k), "exact-neighbours").df
        truth = exact.select("query_row", "found_row").join(self.rows.select("leaf", F.col("row").alias("found_row")), "found_row")
        ranks = self.visits(some, None, k).select("query_row", "leaf", "rank")
        per_rank = truth.join(ranks, ["query_row", "leaf"]).groupBy("rank").agg(F.count("*").alias("c")).collect()  # one row a leaf
        held = {r["rank"]: r["c"] for r in per_rank}
        total, met, leaves = sum(held.values()), held.get(0, 0), 1
        while leaves < self.leaves and met < recall * total:
            met += held.get(leaves, 0)
            leaves += 1
        return leaves, met / total if total else 1.0

    def search(self, queries: DataFrame, leaves: int, k: int) -> DataFrame:
        """(query_row, query_id, found_row, vec_id, score): k rows a query."""
        wanted = (self.visits(queries, leaves, k).join(self.parts, "leaf")
                  .select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                          F.lit(1).alias("kind"), F.col("query_row").alias("row"), F.col("query_id").alias("id"), "vec"))
        held = self.rows.select("leaf", "part", F.lit(0).alias("kind"), "row", "id", "vec")
        n_parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = held.unionByName(wanted).repartition(n_parts, "leaf", "part").sortWithinPartitions("leaf", "part", "kind", "row")
        dim = self.dim

        def run(batches: Iterator) -> Iterator:
            import numpy as np

            found, at, x, rows, ids = _Found(k), None, [], [], []
            for b in batches:
                leaf, part, kind, row, vec_id = (c.to_numpy() for c in b.columns[:5])
                vecs = _matrix(b.column(5), dim)
                cuts = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
                for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
                    if lo == hi:
                        continue
                    if kind[lo] == 0:
                        if at != (leaf[lo], part[lo]):
                            at, x, rows, ids = (leaf[lo], part[lo]), [], [], []
                        x.append(vecs[lo:hi])
                        rows.append(row[lo:hi])
                        ids.append(vec_id[lo:hi])
                    elif at == (leaf[lo], part[lo]):
                        x, rows, ids = [np.concatenate(x)], [np.concatenate(rows)], [np.concatenate(ids)]
                        found.score(vecs[lo:hi], row[lo:hi], vec_id[lo:hi], x[0], rows[0], ids[0])
                        yield from found.full()
            yield from found.rest()

        return _merged(dealt.mapInArrow(run, _FOUND), k)


_FOUND = "query_row long, query_id long, found_row long, vec_id long, score double"


class _Found:
    """The best rows of queries so far."""

    def __init__(self, k: int):
        self.k, self.parts, self.size, self.least = k, [], 0, 0

    def score(self, q, q_rows, q_ids, x, rows, ids) -> None:
        import numpy as np

        for lo in range(0, len(q), SLAB):
            sub = q[lo:lo + SLAB]
            s = sub @ x.T
            s[q_rows[lo:lo + SLAB][:, None] == rows[None, :]] = -np.inf
            if len(rows) > self.k + 1:
                # the k-th best less what rounding may change
                cut = np.partition(s, len(rows) - self.k, axis=1)[:, len(rows) - self.k]
                room = 1e-12 * np.sqrt((sub * sub).sum(axis=1)) * np.sqrt((x * x).sum(axis=1).max())
                at, of = np.nonzero((s >= (cut - room)[:, None]) & np.isfinite(s))
            else:
                at, of = np.nonzero(np.isfinite(s))
            exact = np.concatenate([[], *[(sub[at[i:i + 65536]] * x[of[i:i + 65536]]).sum(axis=1) for i in range(0, len(at), 65536)]])
            self._add(q_rows[lo:lo + SLAB][at], q_ids[lo:lo + SLAB][at], rows[of], ids[of], exact)

    def _add(self, *columns) -> None:
        import numpy as np

        columns = self._best(columns)
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size > HELD:
            self.parts = [self._best([np.concatenate(c) for c in zip(*self.parts)])]
            self.size = self.least = len(self.parts[0][0])

    def _best(self, columns):
        import numpy as np

        query, _, _, vec_id, score = columns
        order = np.lexsort((columns[2], vec_id, -score, query))
        first = np.concatenate([[True], np.diff(query[order]) != 0]) if len(order) else np.empty(0, dtype=bool)
        starts = np.flatnonzero(first)
        rank = np.arange(len(order)) - np.repeat(starts, np.diff([*starts, len(order)]))
        order = order[rank < self.k]
        return [c[order] for c in columns]

    def full(self) -> Iterator:
        """The rows held, if too many are left after the reduction to k a query."""
        if self.least > HELD // 2:
            yield from self.rest()

    def rest(self) -> Iterator:
        import numpy as np
        import pyarrow as pa

        if self.parts:
            columns = self._best([np.concatenate(c) for c in zip(*self.parts)])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in _FOUND.split(", ")])
        self.parts, self.size, self.least = [], 0, 0


def _brute_force(vectors: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """The k best rows of every task for a bounded set of queries."""
    asked = queries.sparkSession.sparkContext.broadcast(
        [c.to_numpy() if n != "vec" else _matrix(c, dim) for n, c in
         zip(("row", "id", "vec"), queries.select("row", "id", "vec").toArrow().columns)])

    def run(batches: Iterator) -> Iterator:
        rows, ids, q = asked.value
        found = _Found(k)
        for b in (whole.slice(i, PART) for whole in batches for i in range(0, whole.num_rows, PART)):
            found.score(q, rows, ids, _matrix(b.column(2), dim), b.column(0).to_numpy(), b.column(1).to_numpy())
        yield from found.rest()

    return vectors.select("row", "id", "vec").mapInArrow(run, _FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """k rows of each query: those that tasks kept, at most k a task."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
            recall: float = RECALL, probes: int = PROBES, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score, query_row): the k nearest rows of every
    row of ``df`` for which ``is_query``, an expression over ``id``, holds."""
    vectors = usable(df, id_col, vec_col)
    index = Index(vectors, sample, leaf)
    if not index.n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_row long")
    queries = Stored(vectors.where(is_query), "queries").df
    leaves, _ = index.calibrate(queries, k, recall, probes)
    return index.search(queries, leaves, k).select("query_id", "rank", "vec_id", "score", "query_row")
