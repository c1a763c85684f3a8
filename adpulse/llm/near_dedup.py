"""Near-duplicate components from bottom-k sketches of one hash function.

A document's set is its distinct word shingles, each a 64-bit hash; its sketch
the ``K`` smallest hashes (all of them in a smaller set). Two documents are
linked if the Jaccard similarity of their whole sets is at least 0.8.

1. *Classes.* Documents with equal sets (128-bit fingerprint) form one class;
   everything after works on classes, so a group of exact copies, however
   large, is one row.
2. *Inverted lists.* A class of which most small hashes occur in no other class has
   no partner and is left out at once. Of two linked sets at least ``T`` of the K retained values
   coincide (chance of fewer at similarity 0.8: about 2e-8; sets of fewer than K values are exact). Hence, in any common
   order of the values, linked sketches share one of their first K - T + 1.
   The order puts frequent values last (an approximate frequency does: any
   order is right), so a passage that many documents share opens no lists.
3. *Stars instead of pairs.* In each list every member is proposed to at most
   ``LEADERS`` leaders only, members that share most of their values with others. Proposals are filtered by the union-sketch
   estimate and verified on the whole sets. Lists whose other members then
   lie in one component are finished. The members of the rest are compared across
   components by prefix filtering of their differences from a leader of the
   list (``_across``), verified the same way. Links inside a component are the only ones not looked at, so the
   components are those of all pairs.
4. *Components* by repeated minimum over neighbours and pointer jumping.

Joins whose one side grows with the corpus are sort-merge joins at any size,
which Spark splits where a key is hot. A list's hot member is salted: its text is sent to several tasks, each with at
most ``SALT`` partners. No link, component or fingerprint reaches the driver.

Defined results: a null or empty text, or one without words, has an empty set
and is its own component; fewer words than a shingle make one shingle of all
of them; repeated rows of an id share the component of the id's smallest;
a row with a null id has a null component unless its set has another id.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from .common import SLICE, Stored, map_batches

K = 64
T = 32
K_FIRST, T_FIRST = 32, 12  # of the K_FIRST smallest values T_FIRST coincide (chance of fewer: about 3e-8)
HOT_VALUES = 1 << 16  # entries of the broadcast table of frequent values (an order hint only)
SALT = 256
K_WIDE = 512
WHOLE = 1 << 15  # longer sets are compared by their own values, not by differences
LEADERS = 4
PERCENT = 80

_SKETCH = T_.StructType([
    T_.StructField("n", T_.LongType()), T_.StructField("fp", T_.BinaryType()),
    T_.StructField("sketch", T_.ArrayType(T_.LongType()))])


def shingle_hasher(width: int):
    """A function text -> sorted distinct int64 shingle hashes. Made inside the
    task; its word cache is emptied when it holds ``LIMIT`` words."""
    import numpy as np
    import xxhash

    limit, digest = 150_000, xxhash.xxh64_intdigest

    class Words(dict):
        def __missing__(self, word):
            if len(self) >= limit:
                self.clear()
            h = self[word] = digest(word)
            return h

    cache = Words()
    rng = np.random.default_rng(20240229)
    odd = rng.integers(0, 1 << 63, size=width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def hashes(text: str | None):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, dtype=np.int64)
        w = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
        m = min(width, len(w))
        x = np.full(len(w) - m + 1, m, dtype=np.uint64)
        for i in range(m):
            x += w[i:len(w) - m + 1 + i] * odd[i]
            x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
        return np.unique(x.view(np.int64))

    return hashes


def sketches(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n, fp, sketch): set size, fingerprint and bottom-k sketch."""
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def start():
        import xxhash
        hashes = shingle_hasher(width)

        def run(texts):
            for t in texts:
                h = hashes(t)
                yield len(h), xxhash.xxh3_128_digest(h.tobytes()), h[:K].tolist()
        return run

    return map_batches(src, ["text"], ["id"], _SKETCH, start)


def _with_company(classes: DataFrame) -> DataFrame:
    """The classes that may have a partner: at least T_FIRST of their K_FIRST
    smallest values (four fifths of a smaller set) occur in another class. ``m``
    tells how many of the K values do: a group's least edited texts have the most."""
    probes = classes.select("cid", "n", F.explode(F.slice("sketch", 1, K_FIRST)).alias("value"))
    common = probes.groupBy("value").agg(F.count("*").alias("c")).where("c > 1").select("value")
    need = F.least(F.lit(T_FIRST), F.ceil(F.col("n") * PERCENT / 100.0))
    alive = (probes.join(Stored(common, "common-values").df, "value").groupBy("cid").agg(F.count("*").alias("m"), F.first("n").alias("n"))
             .where(F.col("m") >= need).select("cid"))
    left = Stored(classes.join(Stored(alive, "alive").df.hint("merge"), "cid", "left_semi"), "candidates").df
    values = left.select("cid", F.explode("sketch").alias("value"))
    common = Stored(values.groupBy("value").agg(F.count("*").alias("c")).where("c > 1").select("value"), "shared-values").df
    company = values.join(common, "value").groupBy("cid").agg(F.count("*").cast("int").alias("m"))
    return Stored(left.join(company, "cid"), "company").df


def _hot_values(classes: DataFrame):
    """Sorted frequent values and their approximate frequencies, at most
    HOT_VALUES of them: batches report the values they hold often."""
    def count(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            v, c = np.unique(b.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
            often = c >= 8
            yield pa.RecordBatch.from_arrays([pa.array(v[often]), pa.array(c[often].astype(np.int64))], names=["v", "c"])

    rows = (classes.select("sketch").mapInArrow(count, "v long, c long").groupBy("v").agg(F.sum("c").alias("c"))
            .orderBy(F.desc("c"), "v").limit(HOT_VALUES).collect())
    import numpy as np
    v = np.array([r["v"] for r in rows], dtype=np.int64)
    order = np.argsort(v)
    return v[order], np.array([r["c"] for r in rows], dtype=np.int64)[order]


def _postings(classes: DataFrame) -> DataFrame:
    """(value, cid, n): the first K - T + 1 values of each class in the common
    order; a set below K values needs only those that exactness asks for."""
    hot = classes.sparkSession.sparkContext.broadcast(_hot_values(classes))

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        values, freq = hot.value
        for b in batches:
            out_v, out_c, out_n, out_m = [], [], [], []
            flat = b.column(2).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([len(x) for x in b.column(2)])
            pos = np.minimum(np.searchsorted(values, flat), max(len(values) - 1, 0))
            heat = np.where(values[pos] == flat, freq[pos], 0) if len(values) else np.zeros(len(flat), dtype=np.int64)
            begin = 0
            for cid, n, m, end in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), ends):
                v, h = flat[begin:end], heat[begin:end]
                begin = end
                need = min(T, -(-PERCENT * n // 100))
                first = v[np.lexsort((v, h))][:len(v) - need + 1]
                out_v.append(first)
                out_c += [cid] * len(first)
                out_n += [n] * len(first)
                out_m += [m] * len(first)
            if out_v:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_v)), pa.array(out_c, type=pa.int64()), pa.array(out_n, type=pa.int64()),
                     pa.array(out_m, type=pa.int32())], names=["value", "cid", "n", "m"])

    return classes.select("cid", "n", "sketch", "m").mapInArrow(run, "value long, cid long, n long, m int")


def _sizes_fit(a, b):
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * PERCENT)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose union sketch does not rule out a link."""
    sk = classes.select("cid", "sketch").hint("merge")
    both = (pairs.join(sk.select(F.col("cid").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sk.select(F.col("cid").alias("b"), F.col("sketch").alias("sb")), "b"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, K)
    x, u = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union)), F.size(union)
    return both.where(F.when(u < K, x * 100 >= u * PERCENT).otherwise(x >= T)).select("a", "b")


def _by_leader(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, salt, who, text) of pairs (a: leader, b: member), a leader's row (who
    null) before its members' in the same partition. The leader's text goes to
    ceil(partners / SALT) tasks."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(1 << 20)))
    held = Stored(salted, "proposals")
    parts = held.df.groupBy("a").agg((F.floor((F.count("*") - 1) / SALT) + 1).cast("long").alias("parts"))
    parts = Stored(parts, "leaders")
    members = (held.df.join(parts.df, "a").withColumn("salt", F.col("salt") % F.col("parts"))
               .join(texts.select(F.col("cid").alias("b"), "text"), "b")
               .select("a", "salt", F.col("b").alias("who"), "text"))
    leaders = (parts.df.join(texts.select(F.col("cid").alias("a"), "text"), "a")
               .select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("salt"),
                       F.lit(None).cast("long").alias("who"), "text"))
    n_parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (members.unionByName(leaders).repartition(n_parts, "a", "salt")
            .sortWithinPartitions("a", "salt", F.col("who").asc_nulls_first()))


def _most_apart(n, level):
    """Values by which two linked sets of sizes that add up to ``n`` differ at
    most, among the values of a level: exact at level 0, else six standard
    deviations above the mean."""
    mean = n / 9.0 / F.pow(F.lit(2.0), level)
    return F.when(level > 0, mean + 6 * F.sqrt(mean) + 6).otherwise(mean)


_DIFFERENCE = "ref long, cid long, n long, s long, first double, vals array<long>"


def _differences(members: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(ref, cid, n, s, first, vals) of ``members`` (ref, cid): the s values
    by which a member's set differs from that of ``ref``. ``first`` bounds the
    positions by which a partner of no fewer differences is met: an eighth of the member's size,
    or, for a member linked to ``ref``, half of its differences.

    A member that differs from every reference in most of its values, or is longer
    than WHOLE, goes by its own values instead: those below a hash bound that
    halves with each level, the level being -1 - ref. Both forms are
    written around a limit, so that two linked sets always have one in common."""
    def relative(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        hashes = shingle_hasher(width)
        leader, mine = None, None
        for b in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            out = []
            for a, s, who, text in zip(*[c.to_pylist() for c in b.columns]):
                h = hashes(text)
                if who is None:
                    leader, mine = (a, s), h
                elif leader == (a, s):
                    apart = np.setxor1d(mine, h, assume_unique=True)
                    n, d = len(h), len(apart)
                    first = n / 8
                    if 9 * d <= n + len(mine):
                        first = min(first, (d + (n - len(mine)) / 9) / 2)
                    if n <= WHOLE and d <= n:
                        out.append((a, who, n, d, first, apart.tolist()))
                    if 5 * n > 4 * WHOLE or 10 * d >= 6 * n:
                        out.append((None, who, n, d, 0.0, []))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.float64(), pa.list_(pa.int64())])],
                names=["ref", "cid", "n", "s", "first", "vals"])

    def absolute(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        hashes = shingle_hasher(width)

        def level(n):
            return max(0, int(np.ceil(np.log2(n / K_WIDE))))

        for b in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            out = []
            for who, text in zip(*[c.to_pylist() for c in b.columns]):
                h = hashes(text)
                for x in sorted({level(len(h)), level(1.25 * len(h))}):
                    kept = h[:np.searchsorted(h, (1 << (64 - x)) - (1 << 63))] if x else h
                    mean = len(h) / 4 / 2 ** x
                    out.append((-1 - x, who, len(h), len(kept), (mean + 6 * mean ** 0.5 + 6 if x else mean) / 2, kept.tolist()))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.float64(), pa.list_(pa.int64())])],
                names=["ref", "cid", "n", "s", "first", "vals"])

    pairs = members.select(F.col("ref").alias("a"), F.col("cid").alias("b"))
    by_ref = Stored(_by_leader(pairs, texts).mapInArrow(relative, _DIFFERENCE), "differences").df
    alone = by_ref.where(F.col("ref").isNull()).select("cid").distinct()
    by_self = texts.join(alone, "cid", "left_semi").select("cid", "text").mapInArrow(absolute, _DIFFERENCE)
    return by_ref.where(F.col("ref").isNotNull()).unionByName(by_self)


def _across(members: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(a, b): all pairs of ``members`` (ref, cid, comp) of one reference in
    different components that may be linked, by prefix filtering of their
    differences from the reference.

    What a cloud of edits of one text has in common is in the reference
    too and drops out: a member is left with its own edits. The differences
    of two linked sets x, y number at most D = (nx + ny) / 9, so their differences from the
    reference, sx and sy values, share (sx + sy - D) / 2 or more, and the first shared
    one in a common order stands in x at (sx - sy + D) / 2 or before, in y at
    (sy - sx + D) / 2 or before. That is above zero unless both are linked to the
    reference and hence in one component. The order is by frequency among the members,
    rarest first: edits of a member's own come first and meet nobody. The set
    with more differences probes; in each list the members of its largest
    component do not probe each other."""
    held = Stored(_differences(members, texts, width), "difference-sets").df
    flat = held.select("ref", "cid", F.explode("vals").alias("value"))
    often = flat.groupBy("ref", "value").agg(F.count("*").alias("df")).where("df > 1")
    ranked = (flat.join(Stored(often, "frequencies").df.hint("merge"), ["ref", "value"]).groupBy("ref", "cid")
              .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared")))  # at most 1.25 * WHOLE values
    level = F.greatest(-1 - F.col("ref"), F.lit(0)).cast("int")
    front = (ranked.join(held.drop("vals").hint("merge"), ["ref", "cid"])
             .withColumn("own", F.col("s") - F.size("shared"))
             .withColumn("room", F.floor(_most_apart(F.col("n") * 2.25, level) - F.col("own")).cast("int") + 1).where("room > 0")
             .join(members.select("cid", "comp").distinct().hint("merge"), "cid")
             .select("ref", "cid", "comp", "n", "s", "first", "own", F.posexplode(F.slice("shared", 1, F.col("room"))))
             .select("ref", "cid", "comp", "n", "s", "first", F.col("col.value").alias("value"), (F.col("own") + F.col("pos")).alias("pos")))
    front = Stored(front, "prefixes").df
    met = (front.groupBy("ref", "value", "comp").agg(F.count("*").alias("c"), F.max((F.col("pos") <= F.col("first")).cast("int")).alias("i"))
           .groupBy("ref", "value").agg(F.max(F.struct("c", "comp"))["comp"].alias("major"), F.count("*").alias("comps"), F.max("i").alias("i"))
           .where("comps > 1 and i = 1").select("ref", "value", "major"))
    front = Stored(front.join(Stored(met, "majors").df.hint("merge"), ["ref", "value"]), "mixed-prefixes").df

    is_major = F.col("comp") == F.col("major")
    index = front.where("pos <= first").select(
        "ref", "value", is_major.alias("side"), F.col("cid").alias("y"), F.col("comp").alias("ycomp"),
        F.col("n").alias("yn"), F.col("s").alias("ys"), F.col("pos").alias("ypos"))
    probe = (front.withColumn("side", F.explode(F.when(is_major, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
             .select("ref", "value", "side", F.col("cid").alias("x"), F.col("comp").alias("xcomp"), F.col("n").alias("xn"),
                     F.col("s").alias("xs"), F.col("pos").alias("xpos")))
    probe, index = Stored(probe, "probes").df, Stored(index, "index").df
    apart = _most_apart(F.col("xn") + F.col("yn"), level)
    pairs = probe.join(index.hint("merge"), ["ref", "value", "side"]).where(
        (F.col("xcomp") != F.col("ycomp")) & (F.col("xs") >= F.col("ys")) & _sizes_fit(F.col("xn"), F.col("yn"))
        & (F.col("xpos") * 2 <= F.col("xs") - F.col("ys") + apart) & (F.col("ypos") * 2 <= F.col("ys") - F.col("xs") + apart))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Of the pairs (a: leader, b: member) those with Jaccard >= 0.8 on the
    whole sets."""
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        hashes = shingle_hasher(width)
        leader, mine = None, None
        for b in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            out_a, out_b = [], []
            for a, s, who, text in zip(*[c.to_pylist() for c in b.columns]):
                h = hashes(text)
                if who is None:
                    leader, mine = (a, s), h
                elif leader == (a, s):
                    common = len(np.intersect1d(mine, h, assume_unique=True))
                    if 100 * common >= PERCENT * (len(mine) + len(h) - common):
                        out_a.append(a)
                        out_b.append(who)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, type=pa.int64()), pa.array(out_b, type=pa.int64())],
                                             names=["a", "b"])

    return _by_leader(pairs, texts).mapInArrow(run, "a long, b long")


def connected(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b); comp is the smallest
    node of the component. Each pass is stored, so lineage stays short."""
    edges = Stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges").df
    labels = Stored(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("comp")), "labels")
    while True:
        old = labels.df.select("node", "comp")
        near = (edges.join(old, edges["b"] == F.col("node")).groupBy(F.col("a").alias("n"))
                .agg(F.min("comp").alias("m")))
        step = Stored(old.join(near, F.col("node") == F.col("n"), "left")
                      .select("node", F.least("comp", F.coalesce("m", "comp")).alias("comp"), F.col("comp").alias("was")),
                      "labels-step")
        root = step.df.select(F.col("node").alias("r"), F.col("comp").alias("up"))
        jumped = Stored(step.df.join(root, F.col("comp") == F.col("r"), "left")
                        .select("node", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "was"), "labels")
        labels.drop()
        step.drop()
        labels = jumped
        if not labels.df.where("comp <> was").limit(1).count():
            return labels.df.select("node", "comp")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """One row per row of ``df``: id_col, n_shingles, component_id."""
    docs = Stored(sketches(df, id_col, text_col, width), "sketches")
    grouped = (docs.df.where("n > 0").groupBy("fp")
               .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    classes = Stored(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes").df

    everyone, classes = classes, _with_company(classes)

    postings = Stored(_postings(classes), "postings")
    # up to LEADERS leaders of each list, the classes with the most company of as many parts of it
    part = F.pmod(F.hash("cid"), F.lit(LEADERS))
    lists = Stored(postings.df.groupBy("value", part.alias("part")).agg(F.max(F.struct("m", "cid")).alias("lead"), F.count("*").alias("c"))
                   .groupBy("value").agg(F.collect_list("lead.cid").alias("leads"), F.sum("c").alias("c"))
                   .where("c > 1").select("value", "leads"), "lists")
    active = Stored(postings.df.join(lists.df, "value").drop("m"), "active")
    postings.drop()
    lists.drop()

    # texts of the classes that share a list with another one
    wanted = Stored(active.df.select("cid").distinct().join(classes.select("cid", "rep", "fp"), "cid"), "wanted").df
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    again = src.join(wanted.select(F.col("rep").alias("id"), "cid", "fp").hint("merge"), "id")
    texts = Stored(_same_set(again, width), "texts").df

    sizes = classes.select(F.col("cid").alias("lead"), F.col("n").alias("lead_n"))
    proposals = (active.df.select(F.explode("leads").alias("lead"), "cid", "n").where("cid <> lead").distinct().join(sizes, "lead")
                 .where(_sizes_fit(F.col("n"), F.col("lead_n"))).select(F.col("lead").alias("a"), F.col("cid").alias("b")))
    links = Stored(_verified(_estimated(proposals, classes), texts, width), "links").df
    comps = connected(links)
    tried = Stored(proposals, "tried").df

    rest = active.df.where(~F.array_contains("leads", F.col("cid"))).select("value", "cid", F.array_min("leads").alias("ref")).join(
        comps.select(F.col("node").alias("cid"), "comp"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    rest = Stored(rest, "rest").df
    mixed = rest.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("value")
    open_ = Stored(rest.join(Stored(mixed, "mixed").df, "value").select("ref", "cid", "comp").distinct(), "open").df
    if open_.limit(1).count():
        cross = Stored(_across(open_, texts, width).join(tried, ["a", "b"], "left_anti"), "cross").df
        more = Stored(_verified(_estimated(cross, classes), texts, width), "more-links").df
        links = Stored(links.unionByName(more), "all-links").df
        comps = connected(links)

    found = everyone.select("cid", "fp", "rep").join(comps.select(F.col("node").alias("cid"), "comp"), "cid", "left")
    found = Stored(found.withColumn("comp", F.coalesce("comp", "cid")), "found").df
    roots = Stored(found.groupBy("comp").agg(F.min("rep").alias("component_id")), "roots").df
    named = Stored(found.join(roots, "comp").select("fp", "component_id"), "named").df
    return (docs.df.select("id", "n", F.col("fp")).join(named.hint("merge"), "fp", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))


def _same_set(rows: DataFrame, width: int) -> DataFrame:
    """(cid, text) of the rows whose text has the class's set (an id may repeat with another text)."""
    def start():
        import xxhash
        hashes = shingle_hasher(width)
        return lambda texts, fps: ((xxhash.xxh3_128_digest(hashes(t).tobytes()) == bytes(f),) for t, f in zip(texts, fps))

    flag = T_.StructType([T_.StructField("same", T_.BooleanType())])
    return map_batches(rows, ["text", "fp"], ["cid", "text"], flag, start).where("same").select("cid", "text")
