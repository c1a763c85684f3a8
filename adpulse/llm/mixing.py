"""Mixing sources to target token weights by entropy balancing.

Targets. The sources in code-point order (null last) weigh 3, 1, 2, repeating,
and share ``BUDGET`` times all words; a target stops at ``CAP`` times its
source's size and the excess is reshared by weight until none is above. That
is a water level: target = min(CAP * size, weight * level).

Rates. Among all rates w_i in [0, CAP] with sum(size_i * w_i) = target, entropy
balancing takes the one nearest to one copy each in relative entropy:
w_i = min(CAP, exp(lambda_s * size_i / scale_s)). lambda_s maximises the
concave (minimises the convex) dual of its source; all sources' multipliers
are found together by safeguarded Newton steps. A rate depends only on
(source, size), so every step aggregates a histogram (source, size, count)
that map-side combining has made once; a source with a third of all rows is
summed by all tasks. Sums are exact decimals: reruns agree to the bit.

Copies. floor(w_i) copies, and one more where u_i - frac(w_i) lies below a cut,
u_i a uniform hash of the document id. Each source has one cut per size class
(powers of two); from the largest class down, the cut (of 2 * BINS) is taken
that brings the words taken so far nearest to those wanted, so small documents
make up for the rounding of large ones.

Defined results: a null or empty text has size 0 and takes 0 words; null
sources are one source; rows that repeat a document id are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stored

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
BINS = 1024
MAX_STEPS = 80
UNIT = 1 << 20  # resolution of the exact sums
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of runs of non-space characters."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _exact(value: Column) -> Column:
    return F.sum(F.round(value * UNIT).cast("decimal(38,0)")).cast("double") / UNIT


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n_docs, weight, target) of a frame (source, size, n)."""
    agg = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                      F.sum("n").alias("n_docs"))
    order = F.col("source").asc_nulls_last()
    parts = Stored(agg.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources").df
    within = parts.withColumn("pos", F.row_number().over(Window.partitionBy("part").orderBy(order)))
    before = (parts.groupBy("part").agg(F.count("*").alias("c"))  # one row per partition
              .withColumn("before", F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))))
    ranked = within.join(before.select(F.col("part").alias("p"), "before"), F.col("part") == F.col("p"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]),
                          (((F.col("pos") - 1 + F.coalesce(F.col("before"), F.lit(0))) % len(WEIGHTS)) + 1).cast("int"))
    table = Stored(ranked.select("source", "source_size", "n_docs", weight.cast("double").alias("weight")), "weights").df
    # water level: Newton steps on a concave piecewise linear sum, exact after finitely many
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, None
    while total:
        over = F.col("source_size") * CAP < F.col("weight") * level
        row = table.agg(F.sum(F.when(over, F.col("source_size") * CAP)).alias("full"),
                        F.sum(F.when(over, None).otherwise(F.col("weight"))).alias("open"),
                        F.sum(over.cast("int")).alias("n")).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (BUDGET * total - (row["full"] or 0)) / row["open"]
    target = F.least(F.col("source_size").cast("double") * CAP, F.col("weight") * F.lit(float(level)))
    return table.withColumn("target", target)


def _rate(lam: Column, size: Column, scale: Column) -> Column:
    return F.when(size <= 0, F.lit(1.0)).otherwise(
        F.least(F.lit(float(CAP)), F.exp(F.least(F.lit(50.0), lam * size / scale))))


def balance(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, scale, lam): the multipliers of the dual.

    A source whose target is at its cap (or that has no words) needs no step:
    its multiplier is +infinity (rate CAP), kept as a large number."""
    top = 60.0
    state = targets.select(
        "source", "source_size", "target",
        F.greatest(F.lit(1.0), F.col("source_size") / F.col("n_docs")).alias("scale"),
        F.when(F.col("target") >= CAP * F.col("source_size"), F.lit(1e9))
        .otherwise(F.log(F.greatest(F.lit(1e-9), F.col("target") / F.col("source_size")))).alias("lam"),
        F.lit(-1e6).alias("lo"), F.lit(top * 1e6).alias("hi"),
        (F.col("target") >= CAP * F.col("source_size")).alias("done"))
    held = Stored(state, "duals")
    for _ in range(MAX_STEPS):
        s = held.df
        h = sizes.where("size > 0").join(
            s.where(~F.col("done")).select(F.col("source").alias("src"), "lam", "scale"),
            F.col("source").eqNullSafe(F.col("src")))
        size, rate = F.col("size"), _rate(F.col("lam"), F.col("size"), F.col("scale"))
        sums = h.groupBy("src").agg(
            _exact(F.col("n") * size * rate).alias("got"),
            _exact(F.when(rate < CAP, F.col("n") * size * rate * size / F.col("scale")).otherwise(0.0)).alias("slope"))
        gap = F.col("got") - F.col("target")
        near = F.abs(gap) <= F.greatest(F.lit(0.01), F.col("target") * 1e-9)
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - gap / F.col("slope")
        # a step that leaves the bracket is replaced by bisection, or by doubling while one side is open
        inside = (F.col("slope") > 0) & (newton > lo) & (newton < hi)
        middle = F.when(lo <= -1e5, F.least(F.col("lam") * 2, F.col("lam") - 1)).when(
            hi >= 1e7, F.greatest(F.col("lam") * 2, F.col("lam") + 1)).otherwise((lo + hi) / 2)
        step = F.when(F.col("done") | F.col("got").isNull() | near, F.col("lam")).when(inside, newton).otherwise(middle)
        new = s.join(sums, F.col("source").eqNullSafe(F.col("src")), "left").select(
            "source", "source_size", "target", "scale", step.alias("lam"), lo.alias("lo"), hi.alias("hi"),
            (F.col("done") | F.col("got").isNull() | near | (step == F.col("lam"))).alias("done"))
        held, old = Stored(new, "duals"), held
        left = held.df.where(~F.col("done")).limit(1).count()
        old.drop()
        if not left:
            break
    return held.df.select("source", "source_size", "target", "scale", "lam")


def _uniform(doc_id: Column) -> Column:
    """Uniform in [0, 1) by the id; a fixed hash, so reruns agree."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 8), 16, 10).cast("double") / float(1 << 32)


def _cuts(rows):
    """The cuts of one source from its bins, size classes from the largest
    down: each class makes up for what the larger ones took too much or too
    little. At most 2 * BINS + 1 rows for each of some forty classes."""
    import numpy as np
    import pandas as pd
    cuts, off = {}, 0.0  # off: words taken beyond those wanted so far
    classes = sorted(rows["cls"].unique(), reverse=True)
    slack = float(rows["target"].iloc[0]) - float(rows["want"].sum())
    for c in classes:
        part = rows[rows["cls"] == c]
        want = float(part["want"].sum()) + (slack if c == classes[-1] else 0.0)
        open_ = part[part["bin"].notna()].sort_values("bin")
        steps = np.concatenate([[0.0], np.cumsum(open_["more"].to_numpy(dtype=float))])
        gaps = np.abs(off + float(part["base"].sum()) + steps - want)
        k = int(np.argmin(gaps))
        cuts[int(c)] = int(open_["bin"].iloc[k - 1]) if k else -1
        off += float(part["base"].sum()) + steps[k] - want
    return pd.DataFrame({"source": [rows["source"].iloc[0]], "cuts": [cuts]})


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """All columns of ``df`` that clash with none of the results, plus size,
    source_size, target, rate, copies and taken. The text is read twice (sizes,
    then copies); it is never shuffled unless the sources are too many to
    broadcast, which Spark decides by their measured size."""
    results = {"size", "source_size", "target", "rate", "copies", "taken"}
    keep = [c for c in df.columns if c.lower() not in results]
    src = df.select(*[f"`{c}`" for c in keep],
                    F.struct(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                             n_words(F.col(f"`{text_col}`")).alias("size")).alias("__mix"))
    docs = Stored(src.select("__mix.*"), "doc-sizes").df
    sizes = Stored(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "size-histogram").df
    duals = balance(sizes, source_targets(sizes))

    def placed(frame: DataFrame, size: Column, ident: Column) -> DataFrame:
        """rate, floor and the position of the extra copy's threshold."""
        rate = _rate(F.col("d.lam"), size, F.col("d.scale"))
        frame = frame.withColumn("__rate", rate).withColumn("__floor", F.floor("__rate").cast("long"))
        v = _uniform(ident) - (F.col("__rate") - F.col("__floor"))
        return frame.withColumn("__bin", F.when(F.col("__floor") < CAP, F.floor((v + 1.0) * BINS).cast("int")))

    def size_class(size: Column) -> Column:
        return F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int")

    d = duals.alias("d")
    spread = placed(docs.alias("x").join(d, F.col("x.source").eqNullSafe(F.col("d.source"))), F.col("x.size"), F.col("x.id"))
    bins = (spread.where("x.size > 0")
            .groupBy(F.col("d.source").alias("source"), size_class(F.col("x.size")).alias("cls"), F.col("__bin").alias("bin"))
            .agg(F.sum(F.col("x.size") * F.col("__floor")).alias("base"), F.sum("x.size").alias("more"),
                 _exact(F.col("x.size") * F.col("__rate")).alias("want"), F.first("d.target").alias("target")))
    cuts = bins.groupBy("source").applyInPandas(_cuts, "source string, cuts map<int,int>")
    params = Stored(duals.alias("d").join(cuts.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")), "left")
                    .select("d.*", "c.cuts"), "mix-parameters").df

    out = placed(src.alias("x").join(params.alias("d"), F.col("x.__mix.source").eqNullSafe(F.col("d.source"))),
                 F.col("x.__mix.size"), F.col("x.__mix.id"))
    cut = F.col("d.cuts")[size_class(F.col("x.__mix.size"))]
    extra = F.coalesce((F.col("__bin") <= cut).cast("long"), F.lit(0))
    copies = F.when(F.col("x.__mix.size") > 0, F.col("__floor") + extra).otherwise(F.lit(1))
    return out.select(*[F.col(f"x.`{c}`") for c in keep], F.col("x.__mix.size").alias("size"),
                      F.col("d.source_size").alias("source_size"), F.col("d.target").alias("target"),
                      F.col("__rate").alias("rate"), copies.alias("copies"),
                      (copies * F.col("x.__mix.size")).alias("taken"))
