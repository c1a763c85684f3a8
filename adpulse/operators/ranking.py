"""Exact k-th largest value per group without a per-group window over rows.

``ROW_NUMBER() OVER (PARTITION BY g ORDER BY v DESC)`` puts a whole group in
one task. Here the rows are first counted per (group, value), so any number
of ties is one row. Values fall into slices by a fixed monotone function; a
window over a group's slice counts finds the slice that holds a wanted rank,
and only that slice's distinct values are ordered. Nothing is written, and
every step is a deterministic function of the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES_PER_E = 256  # slices per factor e of the value


def _slice(value: Column) -> Column:
    """Monotone in the value: a signed logarithm, cut into slices."""
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.log1p(F.abs(v) * 1e6) * SLICES_PER_E)).cast("long")


def select_ranks(df: DataFrame, keys: list[str], value: str,
                 ranks: Callable[[Column], list[tuple[str, Column]]],
                 min_count: int = 0) -> DataFrame:
    """Return ``keys, n, label, rank, value`` for each group with more than
    ``min_count`` rows and each ``(label, rank_expr(n))`` of ``ranks``; ``rank``
    is 1-based in descending ``value`` order, NULL values last (only the value
    at the rank is returned, which ties do not change)."""
    counts = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumn("_s", _slice(F.col("_v")))
    group = Window.partitionBy(*keys)
    slices = (counts.groupBy(*keys, "_s").agg(F.sum("_c").alias("_c"))
              .withColumn("n", F.sum("_c").over(group))
              .withColumn("_before", F.sum("_c").over(group.orderBy(F.col("_s").desc_nulls_last())) - F.col("_c"))
              .filter(F.col("n") > min_count))
    wanted = F.array(*[F.struct(F.lit(lbl).alias("label"), expr.cast("long").alias("rank"))
                       for lbl, expr in ranks(F.col("n"))])
    targets = (slices.select(*keys, "_s", "n", "_before", "_c", F.explode(wanted).alias("_w"))
               .select(*keys, "_s", "n", "_before", "_c", "_w.label", "_w.rank")
               .filter((F.col("rank") > F.col("_before")) & (F.col("rank") <= F.col("_before") + F.col("_c")))
               .drop("_c")).alias("t")
    c = counts.alias("c")
    same = F.col("c._s").eqNullSafe(F.col("t._s"))
    for k in keys:
        same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"t.{k}"))
    inside = c.join(targets, same).select(*[F.col(f"t.{k}") for k in keys], "n", "label", "rank", "_before", "c._v", "c._c")
    upto = F.sum("_c").over(Window.partitionBy(*keys, "label").orderBy(F.col("_v").desc_nulls_last()))
    return (inside.withColumn("_upto", F.col("_before") + upto)
            .filter((F.col("rank") <= F.col("_upto")) & (F.col("rank") > F.col("_upto") - F.col("_c")))
            .select(*keys, "n", "label", "rank", F.col("_v").alias(value)))
