"""Exponential smoothing forecasts and series statistics.

A series is gathered per group with ``collect_list`` (partial aggregation
map-side), ordered with ``array_sort`` and folded with the SQL higher-order
``aggregate`` - all JVM-side, no Python. Groups are bounded: a forecast
looks at a fixed number of days, so no unbounded group is collected.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_div

UAR_COLS = ["uar1", "uar2", "uar3", "uar4", "uar5"]
UAR_ALPHA = "0.6"          # fixed value: smoothing level of the UAR forecast
UAR_HISTORY_DAYS = 7       # fixed value: days of history per forecast, [run - 7, run)
ACC = "decimal(38,18)"


def head_sum(values: Column, seed: int) -> Column:
    """Exact sum of the first ``seed`` elements of an array column."""
    return F.aggregate(F.slice(values, 1, seed), F.lit(0).cast(ACC), lambda s, x: (s + x).cast(ACC))


def mean_seed(total: Column, n: Column, seed: int) -> Column:
    """HALF_UP 6-decimal mean of the first ``n <= seed`` values, by integer
    remainder division: exact for every seed and for all 18 decimals kept."""
    return round_div(total, n, 6, "half_up", num_scale=18).cast(ACC)


def exp_smoothing(values: Column, alpha: str = UAR_ALPHA, seed: int = 1, start: Column | None = None) -> Column:
    """E1 / E2 over an ordered array column of decimals.

    ``seed=1``: start from the first element, which is also consumed
    (s = x0; for x in xs: s = a*x + (1-a)*s). ``seed=3``: start from the mean
    of the first <= 3 elements rounded HALF_UP to 6 decimals (``start`` may
    pass that seed precomputed).
    """
    # narrow literal types keep every step exact for short series (scale grows by one per step)
    a = F.lit(Decimal(alpha))
    one_minus = F.lit(Decimal(1) - Decimal(alpha))
    if start is None:
        if seed == 1:
            start = F.element_at(values, 1).cast(ACC)
        else:
            start = mean_seed(head_sum(values, seed), F.least(F.size(values), F.lit(seed)), seed)
    return F.aggregate(values, start, lambda s, x: (a * x + one_minus * s).cast(ACC))


def smooth_series(series: DataFrame, keys: list[str], order: str, value_cols: list[str],
                  alpha: str = UAR_ALPHA, seed: int = 1) -> DataFrame:
    """Smooth each value column of a (keys, order, values) series per key.

    For a mean seed, the head sums and counts are computed as columns first,
    so the head-sum lambda runs once per group and column."""
    arr = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in value_cols])))
    g = series.groupBy(*keys).agg(arr.alias("_s"))
    if seed == 1:
        return g.select(*keys, *[exp_smoothing(F.col("_s").getField(c), alpha, seed).alias(c)
                                 for c in value_cols])
    g = g.select(*keys, "_s", F.least(F.size("_s"), F.lit(seed)).alias("_n"),
                 *[head_sum(F.col("_s").getField(c), seed).alias(f"_h_{c}") for c in value_cols])
    g = g.select(*keys, "_s", *[mean_seed(F.col(f"_h_{c}"), F.col("_n"), seed).alias(f"_seed_{c}")
                                for c in value_cols])
    return g.select(*keys, *[exp_smoothing(F.col("_s").getField(c), alpha, seed, start=F.col(f"_seed_{c}")).alias(c)
                             for c in value_cols])


def forecast_uar(apps: DataFrame, uar_daily: DataFrame, begin_day=None, end_day=None,
                 alpha: str = UAR_ALPHA, seed: int = 1) -> DataFrame:
    """Per app x country and run day R, smooth the UAR series of days
    ``[R - 7, R)``. Apps: status 1 with a region list set (left-semi join).

    Set-oriented: every daily point is fanned out to the (at most 7) run days
    whose window holds it, then each (app, country, R) folds its <= 7 points.
    ``begin_day``/``end_day`` bound the run days (None = every run day some
    data reaches).
    """
    eligible = apps.filter((F.col("status") == 1) & F.col("uar_regions").isNotNull()) \
                   .select(F.col("id").alias("pub_app_id"))
    # Shuffle the daily series once by (app, country): that partitioning
    # already satisfies the (app, country, run_day) grouping below, so the
    # 7x fan-out is grouped inside its partition instead of being shuffled.
    # A partition key holds at most one row per day, so even a hot app is
    # bounded by the number of days.
    pts = uar_daily.join(eligible, "pub_app_id", "left_semi").repartition("pub_app_id", "country")
    runs = F.sequence(F.date_add("day", 1), F.date_add("day", UAR_HISTORY_DAYS))
    fanned = pts.select("*", F.explode(runs).alias("run_day"))
    if begin_day is not None:
        fanned = fanned.filter(F.col("run_day") >= F.lit(begin_day))
    if end_day is not None:
        fanned = fanned.filter(F.col("run_day") <= F.lit(end_day))
    return smooth_series(fanned, ["pub_app_id", "country", "run_day"], "day", UAR_COLS, alpha, seed)


def uar_region_map(forecast: DataFrame, apps: DataFrame) -> DataFrame:
    """Per app and run day, a map country -> [uar1..uar5 x 1000] of the
    app's whitelisted regions only, and its JSON text (``{}`` when none).
    Every eligible app with a forecast gets a row."""
    regions = (apps.filter((F.col("status") == 1) & F.col("uar_regions").isNotNull())
               .select(F.col("id").alias("pub_app_id"), F.split("uar_regions", ",").alias("_regions")))
    f = forecast.join(regions, "pub_app_id", "inner")
    entry = F.when(F.array_contains("_regions", F.col("country")),
                   F.struct(F.col("country").alias("key"),
                            F.array(*[(F.col(c) * F.lit(1000)).cast("decimal(38,15)") for c in UAR_COLS])
                            .alias("value")))
    g = f.groupBy("pub_app_id", "run_day").agg(F.collect_list(entry).alias("_e"))
    m = F.map_from_entries(F.array_sort("_e"))
    return g.select("pub_app_id", "run_day", m.alias("region_uar"), F.to_json(m).alias("region_uar_json"))


# ---------------------------------------------------------------- E5-E10

def series_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """E5-E10 per group: population/sample variance and std-dev, mean
    (HALF_UP, 6 decimals) and coefficient of variation (0 when mean is 0).
    Sample statistics of a single point are NULL."""
    x = F.col(value)
    g = df.groupBy(*keys).agg(
        F.var_pop(x).alias("var_pop"), F.stddev_pop(x).alias("stddev_pop"),
        F.var_samp(x).alias("var_samp"), F.stddev_samp(x).alias("stddev_samp"),
        F.sum(x).alias("_sum"), F.count(x).alias("_n"), F.avg(x.cast("double")).alias("_avg"))
    return g.select(*keys, "var_pop", "stddev_pop", "var_samp", "stddev_samp",
                    round_div("_sum", "_n", 6, "half_up").alias("mean6"),
                    F.when(F.col("_avg") == 0, F.lit(0.0))
                    .otherwise(F.col("stddev_pop") / F.col("_avg")).alias("coeff_variation"))
