"""eCPM rollups over daily network statistics.

One parametrised operator replaces eighteen hand-written datasets. A window
either ends on the ``as_of`` day, or - for "delay" datasets - on
``date(as_of - delay(network))`` with a per-network reporting delay: the
delay table is joined once (it is a bounded per-network config table, so
Spark plans a broadcast hash join from its statistics) instead of issuing one
query per network. Aggregation is map-side combined; HAVING becomes a filter
after the aggregate.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import ecpm as ecpm_expr

# Reporting delay of each ad network, in hours (network id -> hours).
DEFAULT_NETWORK_DELAY_HOURS = {
    1: 1, 2: 3, 3: 9, 4: 2, 5: 1, 6: 11, 7: 1, 8: 1, 9: 47, 11: 1,
    12: 9, 13: 16, 14: 2, 15: 1, 17: 12, 18: 10, 19: 1, 20: 14, 21: 10, 23: 10,
}


def default_delays(spark: SparkSession) -> DataFrame:
    rows = sorted(DEFAULT_NETWORK_DELAY_HOURS.items())
    return spark.createDataFrame(rows, "adn_id int, delay_hours int")


@dataclass(frozen=True)
class EcpmSpec:
    name: str
    keys: tuple[str, ...]
    money: str = "revenue"            # revenue | cost
    min_impr: int = 0                 # HAVING impr_sum > min_impr
    min_money: float | None = None    # HAVING money_sum > min_money
    rounding: str = "half_down"
    span_days: int = 0                # window = [end - span_days days, end]
    span_hours: int = 0               # window = [date(end_ts - span_hours), date(end_ts)]
    delay: bool = False               # end = as_of - network delay
    country_not_null: bool = True
    merge: str = "single"             # single | sum (per day, then summed) | latest (per day, latest day)
    series: bool = False              # emit the per-day (impr, money) series instead of an eCPM
    extra: dict = field(default_factory=dict)


# The 18 datasets. Per-network datasets also group by adn_id (the reference
# ran one query per network), which is dropped from the output when not a key.
SPECS = [
    EcpmSpec("stat_instance_country_ecpm", ("instance_id", "country"), money="cost", min_money=0, span_days=3),
    EcpmSpec("stat_placement_country_ecpm", ("placement_id", "country"), money="cost", min_money=0, span_days=3),
    EcpmSpec("stat_placement_ecpm", ("placement_id", "country"), min_impr=2000, rounding="half_up", span_days=7),
    EcpmSpec("stat_country_adtype_ecpm", ("country", "ad_type"), rounding="half_up", span_days=7),
    EcpmSpec("stat_instance_country_ecpm_3h", ("instance_id", "country"), min_impr=2000, min_money=0,
             span_hours=3, delay=True),
    EcpmSpec("stat_instance_country_ecpm_6h", ("instance_id", "country"), min_impr=2000, min_money=0,
             span_hours=6, delay=True),
    EcpmSpec("stat_instance_country_ecpm_12h", ("instance_id", "country"), min_impr=2000, min_money=0,
             span_hours=12, delay=True),
    EcpmSpec("stat_instance_country_ecpm_24h", ("instance_id", "country"), min_impr=2000, min_money=0,
             span_hours=24, delay=True),
    EcpmSpec("stat_adn_country_ecpm24h", ("adn_id", "country"), min_impr=2000, min_money=0, span_hours=24,
             delay=True),
    EcpmSpec("stat_adn_adtype_country_ecpm3d", ("adn_id", "ad_type", "country"), min_impr=2000, min_money=0,
             span_days=3, delay=True, country_not_null=False),
    EcpmSpec("stat_adn_ecpm3d", ("adn_id",), min_impr=2000, min_money=0, span_days=3, delay=True,
             country_not_null=False),
    EcpmSpec("instance_country_ecpm_7d", ("instance_id", "country"), span_days=7, delay=True, series=True),
    EcpmSpec("adn_adtype_country_ecpm_3d", ("adn_id", "ad_type", "country"), span_days=3, delay=True,
             merge="latest"),
    EcpmSpec("adtype_country_ecpm_3d", ("ad_type", "country"), span_days=3, merge="sum"),
    EcpmSpec("country_ecpm_3d", ("country",), span_days=3, merge="sum"),
    EcpmSpec("adtype_ecpm_3d", ("ad_type",), span_days=3, merge="sum"),
    EcpmSpec("adn_adtype_ecpm_3d", ("adn_id", "ad_type"), span_days=3, delay=True, merge="latest"),
    EcpmSpec("adn_ecpm_3d", ("adn_id",), span_days=3, delay=True, merge="latest"),
]
SPEC_BY_NAME = {s.name: s for s in SPECS}


def _ntz(ts: _dt.datetime) -> Column:
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def delay_window(stat: DataFrame, as_of: _dt.datetime, spec: EcpmSpec, delays: DataFrame | None) -> DataFrame:
    """Keep the rows inside the dataset's day window.

    With a delay, rows of networks missing from ``delays`` (or with a NULL
    delay) are dropped, as the reference only queried listed networks. The
    largest delay is read from the (small) delay table once so the scan gets a
    static day range it can prune partitions with.
    """
    now = _ntz(as_of)
    if not spec.delay:
        end = F.to_date(now)
        start = (F.date_sub(end, spec.span_days) if spec.span_days
                 else F.to_date(now - F.make_interval(hours=F.lit(spec.span_hours))))
        return stat.filter((F.col("day") >= start) & (F.col("day") <= end))
    d = delays.filter(F.col("delay_hours").isNotNull()).select("adn_id", "delay_hours")
    max_delay = d.agg(F.max("delay_hours")).first()[0] or 0
    lower = (as_of - _dt.timedelta(hours=max_delay + spec.span_hours, days=spec.span_days)).date()
    pruned = stat.filter((F.col("day") >= F.lit(lower)) & (F.col("day") <= F.lit(as_of.date())))
    end_ts = now - F.make_interval(hours=F.col("delay_hours"))
    end = F.to_date(end_ts)
    start = (F.date_sub(end, spec.span_days) if spec.span_days
             else F.to_date(end_ts - F.make_interval(hours=F.lit(spec.span_hours))))
    return (pruned.join(d, "adn_id", "inner")
            .filter((F.col("day") >= start) & (F.col("day") <= end)).drop("delay_hours"))


def ecpm_rollup(stat: DataFrame, spec: EcpmSpec | str, as_of: _dt.datetime,
                delays: DataFrame | None = None) -> DataFrame:
    """Compute one eCPM dataset. ``stat`` columns: day (date), adn_id,
    instance_id, placement_id, ad_type, country, api_impr, revenue, cost."""
    if isinstance(spec, str):
        spec = SPEC_BY_NAME[spec]
    if spec.delay and delays is None:
        delays = default_delays(stat.sparkSession)
    src = delay_window(stat, as_of, spec, delays)
    if spec.country_not_null:
        src = src.filter(F.col("country").isNotNull())
    grp = list(spec.keys)
    if spec.delay and "adn_id" not in grp:
        grp = ["adn_id", *grp]
    money = spec.money
    if spec.series or spec.merge in ("sum", "latest"):
        daily = (src.groupBy("day", *grp).agg(F.sum("api_impr").alias("impr_sum"), F.sum(money).alias("money_sum"))
                 .filter(F.col("impr_sum") > 0))
        if spec.series:
            return daily.select(*spec.keys, F.date_format("day", "yyyy-MM-dd").alias("day"),
                                F.col("impr_sum").cast("int").alias("impr"),
                                F.col("money_sum").alias(money))
        if spec.merge == "sum":
            agg = daily.groupBy(*grp).agg(F.sum("impr_sum").alias("impr_sum"), F.sum("money_sum").alias("money_sum"))
        else:  # latest day wins (deterministic version of the reference's map overwrite)
            agg = daily.groupBy(*grp).agg(F.max_by(F.struct("impr_sum", "money_sum"), "day").alias("_l")).select(
                *grp, "_l.impr_sum", "_l.money_sum")
    else:
        agg = src.groupBy(*grp).agg(F.sum("api_impr").alias("impr_sum"), F.sum(money).alias("money_sum"))
        agg = agg.filter(F.col("impr_sum") > spec.min_impr)
        if spec.min_money is not None:
            agg = agg.filter(F.col("money_sum") > spec.min_money)
    out = agg.select(*spec.keys, ecpm_expr("money_sum", "impr_sum", spec.rounding).alias("ecpm"))
    if "country" in spec.keys and not spec.country_not_null:
        out = out.withColumn("country", F.coalesce("country", F.lit("")))
    return out


# ---------------------------------------------------------------- all datasets at once

STAT_DIMS = ["adn_id", "instance_id", "placement_id", "ad_type", "country"]


def daily_partials(stat: DataFrame) -> DataFrame:
    """Per day and combination of ``STAT_DIMS`` the sums that every dataset is
    made from. Additive: a job stores its own days (slots ``day``) and the
    rollups read the stored days of their windows, never the raw statistics."""
    return stat.groupBy("day", *STAT_DIMS).agg(F.sum("api_impr").alias("api_impr"), F.sum("revenue").alias("revenue"),
                                               F.sum("cost").alias("cost"))


def _grouping(spec: EcpmSpec) -> list[str]:
    return [d for d in STAT_DIMS if d in spec.keys or (d == "adn_id" and spec.delay)]


def _window(spec: EcpmSpec, as_of: _dt.datetime) -> Column:
    """D19 as a condition on ``day`` and ``delay_hours`` (NULL: never inside)."""
    end_ts = _ntz(as_of) - F.make_interval(hours=F.col("delay_hours")) if spec.delay else _ntz(as_of)
    start = (F.date_sub(F.to_date(end_ts), spec.span_days) if spec.span_days
             else F.to_date(end_ts - F.make_interval(hours=F.lit(spec.span_hours))))
    return F.coalesce((F.col("day") >= start) & (F.col("day") <= F.to_date(end_ts)), F.lit(False))


def ecpm_rollups(partials: DataFrame, as_of: _dt.datetime, delays: DataFrame | None = None,
                 specs: list[EcpmSpec] | None = None) -> DataFrame:
    """D1-D18 in one job: every dataset of ``specs``, tagged ``dataset``, from
    one scan of ``partials`` (or of the statistics themselves).

    One ``GROUPING SETS`` pass sums per day for each distinct key set (whether
    a country is known is a key of all of them, since some datasets leave the
    unknown ones out); its daily rows, a small fraction of the input, are dealt to the
    datasets whose window holds their day and summed again, which also merges
    their days. Columns that a dataset lacks are NULL; a series has
    ``day``, ``impr`` and its ``money`` instead of an ``ecpm``."""
    specs = specs or SPECS
    if delays is None:
        delays = default_delays(partials.sparkSession)
    known = delays.filter(F.col("delay_hours").isNotNull()).select("adn_id", "delay_hours")
    max_delay = known.agg(F.max("delay_hours")).first()[0] or 0
    lower = min(as_of - _dt.timedelta(hours=s.span_hours + (max_delay if s.delay else 0), days=s.span_days) for s in specs).date()
    src = partials.filter((F.col("day") >= F.lit(lower)) & (F.col("day") <= F.lit(as_of.date()))) \
        .withColumn("_known", F.col("country").isNotNull())

    fixed = ["day", "_known"]
    columns = [*fixed, *STAT_DIMS]
    sets = sorted({tuple(_grouping(s)) for s in specs})
    # the bit of a column is set where it is summed over; the first column has the highest bit
    number = {keys: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in fixed and c not in keys) for keys in sets}
    money_type = "decimal(34,4)"
    daily = src.groupingSets([[*fixed, *keys] for keys in sets], *columns).agg(
        F.sum("api_impr").alias("_impr"), F.sum("revenue").cast(money_type).alias("_revenue"),
        F.sum("cost").cast(money_type).alias("_cost"), F.grouping_id().alias("_set"))

    def takes(spec: EcpmSpec) -> Column:
        cond = (F.col("_set") == number[tuple(_grouping(spec))]) & _window(spec, as_of)
        if spec.country_not_null:
            cond = cond & F.col("_known")
        if spec.series or spec.merge != "single":
            if not spec.country_not_null and "country" not in spec.keys:
                raise ValueError(f"{spec.name}: the days of a merged dataset need one row per key")
            cond = cond & (F.col("_impr") > 0)
        return cond

    def of(value, *, when=None) -> Column:
        """The spec's value, or whether the spec is one of those for which ``when`` holds."""
        if when is not None:
            chosen = [i for i, s in enumerate(specs) if when(s)]
            return F.col("_spec").isin(chosen) if chosen else F.lit(False)
        return F.element_at(F.array(*[F.lit(value(s)) for s in specs]), F.col("_spec") + 1)

    wanted = F.array_compact(F.array(*[F.when(takes(s), F.lit(i)) for i, s in enumerate(specs)]))
    rows = daily.join(known, "adn_id", "left").select("*", F.explode(wanted).alias("_spec")).select(
        "_spec", *STAT_DIMS, "day", F.when(of(None, when=lambda s: s.series), F.col("day")).alias("_day"), "_impr",
        F.when(of(None, when=lambda s: s.money == "cost"), F.col("_cost")).otherwise(F.col("_revenue")).alias("_money"))
    merged = rows.groupBy("_spec", "_day", *STAT_DIMS).agg(
        F.sum("_impr").alias("_all"), F.sum("_money").alias("_sum"), F.max_by(F.struct("_impr", "_money"), "day").alias("_last"))
    latest = of(None, when=lambda s: s.merge == "latest")
    merged = merged.withColumns({"_impr": F.when(latest, F.col("_last._impr")).otherwise(F.col("_all")),
                                 "_money": F.when(latest, F.col("_last._money")).otherwise(F.col("_sum"))})
    single = of(None, when=lambda s: s.merge == "single" and not s.series)
    least = of(lambda s: s.min_money)
    kept = merged.filter(~single | ((F.col("_impr") > of(lambda s: s.min_impr)) & (least.isNull() | (F.col("_money") > least))))
    series = of(None, when=lambda s: s.series)
    ratio = F.when(of(None, when=lambda s: s.rounding == "half_up"), ecpm_expr("_money", "_impr", "half_up")) \
        .otherwise(ecpm_expr("_money", "_impr", "half_down"))
    country = F.when(of(None, when=lambda s: "country" in s.keys and not s.country_not_null), F.coalesce("country", F.lit(""))) \
        .otherwise(F.col("country"))
    return kept.select(
        of(lambda s: s.name).alias("dataset"), F.when(of(None, when=lambda s: "adn_id" in s.keys), F.col("adn_id")).alias("adn_id"),
        "instance_id", "placement_id", "ad_type", country.alias("country"),
        F.when(series, F.date_format("_day", "yyyy-MM-dd")).alias("day"), F.when(~series, ratio).alias("ecpm"),
        F.when(series, F.col("_impr").cast("int")).alias("impr"), F.when(series, F.col("_money")).alias("money"))
