"""Daily user activity reports (C3-C7c) and new/old user marking."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import day_filter

# Dimension sets of the optional user reports (C4-C7b), on top of BASE.
USER_DIM_SETS = {
    "base": [],
    "abtest": ["abt", "abt_id"],
    "adn": ["adn_id"],
    "adn_placement": ["placement_id", "adn_id"],
    "placement": ["placement_id"],
    "instance": ["placement_id", "instance_id", "adn_id"],
}

# report dimension -> log field (NULL -> 0)
_EXTRA_DIMS = {"abt": "abt", "abt_id": "abtId", "adn_id": "mid", "placement_id": "pid", "instance_id": "iid"}

USER_BASE_DIMS = ["day", "publisher_id", "pub_app_id", "platform", "country",
                  "app_version", "sdk_version", "os_version"]


def _base_dims() -> list[Column]:
    return [
        F.date_format("dt", "yyyy-MM-dd").alias("day"),
        F.coalesce("publisherId", F.lit(0)).alias("publisher_id"),
        F.coalesce("pubAppId", F.lit(0)).alias("pub_app_id"),
        F.coalesce("plat", F.lit(-1)).alias("platform"),
        F.col("country"),
        F.col("appv").alias("app_version"),
        F.col("sdkv").alias("sdk_version"),
        F.col("osv").alias("os_version"),
    ]


def user_report(lr: DataFrame, begin_day=None, end_day=None, dims: str | list[str] = "base",
                exact_deu: bool = False, approx_rsd: float | None = None) -> DataFrame:
    """Distinct ip / did / uid (DAU) and engaged users (DEU) per day.

    ``dims`` names a set of USER_DIM_SETS or lists extra dimensions. The
    default DEU is the reference's ``count(DISTINCT if(type=6, uid, '')) - 1``
    (one too low when every row of a group is an impression); ``exact_deu``
    counts distinct impression uids instead.

    Four distinct counts compile to one Expand + two-level aggregation: the
    first shuffle is keyed by (group, distinct value), so a hot group is
    spread across tasks and deduplicated before the final per-group count.
    ``approx_rsd`` switches to HyperLogLog++ sketches (``approx_count_distinct``
    with that relative standard deviation): a named, non-exact variant that
    needs no Expand and shuffles one small sketch per group and map task.
    """
    extra = USER_DIM_SETS[dims] if isinstance(dims, str) else list(dims)
    src = lr.filter(F.col("serverTs").isNotNull() & day_filter("dt", begin_day, end_day))

    def distinct(c):
        return F.count_distinct(c) if approx_rsd is None else F.approx_count_distinct(c, approx_rsd)

    if exact_deu:
        deu = distinct(F.when(F.col("type") == 6, F.col("uid")))
    else:
        deu = distinct(F.when(F.col("type") == 6, F.col("uid")).otherwise(F.lit(""))) - 1
    return src.groupBy(*_base_dims(), *[F.coalesce(_EXTRA_DIMS[d], F.lit(0)).alias(d) for d in extra]).agg(
        distinct(F.col("ip")).alias("ip_count"),
        distinct(F.col("did")).alias("did_count"),
        distinct(F.col("uid")).alias("dau"),
        deu.alias("deu"),
    )


def user_reports(lr: DataFrame, begin_day=None, end_day=None, enabled=("adn", "adn_placement", "placement",
                                                                       "instance")) -> dict[str, DataFrame]:
    """Base and abtest always, plus the enabled optional reports.

    The log is parsed and reduced once, to the distinct (dimensions, ip, did,
    uid, impression) of all the reports; every count is a distinct count, so
    each report is counted from that frame. Spark computes its exchange once
    where the reports run in one job (``user_reports_table``); a caller that
    writes them one by one stores the ``"_shared"`` frame first.
    """
    names = ["base", "abtest"] + [n for n in enabled if n not in ("base", "abtest")]
    extra = list(dict.fromkeys(_EXTRA_DIMS[d] for n in names for d in USER_DIM_SETS[n]))
    impression = F.when(F.col("type") == 6, 6).alias("type")
    shared = (lr.filter(F.col("serverTs").isNotNull() & day_filter("dt", begin_day, end_day))
              .select("dt", "publisherId", "pubAppId", "plat", "country", "appv", "sdkv", "osv", "ip", "did", "uid",
                      impression, *extra).distinct().withColumn("serverTs", F.lit(0)))
    out = {n: user_report(shared, dims=n) for n in names}
    out["_shared"] = shared
    return out


def user_reports_table(lr: DataFrame, begin_day=None, end_day=None, **kw) -> DataFrame:
    """C7c as one frame: the rows of every enabled report, tagged ``report``;
    dimensions that a report lacks are NULL."""
    reports = user_reports(lr, begin_day, end_day, **kw)
    out = None
    for name, df in reports.items():
        if name != "_shared":
            tagged = df.withColumn("report", F.lit(name))
            out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- C8

USER_KEYS = ["publisher_id", "pub_app_id", "country", "uid"]


def _ymd(d) -> str:
    return d.strftime("%Y%m%d") if isinstance(d, (_dt.date, _dt.datetime)) else str(d)


def mark_publisher_users(lr: DataFrame, history: DataFrame | None = None, begin_day=None,
                         end_day=None) -> DataFrame:
    """(publisher, app, country, uid) active per day, flagged ``is_new``.

    ``is_new = 1`` on the first day a key is seen, unless ``history`` already
    holds an ``is_new = 1`` row for it on an earlier day than the run. One
    run over a day range equals running the days one after another.

    Plan: one shuffle groups each key's active days (partial collect_set
    map-side; the set is bounded by the days in the run), then a left join
    against the history's new-user rows. At scale the history should be
    stored bucketed by these keys so the join does not reshuffle it daily.
    """
    src = lr.filter(F.col("serverTs").isNotNull() & day_filter("dt", begin_day, end_day)
                    & F.col("publisherId").isNotNull() & F.col("pubAppId").isNotNull()
                    & F.col("country").isNotNull() & F.col("uid").isNotNull())
    keyed = src.select(F.col("publisherId").alias("publisher_id"), F.col("pubAppId").alias("pub_app_id"),
                       "country", F.coalesce("uid", F.lit("")).alias("uid"), "dt")
    per_key = keyed.groupBy(*USER_KEYS).agg(F.array_sort(F.collect_set("dt")).alias("_days"))
    if history is not None:
        known = history.filter(F.col("is_new") == 1)
        if begin_day is not None:
            known = known.filter(F.col("ymd") < F.lit(_ymd(begin_day)))
        known = known.select(*USER_KEYS).distinct().withColumn("_known", F.lit(True))
        per_key = per_key.join(known, USER_KEYS, "left")
    else:
        per_key = per_key.withColumn("_known", F.lit(None).cast("boolean"))
    exploded = per_key.select(*USER_KEYS, "_known", F.posexplode("_days").alias("_pos", "_dt"))
    return exploded.select(
        *USER_KEYS,
        F.when((F.col("_pos") == 0) & F.col("_known").isNull(), 1).otherwise(0).alias("is_new"),
        F.date_format("_dt", "yyyyMMdd").alias("ymd"),
    )
