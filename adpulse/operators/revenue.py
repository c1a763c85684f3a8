"""Revenue jobs: rank prices (C9), user ad revenue (C10), cost allocation
(C11a), IAP value (C11b), LTV / retention cohorts (C11, C11c), restatement
(C12)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import day_filter
from .funnel import counter_value
from .ranking import select_ranks

# ---------------------------------------------------------------- C9

# Percentile points of the rank prices (rank = floor(n * p)).
RANK_PRICE_POINTS = [("top10_price", 1), ("top20_price", 2), ("top30_price", 3), ("top40_price", 4),
                     ("top50_price", 5)]
RANK_PRICE_MIN_DEVICES = 10


def revenue_rank_prices(lr: DataFrame, begin_day=None, end_day=None, grain: str = "day") -> DataFrame:
    """Per app x country, the device revenue at rank floor(n*p) for
    p = 0.1..0.5 (descending), divided by 1000, for groups with n > 10.

    ``grain='day'`` gives one row per day (the reference's daily job);
    ``grain='range'`` treats the whole day range as one period.
    The ``decimal(10,8)`` target overflows at >= 100; ``try_cast`` yields NULL
    there instead of failing the job.
    """
    src = lr.filter(F.col("serverTs").isNotNull() & day_filter("dt", begin_day, end_day)
                    & (F.col("revenue") > 0) & (F.col("type") == 6))
    keys = (["dt"] if grain == "day" else []) + ["pubAppId", "country"]
    devices = src.groupBy(*keys, "did").agg(F.sum("revenue").alias("revenue"))
    picked = select_ranks(devices, keys, "revenue",
                          lambda n: [(lbl, F.floor(n * k / 10)) for lbl, k in RANK_PRICE_POINTS],
                          min_count=RANK_PRICE_MIN_DEVICES)
    price = (F.col("revenue") / F.lit(1000)).try_cast("decimal(10,8)")
    wide = picked.groupBy(*keys).agg(*[F.max(F.when(F.col("label") == lbl, price)).alias(lbl)
                                       for lbl, _ in RANK_PRICE_POINTS])
    out = wide.withColumnRenamed("pubAppId", "pub_app_id")
    if grain == "day":
        out = out.withColumn("day", F.date_format("dt", "yyyy-MM-dd")).drop("dt")
    return out.select(*(["day"] if grain == "day" else []), "pub_app_id", "country",
                      *[F.col(lbl) for lbl, _ in RANK_PRICE_POINTS])


# ---------------------------------------------------------------- allocation

def allocation_weight(impr: Column, click: Column) -> Column:
    """Weight of a device / user inside an instance: impressions + 4 clicks."""
    return impr + F.lit(4) * click


HOT_ROWS = 1_000_000  # devices or users of an instance and day that one task joins


def allocate_cost(events: DataFrame, cost: DataFrame, inst_keys: list[str], who: list[str],
                  cost_keys: list[str] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Spread each instance's cost over ``who`` by weight impr+4*click.

    ``events`` carries ``inst_keys + who + [shows, taps]`` (any grain;
    it is pre-aggregated per (instance, who) first: allocation is linear, so
    this equals the reference's row-level window up to rounding and shuffles
    one row per (instance, who) instead of every log row).
    ``cost`` carries ``cost_keys + [cost]`` already summed per key.
    Instance totals come from a groupBy (map-side combined), are joined to the
    cost once (small x small) and then joined back to the per-who rows. That
    join is the only wide one, and salted by a measured fan-out: an instance with
    more than ``hot_rows`` rows gets as many salts as it has that many rows, its
    rows are dealt over them by a hash of ``who`` and its one total is
    repeated for each. The table of hot instances has at most (rows / hot_rows)
    rows: that bound is what lets it be broadcast.
    ``cost_keys`` (default ``inst_keys``) join with plain equality, so a NULL
    key never matches a cost (revenue 0), while totals group NULLs together.
    Returns ``inst_keys + who + [shows, taps, value]`` with ``value``
    a decimal(38,12) share; instances without weight or cost give 0.
    """
    cost_keys = cost_keys or inst_keys
    per_who = events.groupBy(*inst_keys, *who).agg(F.sum("shows").alias("shows"),
                                                   F.sum("taps").alias("taps"))
    totals = per_who.groupBy(*inst_keys).agg(F.sum("shows").alias("all_shows"),
                                             F.sum("taps").alias("all_taps"), F.count("*").alias("_rows"))
    totals = totals.withColumn("_salts", F.when(F.col("_rows") > hot_rows, F.ceil(F.col("_rows") / hot_rows)).otherwise(F.lit(1)))
    # reading the sums here too keeps both uses of the totals alike, so that Spark computes their exchange once
    hot = totals.filter((F.col("_rows") > hot_rows) & (F.col("all_shows") + F.col("all_taps") >= 0)).select(*inst_keys, "_salts")
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in inst_keys]
    inst = totals.alias("t").join(
        cost.alias("c"), [F.col(f"t.{k}") == F.col(f"c.{k}") for k in cost_keys], "left"
    ).select(*[F.col(f"t.{k}").alias(k) for k in inst_keys], "all_shows", "all_taps", F.col("c.cost"), "_salts")
    salts = F.coalesce(F.col("h._salts"), F.lit(1))
    per_who = per_who.alias("w").join(hot.hint("broadcast").alias("h"), same("w", "h"), "left").select(
        "w.*", F.pmod(F.xxhash64(*[F.col(f"w.{c}") for c in who]), salts).alias("_salt"))
    inst = inst.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("_salt"))
    joined = per_who.alias("w").join(inst.alias("i"), [*same("w", "i"), F.col("w._salt") == F.col("i._salt")], "inner")
    w = allocation_weight(F.col("shows"), F.col("taps"))
    total = allocation_weight(F.col("all_shows"), F.col("all_taps"))
    cst = F.coalesce(F.col("cost"), F.lit(0))
    share = (w.cast("double") * cst.cast("double") / total.cast("double")).cast("decimal(38,12)")
    value = F.when((cst == 0) | ((F.col("all_shows") + F.col("all_taps")) == 0),
                   F.lit(0).cast("decimal(38,12)")).otherwise(share)
    return joined.select(*[F.col(f"w.{k}").alias(k) for k in inst_keys], *[F.col(f"w.{k}") for k in who],
                         F.col("w.shows"), F.col("w.taps"), value.alias("value"))


# ---------------------------------------------------------------- C10

def user_ad_revenue(lr: DataFrame, cost: DataFrame, adn: DataFrame | None, begin_day=None,
                    end_day=None) -> DataFrame:
    """Each instance's daily cost allocated to devices, summed per
    (day, device, app, device type, network), labelled with the network's
    class name. ``cost`` columns: dt, pub_app_id, platform, adn_id, country,
    instance_id, cost. ``adn``: id, class_name (a bounded dimension).
    """
    src = lr.filter(F.col("serverTs").isNotNull() & day_filter("dt", begin_day, end_day))
    events = src.select(
        "dt",
        F.coalesce("pubAppId", F.lit(0)).alias("pub_app_id"),
        F.coalesce("plat", F.lit(-1)).alias("platform"),
        F.coalesce("mid", F.lit(0)).alias("adn_id"),
        F.col("country"),
        F.coalesce("iid", F.lit(0)).alias("instance_id"),
        F.coalesce("did", F.lit("")).alias("device_id"),
        counter_value(6, "impr").alias("shows"),
        counter_value(7, "click").alias("taps"),
    )
    inst_keys = ["dt", "pub_app_id", "platform", "adn_id", "country", "instance_id"]
    cost_sum = (cost.filter(day_filter("dt", begin_day, end_day))
                .groupBy(*inst_keys).agg(F.sum(F.coalesce("cost", F.lit(0))).alias("cost")))
    alloc = allocate_cost(events, cost_sum, inst_keys, ["device_id"])
    per_dev = alloc.groupBy(
        "dt", "device_id", "pub_app_id",
        F.when(F.col("platform") == 0, "IDFA").otherwise("GAID").alias("device_type"), "adn_id",
    ).agg(F.sum("shows").alias("impr_cnt"), F.sum("taps").alias("click_cnt"),
          F.sum("value").alias("revenue"))
    if adn is not None:
        labels = adn.select(F.col("id").alias("adn_id"), F.col("class_name").alias("adn_name"))
        per_dev = per_dev.join(labels, "adn_id", "left")
    else:
        per_dev = per_dev.withColumn("adn_name", F.lit(None).cast("string"))
    return per_dev.select(F.date_format("dt", "yyyy-MM-dd").alias("day"), "pub_app_id", "device_id",
                          "device_type", "adn_name", "impr_cnt", "click_cnt", "revenue")


# ---------------------------------------------------------------- C11

LTV_KEYS = ["country", "publisher_id", "pub_app_id", "uid"]
LTV_GROUP = ["country", "publisher_id", "pub_app_id"]
LTV_RANGE_DAYS = 30  # fixed value: default cohort horizon in days


def iap_value(iap: DataFrame, begin_day=None, end_day=None) -> DataFrame:
    """In-app purchase value per (day, country, publisher, app, uid)."""
    src = iap.filter(day_filter("dt", begin_day, end_day) & F.col("country").isNotNull()
                     & F.col("publisherId").isNotNull() & F.col("pubAppId").isNotNull()
                     & F.col("uid").isNotNull())
    return src.groupBy("dt", "country", F.col("publisherId").alias("publisher_id"),
                       F.col("pubAppId").alias("pub_app_id"), "uid").agg(F.sum("iapUsd").alias("iap_value"))


def mediation_value(lr: DataFrame, cost: DataFrame, begin_day=None, end_day=None) -> DataFrame:
    """Per (day, country, publisher, app, uid): allocated instance cost.

    Every uid with at least one qualifying log row gets a row (value may be
    0); that presence is what the LTV report counts as retention.
    """
    src = lr.filter(day_filter("dt", begin_day, end_day) & F.col("country").isNotNull()
                    & F.col("publisherId").isNotNull() & F.col("pubAppId").isNotNull()
                    & F.col("mid").isNotNull() & F.col("iid").isNotNull() & F.col("uid").isNotNull())
    events = src.select("dt", "country", F.col("publisherId").alias("publisher_id"),
                        F.col("pubAppId").alias("pub_app_id"), F.col("mid").alias("adn_id"),
                        F.col("iid").alias("instance_id"), "uid",
                        counter_value(6, "impr").alias("shows"), counter_value(7, "click").alias("taps"))
    inst_keys = ["dt", "country", "publisher_id", "pub_app_id", "adn_id", "instance_id"]
    cost_sum = (cost.filter(day_filter("dt", begin_day, end_day))
                .groupBy(*inst_keys).agg(F.sum(F.coalesce("cost", F.lit(0))).alias("cost")))
    alloc = allocate_cost(events, cost_sum, inst_keys, ["uid"])
    return alloc.groupBy("dt", *LTV_KEYS).agg(F.sum("value").alias("mediation_value"))


def retention_day(execute_day: Column, base_ymd: Column) -> Column:
    """Days between the cohort day (``yyyyMMdd`` text) and the run."""
    return F.datediff(execute_day, F.to_date(base_ymd, "yyyyMMdd"))


def ltv_report(users: DataFrame, lr: DataFrame, cost: DataFrame, iap: DataFrame, begin_day, end_day,
               range_days: int = LTV_RANGE_DAYS) -> DataFrame:
    """C11: cohort report for every execute day E in ``[begin_day, end_day]``.

    For each base day B in ``[E - range_days, E]`` and (country, publisher,
    app): new/old user counts of B, how many of them were active on E
    (retained) and their mediation / IAP / total value on E.

    Set-oriented: user counts depend on B only, so they are computed once per
    (B, group) and paired with the (at most range_days + 1) execute days at
    group level. Values need the user-level join of cohort rows and execute
    day values; both sides hold at most one row per (user, day), so a key
    joins at most (days x days) pairs and no cohort x day product of users is
    materialised.
    """
    b0 = begin_day - _dt.timedelta(days=range_days)
    cohort = (users.withColumn("_b", F.to_date("ymd", "yyyyMMdd"))
              .filter((F.col("_b") >= F.lit(b0)) & (F.col("_b") <= F.lit(end_day))))
    counts = cohort.groupBy("_b", *LTV_GROUP).agg(
        F.sum(F.when(F.col("is_new") == 1, 1).otherwise(0)).alias("user_cnt_new"),
        F.sum(F.when(F.col("is_new") == 0, 1).otherwise(0)).alias("user_cnt_old"))
    # pair every (B, group) with its execute days E in [max(B, begin), min(B + range, end)]
    days = F.sequence(F.greatest(F.col("_b"), F.lit(begin_day)),
                      F.least(F.date_add(F.col("_b"), range_days), F.lit(end_day)))
    counts = counts.select("*", F.explode(days).alias("_e"))

    med = mediation_value(lr, cost, begin_day, end_day).withColumn("_present", F.lit(1))
    iapv = iap_value(iap, begin_day, end_day)
    values = med.join(iapv, ["dt", *LTV_KEYS], "full_outer").withColumnRenamed("dt", "_e")
    c, v = cohort.alias("c"), values.alias("v")
    cond = [F.col(f"c.{k}") == F.col(f"v.{k}") for k in LTV_KEYS] + [
        F.col("v._e") >= F.col("c._b"), F.col("v._e") <= F.date_add(F.col("c._b"), range_days)]
    pairs = c.join(v, cond, "inner")
    is_new = F.col("c.is_new")
    medv = F.coalesce(F.col("v.mediation_value"), F.lit(0))
    iapx = F.coalesce(F.col("v.iap_value"), F.lit(0))
    zero = F.lit(0)
    present = F.col("v._present").isNotNull()
    pair_rows = pairs.select(
        F.col("c._b").alias("_b"), F.col("v._e").alias("_e"), *[F.col(f"c.{k}").alias(k) for k in LTV_GROUP],
        zero.alias("user_cnt_new"), zero.alias("user_cnt_old"),
        F.when(present & (is_new == 1), 1).otherwise(0).alias("retention_cnt_new"),
        F.when(present & (is_new == 0), 1).otherwise(0).alias("retention_cnt_old"),
        F.when(is_new == 1, medv).otherwise(zero).alias("mediation_value_new"),
        F.when(is_new == 0, medv).otherwise(zero).alias("mediation_value_old"),
        F.when(is_new == 1, iapx).otherwise(zero).alias("iap_value_new"),
        F.when(is_new == 0, iapx).otherwise(zero).alias("iap_value_old"),
        F.when(is_new == 1, medv + iapx).otherwise(zero).alias("total_value_new"),
        F.when(is_new == 0, medv + iapx).otherwise(zero).alias("total_value_old"))
    metrics = ["retention_cnt_new", "retention_cnt_old", "mediation_value_new", "mediation_value_old",
               "iap_value_new", "iap_value_old", "total_value_new", "total_value_old"]
    count_rows = counts.select("_b", "_e", *LTV_GROUP, "user_cnt_new", "user_cnt_old",
                               *[F.lit(0).cast(pair_rows.schema[m].dataType).alias(m) for m in metrics])
    # every (B, E, group) of the pairs also has a counts row (its user is in
    # B's cohort), so one grouped sum over the union replaces a join of the two
    merged = count_rows.unionByName(pair_rows).groupBy("_b", "_e", *LTV_GROUP).agg(
        *[F.sum(c).alias(c) for c in ["user_cnt_new", "user_cnt_old", *metrics]])
    return merged.select(
        F.date_format("_e", "yyyyMMdd").alias("execute_date"),
        F.date_format("_b", "yyyyMMdd").alias("base_date"),
        F.datediff(F.col("_e"), F.col("_b")).alias("retention_day"),
        *LTV_GROUP,
        *[F.col(c).cast("bigint").alias(c) for c in ["user_cnt_new", "user_cnt_old", "retention_cnt_new",
                                                     "retention_cnt_old"]],
        *[F.col(m) for m in metrics[2:]],
    )


# ---------------------------------------------------------------- C12

RESTATE_DAYS = 3  # fixed value: network costs arrive up to two days late


def restate(job, run_day: _dt.date, days: int = RESTATE_DAYS, **inputs) -> DataFrame:
    """Rerun a daily job for ``run_day - days + 1 .. run_day`` in ONE
    set-oriented call (the job groups by day), ready for a dynamic
    partition overwrite of exactly those days (B1)."""
    begin = run_day - _dt.timedelta(days=days - 1)
    return job(begin_day=begin, end_day=run_day, **inputs)
