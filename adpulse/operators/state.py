"""Change sets and state maintenance."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_div

CAP_TOPIC = "cp_campaign_cap"   # fixed value: topic prefix, one topic per data centre
CAP_SEPARATOR = "\u0001"        # fixed value: field separator of cap messages
DEV_APP_TTL_HOURS = 1           # fixed value: dev apps expire one hour after activation
BASE_CURRENCY_TO = "USD"


def running_campaigns(campaigns: DataFrame) -> DataFrame:
    """Campaigns with status 1, a cap above 0 and, where the source has the
    column (the campaign table does, a cap-only source does not), run status 1."""
    c = campaigns.filter((F.col("status") == 1) & (F.col("daily_cap") > 0))
    return c.filter(F.col("run_status") == 1) if "run_status" in c.columns else c


def cap_delta(campaigns: DataFrame, prev: DataFrame | None) -> DataFrame:
    """H1: daily-cap change of every running campaign (``running_campaigns``)
    against the previous snapshot of the same day:
    new -> cap, changed -> cap - old, unchanged -> no row."""
    c = running_campaigns(campaigns).select("id", "publisher_id", "daily_cap")
    if prev is None:
        return c.select("id", "publisher_id", F.col("daily_cap").alias("change_cap"))
    p = prev.select("id", F.col("daily_cap").alias("_old"))
    j = c.join(p, "id", "left")
    change = F.when(F.col("_old").isNull(), F.col("daily_cap")).otherwise(F.col("daily_cap") - F.col("_old"))
    return (j.filter(F.col("_old").isNull() | (F.col("daily_cap") != F.col("_old")))
            .select("id", "publisher_id", change.alias("change_cap")))


def cap_messages(delta: DataFrame, dcenters: list[int]) -> DataFrame:
    """One ``(topic, value)`` message per change and data centre; the
    frame can be written with ``df.write.format("kafka")``. The data centre
    list is configuration, expanded per row (no cross join)."""
    dc = F.explode(F.array(*[F.lit(int(d)) for d in dcenters]))
    return delta.select("*", dc.alias("_dc")).select(
        F.concat(F.lit(CAP_TOPIC), F.col("_dc").cast("string")).alias("topic"),
        F.concat_ws(CAP_SEPARATOR, F.col("id").cast("string"), F.col("change_cap").cast("string")).alias("value"))


def expire_dev_apps(dev_apps: DataFrame, now: _dt.datetime) -> DataFrame:
    """H2: dev apps active for more than an hour are switched off."""
    ts = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    expired = (F.col("status") == 1) & \
        ((F.col("active_time").cast("timestamp") + F.make_interval(hours=F.lit(DEV_APP_TTL_HOURS))) < ts)
    return dev_apps.withColumn("status", F.when(expired, F.lit(0)).otherwise(F.col("status")))


def cross_rates(quotes: DataFrame, to: str = BASE_CURRENCY_TO) -> DataFrame:
    """H3: rates quoted against a base (EUR) -> rates to ``to``:
    rate(to) / rate(cur), HALF_UP at 6 decimals; ``to`` itself is 1.

    The ``to`` quote is one row; it is joined on a constant key (a one-row
    broadcast, so no nested loop)."""
    ref = quotes.filter(F.col("cur") == to).groupBy().agg(F.max("rate").alias("_to_rate")) \
                .withColumn("_k", F.lit(1))
    q = quotes.withColumn("_k", F.lit(1)).join(F.broadcast(ref), "_k", "inner")
    num = F.col("_to_rate").cast("decimal(38,6)") * F.lit(1000000)
    den = (F.col("rate").cast("decimal(38,6)") * F.lit(1000000)).cast("decimal(38,0)")
    rate = F.when(F.col("cur") == to, F.lit(1).cast("decimal(38,6)")).otherwise(round_div(num, den, 6, "half_up"))
    return q.select(F.col("cur").alias("cur_from"), F.lit(to).alias("cur_to"), rate.alias("exchange_rate"))


def upsert_rates(latest: DataFrame, new: DataFrame, keys=("cur_from", "cur_to"), order: str | None = None) -> DataFrame:
    """H4 (B7): latest-rate table after an upsert: untouched keys stay, new
    keys are inserted, existing keys take the new rate. Of several incoming rows
    of a key the last by ``order`` (a column of ``new``) wins; without an order,
    or among equals, the one with the largest values."""
    keys = list(keys)
    rest = [c for c in latest.columns if c not in keys]
    rank = F.struct(*([order] if order else []), *rest)
    last = new.groupBy(*keys).agg(F.max(rank).alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])
    kept = latest.join(last.select(*keys), keys, "left_anti")
    return kept.unionByName(last.select(*latest.columns))


def append_history(history: DataFrame | None, new: DataFrame, day: _dt.date) -> DataFrame:
    """H4: the history with the day's rates; a rerun replaces the day's rows."""
    rows = new.withColumn("day", F.lit(day))
    return rows if history is None else history.filter(~F.col("day").eqNullSafe(F.lit(day))).unionByName(rows)
