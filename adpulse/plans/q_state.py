"""Registered change-set and state queries."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..fixtures import Views, with_views
from ..functions.numeric import duck_round_div
from ..operators import state
from .registry import register

DEV_NOW = _dt.datetime(1998, 10, 3, 0, 30, 0)   # fixture clock of the dev-app expiry
DCENTERS = [0, 1, 2]                             # data centres receiving cap messages
RATES_DAY = _dt.date(1998, 6, 15)

_DELTA_SQL = """
, cur AS (SELECT id, publisher_id, daily_cap FROM f_campaign WHERE status = 1 AND daily_cap > 0)
, delta AS (SELECT cur.id, cur.publisher_id,
                   CASE WHEN p.id IS NULL THEN cur.daily_cap ELSE cur.daily_cap - p.daily_cap END AS change_cap
            FROM cur LEFT JOIN f_campaign_prev p ON p.id = cur.id
            WHERE p.id IS NULL OR cur.daily_cap <> p.daily_cap)"""


@register("cap_delta", with_views(["f_campaign", "f_campaign_prev"], _DELTA_SQL + """
SELECT id, publisher_id, change_cap FROM delta
"""))
def q_cap_delta(spark, sf_dir):
    v = Views(spark, sf_dir)
    return state.cap_delta(v.f_campaign, v.f_campaign_prev)


@register("cap_messages", with_views(["f_campaign", "f_campaign_prev"], _DELTA_SQL + f"""
, dc AS (SELECT unnest({DCENTERS}) AS dc)
SELECT 'cp_campaign_cap' || CAST(dc.dc AS VARCHAR) AS topic,
       CAST(delta.id AS VARCHAR) || chr(1) || CAST(delta.change_cap AS VARCHAR) AS value
FROM delta, dc
"""))
def q_cap_messages(spark, sf_dir):
    v = Views(spark, sf_dir)
    return state.cap_messages(state.cap_delta(v.f_campaign, v.f_campaign_prev), DCENTERS)


@register("expire_dev_apps", with_views(["f_dev_app"], f"""
SELECT publisher_id, pub_app_id, adn_id, strftime(active_time, '%Y-%m-%d %H:%M:%S') AS active_time,
       CASE WHEN status = 1 AND active_time + INTERVAL 1 HOUR < TIMESTAMP '{DEV_NOW:%Y-%m-%d %H:%M:%S}' THEN 0
            ELSE status END AS status
FROM f_dev_app
"""))
def q_expire_dev_apps(spark, sf_dir):
    out = state.expire_dev_apps(Views(spark, sf_dir).f_dev_app, DEV_NOW)
    return out.withColumn("active_time", F.date_format("active_time", "yyyy-MM-dd HH:mm:ss"))


_RATE_SQL = f"""
, usd AS (SELECT max(rate) AS r FROM f_quotes WHERE cur = 'USD')
, rates AS (SELECT cur AS cur_from, 'USD' AS cur_to,
                   CASE WHEN cur = 'USD' THEN 1.0
                        ELSE {duck_round_div('usd.r * 1000000', 'rate * 1000000')} END AS exchange_rate
            FROM f_quotes, usd)"""


@register("cross_rates", with_views(["f_quotes"], _RATE_SQL + """
SELECT cur_from, cur_to, exchange_rate FROM rates
"""))
def q_cross_rates(spark, sf_dir):
    out = state.cross_rates(Views(spark, sf_dir).f_quotes)
    return out.withColumn("exchange_rate", F.col("exchange_rate").cast("double"))


@register("upsert_rates", with_views(["f_quotes"], _RATE_SQL + """
, latest AS (SELECT cur AS cur_from, 'USD' AS cur_to, CAST(rate AS DOUBLE) AS exchange_rate FROM f_quotes
             UNION ALL SELECT 'OLD', 'USD', 2.0)
, new AS (SELECT * FROM rates WHERE cur_from NOT IN ('C3', 'C5'))
SELECT * FROM latest WHERE (cur_from, cur_to) NOT IN (SELECT (cur_from, cur_to) FROM new)
UNION ALL SELECT cur_from, cur_to, CAST(exchange_rate AS DOUBLE) FROM new
"""))
def q_upsert_rates(spark, sf_dir):
    """H4: yesterday's table = the raw quotes (plus a currency that is no
    longer quoted); today's cross rates, minus two currencies, are upserted.
    Every currency came before with another rate; the last one counts."""
    q = Views(spark, sf_dir).f_quotes
    latest = q.select(F.col("cur").alias("cur_from"), F.lit("USD").alias("cur_to"),
                      F.col("rate").cast("double").alias("exchange_rate"))
    latest = latest.unionByName(spark.createDataFrame([("OLD", "USD", 2.0)], latest.schema))
    new = state.cross_rates(q).filter(~F.col("cur_from").isin("C3", "C5")) \
               .withColumn("exchange_rate", F.col("exchange_rate").cast("double"))
    first = new.select("cur_from", "cur_to", (F.col("exchange_rate") * 3).alias("exchange_rate"), F.lit(1).alias("seq"))
    return state.upsert_rates(latest, first.unionByName(new.withColumn("seq", F.lit(2))), order="seq")


@register("rates_history", with_views(["f_quotes"], _RATE_SQL + f"""
SELECT cur_from, cur_to, exchange_rate, '{RATES_DAY}' AS day FROM rates
"""))
def q_rates_history(spark, sf_dir):
    """H4: the day's cross rates in the history twice; the second run replaces the first."""
    rates = state.cross_rates(Views(spark, sf_dir).f_quotes).withColumn(
        "exchange_rate", F.col("exchange_rate").cast("double"))
    wrong = state.append_history(None, rates.withColumn("exchange_rate", F.col("exchange_rate") + 1), RATES_DAY)
    out = state.append_history(wrong, rates, RATES_DAY)
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
