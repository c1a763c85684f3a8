"""Registered forecasting and statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Views, with_views
from ..functions.numeric import duck_round_div
from ..operators import forecast
from .registry import register

_ELIGIBLE = "SELECT id FROM f_app WHERE status = 1 AND uar_regions IS NOT NULL"


def _smooth_sql(col: str, seed: int, rounded: bool = True) -> str:
    x = f"CAST({col} AS DOUBLE)"
    terms = f"SUM(0.6 * pow(0.4, n - 1 - i) * {x})"
    if seed == 1:
        start = f"max(CASE WHEN i = 0 THEN {x} END)"
    else:
        s3 = f"SUM(CASE WHEN i < 3 THEN CAST({col} AS DECIMAL(38,8)) END)"
        start = duck_round_div(s3, "least(max(n), 3)", 6, "half_up")
    value = f"{terms} + pow(0.4, max(n)) * {start}"
    return f"CAST(ROUND({value}, 8) AS DOUBLE) AS {col}" if rounded else f"{value} AS {col}"


def forecast_cte(seed: int = 1) -> str:
    """DuckDB CTEs ending in ``fc(pub_app_id, country, run_day, uar1..5)``:
    the unrounded closed-form forecast (needs f_stat, f_uar, f_app)."""
    cols = ",\n       ".join(_smooth_sql(c, seed, rounded=False) for c in forecast.UAR_COLS)
    return f"""
, fan AS (SELECT u.*, CAST(u.day + CAST(t.r AS INTEGER) AS DATE) AS run_day
          FROM f_uar u, range(1, 8) t(r) WHERE u.pub_app_id IN ({_ELIGIBLE}))
, ord AS (SELECT *, row_number() OVER (PARTITION BY pub_app_id, country, run_day ORDER BY day) - 1 AS i,
                 count(*) OVER (PARTITION BY pub_app_id, country, run_day) AS n FROM fan)
, fc AS (SELECT pub_app_id, country, run_day,
       {cols}
FROM ord GROUP BY pub_app_id, country, run_day)"""


def _forecast_oracle(seed: int) -> str:
    cols = ",\n       ".join(_smooth_sql(c, seed) for c in forecast.UAR_COLS)
    return with_views(["f_stat", "f_uar", "f_app"], f"""
, fan AS (SELECT u.*, CAST(u.day + CAST(t.r AS INTEGER) AS DATE) AS run_day
          FROM f_uar u, range(1, 8) t(r) WHERE u.pub_app_id IN ({_ELIGIBLE}))
, ord AS (SELECT *, row_number() OVER (PARTITION BY pub_app_id, country, run_day ORDER BY day) - 1 AS i,
                 count(*) OVER (PARTITION BY pub_app_id, country, run_day) AS n FROM fan)
SELECT pub_app_id, country, strftime(run_day, '%Y-%m-%d') AS day,
       {cols}
FROM ord GROUP BY pub_app_id, country, run_day
""")


def _forecast(spark, sf_dir, seed=1):
    v = Views(spark, sf_dir)
    out = forecast.forecast_uar(v.f_app, v.f_uar, seed=seed)
    return out.select("pub_app_id", "country", F.date_format("run_day", "yyyy-MM-dd").alias("day"),
                      *[F.round(c, 8).cast("double").alias(c) for c in forecast.UAR_COLS])


register("uar_forecast", _forecast_oracle(1), headline=True)(_forecast)
register("exp_smoothing_seed3", _forecast_oracle(3))(lambda spark, sf_dir: _forecast(spark, sf_dir, seed=3))


_VALS = " || '|' || ".join(f"CAST(CAST(ROUND(f.{c} * 1000, 5) AS DECIMAL(38,5)) AS VARCHAR)" for c in forecast.UAR_COLS)
_REGION_ORACLE = _forecast_oracle(1).replace("SELECT pub_app_id, country, strftime", ", fc AS (SELECT pub_app_id, country, run_day, strftime", 1)
_REGION_ORACLE = _REGION_ORACLE.rstrip() + f""")
, apps AS (SELECT id, string_split(uar_regions, ',') AS regions FROM f_app WHERE status = 1 AND uar_regions IS NOT NULL)
SELECT f.pub_app_id, strftime(f.run_day, '%Y-%m-%d') AS day,
       coalesce(string_agg(CASE WHEN list_contains(a.regions, f.country) THEN f.country || ':' || {_VALS} END, ';'
                           ORDER BY f.country), '') AS regions
FROM fc f JOIN apps a ON f.pub_app_id = a.id
GROUP BY f.pub_app_id, f.run_day
"""


@register("uar_region_map", _REGION_ORACLE)
def q_uar_region_map(spark, sf_dir):
    """E4, flattened to sorted text for comparison (the operator also emits
    the map and its JSON)."""
    v = Views(spark, sf_dir)
    fc = forecast.forecast_uar(v.f_app, v.f_uar)
    fc = fc.select("pub_app_id", "country", "run_day", *[F.round(c, 8).alias(c) for c in forecast.UAR_COLS])
    m = forecast.uar_region_map(fc, v.f_app)
    text = F.array_join(F.transform(
        F.map_entries("region_uar"),
        lambda e: F.concat(e["key"], F.lit(":"), F.array_join(
            F.transform(e["value"], lambda x: F.round(x, 5).cast("decimal(38,5)").cast("string")), "|"))), ";")
    return m.select("pub_app_id", F.date_format("run_day", "yyyy-MM-dd").alias("day"), text.alias("regions"))


@register("series_stats", with_views(["f_stat"], f"""
, d AS (SELECT instance_id, day, SUM(api_click) AS x FROM f_stat GROUP BY instance_id, day)
SELECT instance_id, ROUND(var_pop(x), 6) AS var_pop, ROUND(stddev_pop(x), 6) AS stddev_pop,
       ROUND(var_samp(x), 6) AS var_samp, ROUND(stddev_samp(x), 6) AS stddev_samp,
       {duck_round_div('SUM(x)', 'COUNT(x)', 6, 'half_up')} AS mean6,
       ROUND(CASE WHEN avg(x) = 0 THEN 0 ELSE stddev_pop(x) / avg(x) END, 6) AS coeff_variation
FROM d GROUP BY instance_id
"""))
def q_series_stats(spark, sf_dir):
    """E5-E10 over each instance's daily click series."""
    st = Views(spark, sf_dir).f_stat
    daily = st.groupBy("instance_id", "day").agg(F.sum("api_click").alias("x"))
    out = forecast.series_stats(daily, ["instance_id"], "x")
    return out.select("instance_id", *[F.round(c, 6).cast("double").alias(c) for c in
                                       ["var_pop", "stddev_pop", "var_samp", "stddev_samp", "mean6",
                                        "coeff_variation"]])
