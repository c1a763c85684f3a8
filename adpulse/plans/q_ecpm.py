"""Registered eCPM rollups (D1-D18), all at the fixture ``as_of``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..fixtures import Views, with_views
from ..functions.numeric import duck_round_div
from ..operators import ecpm
from ..sinks import writers
from .q_io import scratch
from .registry import register

# Fixture clock: the 1-, 3- and 7-day windows straddle the impr > 2000 threshold here.
AS_OF = _dt.datetime(1998, 6, 15, 12, 0, 0)


def delays_of(adn_df):
    return adn_df.select(F.col("id").alias("adn_id"), "delay_hours")


def _oracle(spec: ecpm.EcpmSpec) -> str:
    ts = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
    if spec.delay:
        end_ts = f"({ts} - to_hours(d.delay_hours))"
        src = "f_stat s JOIN d ON s.adn_id = d.adn_id"
    else:
        end_ts, src = ts, "f_stat s"
    end = f"CAST({end_ts} AS DATE)"
    start = (f"({end} - {spec.span_days})" if spec.span_days
             else f"CAST({end_ts} - INTERVAL {spec.span_hours} HOUR AS DATE)")
    where = f"s.day >= {start} AND s.day <= {end}"
    if spec.country_not_null:
        where += " AND s.country IS NOT NULL"
    grp = list(spec.keys)
    if spec.delay and "adn_id" not in grp:
        grp = ["adn_id", *grp]
    gsel = ", ".join(f"s.{k} AS {k}" for k in grp)
    gby = ", ".join(f"s.{k}" for k in grp)
    m = spec.money
    keys = ", ".join(spec.keys)
    if spec.series or spec.merge in ("sum", "latest"):
        daily = (f"SELECT s.day, {gsel}, SUM(s.api_impr) AS impr_sum, SUM(s.{m}) AS money_sum FROM {src} "
                 f"WHERE {where} GROUP BY s.day, {gby} HAVING SUM(s.api_impr) > 0")
        if spec.series:
            body = (f"SELECT {keys}, strftime(day, '%Y-%m-%d') AS day, CAST(impr_sum AS INT) AS impr, "
                    f"CAST(money_sum AS DOUBLE) AS {m} FROM daily")
            return with_views(["f_stat", "f_adn"], _delay_cte() + f", daily AS ({daily})\n{body}")
        g2 = ", ".join(grp)
        if spec.merge == "sum":
            agg = f"SELECT {g2}, SUM(impr_sum) AS impr_sum, SUM(money_sum) AS money_sum FROM daily GROUP BY {g2}"
        else:
            agg = (f"SELECT {g2}, arg_max(impr_sum, day) AS impr_sum, arg_max(money_sum, day) AS money_sum "
                   f"FROM daily GROUP BY {g2}")
        ctes = f", daily AS ({daily}), agg AS ({agg})"
    else:
        having = f"SUM(s.api_impr) > {spec.min_impr}"
        if spec.min_money is not None:
            having += f" AND SUM(s.{m}) > {spec.min_money}"
        ctes = (f", agg AS (SELECT {gsel}, SUM(s.api_impr) AS impr_sum, SUM(s.{m}) AS money_sum FROM {src} "
                f"WHERE {where} GROUP BY {gby} HAVING {having})")
    ecpm_sql = duck_round_div("money_sum * 1000", "impr_sum", 6, spec.rounding)
    cols = [("coalesce(country, '') AS country" if (k == "country" and not spec.country_not_null) else k)
            for k in spec.keys]
    return with_views(["f_stat", "f_adn"], _delay_cte() + ctes + f"\nSELECT {', '.join(cols)}, {ecpm_sql} AS ecpm FROM agg")


def _delay_cte() -> str:
    return ", d AS (SELECT id AS adn_id, delay_hours FROM f_adn WHERE delay_hours IS NOT NULL)"


def _builder(spec: ecpm.EcpmSpec):
    def build(spark, sf_dir):
        v = Views(spark, sf_dir)
        out = ecpm.ecpm_rollup(v.f_stat, spec, AS_OF, delays_of(v.f_adn))
        if spec.series:
            return out.withColumn(spec.money, F.col(spec.money).cast("double"))
        return out.withColumn("ecpm", F.col("ecpm").cast("double"))
    return build


for _spec in ecpm.SPECS:
    register(f"ecpm_{_spec.name}", _oracle(_spec), headline=_spec.name in (
        "stat_instance_country_ecpm_24h", "adn_adtype_country_ecpm_3d"))(_builder(_spec))


def _all_oracle() -> str:
    """The rows of all the datasets, tagged; the series' money is its revenue."""
    parts = [f"SELECT '{s.name}' AS dataset, * FROM ({_oracle(s)}) x" if not s.series else
             f"SELECT '{s.name}' AS dataset, instance_id, country, day, impr, {s.money} AS money FROM ({_oracle(s)}) x"
             for s in ecpm.SPECS]
    columns = "dataset, adn_id, instance_id, placement_id, ad_type, country, day, ecpm, impr, money"
    return f"SELECT {columns} FROM (" + "\nUNION ALL BY NAME\n".join(f"({p})" for p in parts) + ") y"


def _finish_all(out):
    return out.withColumns({c: F.col(c).cast("double") for c in ("ecpm", "money")})


@register("ecpm_all_datasets", _all_oracle())
def q_ecpm_all_datasets(spark, sf_dir):
    """D1-D18 from one scan of the statistics."""
    v = Views(spark, sf_dir)
    return _finish_all(ecpm.ecpm_rollups(ecpm.daily_partials(v.f_stat), AS_OF, delays_of(v.f_adn)))


@register("ecpm_all_from_partials", _all_oracle())
def q_ecpm_all_from_partials(spark, sf_dir):
    """D1-D18 from stored daily partial sums: all days first, then the last
    three days before the clock once more, as a restatement would."""
    v = Views(spark, sf_dir)
    path = f"{scratch(spark)}/stat_partials"
    writers.write_slot(ecpm.daily_partials(v.f_stat), path, ["day"])
    days = [AS_OF.date() - _dt.timedelta(days=i) for i in range(3)]
    again = ecpm.daily_partials(v.f_stat.filter(F.col("day").isin(days)))
    writers.write_slot(again, path, ["day"], slots=[{"day": d} for d in days])
    return _finish_all(ecpm.ecpm_rollups(spark.read.parquet(path), AS_OF, delays_of(v.f_adn)))
