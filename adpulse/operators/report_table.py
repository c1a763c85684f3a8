"""Many custom reports in one job (F12): the specs are rows of a frame.

The reference runs its report tasks one after another. Here every statistics
row meets the specs of its publisher whose window and lists it fits, takes their
dimensions (the others are NULL) and is summed per (report, dimension values):
one scan and one grouped sum per side, however many reports there are. The
sides are merged and the ratios computed for all reports alike; a report shows
its own dimensions and metrics, the other columns are NULL.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .report import (ADN_SUMS, DAU_DIMS, DAU_SUMS, DS_USER_ACTIVITY, LR_SUMS, SUPPORTED_DIMS, ReportSpec, _ints, derived_columns,
                     label_dims, report_window)

_LISTS = {"adn_id": "adn_ids", "pub_app_id": "pub_app_ids", "placement_id": "placement_ids", "instance_id": "instance_ids",
          "country": "countries"}
SPEC_SCHEMA = ("report string, publisher_id int, dimensions array<string>, metrics array<string>, data_source int, "
               "begin date, end date, adn_ids array<int>, pub_app_ids array<int>, placement_ids array<int>, "
               "instance_ids array<int>, countries array<string>")


def specs_frame(spark: SparkSession, tasks: dict[str, tuple[ReportSpec, _dt.date, _dt.date | None]]) -> DataFrame:
    """The specs of named tasks (spec, task day, day of the run) as rows; an empty list filters nothing."""
    rows = []
    for name, (s, task_day, now) in tasks.items():
        begin, end = report_window(s, task_day, now or task_day)
        rows.append((name, s.publisher_id, s.dims, s.metric_list, s.data_source, begin, end, _ints(s.cond_adn_list),
                     _ints(s.cond_pub_app_list), _ints(s.cond_placement_list), _ints(s.cond_instance_list),
                     s.cond_country_list.split(",") if s.cond_country_list.strip() else []))
    return spark.createDataFrame(rows, SPEC_SCHEMA)


def _side(df: DataFrame, specs: DataFrame, sums: list[tuple[str, str]], number: int, dims: list[str], lists: list[str]) -> DataFrame:
    """The sums of one side per (report, dimension values as text)."""
    s, d = specs.alias("s"), df.alias("d")
    cond = [F.col("d.publisher_id") == F.col("s.publisher_id"), F.col("d.day") >= F.col("s.begin"), F.col("d.day") <= F.col("s.end")]
    cond += [(F.size(f"s.{_LISTS[c]}") == 0) | F.array_contains(f"s.{_LISTS[c]}", F.col(f"d.{c}")) for c in lists]
    own = {c: F.array_contains("s.dimensions", c) if c in dims else F.lit(False) for c in SUPPORTED_DIMS}
    keys = [(F.when(own[c], F.col(f"d.{c}").cast("string")) if c in dims else F.lit(None).cast("string")).alias(c) for c in SUPPORTED_DIMS]
    has = [own[c].alias(f"_has_{c}") for c in SUPPORTED_DIMS]
    rows = d.join(s, cond).select(F.col("s.report"), *keys, *has, *[F.col(f"d.{c}").alias(n) if c in df.columns else
                                                                   F.lit(None).cast("bigint").alias(n) for n, c in sums])
    out = rows.groupBy("report", *SUPPORTED_DIMS, *[f"_has_{c}" for c in SUPPORTED_DIMS]).agg(*[F.sum(n).alias(n) for n, _ in sums])
    return out.withColumn("_side", F.lit(number))


def custom_reports(specs: DataFrame, stat_adn: DataFrame, stat_lr: DataFrame, stat_dau: DataFrame,
                   labels: dict[str, DataFrame]) -> DataFrame:
    """Every report of ``specs`` (``SPEC_SCHEMA``), tagged ``report``: the
    dimensions under their names, then every metric that any report can have, as text."""
    everywhere = list(_LISTS)
    users = specs.filter(F.col("data_source") == DS_USER_ACTIVITY)
    sides = [_side(stat_adn, specs, ADN_SUMS, 0, SUPPORTED_DIMS, everywhere),
             _side(stat_lr, specs, [(c, c) for c in LR_SUMS], 1, SUPPORTED_DIMS, everywhere),
             _side(stat_dau, users, [(c, c) for c in DAU_SUMS], 2, [c for c in SUPPORTED_DIMS if c in DAU_DIMS], ["pub_app_id", "country"])]
    u = sides[0].unionByName(sides[1], allowMissingColumns=True).unionByName(sides[2], allowMissingColumns=True)
    keys = [F.coalesce(c, F.lit("")).alias(f"_key_{c}") for c in SUPPORTED_DIMS]  # NULL and '' are one value
    sums = [n for n, _ in ADN_SUMS] + LR_SUMS + DAU_SUMS
    merged = u.groupBy("report", *keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(f"_has_{c}"), F.col("_side"))).alias(c) for c in SUPPORTED_DIMS],
        *[F.max_by(F.col(m), F.when(F.col(m).isNotNull(), F.col("_side"))).alias(m) for m in sums])
    about = specs.select("report", "dimensions", "metrics", (
        F.array_contains("dimensions", "adn_id") | (F.size("adn_ids") > 0) | F.array_contains("dimensions", "instance_id")
        | (F.size("instance_ids") > 0)).alias("_by_instance"))
    known = merged.select("report", *SUPPORTED_DIMS, *sums).join(about, "report")

    def choose(inst: str, all_: str) -> Column:
        return F.when(F.col("_by_instance"), F.col(inst)).otherwise(F.col(all_))

    named, derived = derived_columns(known, choose("instance_request", "waterfall_request"), choose("instance_filled", "waterfall_filled"))
    values = derived | {m: F.col(m).cast("string") for m in sums if m not in derived}
    named = label_dims(named.withColumns({f"_m_{m}": v for m, v in values.items()}), SUPPORTED_DIMS, labels)
    return named.select(
        "report", *[F.when(F.array_contains("dimensions", c), F.coalesce(F.col(c), F.lit(""))).alias(c) for c in SUPPORTED_DIMS],
        *[F.when(F.array_contains("metrics", m), F.coalesce(F.col(f"_m_{m}"), F.lit("0"))).alias(m) for m in values])
