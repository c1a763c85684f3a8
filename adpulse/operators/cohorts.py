"""Activity bitmaps for retention and LTV cohorts (C11, C11c), fed day by day.

One row per user (country, publisher, app, uid) holds the day it was first
seen and a bitmap of its last days: bit i is set if it was active i days
before the day the row is of. A day's run shifts the bitmaps by the days that
have passed and sets bit 0 of the day's users; whether a user of the day belongs
to the cohort of an earlier day is then a bit test, and no earlier log or
history row is read again. Users who share group, first day and bitmap are
summed up before the bits are taken apart.

Days are fed in order (a gap only shifts further); the last day may be fed
again, which replaces it. An earlier day is refused: its report would need
bits that later days have shifted on.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import drop_old_versions, newest_version
from . import users
from .revenue import LTV_GROUP, LTV_KEYS, LTV_RANGE_DAYS, iap_value, mediation_value

MAX_RANGE = 62  # bits of a bitmap beside its sign


def advance(state: DataFrame | None, day_users: DataFrame, day: _dt.date, gap_days: int, range_days: int = LTV_RANGE_DAYS) -> DataFrame:
    """The bitmaps of ``day``: those of ``gap_days`` earlier shifted, the day's users marked."""
    if not 0 < range_days <= MAX_RANGE:
        raise ValueError(f"a bitmap holds up to {MAX_RANGE} days before its own")
    active = day_users.select(*LTV_KEYS).distinct().withColumn("_active", F.lit(1).cast("long"))
    if state is None:
        return active.select(*LTV_KEYS, F.lit(day).alias("first_day"), F.col("_active").alias("bits"))
    kept = (1 << (range_days + 1)) - 1
    shifted = F.shiftleft("bits", gap_days).bitwiseAND(F.lit(kept)) if gap_days <= range_days else F.lit(0).cast("long")
    joined = state.join(active, LTV_KEYS, "full_outer")
    return joined.select(*LTV_KEYS, F.coalesce("first_day", F.lit(day)).alias("first_day"),
                         F.coalesce(shifted, F.lit(0)).bitwiseOR(F.coalesce("_active", F.lit(0))).alias("bits"))


def day_counts(state: DataFrame, day: _dt.date) -> DataFrame:
    """New and old users of the day by group."""
    new = F.col("first_day") == F.lit(day)
    return state.filter(F.col("bits").bitwiseAND(F.lit(1)) == 1).groupBy(*LTV_GROUP).agg(
        F.sum(F.when(new, 1).otherwise(0)).cast("bigint").alias("user_cnt_new"),
        F.sum(F.when(new, 0).otherwise(1)).cast("bigint").alias("user_cnt_old"))


_SUMS = ["retention_cnt", "mediation_value", "iap_value", "total_value"]


def day_cohorts(state: DataFrame, values: DataFrame, day: _dt.date, range_days: int = LTV_RANGE_DAYS) -> DataFrame:
    """Retained users and values of ``day`` by cohort day and group. ``values``
    has one row per user of the day: LTV_KEYS, mediation_value (NULL: not
    present), iap_value."""
    med, iap = F.coalesce("mediation_value", F.lit(0)), F.coalesce("iap_value", F.lit(0))
    # one row a user on both sides: neither goes through the driver, however few bytes a day's file has
    alike = values.join(state.hint("merge"), LTV_KEYS).groupBy(*LTV_GROUP, "first_day", "bits").agg(
        F.count("mediation_value").alias("retention_cnt"), F.sum(med).alias("mediation_value"), F.sum(iap).alias("iap_value"),
        F.sum(med + iap).alias("total_value"))
    back = F.expr(f"filter(sequence(0, {range_days}), i -> shiftright(bits, i) & 1 = 1)")
    cohorts = alike.withColumn("_back", F.explode(back)).withColumn("base_day", F.date_sub(F.lit(day), F.col("_back")))
    new = F.col("first_day") == F.col("base_day")
    return cohorts.groupBy("base_day", *LTV_GROUP).agg(*[
        F.sum(F.when(new if kind == "new" else ~new, F.col(m)).otherwise(0)).alias(f"{m}_{kind}") for m in _SUMS for kind in ("new", "old")])


class CohortStore:
    """Bitmaps (one version a day), cohort sizes and reports under ``path``."""

    def __init__(self, spark: SparkSession, path: str, range_days: int = LTV_RANGE_DAYS):
        self.spark, self.path, self.range_days = spark, path.rstrip("/"), range_days

    def feed(self, day: _dt.date, lr: DataFrame, cost: DataFrame, iap: DataFrame) -> None:
        """Store the bitmaps, cohort sizes and report of ``day``, given the day's logs and costs."""
        version = f"v={day:%Y%m%d}"
        newest = newest_version(self.spark, f"{self.path}/users")
        if newest and newest.rsplit("/", 1)[1] > version:
            raise ValueError(f"{day} comes before {newest.rsplit('=', 1)[1]}, which has been fed")
        before = newest_version(self.spark, f"{self.path}/users", below=version)
        gap = (day - _dt.datetime.strptime(before.rsplit("=", 1)[1], "%Y%m%d").date()).days if before else 0
        state = advance(self.spark.read.parquet(before) if before else None,
                        users.mark_publisher_users(lr, begin_day=day, end_day=day), day, gap, self.range_days)
        state.write.mode("overwrite").parquet(f"{self.path}/users/{version}")
        state = self.spark.read.parquet(f"{self.path}/users/{version}")
        day_counts(state, day).write.mode("overwrite").parquet(f"{self.path}/counts/base_day={day}")
        med = mediation_value(lr, cost, day, day)
        values = med.join(iap_value(iap, day, day), ["dt", *LTV_KEYS], "full_outer").drop("dt")
        self._report(day, day_cohorts(state, values, day, self.range_days)) \
            .write.mode("overwrite").parquet(f"{self.path}/report/execute_day={day}")
        drop_old_versions(self.spark, f"{self.path}/users", keep=2)

    def _report(self, day: _dt.date, cohorts: DataFrame) -> DataFrame:
        first = day - _dt.timedelta(days=self.range_days)
        counts = self.spark.read.parquet(f"{self.path}/counts").filter(
            (F.col("base_day") >= F.lit(first)) & (F.col("base_day") <= F.lit(day)))
        sums = [f"{m}_{kind}" for m in _SUMS for kind in ("new", "old")]
        types = {c: cohorts.schema[c].dataType for c in sums}
        count_rows = counts.select("base_day", *LTV_GROUP, "user_cnt_new", "user_cnt_old",
                                   *[F.lit(0).cast(types[c]).alias(c) for c in sums])
        zero = F.lit(0).cast("bigint")
        cohort_rows = cohorts.select("base_day", *LTV_GROUP, zero.alias("user_cnt_new"), zero.alias("user_cnt_old"), *sums)
        merged = count_rows.unionByName(cohort_rows).groupBy("base_day", *LTV_GROUP).agg(
            *[F.sum(c).alias(c) for c in ["user_cnt_new", "user_cnt_old", *sums]])
        counted = ["user_cnt_new", "user_cnt_old", "retention_cnt_new", "retention_cnt_old"]
        return merged.select(
            F.date_format(F.lit(day), "yyyyMMdd").alias("execute_date"), F.date_format("base_day", "yyyyMMdd").alias("base_date"),
            F.datediff(F.lit(day), F.col("base_day")).alias("retention_day"), *LTV_GROUP,
            *[F.col(c).cast("bigint").alias(c) for c in counted], *[c for c in sums if c not in counted])

    def report(self) -> DataFrame:
        """The LTV reports of all days fed."""
        return self.spark.read.parquet(f"{self.path}/report").drop("execute_day")
