"""Registered source / sink round trips.

Each query writes data derived from the fixture tables into a fresh folder
under the session's reliable checkpoint directory (shared storage on a
cluster), reads it back through the source operator and must reproduce the
result of the plain query, so it reuses that query's oracle.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from ..fixtures import Views, with_views
from ..operators import funnel, revenue, users
from ..session import ensure_checkpoint_dir
from ..sinks import writers
from ..sinks.slots import SlotTable
from ..sources import intake, logs
from . import q_config, q_reports
from .registry import QUERIES, doubles, register
from .. import schemas


def scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{uuid.uuid4().hex}"


def _day_range(df):
    r = df.agg(F.min("dt").alias("a"), F.max("dt").alias("b")).first()
    return r["a"], r["b"]


def write_lr_json(spark, lr, root: str, hourly: bool = True, mode: str = "overwrite") -> None:
    """Write log rows as JSON slots in the Hive-style layout (hour slots, or
    day slots when ``hourly`` is False)."""
    cols = [f.name for f in schemas.LR.fields]
    keys = ["y", "m", "d"] + (["h"] if hourly else [])
    out = lr.select(*cols, F.date_format("dt", "yyyy").alias("y"), F.date_format("dt", "MM").alias("m"),
                    F.date_format("dt", "dd").alias("d"), F.lpad(F.col("h").cast("string"), 2, "0").alias("h"))
    out.select(*cols, *keys).repartition(*keys).write.mode(mode).partitionBy(*keys).json(f"{root}/lr")


@register("json_log_scan", QUERIES["common_report"].oracle)
def q_json_log_scan(spark, sf_dir):
    """A1: the funnel report computed from hourly JSON slots."""
    lr = Views(spark, sf_dir).f_lr
    root = scratch(spark)
    write_lr_json(spark, lr, root)
    first, last = _day_range(lr)
    begin = _dt.datetime.combine(first, _dt.time(0))
    end = _dt.datetime.combine(last + _dt.timedelta(days=1), _dt.time(0))
    scanned = logs.scan_log(spark, root, "lr", begin, end, layout=logs.HIVE)
    out = funnel.common_report(scanned, begin, end)
    return doubles(out, "bid_resp_price", "bid_win_price")


@register("backfill_user_report", QUERIES["user_report"].oracle)
def q_backfill_user_report(spark, sf_dir):
    """The daily user report for the whole range in one run."""
    lr = Views(spark, sf_dir).f_lr
    first, last = _day_range(lr)
    return logs.backfill(users.user_report, first, last, lr=lr)


@register("slot_overwrite_roundtrip", QUERIES["common_report"].oracle)
def q_slot_overwrite_roundtrip(spark, sf_dir):
    """B1: write every slot, rerun (overwrite) the last three days, read back:
    no slot is lost or duplicated."""
    lr = Views(spark, sf_dir).f_lr
    path = f"{scratch(spark)}/stat_lr"
    full = funnel.common_report(lr)
    writers.write_slot(full, path, ["day"])
    _, last = _day_range(lr)
    rerun = funnel.common_report(lr).filter(F.col("day") >= F.lit(str(last - _dt.timedelta(days=2))))
    writers.write_slot(rerun, path, ["day"])
    back = spark.read.parquet(path).withColumn("day", F.col("day").cast("string"))
    return doubles(back.select(*full.columns), "bid_resp_price", "bid_win_price")


_SLOTS_ORACLE = with_views(["f_lr"], f"""
SELECT strftime(dt, '%Y-%m-%d') AS slot_day, h AS slot_hour, {q_reports._C1_DIMS_SQL}, {q_reports._C1_METRICS_SQL}
FROM f_lr WHERE serverTs IS NOT NULL AND type <> 1 GROUP BY ALL
""")


def _slots_of(first, n_hours: int) -> list[dict]:
    hours = (first + _dt.timedelta(hours=i) for i in range(n_hours))
    return [{"slot_day": f"{t:%Y-%m-%d}", "slot_hour": t.hour} for t in hours]


@register("hourly_slot_jobs", _SLOTS_ORACLE)
def q_hourly_slot_jobs(spark, sf_dir):
    """B1 with C1 (W4): the hourly job in two runs of consecutive slots, then
    a rerun of six hours of the second day. Late rows belong to the slot they came
    in, so no run touches what another has counted."""
    lr = Views(spark, sf_dir).f_lr
    path = f"{scratch(spark)}/stat_lr"
    first, last = _day_range(lr)
    start = _dt.datetime.combine(first, _dt.time(0))
    hours = 24 * ((last - first).days + 1)
    for begin, n in ((0, 36), (36, hours - 36), (24, 6)):
        t = start + _dt.timedelta(hours=begin)
        out = funnel.common_report(lr, t, t + _dt.timedelta(hours=n), by_slot=True)
        writers.write_slot(out, path, funnel.SLOT_NAMES, slots=_slots_of(t, n))
    back = spark.read.parquet(path).withColumn("slot_day", F.date_format("slot_day", "yyyy-MM-dd"))
    return doubles(back.select(*out.columns), "bid_resp_price", "bid_win_price")


@register("slot_commit", with_views(["f_lr"], f"""
SELECT strftime(dt, '%Y-%m-%d') AS slot_day, h AS slot_hour, {q_reports._C1_DIMS_SQL}, {q_reports._C1_METRICS_SQL}
FROM f_lr WHERE serverTs IS NOT NULL AND type <> 1
     AND NOT (dt >= (SELECT max(dt) FROM f_lr) - INTERVAL 4 DAY AND (h = 7 OR pubAppId = 10 OR dt = (SELECT max(dt) FROM f_lr)))
GROUP BY ALL
"""))
def q_slot_commit(spark, sf_dir):
    """B1 with one commit a run: all hours first; then a rerun of the last five
    days, in which an app, an hour of each day and the whole last day are gone."""
    lr = Views(spark, sf_dir).f_lr
    first, last = _day_range(lr)
    start = _dt.datetime.combine(first, _dt.time(0))
    full = funnel.common_report(lr, by_slot=True)
    table = SlotTable(spark, f"{scratch(spark)}/stat_lr", full.schema, funnel.SLOT_NAMES)
    table.commit(full, _slots_of(start, 24 * ((last - first).days + 1)))
    begin = _dt.datetime.combine(last - _dt.timedelta(days=4), _dt.time(0))
    left = lr.filter((F.col("h") != 7) & (F.col("pubAppId") != 10) & (F.col("dt") != F.lit(last)))
    table.commit(funnel.common_report(left, begin, by_slot=True), _slots_of(begin, 24 * 5))
    return doubles(table.read(), "bid_resp_price", "bid_win_price")


@register("publisher_users_store", QUERIES["publisher_users"].oracle)
def q_publisher_users_store(spark, sf_dir):
    """C8 into its bucketed store, every day written twice: the second write
    replaces the first and clears a day that has no users any more."""
    lr = Views(spark, sf_dir).f_lr
    marked = users.mark_publisher_users(lr)
    root = scratch(spark)
    name = f"dws_publisher_user_{root.rsplit('/', 1)[-1]}"
    first, last = _day_range(lr)
    days = [f"{first + _dt.timedelta(days=i):%Y%m%d}" for i in range((last - first).days + 1)]
    stale = marked.withColumn("ymd", F.when(F.col("ymd") == days[0], F.lit("20991231")).otherwise(F.col("ymd")))
    writers.write_bucketed(stale, name, f"{root}/dws", users.USER_KEYS, 8, ["ymd"])
    writers.write_bucketed(marked, name, f"{root}/dws", users.USER_KEYS, 8, ["ymd"],
                           slots=[{"ymd": d} for d in [*days, "20991231"]])
    return spark.read.schema(schemas.PUBLISHER_USER).parquet(f"{root}/dws").select(*marked.columns)


@register("per_app_csv_roundtrip", QUERIES["user_ad_revenue"].oracle)
def q_per_app_csv_roundtrip(spark, sf_dir):
    """User ad revenue split into one gzip CSV directory per app, after a
    run that held other apps: their files are not read any more."""
    v = Views(spark, sf_dir)
    uar = q_reports._finish_uar(revenue.user_ad_revenue(v.f_lr, v.f_cost, v.f_adn))
    path = f"{scratch(spark)}/uar"
    writers.write_per_app(uar.withColumn("pub_app_id", F.col("pub_app_id") + 1000), path)
    writers.write_per_app(uar, path)
    schema = "day string, device_id string, device_type string, adn_name string, impr_cnt bigint, " \
             "click_cnt bigint, revenue double, pub_app_id int"
    return writers.read_per_app(spark, path, schema).select(*uar.columns)


@register("cost_dump_scan", with_views(["f_cost"], """
SELECT CAST(NULL AS INTEGER) AS id, publisher_id, pub_app_id, platform, country, adn_id, instance_id,
       CAST(cost AS DOUBLE) AS cost
FROM f_cost
"""))
def q_cost_dump_scan(spark, sf_dir):
    """A3 (W10): costs dumped as \\u0001-separated text with a trailing
    separator and 'null' for NULL, read back with the fixed schema."""
    c = Views(spark, sf_dir).f_cost.withColumn("id", F.lit(None).cast("int"))
    cols = [f.name for f in schemas.STAT_ADNETWORK.fields]
    path = f"{scratch(spark)}/ods_stat_adnetwork"
    writers.cost_dump_lines(c, cols).write.mode("overwrite").text(path)
    back = logs.scan_stat_adnetwork(spark, path)
    return back.withColumn("cost", F.col("cost").cast("double"))


@register("adnetwork_dump_scan", with_views(["f_adn"], """
SELECT id, name, class_name, CAST(NULL AS VARCHAR) AS descn FROM f_adn
"""))
def q_adnetwork_dump_scan(spark, sf_dir):
    """A4: the network dimension dump read back."""
    a = Views(spark, sf_dir).f_adn.withColumn("descn", F.lit(None).cast("string"))
    path = f"{scratch(spark)}/ods_om_adnetwork"
    writers.cost_dump_lines(a, ["id", "name", "class_name", "descn"]).write.mode("overwrite").text(path)
    return logs.scan_adnetwork(spark, path)


@register("publisher_user_history_scan", QUERIES["publisher_users"].oracle)
def q_publisher_user_history_scan(spark, sf_dir):
    """C8 output stored partitioned by ymd (B1), read back by range (A5)."""
    lr = Views(spark, sf_dir).f_lr
    marked = users.mark_publisher_users(lr)
    path = f"{scratch(spark)}/dws_publisher_user"
    writers.write_slot(marked, path, ["ymd"])
    first, last = _day_range(lr)
    return logs.scan_publisher_user(spark, path, first, last).select(*marked.columns)


@register("snapshot_publish", QUERIES["snap_network"].oracle)
def q_snapshot_publish(spark, sf_dir):
    """Publish a snapshot version and read the newest one back."""
    snap = q_config.q_snap_network(spark, sf_dir)
    root = scratch(spark)
    writers.publish_snapshot(spark, snap, root, "om_adnetwork")
    return writers.read_snapshot(spark, root, "om_adnetwork", snap.schema)


@register("keyed_replace", with_views(["f_stat"], """
, s AS (SELECT pub_app_id, day, SUM(api_impr) AS impr FROM f_stat GROUP BY pub_app_id, day)
SELECT pub_app_id, strftime(day, '%Y-%m-%d') AS day,
       CAST(CASE WHEN pub_app_id % 2 = 0 THEN impr * 2 ELSE impr END AS BIGINT) AS impr FROM s
"""))
def q_keyed_replace(spark, sf_dir):
    """A daily per-app table where the even apps are re-delivered with
    new values; their (app, day) keys are replaced, the others kept."""
    st = Views(spark, sf_dir).f_stat
    s = st.groupBy("pub_app_id", "day").agg(F.sum("api_impr").cast("bigint").alias("impr"))
    incoming = s.filter(F.col("pub_app_id") % 2 == 0).withColumn("impr", F.col("impr") * 2)
    out = writers.replace_keys(s, incoming, ["pub_app_id", "day"])
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("csv_dir_roundtrip", QUERIES["user_report"].oracle)
def q_csv_dir_roundtrip(spark, sf_dir):
    """The daily user report as CSV part files, written twice."""
    out = users.user_report(Views(spark, sf_dir).f_lr)
    path = f"{scratch(spark)}/stat_dau"
    for _ in range(2):
        writers.write_csv_dir(out, path)
    return spark.read.schema(out.schema).csv(path)


@register("cost_sync", with_views(["f_cost"], """
SELECT CAST(dt AS VARCHAR) AS day, instance_id, country, CAST(SUM(coalesce(cost, 0)) AS DOUBLE) AS cost, count(*) AS n
FROM f_cost WHERE dt <> (SELECT max(dt) FROM f_cost) GROUP BY ALL
"""))
def q_cost_sync(spark, sf_dir):
    """H5: every day's costs copied twice, the second time the last day comes empty and is cleared."""
    costs = Views(spark, sf_dir).f_cost.withColumnRenamed("dt", "day")
    path = f"{scratch(spark)}/ods_stat_adnetwork"
    first, last = _day_range(costs.withColumnRenamed("day", "dt"))
    days = [first + _dt.timedelta(days=i) for i in range((last - first).days + 1)]
    writers.sync_cost_days(costs, path, days)
    writers.sync_cost_days(costs.filter(F.col("day") != F.lit(last)), path, days)
    out = spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day"), "instance_id", "country")
    return out.agg(F.sum(F.coalesce("cost", F.lit(0))).cast("double").alias("cost"), F.count("*").alias("n"))


def _intake(spark, sf_dir):
    """A1 / A2: the log in daily slots, taken in by two runs. Rows without a
    time arrive as lines cut off after 20 characters. The first run finds the
    hours before noon; then every slot grows by the other hours and the broken lines."""
    lr, root = Views(spark, sf_dir).f_lr, scratch(spark)
    name = f"log_lr_{root.rsplit('/', 1)[-1]}"
    timed = lr.filter(F.col("serverTs").isNotNull())
    broken = lr.filter(F.col("serverTs").isNull()).select(
        F.substring(F.to_json(F.struct(*[f.name for f in schemas.LR.fields])), 1, 20).alias("value"),
        F.date_format("dt", "yyyy").alias("y"), F.date_format("dt", "MM").alias("m"), F.date_format("dt", "dd").alias("d"))

    def run(hours):
        write_lr_json(spark, timed.filter(hours), root, hourly=False, mode="append")
        intake.start_intake(spark, root, "lr", f"{root}/lake", f"{root}/_ckpt", name, logs.HIVE, hourly=False).awaitTermination()

    run(F.col("h") < 12)
    broken.hint("rebalance", "d").write.mode("append").partitionBy("y", "m", "d").text(f"{root}/lr")
    run(F.col("h") >= 12)
    return root, name


@register("slot_intake", QUERIES["common_report"].oracle)
def q_slot_intake(spark, sf_dir):
    """A1 / A2: the funnel report from the registered partitions of the catalog table."""
    _, name = _intake(spark, sf_dir)
    return doubles(funnel.common_report(spark.table(name)
                                        .withColumns({"dt": F.lit(None).cast("date"), "h": F.lit(None).cast("int")})),
                   "bid_resp_price", "bid_win_price")


@register("slot_quarantine", with_views(["f_lr"], """
SELECT strftime(dt, '%Y') AS y, strftime(dt, '%m') AS m, strftime(dt, '%d') AS d, count(*) AS lines
FROM f_lr WHERE serverTs IS NULL GROUP BY dt
"""))
def q_slot_quarantine(spark, sf_dir):
    """A1: the malformed lines that the intake kept, by slot."""
    root, _ = _intake(spark, sf_dir)
    return intake.quarantine_counts(spark, f"{root}/lake", hourly=False)
