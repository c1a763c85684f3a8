"""Sources, sinks, streaming and the skew-safe rank selection."""

import datetime as dt
import json
import os
import random
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adpulse.operators import funnel
from adpulse.operators.ranking import select_ranks
from adpulse.sinks import writers
from adpulse.sources import logs
from adpulse.streaming import jobs
from adpulse import schemas

MS1 = 1704067200000  # 2024-01-01 00:00 UTC


def _scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_scan_log_plain_layout_with_malformed_line(spark):
    root = _scratch()
    for hour in (0, 1):
        d = os.path.join(root, "lr", "2024", "01", "01", f"{hour:02d}")
        os.makedirs(d)
        with open(os.path.join(d, "part-0.json"), "w") as f:
            f.write(json.dumps({"serverTs": MS1 + hour * 3_600_000, "type": 6, "country": "US"}) + "\n")
            f.write('{"serverTs": 1704067200000, "type": \n')        # truncated line -> all-NULL row
    df = logs.scan_log(spark, root, "lr", dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 3))
    rows = df.select("serverTs", "y", "m", "d", "h", "dt").collect()
    assert len(rows) == 4 and sum(r.serverTs is None for r in rows) == 2
    assert {r.h for r in rows} == {0, 1} and {r.dt for r in rows} == {dt.date(2024, 1, 1)}
    out = funnel.common_report(df).collect()
    assert sorted((r.hour, r.impr) for r in out) == [("00", 1), ("01", 1)]
    only_first = logs.scan_log(spark, root, "lr", dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 1))
    assert only_first.filter("serverTs IS NOT NULL").count() == 1


def test_cost_dump_trailing_separator_and_null_text(spark):
    path = os.path.join(_scratch(), "dump")
    os.makedirs(path)
    with open(os.path.join(path, "d.txt"), "w") as f:
        f.write("1\u00012\u000110\u00010\u0001US\u00013\u00017\u00011.5\u0001\n")
        f.write("2\u00012\u000110\u00011\u0001null\u00013\u00017\u0001null\u0001\n")
    rows = logs.scan_stat_adnetwork(spark, path).orderBy("id").collect()
    assert rows[0].cost == Decimal("1.50000000") and rows[0].country == "US"
    assert rows[1].country is None and rows[1].cost is None


def test_write_slot_is_idempotent_and_keeps_other_slots(spark):
    path = os.path.join(_scratch(), "t")
    a = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "day string, v int")
    writers.write_slot(a, path, ["day"])
    b = spark.createDataFrame([("2024-01-02", 5)], "day string, v int")
    writers.write_slot(b, path, ["day"])
    writers.write_slot(b, path, ["day"])
    got = sorted((str(r.day), r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 5)]


def test_publish_snapshot_shows_the_newest_complete_version(spark):
    root = _scratch()
    writers.publish_snapshot(spark, spark.createDataFrame([(1,)], "id int"), root, "s")
    writers.publish_snapshot(spark, spark.createDataFrame([(2,)], "id int"), root, "s")
    assert [r.id for r in writers.read_snapshot(spark, root, "s", "id int").collect()] == [2]
    os.makedirs(os.path.join(root, "s", "v=99999999999999999999-half"))  # begun, never committed
    assert [r.id for r in writers.read_snapshot(spark, root, "s", "id int").collect()] == [2]


def test_ranks_where_most_values_tie(spark):
    rows = [("hot", 1.25)] * 9500 + [("hot", round(2 + i / 7, 4)) for i in range(250)] + [("hot", 0.001 * i) for i in range(1, 251)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(16)
    vals = sorted((v for _, v in rows), reverse=True)
    ranks = [("first", 1), ("edge", 250), ("tie", 251), ("mid", 5000), ("tie_end", 9750), ("low", 9751), ("last", 10000)]
    got = {r.label: (r.n, r.v) for r in select_ranks(df, ["g"], "v", lambda n: [(k, F.lit(x)) for k, x in ranks]).collect()}
    assert got == {k: (10000, vals[x - 1]) for k, x in ranks}


def test_select_ranks_on_a_hot_group_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.randint(0, 500)) for _ in range(3000)] + \
           [(f"g{i % 7}", rnd.randint(0, 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(16)
    got = select_ranks(df, ["g"], "v", lambda n: [("a", F.floor(n / 3)), ("b", F.lit(1)), ("c", n)])
    got = {(r.g, r.label): r.v for r in got.collect()}
    for g in {r[0] for r in rows}:
        vals = sorted((v for k, v in rows if k == g), reverse=True)
        n = len(vals)
        assert got[(g, "a")] == vals[n // 3 - 1] if n // 3 >= 1 else True
        assert got[(g, "b")] == vals[0] and got[(g, "c")] == vals[-1]


class Feed:
    """A folder of JSON files that a stream reads one file per micro-batch, in the order they were put."""

    def __init__(self, root, cols):
        self.path, self.cols, self.clock, self.n = os.path.join(root, "in"), cols, 1_700_000_000, 0
        os.makedirs(self.path)

    def put(self, rows):
        self.n += 1
        path = os.path.join(self.path, f"{self.n:03d}.json")
        with open(path, "w") as f:
            for r in rows:
                f.write(json.dumps({c: r.get(c) for c in self.cols}) + "\n")
        self.clock += 10          # distinct modification times fix the processing order
        os.utime(path, (self.clock, self.clock))


def test_funnel_stream_counts_late_rows(spark):
    root = _scratch()
    feed = Feed(root, [f.name for f in schemas.LR.fields])
    stream = spark.readStream.schema(schemas.LR).option("maxFilesPerTrigger", 1).json(feed.path)

    def run():
        jobs.start_funnel_stream(stream, os.path.join(root, "out"), os.path.join(root, "ck")).awaitTermination()
        return sorted((int(r.hour), r.impr) for r in jobs.read_funnel(spark, os.path.join(root, "out")).collect())

    feed.put([dict(serverTs=MS1 + 10 * 60_000, type=6, country="US")])
    feed.put([dict(serverTs=MS1 + 5 * 3_600_000, type=6, country="US")])
    assert run() == [(0, 1), (5, 1)]
    # an impression of hour 0 arrives five hours late, beside one of hour 5
    feed.put([dict(serverTs=MS1 + 20 * 60_000, type=6, country="US"),
              dict(serverTs=MS1 + 5 * 3_600_000 + 60_000, type=6, country="US")])
    assert run() == [(0, 2), (5, 2)]


def test_user_marking_stream_corrects_late_days(spark):
    root = _scratch()
    day = 86_400_000
    feed = Feed(root, [f.name for f in schemas.LR.fields])
    stream = spark.readStream.schema(schemas.LR).option("maxFilesPerTrigger", 1).json(feed.path) \
        .withColumn("dt", F.to_date(F.timestamp_millis("serverTs")))
    for d in (6, 5, 7, 5, 4):
        feed.put([dict(serverTs=MS1 + d * day, uid="u1", publisherId=1, pubAppId=10, country="US"),
                  dict(serverTs=MS1 + d * day, uid=f"only{d}", publisherId=1, pubAppId=10, country="US")])
    jobs.start_user_marking_stream(stream, os.path.join(root, "h"), os.path.join(root, "ck")).awaitTermination()
    # a batch adds rows of its own users only: the corrected first day among them
    sizes = {r.epoch: r["count"] for r in spark.read.parquet(os.path.join(root, "h", "changes")).groupBy("epoch").count().collect()}
    assert sizes == {0: 2, 1: 3, 2: 2, 3: 2, 4: 3}
    got = sorted((r.uid, r.ymd[-2:], r.is_new) for r in jobs.read_user_history(spark, os.path.join(root, "h")).collect())
    first = int(got[-4][1])
    assert [g for g in got if g[0] == "u1"] == [("u1", f"{first + i:02d}", int(i == 0)) for i in range(4)]
    assert sum(g[0].startswith("only") for g in got) == 4 and all(g[2] == 1 for g in got if g[0].startswith("only"))


def test_cap_stream_sends_each_change_once(spark):
    root = _scratch()
    schema = "id bigint, publisher_id int, status int, run_status int, daily_cap int"
    feed = Feed(root, ["id", "publisher_id", "status", "run_status", "daily_cap"])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(feed.path)
    row = lambda i, cap, status=1, run=1: dict(id=i, publisher_id=1, status=status, run_status=run, daily_cap=cap)
    for rows in ([row(1, 100)], [row(2, 50)], [row(1, 100)], [row(1, 130), row(3, 5, run=0)], [row(2, 50, status=0)], [row(2, 50)]):
        feed.put(rows)
    q = jobs.start_cap_stream(stream, os.path.join(root, "s"), os.path.join(root, "m"), os.path.join(root, "ck"), [1], dt.date(2024, 1, 1))
    q.awaitTermination()
    got = [(r.epoch, r.value.split("\u0001")) for r in spark.read.parquet(os.path.join(root, "m")).orderBy("epoch").collect()]
    assert got == [(0, ["1", "100"]), (1, ["2", "50"]), (3, ["1", "30"]), (5, ["2", "50"])]


def test_slot_jobs_keep_late_rows_and_clear_emptied_slots(spark):
    path = os.path.join(_scratch(), "stat")
    cols = [f.name for f in schemas.LR.fields if f.name != "serverTs"]
    types = "serverTs long, dt date, h int, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.LR.fields if f.name != "serverTs")

    def lr(rows):
        return spark.createDataFrame([(ts, dt.date(2024, 1, 1), h, *[6 if c == "type" else None for c in cols]) for ts, h in rows], types)

    def job(rows, hour):
        begin = dt.datetime(2024, 1, 1, hour)
        out = funnel.common_report(lr(rows), begin, begin + dt.timedelta(hours=1), by_slot=True)
        writers.write_slot(out, path, funnel.SLOT_NAMES, slots=[{"slot_day": "2024-01-01", "slot_hour": hour}])

    def total():
        return {r.hour: r["sum(impr)"] for r in spark.read.parquet(path).groupBy("hour").sum("impr").collect()}

    six, seven = [(MS1 + 6 * 3_600_000 + i, 6) for i in range(5)], [(MS1 + 7 * 3_600_000, 7), (MS1 + 6 * 3_600_000, 7)]
    job(six, 6)
    job(seven, 7)
    job(seven, 7)
    assert total() == {"06": 6, "07": 1}
    job([], 6)
    assert total() == {"06": 1, "07": 1}
    with pytest.raises(ValueError):
        out = funnel.common_report(lr(six), by_slot=True)
        writers.write_slot(out, path, funnel.SLOT_NAMES, slots=[{"slot_day": "2024-01-01", "slot_hour": 7}])


def test_register_partition_is_idempotent(spark):
    root = _scratch()
    d = os.path.join(root, "lr", "2024", "01", "01", "05")
    os.makedirs(d)
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write(json.dumps({"serverTs": MS1 + 5 * 3_600_000, "type": 6}) + "\n")
    name = f"lr_{os.path.basename(root).replace('-', '_')}"
    spark.sql(f"CREATE TABLE {name} (serverTs BIGINT, type INT, y STRING, m STRING, d STRING, h STRING) "
              f"USING json PARTITIONED BY (y, m, d, h) LOCATION '{root}/lr_table'")
    for _ in range(2):
        logs.register_partition(spark, name, dt.datetime(2024, 1, 1, 5), d)
    rows = spark.table(name).collect()
    assert [(r.serverTs, r.h) for r in rows] == [(MS1 + 5 * 3_600_000, "05")]
    spark.sql(f"DROP TABLE {name}")


def test_csv_sinks_and_cost_sync(spark):
    root = _scratch()
    df = spark.createDataFrame([("a", 1), ("b", 2)], "Region string, Impressions int")
    writers.write_report_csv(df, os.path.join(root, "report"))
    back = spark.read.option("header", True).csv(os.path.join(root, "report"))
    assert back.columns == ["Region", "Impressions"] and back.count() == 2
    writers.write_csv_dir(df, os.path.join(root, "plain"))
    assert spark.read.csv(os.path.join(root, "plain")).count() == 2
    costs = spark.createDataFrame([(1, 2.5)], "instance_id int, cost double")
    writers.sync_costs(costs, os.path.join(root, "costs"), dt.date(2024, 1, 1))
    writers.sync_costs(costs, os.path.join(root, "costs"), dt.date(2024, 1, 1))
    writers.sync_costs(costs, os.path.join(root, "costs"), dt.date(2024, 1, 2))
    got = spark.read.parquet(os.path.join(root, "costs")).groupBy("day").count().collect()
    assert sorted((str(r.day), r["count"]) for r in got) == [("2024-01-01", 1), ("2024-01-02", 1)]


def test_bucketed_history_join_reads_history_without_a_shuffle(spark):
    from adpulse.operators import users
    root = _scratch()
    name = f"hist_{os.path.basename(root).replace('-', '_')}"
    rows = [(1, 10, "US", f"u{i}", 1, "20240101") for i in range(50)]
    hist = spark.createDataFrame(rows, schemas.PUBLISHER_USER)
    # buckets >= the session's shuffle partitions (8 in tests): the bucketed side is then kept as is
    for _ in range(2):  # the rerun replaces the day
        writers.write_bucketed(hist, name, os.path.join(root, "h"), users.USER_KEYS, 8, ["ymd"])
    assert spark.table(name).count() == 50
    lr = spark.createDataFrame([(MS1, f"u{i}", 1, 10, "US", dt.date(2024, 1, 2)) for i in range(0, 100, 2)],
                               "serverTs long, uid string, publisherId int, pubAppId int, country string, dt date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = users.mark_publisher_users(lr, spark.table(name), begin_day=dt.date(2024, 1, 2))
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.uid: r.is_new for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {name}")
    # only the day's users are exchanged: one hash exchange, none above the bucketed scan
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert got["u0"] == 0 and got["u48"] == 0 and got["u50"] == 1 and len(got) == 50


def test_select_ranks_groups_null_keys_together(spark):
    rows = [(None, v) for v in range(1, 13)] + [("a", v) for v in range(1, 4)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = {(r.g, r.label): (r.n, r.v) for r in
           select_ranks(df, ["g"], "v", lambda n: [("top", F.lit(1)), ("mid", F.floor(n / 2))]).collect()}
    assert got[(None, "top")] == (12, 12) and got[(None, "mid")] == (12, 7)
    assert got[("a", "top")] == (3, 3) and got[("a", "mid")] == (3, 3)
