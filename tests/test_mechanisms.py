"""Stores and one-pass forms: activity bitmaps, digest ledger, slot sets, slot
table, all eCPM datasets at once, pointer doubling, salted allocation, intake."""

import datetime as dt
import decimal
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import SF_SMALL

from adpulse import schemas
from adpulse.fixtures import Views
from adpulse.functions.text import split_items
from adpulse.operators import cohorts, ecpm, ledger, mergeable, report, report_table, revenue, state, users
from adpulse.plans import q_custom, q_ecpm
from adpulse.sinks import writers
from adpulse.sinks.slots import SlotTable
from adpulse.snapshots import common
from adpulse.sources import intake
from adpulse.streaming import jobs

DAY = dt.date(2024, 1, 1)
MS = 1_704_067_200_000


def folder():
    return tempfile.mkdtemp(prefix="run-mech-", dir="/tmp")


def log(spark, rows):
    """Log rows from dicts; ``dt`` is a day number from DAY, the time follows it."""
    fields = [f.name for f in schemas.LR.fields]
    full = [tuple([DAY + dt.timedelta(days=r["d"]), r.get("h", 0)] + [
        {"serverTs": MS + r["d"] * 86_400_000, "publisherId": 1, "pubAppId": 10, "country": "US", "mid": 1, "iid": 1, **r}.get(c)
        for c in fields]) for r in rows]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.LR.fields)
    return spark.createDataFrame(full, f"dt date, h int, {types}")


# ---------------------------------------------------------------- texts, rates, versions

def test_split_items_drops_trailing_empties_only(spark):
    texts = ["a,b", "a,b,,", ",a,,b,", ",", "", " ", None, "a, ,"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in df.orderBy("i").select(split_items("t").alias("x")).collect()]
    assert got == [["a", "b"], ["a", "b"], ["", "a", "", "b"], [], [""], [" "], None, ["a", " "]]


def test_last_of_repeated_rates_and_reruns(spark):
    latest = spark.createDataFrame([("A", "USD", 1.0), ("B", "USD", 2.0)], "cur_from string, cur_to string, exchange_rate double")
    new = spark.createDataFrame([("B", "USD", 9.0, 1), ("B", "USD", 4.0, 2), ("C", "USD", 5.0, 1)], "cur_from string, cur_to string, exchange_rate double, seq int")
    assert sorted(map(tuple, state.upsert_rates(latest, new, order="seq").collect())) == [("A", "USD", 1.0), ("B", "USD", 4.0), ("C", "USD", 5.0)]
    once = state.append_history(None, latest, DAY)
    twice = state.append_history(state.append_history(once, latest, DAY + dt.timedelta(days=1)), latest.limit(1), DAY)
    assert sorted((r.day, r.cur_from) for r in twice.collect()) == [
        (DAY, "A"), (DAY + dt.timedelta(days=1), "A"), (DAY + dt.timedelta(days=1), "B")]


def test_emptied_costs_users_and_apps_go(spark):
    root = folder()
    costs = spark.createDataFrame([(1, 2.5)], "instance_id int, cost double")
    for day, df in ((1, costs), (2, costs), (1, costs.limit(0))):
        writers.sync_costs(df, f"{root}/costs", dt.date(2024, 1, day))
    assert [str(r.day) for r in spark.read.parquet(f"{root}/costs").collect()] == ["2024-01-02"]
    per_app = spark.createDataFrame([("a", 1), ("b", 2)], "v string, pub_app_id int")
    writers.write_per_app(per_app, f"{root}/apps")
    writers.write_per_app(per_app.filter("pub_app_id = 1"), f"{root}/apps")
    assert [tuple(r) for r in writers.read_per_app(spark, f"{root}/apps", per_app.schema).collect()] == [("a", 1)]
    name = f"users_{os.path.basename(root).replace('-', '_')}"
    marked = spark.createDataFrame([(1, 1, "US", "u", 1, "20240101"), (1, 1, "US", "v", 1, "20240102")], schemas.PUBLISHER_USER)
    writers.write_bucketed(marked, name, f"{root}/h", users.USER_KEYS, 4, ["ymd"])
    writers.write_bucketed(marked.filter("ymd = '20240102'"), name, f"{root}/h", users.USER_KEYS, 4, ["ymd"],
                           slots=[{"ymd": "20240101"}, {"ymd": "20240102"}])
    assert [r.uid for r in spark.table(name).collect()] == ["v"]
    assert [r.uid for r in spark.read.parquet(f"{root}/h").collect()] == ["v"]


def test_old_versions_are_dropped(spark):
    root = folder()
    for i in range(4):
        writers.publish_snapshot(spark, spark.createDataFrame([(i,)], "id int"), root, "s")
    os.makedirs(f"{root}/s/v=00000000000000000000-begun")
    assert writers.drop_old_versions(spark, f"{root}/s", keep=2) == 3
    assert writers.read_snapshot(spark, root, "s", "id int").first().id == 3 and len(os.listdir(f"{root}/s")) == 2
    assert writers.drop_old_versions(spark, f"{root}/none") == 0


# ---------------------------------------------------------------- cohorts

def test_bitmaps_follow_gaps_and_equal_the_report(spark):
    rng = random.Random(4)
    rows = [dict(d=d, uid=f"u{u}", type=6, impr=rng.randint(1, 3), iid=1 + u % 2, publisherId=1, country=rng.choice(["US", None]) if u == 5 else "US")
            for d in (0, 1, 4, 5, 9) for u in range(8) if rng.random() < 0.6]
    lr = log(spark, rows)
    cost = spark.createDataFrame([(DAY + dt.timedelta(days=d), 1, 10, 0, 1, i, "US", 7.0) for d in range(10) for i in (1, 2)],
                                 "dt date, publisher_id int, pub_app_id int, platform int, adn_id int, instance_id int, country string, cost double")
    iap = spark.createDataFrame([(DAY + dt.timedelta(days=4), "u1", 1, 10, "US", 3.0), (DAY + dt.timedelta(days=9), "new", 1, 10, "US", 2.0)],
                                "dt date, uid string, publisherId int, pubAppId int, country string, iapUsd double")
    store = cohorts.CohortStore(spark, f"{folder()}/c", range_days=4)
    of = lambda df, day: df.filter(F.col("dt") == F.lit(day))
    days = [DAY + dt.timedelta(days=d) for d in (0, 1, 4, 5, 9)]
    for day in [*days, days[-1]]:  # the last day is fed twice
        store.feed(day, of(lr, day), of(cost, day), of(iap, day))
    with pytest.raises(ValueError, match="comes before"):
        store.feed(days[0], lr, cost, iap)
    marked = users.mark_publisher_users(lr)
    want = revenue.ltv_report(marked, lr, cost, iap, days[0], days[-1], range_days=4).filter(
        F.col("execute_date").isin([f"{d:%Y%m%d}" for d in days]))
    round_ = lambda df: sorted([tuple(round(float(x), 6) if i > 9 else x for i, x in enumerate(r)) for r in df.collect()], key=str)
    got = round_(store.report().select(*want.columns))
    assert got == round_(want) and any(r[8] for r in got)


def test_a_bitmap_holds_62_days(spark):
    with pytest.raises(ValueError):
        cohorts.advance(None, log(spark, []).select(F.lit(1).alias("x")), DAY, 0, 63)
    old = spark.createDataFrame([("US", 1, 1, "u", DAY, 1)], "country string, publisher_id int, pub_app_id int, uid string, first_day date, bits long")
    none = old.select("country", "publisher_id", "pub_app_id", "uid").limit(0)
    bits = [cohorts.advance(old, none, DAY + dt.timedelta(days=g), g, 62).first().bits for g in (61, 62, 63, 500)]
    assert bits == [1 << 61, 1 << 62, 0, 0]


def test_bitmaps_of_users_are_not_broadcast(spark):
    """A day's bitmaps grow with the users: a file below the broadcast limit is still read by the driver every day."""
    path = f"{folder()}/users"
    keys = "country string, publisher_id int, pub_app_id int, uid string"
    spark.createDataFrame([("US", 1, 10, f"u{i}", DAY, 1) for i in range(5)], f"{keys}, first_day date, bits long").write.parquet(path)
    values = spark.createDataFrame([("US", 1, 10, f"u{i}", 2, i) for i in range(3)], f"{keys}, mediation_value long, iap_value long")
    out = cohorts.day_cohorts(spark.read.parquet(path), values, DAY)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.retention_cnt_new, r.total_value_new) for r in out.collect()] == [(3, 9)]


# ---------------------------------------------------------------- ledger

def test_digests_see_every_difference(spark):
    base = [(DAY, "a", None, 1), (DAY, "b", "c", 2)]
    frame = lambda rows: spark.createDataFrame(rows, "dt date, x string, y string, n int")
    digest = lambda rows: [tuple(r)[2:] for r in ledger.day_digests(frame(rows), "t").collect()]
    assert digest(base) == digest(base[::-1])
    for other in ([(DAY, None, "a", 1), base[1]], base + base[:1], base[:1], [base[0], (DAY, "b", "c", 3)], [base[0], base[0], *base]):
        assert digest(other) != digest(base)


def test_only_changed_days_are_restated(spark):
    root = folder()
    book = ledger.InputLedger(spark, f"{root}/ledger")
    seen = []

    def job(a, b, factor):
        seen.append(sorted({r.dt.day for r in a.select("dt").union(b.select("dt")).distinct().collect()}))
        return a.join(b, "dt").groupBy(F.col("dt").alias("day")).agg((F.sum(F.col("x") * F.col("z")) * factor).alias("v"))

    def run(a, b, **kw):
        frames = {"a": spark.createDataFrame([(dt.date(2024, 1, d), x) for d, x in a], "dt date, x int"),
                  "b": spark.createDataFrame([(dt.date(2024, 1, d), z) for d, z in b], "dt date, z int")}
        days = ledger.restate_changed(book, frames, job, f"{root}/out", factor=10, **kw)
        rows = spark.read.parquet(f"{root}/out").collect()
        return [d.day for d in days], sorted((r.day.day, r.v) for r in rows)

    assert run([(1, 1), (2, 2), (3, 3)], [(1, 1), (2, 1), (3, 1)]) == ([1, 2, 3], [(1, 10), (2, 20), (3, 30)])
    assert run([(1, 1), (2, 2), (3, 3)], [(1, 1), (2, 1), (3, 1)]) == ([], [(1, 10), (2, 20), (3, 30)])
    assert run([(1, 1), (2, 2), (3, 3)], [(1, 1), (2, 5), (3, 1)]) == ([2], [(1, 10), (2, 100), (3, 30)])
    assert run([(1, 1), (2, 2)], [(1, 1), (2, 5), (3, 1)]) == ([3], [(1, 10), (2, 100)])     # the day is emptied
    assert run([(1, 1), (2, 3)], [(1, 1), (2, 5)], reach=1) == ([2, 3, 4], [(1, 10), (2, 150)])
    assert seen == [[1, 2, 3], [2], [3], [1, 2]]


def test_file_digests_see_a_grown_slot(spark):
    root = folder()
    for d in (1, 2):
        os.makedirs(f"{root}/in/2024/01/{d:02d}")
        open(f"{root}/in/2024/01/{d:02d}/a.json", "w").write("{}\n")
    day = lambda p: F.to_date(F.regexp_extract(p, r"(\d{4}/\d{2}/\d{2})/", 1), "yyyy/MM/dd")
    book = ledger.InputLedger(spark, f"{root}/ledger")
    book.record(ledger.file_digests(spark, f"{root}/in", "lr", day))
    open(f"{root}/in/2024/01/02/b.json", "w").write("{}\n")
    changes = book.changes(ledger.file_digests(spark, f"{root}/in", "lr", day)).collect()
    assert [(r.input, r.day.day, r.change) for r in changes] == [("lr", 2, "changed")]


# ---------------------------------------------------------------- slot sets

def test_slot_sets_merge_to_days_and_ranges(spark):
    rng = random.Random(8)
    rows = [dict(d=d, h=h, uid=rng.choice([None, "", f"u{rng.randint(0, 30)}"]), did=f"d{rng.randint(0, 9)}", ip=rng.choice([None, "1.1"]),
                 type=rng.choice([6, 7, None])) for d in range(2) for h in (0, 5, 23) for _ in range(40)]
    rows += [dict(d=1, h=1, uid=None, type=6, country="DE")]  # a group whose sets are all empty
    lr, root = log(spark, rows), folder()
    numbers = mergeable.Dictionary(spark, f"{root}/n")
    for hours in ([0, 1], [5, 23], [5]):  # the last run repeats a slot of the one before
        sets = mergeable.slot_bitmaps(lr.filter(F.col("h").isin(hours)), numbers)
        slots = [{"slot_day": f"2024-01-0{d}", "slot_hour": h} for d in (1, 2) for h in hours]
        mergeable.store_slots(spark.createDataFrame(sets.collect(), sets.schema), f"{root}/s", slots)
    ids = numbers.read().collect()
    for domain in ("ip", "did", "uid"):
        assert sorted(r.id for r in ids if r.domain == domain) == list(range(sum(r.domain == domain for r in ids)))
    stored = spark.read.parquet(f"{root}/s")
    columns = [*users.USER_BASE_DIMS, "ip_count", "did_count", "dau", "deu"]
    rows_of = lambda df: sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))
    assert rows_of(mergeable.merge_bitmaps(stored, users.USER_BASE_DIMS)) == rows_of(users.user_report(lr))
    both = mergeable.merge_bitmaps(stored, ["pub_app_id"]).first()
    assert both.dau == len({r["uid"] for r in rows} - {None}) and both.ip_count == 1
    guess = mergeable.merge_sketches(mergeable.slot_sketches(lr), ["pub_app_id"]).first()
    assert abs(guess.dau - both.dau) <= 1 and abs(guess.did_count - 10) <= 1


# ---------------------------------------------------------------- slot table

def test_a_commit_switches_all_its_slots(spark):
    schema = spark.createDataFrame([], "v int, day string, app int").schema
    table = SlotTable(spark, f"{folder()}/t", schema, ["day", "app"])
    frame = lambda rows: spark.createDataFrame(rows, schema)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    slot = lambda d, a: {"day": d, "app": a}
    assert rows(table.read()) == []
    table.commit(frame([(1, "01", 1), (2, "01", 2), (3, "02", 1)]), [slot("01", 1), slot("01", 2), slot("02", 1)])
    before = table.read()
    with pytest.raises(ValueError):
        table.commit(frame([(9, "01", 1), (9, "03", 1)]), [slot("01", 1)])
    assert rows(table.read()) == [(1, "01", 1), (2, "01", 2), (3, "02", 1)]
    table.commit(frame([(5, "01", 1)]), [slot("01", 1), slot("01", 2)])
    assert rows(table.read()) == [(3, "02", 1), (5, "01", 1)]
    assert rows(before) == [(1, "01", 1), (2, "01", 2), (3, "02", 1)]  # a reader keeps its commit
    table.commit(frame([]), [slot("02", 1), slot("01", 1)])
    assert rows(table.read()) == []
    assert table.drop_unused(older_than_seconds=3600) == 0 and table.drop_unused(older_than_seconds=0) == 3


# ---------------------------------------------------------------- eCPM

def test_all_datasets_equal_the_single_ones_from_one_scan(spark):
    v = Views(spark, SF_SMALL)
    delays = q_ecpm.delays_of(v.f_adn)
    for as_of in (q_ecpm.AS_OF, dt.datetime(1996, 3, 2, 1)):
        out = ecpm.ecpm_rollups(v.f_stat, as_of, delays)
        rows = {}
        for r in out.collect():
            rows.setdefault(r.dataset, []).append(r)
        for spec in ecpm.SPECS:
            single = ecpm.ecpm_rollup(v.f_stat, spec, as_of, delays)
            names = [c if c != spec.money else "money" for c in single.columns]
            plain = lambda r: str(tuple(float(x) if isinstance(x, decimal.Decimal) else x for x in r))
            assert sorted(plain(r[c] for c in names) for r in rows.get(spec.name, [])) \
                == sorted(plain(r) for r in single.collect()), spec.name
    plan = ecpm.ecpm_rollups(v.f_stat, q_ecpm.AS_OF, delays)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_extendedprice") and plan.count("Expand") == 1 and plan.count("l_suppkey") <= 60
    physical = ecpm.ecpm_rollups(v.f_stat, q_ecpm.AS_OF, delays)._jdf.queryExecution().executedPlan().toString()
    assert sum("lineitem.parquet" in line for line in physical.splitlines() if "FileScan" in line) == 1


# ---------------------------------------------------------------- dictionary

def test_paths_of_a_deep_dictionary(spark, monkeypatch):
    rounds = []
    original = common._fs
    monkeypatch.setattr(common, "_fs", lambda s, p: rounds.append(p) or original(s, p))
    deep = [(i, i - 1, f"n{i}", str(i)) for i in range(1, 1001)] + [(2000, 1999, "orphan", "x"), (2001, 2000, "below", "y")]
    random.Random(1).shuffle(deep)
    got = {r.id: r.path for r in common.dict_paths(spark.createDataFrame(deep, "id int, pid int, name string, value string")).collect()}
    assert len(got) == 1000 and all(got[i] == "/" + "/".join(f"n{j}" for j in range(1, i + 1)) for i in (1, 2, 999, 1000))
    assert len(rounds) <= 11
    for circle in ([(1, 0, "r", ""), (2, 3, "a", ""), (3, 2, "b", ""), (4, 2, "c", "")], [(5, 5, "self", ""), (1, 0, "r", "")],
                   [(1, 0, "r", ""), (2, 1, "two ways", ""), (2, 3, "two ways", ""), (3, 3, "self", "")]):
        got = common.dict_paths(spark.createDataFrame(circle, "id int, pid int, name string, value string")).collect()
        assert sorted(r.path for r in got) == ["/r"] + (["/r/two ways"] if circle[1][2] == "two ways" else [])
    with pytest.raises(ValueError, match="circle"):
        common.dict_paths(spark.createDataFrame([(1, 0, "r", ""), (2, 1, "a", ""), (3, 2, "b", ""), (2, 3, "a", "")],
                                                "id int, pid int, name string, value string"))
    assert common.dict_paths(spark.createDataFrame([], "id int, pid int, name string, value string")).collect() == []


# ---------------------------------------------------------------- allocation

def test_a_hot_instance_is_dealt_over_the_tasks(spark):
    rows = [(1 if i % 20 else 2 + i % 7, f"d{i}", 1 + i % 3, i % 2) for i in range(20_000)]
    events = spark.createDataFrame(rows, "iid int, did string, shows int, taps int").repartition(8)
    cost = spark.createDataFrame([(1, 100.0), (2, 3.0), (5, 0.0)], "iid int, cost double")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = revenue.allocate_cost(events, cost, ["iid"], ["did"], hot_rows=100).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("task").count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / 16
        salted = sorted(map(str, out.drop("task").collect()))
        plain = sorted(map(str, revenue.allocate_cost(events, cost, ["iid"], ["did"]).collect()))
        assert salted == plain
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# ---------------------------------------------------------------- intake, reports, streams

def test_intake_takes_new_files_and_keeps_broken_lines(spark):
    root = folder()
    name = f"lr_{os.path.basename(root).replace('-', '_')}"

    def put(hour, file, lines):
        os.makedirs(f"{root}/lr/2024/01/02/{hour:02d}", exist_ok=True)
        with open(f"{root}/lr/2024/01/02/{hour:02d}/{file}", "w") as f:
            f.write("\n".join(lines) + "\n")

    def run():
        intake.start_intake(spark, root, "lr", f"{root}/lake", f"{root}/ck", name).awaitTermination()
        bad = sorted((r.h, r.lines) for r in intake.quarantine_counts(spark, f"{root}/lake").collect()) if os.path.isdir(f"{root}/lake/quarantine") else []
        return sorted((r.h, r.serverTs) for r in spark.table(name).collect()), bad

    put(3, "a.json", [json.dumps({"serverTs": 1}), json.dumps({"serverTs": 2})])
    assert run() == ([("03", 1), ("03", 2)], [])
    put(3, "b.json", [json.dumps({"serverTs": 3}), '{"serverTs": 4', "not json"])
    put(4, "a.json", ['{"serverTs": "text"}', json.dumps({"serverTs": 5, "other": 1})])
    assert run() == ([("03", 1), ("03", 2), ("03", 3), ("04", 5)], [("03", 2), ("04", 1)])
    assert run() == ([("03", 1), ("03", 2), ("03", 3), ("04", 5)], [("03", 2), ("04", 1)])
    lines = sorted(r.line for r in spark.read.parquet(f"{root}/lake/quarantine").collect())
    assert lines == ["not json", '{"serverTs": "text"}', '{"serverTs": 4']


def test_a_spec_table_gives_every_report(spark):
    stat, stat_lr, stat_dau, labels = q_custom.inputs(spark, SF_SMALL)
    task = dt.date(2024, 1, 20)
    specs = {"by_instance": report.ReportSpec(1, "day,country", "request,filled,fillRate,impr", cond_day_period=9, cond_instance_list="1,2,3"),
             "by_app": report.ReportSpec(2, "pubAppId", "dau,impr,imprDau,isReady", cond_day_period=5, data_source=report.DS_USER_ACTIVITY,
                                         cond_pub_app_list="20,21"),
             "empty": report.ReportSpec(99, "day", "impr", cond_day_period=9)}
    frame = report_table.specs_frame(spark, {n: (s, task, None) for n, s in specs.items()})
    rows = report_table.custom_reports(frame, stat, stat_lr, stat_dau, labels).collect()
    for name, spec in specs.items():
        single = report.custom_report(spec, stat, stat_lr, stat_dau, labels, task).collect()
        assert sorted(tuple(r[c] for c in spec.dims + spec.metric_list) for r in rows if r.report == name) == sorted(map(tuple, single))
        assert bool(single) == (name != "empty")


def test_streamed_users_start_from_history_and_compact(spark):
    root, day = folder(), 86_400_000
    os.makedirs(f"{root}/in")
    history = spark.createDataFrame([(1, 10, "US", "old", 1, "20231230"), (1, 10, "US", "old", 0, "20231231"),
                                     (1, 10, "US", "late", 1, "20240105")], schemas.PUBLISHER_USER)
    stream = spark.readStream.schema(schemas.LR).option("maxFilesPerTrigger", 1).json(f"{root}/in") \
        .withColumn("dt", F.to_date(F.timestamp_millis("serverTs")))

    def run(n, rows):
        with open(f"{root}/in/{n}.json", "w") as f:
            for d, uid in rows:
                f.write(json.dumps(dict(serverTs=MS + d * day, uid=uid, publisherId=1, pubAppId=10, country="US")) + "\n")
        jobs.start_user_marking_stream(stream, f"{root}/h", f"{root}/ck", history=history).awaitTermination()
        return sorted((r.uid, r.ymd[4:], r.is_new) for r in jobs.read_user_history(spark, f"{root}/h").collect())

    first = [("late", "0102", 1), ("late", "0105", 0), ("new", "0102", 1), ("old", "0102", 0), ("old", "1230", 1), ("old", "1231", 0)]
    assert run(1, [(1, "old"), (1, "late"), (1, "new"), (1, "new")]) == first
    for _ in range(2):
        jobs.compact_user_history(spark, f"{root}/h")
        assert sorted((r.uid, r.ymd[4:], r.is_new) for r in jobs.read_user_history(spark, f"{root}/h").collect()) == first
    assert run(2, [(0, "new"), (3, "old")]) == sorted([*first[:2], ("new", "0101", 1), ("new", "0102", 0), ("old", "0104", 0), *first[3:]])
    jobs.compact_user_history(spark, f"{root}/h")
    assert len([n for n in os.listdir(f"{root}/h/base") if n.startswith("v=")]) == 2


def test_a_batch_asks_the_state_once_for_a_bucket_of_users():
    class Value:
        calls, held = [], None

        def get(self):
            self.calls.append("get")
            return self.held

        def update(self, value):
            self.calls.append("update")
            self.held = value

    class Handle:
        def getValueState(self, name, schema):
            return Value()

    p = jobs.FirstSeen()
    p.init(Handle())

    def batch(rows):
        p.first.calls.clear()
        given = [Row(publisher_id=1, pub_app_id=10, country="US", uid=u, user=f"1,10,2,US{u}", ymd=d) for u, d in rows]
        return [(r.uid, r.ymd, r.is_new) for r in p.handleInputRows((0,), iter(given), None)], list(p.first.calls)

    p.handleInitialState((0,), Row(bucket=0, days='{"1,10,2,USu0": "05"}'), None)
    out, calls = batch([(f"u{i}", d) for i in range(100) for d in ("03", "04", "04")])
    assert calls == ["get", "update"]
    assert out[:3] == [("u0", "03", 1), ("u0", "04", 0), ("u0", "05", 0)] and out[3:5] == [("u1", "03", 1), ("u1", "04", 0)] and len(out) == 201
    assert batch([("u1", "04")]) == ([("u1", "04", 0)], ["get"])
    assert batch([("u1", "02")]) == ([("u1", "02", 1), ("u1", "03", 0)], ["get", "update"])


def test_users_that_share_a_bucket_stay_apart(spark, monkeypatch):
    """Keys whose parts read alike when joined, in two buckets, over batches out of order and a history."""
    monkeypatch.setattr(jobs, "USER_BUCKETS", 2)
    root, day = folder(), 86_400_000
    os.makedirs(f"{root}/in")
    keys = [(1, 10, "US", "u"), (1, 10, "U", "Su"), (11, 0, "US", "u"), (1, 10, "US", ",u\u00fc\""), (1, 10, "", "USu"), (1, 10, "US", "")]
    files = [[(3, i) for i in range(6)], [(2, 0), (2, 3), (4, 1)], [(1, 4), (3, 2), (1, 5), (1, 0)]]
    for n, rows in enumerate(files):
        with open(f"{root}/in/{n}.json", "w") as f:
            for d, i in rows:
                f.write(json.dumps(dict(serverTs=MS + d * day, publisherId=keys[i][0], pubAppId=keys[i][1], country=keys[i][2], uid=keys[i][3])) + "\n")
        os.utime(f"{root}/in/{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    history = spark.createDataFrame([(*keys[1], 1, "20231231"), (*keys[3], 1, "20240109")], schemas.PUBLISHER_USER)
    stream = spark.readStream.schema(schemas.LR).option("maxFilesPerTrigger", 1).json(f"{root}/in") \
        .withColumn("dt", F.to_date(F.timestamp_millis("serverTs")))
    jobs.start_user_marking_stream(stream, f"{root}/h", f"{root}/ck", history=history).awaitTermination()
    days = {}
    for d, i in [(0, 1), (9, 3), *(r for rows in files for r in rows)]:
        days.setdefault(keys[i], set()).add("20231231" if (d, i) == (0, 1) else f"{20240101 + d - (d == 9)}")
    want = sorted((*k, int(d == min(v)), d) for k, v in days.items() for d in v)
    assert sorted(map(tuple, jobs.read_user_history(spark, f"{root}/h").collect())) == want
