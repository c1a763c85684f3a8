"""Structured Streaming versions of the hourly / incremental jobs.

The reference runs these as batch jobs on a timer. Here:

* S1 - the funnel (C1) as partial sums per micro-batch: every metric is a sum,
  so the report of an event hour is the sum of its partial rows, whenever they
  arrived. No row is dropped as late and no state store is kept; a batch's
  rows are stored under its id, so a replay replaces them.
  ``funnel_stream`` is the windowed aggregation with a watermark for consumers that want
  an hour emitted once and accept that rows behind the watermark are left out.
* S2 - new/old user marking (C8) per micro-batch with every key's first day in
  a state store, by buckets of users: a batch touches the buckets of its own users
  and appends their rows only. When an earlier day arrives late, the row that was marked new
  before is corrected by a later row. ``compact_user_history`` merges the rows.
* S3 - campaign cap deltas (H1) per micro-batch against the day's snapshot, a
  new version of which (old rows, replaced by id) each batch commits.

Every sink write is idempotent: a batch replayed after a failure finds its own
output replaced or its input state unchanged.
"""

from __future__ import annotations

import datetime as _dt
import json
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators import funnel, state, users
from ..sinks.writers import _fs, drop_old_versions, newest_version, write_slot

WATERMARK = "17 minutes"   # fixed value: an hour is complete 17 minutes after it ends
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


# ---------------------------------------------------------------- S1

def funnel_stream(lr_stream: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """C1 as a tumbling-hour aggregation; rows behind the watermark are dropped."""
    ev = lr_stream.filter(F.col("serverTs").isNotNull() & (F.col("type") != 1)) \
                  .withColumn("_event_time", F.timestamp_millis("serverTs"))
    return (ev.withWatermark("_event_time", watermark)
            .groupBy(F.window("_event_time", "1 hour").alias("_w"), *funnel.funnel_dims())
            .agg(*funnel.funnel_metrics())
            .drop("_w"))


def start_funnel_stream(lr_stream: DataFrame, sink_path: str, checkpoint: str, trigger: dict | None = None):
    """Run S1: partial report rows per micro-batch, partitioned by (day,
    epoch); read the report with ``read_funnel``. Returns the StreamingQuery."""
    def sink(batch, epoch):
        part = batch.filter(F.col("serverTs").isNotNull() & (F.col("type") != 1)) \
                    .groupBy(*funnel.funnel_dims()).agg(*funnel.funnel_metrics())
        write_slot(part.withColumn("epoch", F.lit(epoch).cast("long")), sink_path, ["day", "epoch"])

    w = lr_stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _base_and_parts(spark: SparkSession, base_folder: str, parts_folder: str, schema: str | None = None):
    """(newest compacted version or None, its number, the parts of batches from that number on or None)."""
    base = newest_version(spark, base_folder)
    upto = int(base.rsplit("=", 1)[1]) if base else 0
    parts = None
    if _path_exists(spark, parts_folder):
        reader = spark.read.schema(f"{schema}, epoch long") if schema else spark.read
        parts = reader.parquet(parts_folder).filter(F.col("epoch") >= upto)
    return base, upto, parts


def _compact(spark: SparkSession, merged: DataFrame, base_folder: str, parts_folder: str, upto: int, last: int, level: str) -> None:
    """Commit ``merged`` as the version that holds all batches up to ``last``,
    then drop the parts that the version before holds: readers of the last two
    versions find theirs, and a run that dies in between leaves only parts that no reader takes."""
    merged.write.mode("overwrite").parquet(f"{base_folder}/v={last + 1:012d}")
    fs, p = _fs(spark, f"{parts_folder}/{level}epoch=*")
    for status in fs.globStatus(p) or []:
        if int(status.getPath().getName().split("=")[1]) < upto:
            fs.delete(status.getPath(), True)
    drop_old_versions(spark, base_folder, keep=2)


def compact_funnel(spark: SparkSession, sink_path: str) -> None:
    """Merge the partial rows of all batches so far into a new base version, so
    that a report reads one set of files however many batches there were. Run it between batches."""
    base, upto, parts = _base_and_parts(spark, f"{sink_path}_base", sink_path)
    last = parts.agg(F.max("epoch")).first()[0] if parts is not None else None
    if last is not None:
        _compact(spark, read_funnel(spark, sink_path), f"{sink_path}_base", sink_path, upto, last, "day=*/")


def read_funnel(spark: SparkSession, sink_path: str) -> DataFrame:
    """The C1 report of everything S1 has read so far."""
    base, _, rows = _base_and_parts(spark, f"{sink_path}_base", sink_path)
    columns = [*funnel.FUNNEL_DIM_NAMES, *funnel.FUNNEL_METRIC_ORDER]
    if rows is not None:
        rows = rows.withColumn("day", F.date_format("day", "yyyy-MM-dd")).select(*columns)
    if base:
        merged = spark.read.parquet(base).select(*columns)
        rows = merged if rows is None else merged.unionByName(rows)
    return rows.groupBy(*funnel.FUNNEL_DIM_NAMES).agg(*[F.sum(m).alias(m) for m in funnel.FUNNEL_METRIC_ORDER])


# ---------------------------------------------------------------- S2

class FirstSeen(StatefulProcessor):
    """The first days of a bucket's users, in a value state: a call to the state
    costs the same for a user as for hundreds, so a batch makes two for each bucket
    it touches. A batch gives a user's rows of its own days; if they hold an earlier
    day than the state, also the row of the day that was first before, which is new no more."""

    def init(self, handle):
        self.first = handle.getValueState("first", "days string")

    def handleInitialState(self, key, initialState, timerValues):
        self.first.update((initialState["days"],))

    def handleInputRows(self, key, rows, timerValues):
        seen = {}
        for r in rows:
            seen.setdefault(r["user"], (r, set()))[1].add(r["ymd"])
        known = self.first.get()
        firsts, changed = json.loads(known[0]) if known else {}, False
        for user, (r, days) in seen.items():
            old = firsts.get(user)
            first = min(days | {old} - {None})
            if first != old:
                firsts[user], changed = first, True
                days |= {old} - {None}
            for d in sorted(days):
                yield Row(**{k: r[k] for k in users.USER_KEYS}, is_new=int(d == first), ymd=d)
        if changed:
            self.first.update((json.dumps(firsts),))

    def close(self):
        pass


USER_BUCKETS = 1 << 13  # a checkpoint keeps to the number that it began with


def _in_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` with the key as one text (``user``) and its ``bucket``."""
    user = F.concat_ws(",", "publisher_id", "pub_app_id", F.length("country"), F.concat("country", "uid"))
    return rows.withColumn("user", user).withColumn("bucket", F.pmod(F.xxhash64("user"), F.lit(USER_BUCKETS)))


_USER_ROWS = "publisher_id int, pub_app_id int, country string, uid string, is_new int, ymd string"


def start_user_marking_stream(lr_stream: DataFrame, history_path: str, checkpoint: str,
                              trigger: dict | None = None, history: DataFrame | None = None):
    """Run S2; read it with ``read_user_history``. A batch reads the state of
    its own users' buckets and appends their rows alone (``changes/epoch=...``). A first
    start takes the first days of a stored C8 ``history`` as its state."""
    spark = lr_stream.sparkSession
    rows = (lr_stream.filter(F.col("serverTs").isNotNull() & F.col("publisherId").isNotNull() & F.col("pubAppId").isNotNull()
                             & F.col("country").isNotNull() & F.col("uid").isNotNull())
            .select(F.col("publisherId").alias("publisher_id"), F.col("pubAppId").alias("pub_app_id"), "country", "uid",
                    F.date_format("dt", "yyyyMMdd").alias("ymd")))
    known = None
    if history is not None:
        known = _in_buckets(history.filter(F.col("is_new") == 1).groupBy(*users.USER_KEYS).agg(F.min("ymd").alias("ymd"))) \
            .groupBy("bucket").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("user", "ymd")))).alias("days")) \
            .groupBy("bucket")
        if not _path_exists(spark, f"{history_path}/base"):
            history.select(*users.USER_KEYS, "is_new", "ymd").write.parquet(f"{history_path}/base/v={0:012d}")
    marked = _in_buckets(rows).groupBy("bucket").transformWithState(FirstSeen(), _USER_ROWS, "Append", "None", initialState=known)

    def sink(batch, epoch):
        write_slot(batch.withColumn("epoch", F.lit(epoch).cast("long")), f"{history_path}/changes", ["epoch"])

    with _conf(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
        w = marked.writeStream.option("checkpointLocation", checkpoint).outputMode("append").foreachBatch(sink)
        return w.trigger(**(trigger or {"availableNow": True})).start()


@contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    """A session setting for as long as a query takes to start (it keeps its own copy)."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def read_user_history(spark: SparkSession, path: str) -> DataFrame:
    """The marked users of everything S2 has read so far: of several rows of a
    key and day the last one counts."""
    base, _, rows = _base_and_parts(spark, f"{path}/base", f"{path}/changes", _USER_ROWS)
    if base:
        merged = spark.read.schema(_USER_ROWS).parquet(base).withColumn("epoch", F.lit(-1).cast("long"))
        rows = merged if rows is None else merged.unionByName(rows)
    return rows.groupBy(*users.USER_KEYS, "ymd").agg(F.max_by("is_new", "epoch").alias("is_new")) \
        .select(*users.USER_KEYS, "is_new", "ymd")


def compact_user_history(spark: SparkSession, path: str) -> None:
    """Merge the rows of all batches so far into a new base version. Run it
    between batches, as often as reads should stay cheap."""
    _, upto, rows = _base_and_parts(spark, f"{path}/base", f"{path}/changes", _USER_ROWS)
    last = rows.agg(F.max("epoch")).first()[0] if rows is not None else None
    if last is not None:
        _compact(spark, read_user_history(spark, path), f"{path}/base", f"{path}/changes", upto, last, "")


# ---------------------------------------------------------------- S3

def start_cap_stream(campaign_stream: DataFrame, snapshot_path: str, messages_path: str, checkpoint: str,
                     dcenters: list[int], day: _dt.date, trigger: dict | None = None):
    """Run S3: every batch of campaign rows is diffed against the newest
    version of the day's cap snapshot that is older than the batch; the change
    messages are stored under the batch id, and the snapshot with the batch's
    campaigns replaced by id becomes version ``epoch``. A campaign that no
    longer runs leaves the snapshot, so its next start is new again. Of
    several rows of a campaign in one batch the one with the largest cap
    counts. A seed of the day is a version named ``v=``."""
    def sink(batch, epoch):
        spark = batch.sparkSession
        part = f"{snapshot_path.rstrip('/')}/day={day:%Y-%m-%d}"
        version = f"v={epoch:012d}"
        found = newest_version(spark, part, below=version)
        prev = spark.read.parquet(found).select("id", "daily_cap") if found else None
        order = F.struct(F.col("daily_cap"), *[F.col(c) for c in batch.columns if c not in ("id", "daily_cap")])
        rows = batch.groupBy("id").agg(F.max(order).alias("_r")).select("id", "_r.*")
        delta = state.cap_delta(rows, prev)
        msgs = state.cap_messages(delta, dcenters).withColumn("epoch", F.lit(epoch))
        write_slot(msgs, messages_path, ["epoch"])
        snap = state.running_campaigns(rows).select("id", "daily_cap")
        if prev is not None:
            snap = prev.join(rows.select("id"), "id", "left_anti").unionByName(snap)
        snap.write.mode("overwrite").parquet(f"{part}/{version}")

    w = campaign_stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return w.trigger(**(trigger or {"availableNow": True})).start()
