"""Sinks (B1-B9). Every write is idempotent per slot or version, so a rerun
(or a retried task after a lost executor) never duplicates rows."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def write_slot(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet", slots: list[dict] | None = None) -> None:
    """B1: replace slots of a table partitioned by ``keys``.

    Without ``slots`` the partitions present in ``df`` are replaced (dynamic
    partition overwrite; other slots are untouched). A scheduled job passes the
    ``slots`` it computed (one dict of key values each): rows of other slots
    are refused, and a slot that has no rows any more is cleared, as the
    reference's delete-then-load does. ``keys`` must be what the job is sliced
    by (the partition slot), not the event time of its rows."""
    if slots is not None:
        named = df.sparkSession.createDataFrame([tuple(s[k] for k in keys) for s in slots],
                                                ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys))
        there = df.select(*keys).distinct()
        if there.join(named, keys, "left_anti").limit(1).count():
            raise ValueError(f"rows outside the slots to be written: {slots}")
        emptied = [r.asDict() for r in named.join(there, keys, "left_anti").collect()]
    # rebalance (not repartition): rows are clustered by slot so each slot
    # gets few files, but AQE splits a hot slot over several tasks and
    # coalesces small ones, so one big day is never written by one task
    (df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).format(fmt).save(path))
    if slots is not None:
        for slot in emptied:
            fs, p = _fs(df.sparkSession, "/".join([path.rstrip("/"), *(f"{k}={slot[k]}" for k in keys)]))
            if fs.exists(p):
                fs.delete(p, True)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batchsize: int = 1000, replace: str | None = None) -> None:
    """B2: load a JDBC report table in batches of 1 000 rows. ``replace`` is
    the SQL condition of the slot the rows belong to; its rows are deleted
    first, so a rerun replaces them (without it the rows are appended)."""
    if replace:
        jvm = df.sparkSession.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in (properties or {}).items():
            props.setProperty(k, str(v))
        conn = jvm.java.sql.DriverManager.getConnection(url, props)
        try:
            conn.createStatement().executeUpdate(f"DELETE FROM {table} WHERE {replace}")
        finally:
            conn.close()
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batchsize)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("append").save()


def write_csv_dir(df: DataFrame, path: str, header: bool = False) -> None:
    """Overwrite a directory with CSV part files."""
    df.write.mode("overwrite").option("header", header).csv(path)


def _new_version(folder: str) -> str:
    return f"{folder.rstrip('/')}/v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_per_app(df: DataFrame, path: str, app_col: str = "pub_app_id") -> str:
    """One gzip-compressed CSV directory per app (``<app_col>=<id>``),
    written by a real CSV writer (quoting intact, W22). Every run is a version
    directory of its own, so an app that left has no file in the newest one;
    returns its path (``read_per_app`` finds it)."""
    target = _new_version(path)
    (df.hint("rebalance", app_col).write.mode("error").option("compression", "gzip").option("header", True)
     .partitionBy(app_col).csv(target))
    return target


def read_per_app(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest run of B4; ``schema`` names the app column last."""
    found = newest_version(spark, path)
    if found is None:
        raise FileNotFoundError(f"no run under {path}")
    return spark.read.schema(schema).option("header", True).csv(found)


def publish_snapshot(spark: SparkSession, df: DataFrame, root: str, name: str) -> str:
    """Write a snapshot as a new version directory. Spark commits it with
    its success marker; readers take the newest version that has the marker,
    so at any moment they see one whole version and never none."""
    target = _new_version(f"{root.rstrip('/')}/{name}")
    df.write.mode("error").option("compression", "gzip").json(target)
    return target


def drop_old_versions(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Delete all but the ``keep`` newest complete versions of ``folder`` and
    the incomplete ones older than those; returns how many went. Keep as many
    as the slowest reader may still be reading."""
    newest = newest_version(spark, folder)
    oldest_kept = newest
    for _ in range(max(1, keep) - 1):
        older = oldest_kept and newest_version(spark, folder, below=oldest_kept.rsplit("/", 1)[1])
        oldest_kept = older or oldest_kept
    if oldest_kept is None:
        return 0
    fs, p = _fs(spark, folder)
    gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("v=")
            and s.getPath().getName() < oldest_kept.rsplit("/", 1)[1]]
    for path in gone:
        fs.delete(path, True)
    return len(gone)


def newest_version(spark: SparkSession, folder: str, below: str | None = None) -> str | None:
    """The newest complete ``v=...`` directory of ``folder`` (names sort by
    age), of those whose name is less than ``below``."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    for v in sorted((n for n in names if n.startswith("v=") and (below is None or n < below)), reverse=True):
        if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{v}/_SUCCESS")):
            return f"{folder.rstrip('/')}/{v}"
    return None


def read_snapshot(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    """Read the newest complete version."""
    path = newest_version(spark, f"{root.rstrip('/')}/{name}")
    if path is None:
        raise FileNotFoundError(f"no published version of {name} under {root}")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def replace_keys(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed replace - rows of ``existing`` whose key is re-delivered are
    dropped (left anti join), the incoming rows are added."""
    return existing.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A rendered custom report as CSV with its title row: part files in
    the frame's order, written by as many tasks as the report has partitions
    (one file for a small report, which AQE has coalesced already)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def cost_dump_lines(df: DataFrame, cols: list[str]) -> DataFrame:
    """Render rows the way the reference dumps costs: ``\\u0001``-joined,
    NULL as ``null``, with a trailing separator (W10)."""
    return df.select(F.concat(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("null"))
                                                      for c in cols]), F.lit("\u0001")).alias("value"))


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int,
                   partition_by: list[str], slots: list[dict] | None = None) -> None:
    """Store a large keyed table (e.g. the publisher-user history of C8) as
    an external catalog table bucketed and sorted by ``keys``. Joins on those
    keys then read it without a shuffle (only the small side is exchanged),
    which removes the largest shuffle of the daily new-user marking. Use at
    least as many buckets as the joining job's shuffle partitions: with fewer,
    Spark re-shuffles the bucketed side to match the other side.

    The ``partition_by`` values present in ``df`` are replaced, so a rerun of
    a day leaves one copy. A job names the ``slots`` it computed; those without
    rows any more leave the table and its folder. Rows are dealt to their buckets first: a partition
    has one file per bucket, however many tasks wrote it."""
    spark = df.sparkSession
    out = df.repartition(buckets, *keys)
    if not spark.catalog.tableExists(table):
        (out.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
         .partitionBy(*partition_by).saveAsTable(table))
    else:
        (out.select(*spark.table(table).columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .insertInto(table))
    if slots is not None:
        there = {tuple(str(r[k]) for k in partition_by) for r in df.select(*partition_by).distinct().collect()}  # one row a slot
        for slot in slots:
            if tuple(str(slot[k]) for k in partition_by) not in there:
                spec = ", ".join(f"`{k}` = '{slot[k]}'" for k in partition_by)
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
                fs, p = _fs(spark, "/".join([path.rstrip("/"), *(f"{k}={slot[k]}" for k in partition_by)]))
                fs.delete(p, True)


def sync_costs(costs: DataFrame, path: str, day) -> None:
    """H5: copy one day of network costs (read from JDBC or a dump with the
    A3/A6 scans) into the lake, replacing exactly that day's partition; a day
    without costs any more is cleared."""
    sync_cost_days(costs.withColumn("day", F.lit(day).cast("date")), path, [day])


def sync_cost_days(costs: DataFrame, path: str, days: list) -> None:
    """H5 for several days at once: ``costs`` has a ``day`` column and no rows
    of other days; every day of ``days`` is replaced or cleared."""
    write_slot(costs, path, ["day"], slots=[{"day": d} for d in days])


def sync_dimension(dim: DataFrame, path: str) -> None:
    """H5: replace a small dimension copy (e.g. the network table) whole."""
    dim.write.mode("overwrite").parquet(path)
