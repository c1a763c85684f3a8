"""Scans of hourly logs, cost dumps and history tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

# Path layouts of an hourly log table under its root.
PLAIN = "plain"   # <root>/<table>/YYYY/MM/DD/HH/...   (the reference's layout)
HIVE = "hive"     # <root>/<table>/y=YYYY/m=MM/d=DD/h=HH/...


def hours(begin: _dt.datetime, end: _dt.datetime) -> list[_dt.datetime]:
    """Hour slots of the half-open range ``[begin, end)``."""
    out, t = [], begin.replace(minute=0, second=0, microsecond=0)
    while t < end:
        out.append(t)
        t += _dt.timedelta(hours=1)
    return out


def slot_path(root: str, table: str, slot: _dt.datetime, layout: str = PLAIN) -> str:
    if layout == PLAIN:
        return f"{root.rstrip('/')}/{table}/{slot:%Y/%m/%d/%H}"
    return f"{root.rstrip('/')}/{table}/y={slot:%Y}/m={slot:%m}/d={slot:%d}/h={slot:%H}"


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Keep the paths that exist: one listing per parent folder (a day of
    hour slots) through the Hadoop file system of the path, so it works for
    any store Spark reads."""
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    there = {}
    for parent in dict.fromkeys(p.rsplit("/", 1)[0] for p in paths):
        jp = jvm.org.apache.hadoop.fs.Path(f"{parent}/*")
        found = jp.getFileSystem(conf).globStatus(jp) or []
        there[parent] = {status.getPath().getName() for status in found}
    return [p for p in paths if p.rsplit("/", 1)[1] in there[p.rsplit("/", 1)[0]]]


def with_slot_columns(df: DataFrame, path_col: F.Column, layout: str = PLAIN) -> DataFrame:
    """Add the partition columns y, m, d (text), dt (date) and h (int) taken
    from the file path (the plain layout is not Hive-style, so Spark's
    partition discovery cannot see them)."""
    # one split of the path per row: .../<y>/<m>/<d>/<h>/<file>
    parts = F.split(path_col, "/")
    y, m, d, h = (F.element_at(parts, i) for i in (-5, -4, -3, -2))
    if layout == HIVE:
        y, m, d, h = (F.substring_index(c, "=", -1) for c in (y, m, d, h))
    return df.withColumns({"y": y, "m": m, "d": d,
                           "dt": F.to_date(F.concat(y, m, d), "yyyyMMdd"), "h": h.cast("int")})


def scan_log(spark: SparkSession, root: str, table: str, begin: _dt.datetime, end: _dt.datetime,
             layout: str = PLAIN, schema: T.StructType | None = None) -> DataFrame:
    """A1: read the hourly JSON slots ``[begin, end)`` of a log table with
    its fixed schema. Malformed lines become all-NULL rows (PERMISSIVE), which
    the reports drop through their ``serverTs``/``ts`` filters. Only the
    slots' directories are listed, so the scan never touches other hours."""
    schema = schema or schemas.LOG_SCHEMAS[table]
    paths = existing_paths(spark, [slot_path(root, table, s, layout) for s in hours(begin, end)])
    if not paths:
        return spark.createDataFrame([], schema).withColumns({
            "y": F.lit(None).cast("string"), "m": F.lit(None).cast("string"), "d": F.lit(None).cast("string"),
            "dt": F.lit(None).cast("date"), "h": F.lit(None).cast("int")})
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(paths)
    return with_slot_columns(df.withColumn("_path", F.col("_metadata.file_path")), F.col("_path"), layout).drop("_path")


def register_partition(spark: SparkSession, table: str, slot: _dt.datetime, location: str,
                       hourly: bool = True, more: dict[str, int] | None = None) -> None:
    """A2: idempotently register one slot of a catalog table partitioned by
    y/m/d[/h] (``ADD IF NOT EXISTS`` makes reruns harmless), and by ``more``
    keys where a slot has several parts."""
    spec = f"y='{slot:%Y}', m='{slot:%m}', d='{slot:%d}'" + (f", h='{slot:%H}'" if hourly else "")
    spec += "".join(f", {k}={v}" for k, v in (more or {}).items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{location}'")


def scan_stat_adnetwork(spark: SparkSession, path: str, day: _dt.date | None = None) -> DataFrame:
    """A3: the daily network cost dump: ``\\u0001``-separated text with a
    trailing separator and NULLs written as the text ``null`` (W10). The
    extra trailing field is read into a throw-away column."""
    schema = T.StructType(list(schemas.STAT_ADNETWORK.fields) + [T.StructField("_trailing", T.StringType())])
    df = (spark.read.schema(schema).option("sep", "\u0001").option("nullValue", "null")
          .option("mode", "PERMISSIVE").csv(path).drop("_trailing"))
    return df if day is None else df.withColumn("dt", F.lit(day))


def scan_adnetwork(spark: SparkSession, path: str) -> DataFrame:
    """A4: the ad-network dimension dump (same text format as A3)."""
    schema = T.StructType(list(schemas.OM_ADNETWORK.fields) + [T.StructField("_trailing", T.StringType())])
    return (spark.read.schema(schema).option("sep", "\u0001").option("nullValue", "null").csv(path)
            .drop("_trailing"))


def scan_publisher_user(spark: SparkSession, path: str, begin: _dt.date, end: _dt.date) -> DataFrame:
    """A5: history rows of ``[begin, end]`` from a table partitioned by
    ``ymd`` (the range filter on the partition column prunes directories)."""
    df = spark.read.schema(schemas.PUBLISHER_USER).parquet(path)
    return df.filter((F.col("ymd") >= f"{begin:%Y%m%d}") & (F.col("ymd") <= f"{end:%Y%m%d}"))


def scan_jdbc(spark: SparkSession, url: str, query: str, fetchsize: int = 10000, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A JDBC read with a 10 000-row fetch size; with a partition column
    the read is split into ``num_partitions`` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions))
    else:
        r = r.option("query", query)
    return r.load()


def backfill(job, begin, end, **inputs) -> DataFrame:
    """Recompute a whole range in ONE set-oriented run: the jobs group
    by day (and hour), so a range is just a wider filter, not a loop."""
    return job(begin_day=begin, end_day=end, **inputs)
