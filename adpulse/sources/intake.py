"""Incremental intake of log slots with a quarantine (A1, A2).

The hourly batch scan (``logs.scan_log``) reads a slot once and drops what it
can't parse. Here a file stream finds the files that are new since the last run,
whichever slot they lie in, so a slot that grows after it was read is read on;
well-formed rows go to Parquet slots that are registered in the catalog,
malformed lines are kept as text with their file, by slot. A batch's output is stored
under its id, so a replayed batch replaces it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..sinks.writers import write_slot
from . import logs

BAD_LINE = "_bad_line"


def slot_keys(hourly: bool) -> list[str]:
    return ["y", "m", "d"] + (["h"] if hourly else [])


def _with_slot(df: DataFrame, path: F.Column, layout: str, hourly: bool) -> DataFrame:
    """The slot of a file: the last folders of its path."""
    parts, keys = F.split(path, "/"), slot_keys(hourly)
    values = {k: F.element_at(parts, -1 - len(keys) + i) for i, k in enumerate(keys)}
    return df.withColumns({k: F.substring_index(v, "=", -1) if layout == logs.HIVE else v for k, v in values.items()})


def create_log_table(spark: SparkSession, name: str, lake: str, schema: T.StructType, hourly: bool = True) -> None:
    """The catalog table of the well-formed rows; its partitions are registered by the intake."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = slot_keys(hourly)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {', '.join(f'{k} string' for k in keys)}, batch bigint) "
              f"USING parquet PARTITIONED BY ({', '.join(keys)}, batch) LOCATION '{lake}/rows'")


def start_intake(spark: SparkSession, root: str, table: str, lake: str, checkpoint: str, catalog_table: str | None = None,
                 layout: str = logs.PLAIN, hourly: bool = True, schema: T.StructType | None = None,
                 files_per_batch: int = 10_000, trigger: dict | None = None):
    """Take in every file of ``<root>/<table>`` that no earlier run with this
    ``checkpoint`` has taken in. Rows go to ``<lake>/rows``, malformed lines to
    ``<lake>/quarantine``. Returns the StreamingQuery."""
    schema = schema or schemas.LOG_SCHEMAS[table]
    keys = slot_keys(hourly)
    if catalog_table:
        create_log_table(spark, catalog_table, lake, schema, hourly)
    read = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    lines = (spark.readStream.schema(read).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
             .option("maxFilesPerTrigger", files_per_batch).json(f"{root.rstrip('/')}/{table}/{'/'.join('*' for _ in keys)}")
             .withColumn("file", F.col("_metadata.file_path")))

    def sink(batch, epoch):
        batch = _with_slot(batch.withColumn("batch", F.lit(epoch).cast("long")), F.col("file"), layout, hourly).persist()
        try:
            good = batch.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE, "file")
            write_slot(good, f"{lake}/rows", [*keys, "batch"])
            bad = batch.filter(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"), "file", *keys, "batch")
            write_slot(bad, f"{lake}/quarantine", [*keys, "batch"])
            if catalog_table:
                for r in good.select(*keys).distinct().collect():  # the slots of one batch
                    slot = _dt.datetime(int(r["y"]), int(r["m"]), int(r["d"]), int(r["h"]) if hourly else 0)
                    folder = "/".join(f"{k}={r[k]}" for k in keys)
                    logs.register_partition(batch.sparkSession, catalog_table, slot, f"{lake}/rows/{folder}/batch={epoch}", hourly,
                                            {"batch": epoch})
        finally:
            batch.unpersist()

    w = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def quarantine_counts(spark: SparkSession, lake: str, hourly: bool = True) -> DataFrame:
    """Malformed lines by slot (y, m, d[, h], lines)."""
    keys = slot_keys(hourly)
    schema = ", ".join(["line string", "file string", *[f"{k} string" for k in keys], "batch long"])
    return spark.read.schema(schema).parquet(f"{lake}/quarantine").groupBy(*keys).agg(F.count("*").alias("lines"))
