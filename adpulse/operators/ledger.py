"""Change-driven restatement (C12, A7, H5): a ledger of input digests.

The reference restates the last three days on a timer, whether or not anything
came late. Here a digest of every (table, day) of the inputs is kept; the days
whose digest differs from the ledger's, which are new in the input or have gone
from it are recomputed, all in one job, and only their slots are written.

A digest is a row count and two order-independent sums over row hashes, one
aggregation with a map-side combine. For hourly log folders ``file_digests``
takes paths, lengths and modification times instead, so that no log is read to
find out that it is unchanged.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import drop_old_versions, newest_version, write_slot, _new_version

SCHEMA = "input string, day date, n long, total decimal(38,0), mixed long"


def day_digests(df: DataFrame, name: str, day_col: str = "dt") -> DataFrame:
    """(input, day, n, total, mixed) of the rows of ``df`` by day; equal rows count as often as they stand."""
    columns = sorted(c for c in df.columns if c != day_col)
    # hash functions pass over NULLs: whether a value is NULL is hashed beside it
    values = [v for c in columns for v in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return _digested(df.select(F.col(f"`{day_col}`").cast("date").alias("day"), F.xxhash64(*values).alias("_h")), name)


def file_digests(spark: SparkSession, folder: str, name: str, day_of_path: Callable) -> DataFrame:
    """The same of the files under ``folder``; ``day_of_path`` turns the path
    column into the day a file belongs to. Only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    day = day_of_path(F.col("path")).cast("date").alias("day")
    return _digested(files.select(day, F.xxhash64("path", "length", "modificationTime").alias("_h")), name)


def _digested(hashes: DataFrame, name: str) -> DataFrame:
    return hashes.groupBy("day").agg(
        F.count("*").alias("n"), F.sum(F.col("_h").cast("decimal(38,0)")).cast("decimal(38,0)").alias("total"),
        F.bit_xor(F.xxhash64("_h", F.lit(1))).alias("mixed")).select(F.lit(name).alias("input"), "day", "n", "total", "mixed")


class InputLedger:
    """The digests that results were last computed from; a version directory
    per record, of which readers take the newest that Spark has committed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        found = newest_version(self.spark, self.path)
        return self.spark.read.schema(SCHEMA).parquet(found) if found else self.spark.createDataFrame([], SCHEMA)

    def changes(self, current: DataFrame) -> DataFrame:
        """(input, day, change: new, changed or gone) of ``current`` against the ledger, for the inputs it names."""
        known, now = self.read().alias("k"), current.alias("c")
        inputs = current.select("input").distinct()
        known = self.read().join(inputs, "input", "left_semi").alias("k")
        both = known.join(now, (F.col("k.input") == F.col("c.input")) & F.col("k.day").eqNullSafe(F.col("c.day")), "full_outer")
        same = (F.col("k.n") == F.col("c.n")) & (F.col("k.total") == F.col("c.total")) & (F.col("k.mixed") == F.col("c.mixed"))
        change = F.when(F.col("k.input").isNull(), "new").when(F.col("c.input").isNull(), "gone").when(~same, "changed")
        return both.select(F.coalesce("k.input", "c.input").alias("input"), F.coalesce("k.day", "c.day").alias("day"),
                           change.alias("change")).filter(F.col("change").isNotNull())

    def record(self, current: DataFrame) -> None:
        """Replace the ledger's rows of the inputs that ``current`` names."""
        rest = self.read().join(current.select("input").distinct(), "input", "left_anti")
        rest.unionByName(current).write.mode("error").parquet(_new_version(self.path))
        drop_old_versions(self.spark, self.path, keep=2)


def restate_changed(ledger: InputLedger, inputs: dict[str, DataFrame], job: Callable[..., DataFrame], path: str,
                    day_col: str = "dt", reach: int = 0, digests: dict[str, DataFrame] | None = None, **fixed) -> list[_dt.date]:
    """Recompute and store the days of which an input has changed; returns them.

    ``inputs`` are the job's frames by argument name, each with a day column;
    ``fixed`` are its arguments without days. ``job`` gets the inputs cut to the
    days it needs and gives rows with a ``day``, the slot they are stored under.
    ``reach`` is for results that look back: a changed day then restates the
    ``reach`` days after it as well, and the job gets their inputs whole. Slots
    that have no rows any more are cleared. The ledger is written last: a run
    that dies finds the same days changed again. The number of days, not of
    rows, goes through the driver."""
    current = None
    for name, df in inputs.items():
        d = (digests or {}).get(name)
        d = day_digests(df, name, day_col) if d is None else d
        current = d if current is None else current.unionByName(d)
    stamp = _new_version(f"{ledger.path.rstrip('/')}-seen")
    current.write.parquet(stamp)  # what is compared now is what is recorded below
    current = ledger.spark.read.schema(SCHEMA).parquet(stamp)
    first = sorted({r["day"] for r in ledger.changes(current).select("day").distinct().collect() if r["day"] is not None})
    days = sorted({d + _dt.timedelta(days=i) for d in first for i in range(reach + 1)})
    if days:
        needed = sorted({d - _dt.timedelta(days=i) for d in days for i in range(reach + 1)})
        cut = {name: df.filter(F.col(day_col).cast("date").isin(needed)) for name, df in inputs.items()}
        out = job(**cut, **fixed).withColumn("day", F.to_date("day")).filter(F.col("day").isin(days))
        write_slot(out, path, ["day"], slots=[{"day": d} for d in days])
    ledger.record(current)
    return days
