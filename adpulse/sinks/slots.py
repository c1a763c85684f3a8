"""A table whose jobs replace a list of slots in one step.

Rows of a run are staged under a folder of their own,
``rows/run=<run>/<key>=<value>/...``; then the manifest - which run holds which
slot - is written as a new version directory. That one commit switches all slots
of the run: emptied slots are just not in the new manifest, and a reader sees all
of a run or nothing of it, also if the job dies at any point before. A dynamic
partition overwrite replaces slots one by one and can't express an empty one.

The manifest has a row per slot. Reading joins it to the partition columns of
the rows, which Spark turns into a list of folders before it scans any
(dynamic partition pruning). One writer at a time: of two that commit at once
the second fails on the version it finds and runs again.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .writers import _fs, newest_version


class SlotTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str]):
        """``schema`` of all columns, ``keys`` those that name a slot."""
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = schema
        self._key_schema = T.StructType([schema[k] for k in self.keys])
        self._manifest_schema = T.StructType([*self._key_schema.fields, T.StructField("run", T.StringType())])

    def manifest(self) -> DataFrame:
        """(keys, run) of the slots that have rows."""
        found = newest_version(self.spark, f"{self.path}/manifest")
        return self.spark.read.schema(self._manifest_schema).parquet(found) if found \
            else self.spark.createDataFrame([], self._manifest_schema)

    def commit(self, df: DataFrame, slots: list[dict]) -> str:
        """Replace ``slots`` (one dict of key values each) by the rows of
        ``df``; rows of other slots are refused and nothing is changed."""
        before = newest_version(self.spark, f"{self.path}/manifest")
        number = int(before.rsplit("=", 1)[1]) + 1 if before else 0
        run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        named = self.spark.createDataFrame([tuple(s[k] for k in self.keys) for s in slots], self._key_schema)
        staged = f"{self.path}/rows/run={run}"
        df.select(*self.schema.fieldNames()).hint("rebalance", *self.keys).write.partitionBy(*self.keys).parquet(staged)
        there = self._rows(f"{self.path}/rows").filter(F.col("run") == run).select(*self.keys).distinct()
        same = lambda other: [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.keys]  # noqa: E731, ARG005
        if there.alias("a").join(named.alias("b"), same(None), "left_anti").limit(1).count():
            fs, p = _fs(self.spark, staged)
            fs.delete(p, True)
            raise ValueError(f"rows outside the slots to be written: {slots}")
        kept = self.manifest().alias("a").join(named.alias("b"), same(None), "left_anti")
        kept.unionByName(there.withColumn("run", F.lit(run))).coalesce(1).write.mode("error") \
            .parquet(f"{self.path}/manifest/v={number:012d}")
        return run

    def _rows(self, folder: str) -> DataFrame:
        schema = T.StructType([*[f for f in self.schema.fields if f.name not in self.keys],
                               T.StructField("run", T.StringType()), *self._key_schema.fields])
        return self.spark.read.schema(schema).option("basePath", folder).parquet(folder)

    def read(self) -> DataFrame:
        """The rows of the newest commit."""
        if newest_version(self.spark, f"{self.path}/manifest") is None:
            return self.spark.createDataFrame([], self.schema)
        rows, held = self._rows(f"{self.path}/rows").alias("a"), self.manifest().alias("b")
        on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.keys] + [F.col("a.run") == F.col("b.run")]
        return rows.join(held, on, "left_semi").select(*self.schema.fieldNames())

    def drop_unused(self, older_than_seconds: float = 86_400) -> int:
        """Delete runs that no slot of the newest manifest names and that began
        longer ago than any reader or unfinished job may take; returns how many."""
        used = {r["run"] for r in self.manifest().select("run").distinct().collect()}  # one row a run
        fs, p = _fs(self.spark, f"{self.path}/rows")
        limit, gone = time.time_ns() - int(older_than_seconds * 1e9), 0
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if name.startswith("run=") and name[4:] not in used and int(name[4:24]) <= limit:
                gone += bool(fs.delete(status.getPath(), True))
        return gone
