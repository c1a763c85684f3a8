"""Shared helpers of the text operators.

Conventions every operator of this subpackage keeps:

* an operator selects the columns it names before it does anything else, so
  extra columns (also ones named like its results) never clash;
* a null text is an empty text, a null in a pass-through column stays null;
* intermediate tables go to the folder named in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# White space of the word definition [^\x20\x09-\x0D]+ (fixed values).
SPACES = " \t\n\x0b\x0c\r"
SLICE = 500  # rows that a map decodes at once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the session's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session; only a local session
    that names none gets a private folder (tests). The folder of one
    application is removed when its Python process ends normally.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile
        base = tempfile.mkdtemp(prefix="run-llm-", dir="/tmp")
        sc.setCheckpointDir(base)
    root = f"{base.rstrip('/')}/llm-{sc.applicationId}"
    if root not in _roots:
        _roots.add(root)
        atexit.register(_drop_quietly, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


_roots: set[str] = set()


def _drop_quietly(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # the session has ended: its owner clears the shared folder
        pass


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Stored:
    """A DataFrame written to the shared folder and read back: it cuts
    lineage, survives lost executors and can be dropped by ``drop()``."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = scratch(self.spark, name)
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        df.write.parquet(self.path)

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        drop_path(self.spark, self.path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    return Stored(df, name).df


def map_batches(df: DataFrame, inputs: list[str], keep: list[str], out: T.StructType,
                start: Callable[[], Callable[..., Iterable[tuple]]], prefix: str = "") -> DataFrame:
    """Narrow map over Arrow batches.

    ``start()`` runs once per task and returns a function that takes one list
    per column of ``inputs`` and returns one tuple per row, in row order, with
    the columns of ``out``. The ``keep`` columns pass through untouched; one
    named like a result column gives way to the result. ``prefix`` is put before
    the result columns' names, for callers that keep columns they don't know.
    """
    out = T.StructType([T.StructField(prefix + f.name, f.dataType) for f in out.fields])
    names = {f.name.lower() for f in out.fields}
    keep = [c for c in keep if c.lower() not in names]
    cols = list(dict.fromkeys(keep + inputs))
    src = df.select(*[f"`{c}`" for c in cols])
    fields = [T.StructField(src.schema[c].name, src.schema[c].dataType, True) for c in keep]
    schema = T.StructType(fields + list(out.fields))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        fn = start()
        # a slice at a time: decoded texts of SLICE rows are all a task holds beside the Arrow batch
        for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            rows = list(fn(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs]))
            cols_out = list(zip(*rows))
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            arrays = [a if a.type == arrow.field(i).type else a.cast(arrow.field(i).type)
                      for i, a in enumerate(arrays)]
            arrays += [pa.array(list(v), type=arrow.field(len(keep) + i).type) for i, v in enumerate(cols_out)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return src.mapInArrow(run, schema)
