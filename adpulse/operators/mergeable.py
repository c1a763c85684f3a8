"""User counts that merge (C3-C7c): stored distinct sets per hourly slot.

A distinct count can't be added up, so the reference counts a day from the whole
day's log. Here an hour's job stores, per report group, the set of the values it
saw; the union of the slots of a day (or a month) gives its counts, and every log
row is read once.

* Exact: values get dense numbers from a dictionary that only grows; a set is
  a row of 4 KB bitmaps (``bitmap_construct_agg``), one per 32,768 numbers that
  occur; the union is ``bitmap_or_agg``. Recent users have neighbouring
  numbers, so a group's set lies in few bitmaps, and zeros compress away.
* Approximate: HLL sketches (``hll_sketch_agg``, ``hll_union_agg``) of a fixed
  size, without a dictionary, for groups so small and many that bitmaps don't pay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks.writers import _fs, write_slot
from .funnel import SLOT_NAMES, slot_columns
from .users import USER_BASE_DIMS, USER_DIM_SETS, _EXTRA_DIMS, _base_dims

# counted sets of a report: name, value of a log row
COUNTS = {"ip_count": "ip", "did_count": "did", "dau": "uid", "deu": "CASE WHEN type = 6 THEN uid ELSE '' END"}
_DOMAIN = {"ip_count": "ip", "did_count": "did", "dau": "uid", "deu": "uid", "": ""}  # whose dictionary a set uses
_PRESENT = ""  # the set that only says that a group has rows


def _exploded(lr: DataFrame, dims: str) -> DataFrame:
    """(slot, dims, kind, value): one row for each set that a log row belongs to."""
    extra = [F.coalesce(_EXTRA_DIMS[d], F.lit(0)).alias(d) for d in USER_DIM_SETS[dims]]
    sets = F.array(*[F.struct(F.lit(k).alias("kind"), F.expr(v).alias("value")) for k, v in COUNTS.items()],
                   F.struct(F.lit(_PRESENT).alias("kind"), F.lit("").alias("value")))
    rows = lr.filter(F.col("serverTs").isNotNull()).select(*slot_columns(), *_base_dims(), *extra, F.explode(sets).alias("_s"))
    return rows.select(*[c for c in rows.columns if c != "_s"], "_s.kind", "_s.value").filter(F.col("value").isNotNull())


def group_columns(dims: str) -> list[str]:
    return [*USER_BASE_DIMS, *USER_DIM_SETS[dims]]


class Dictionary:
    """Numbers of values, by domain: dense from 0, never changed once given.
    A run appends the values it met first; one run at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        schema = "domain string, value string, id long"
        fs, p = _fs(self.spark, f"{self.path}/numbers")
        return self.spark.read.schema(schema).parquet(f"{self.path}/numbers") if fs.exists(p) else self.spark.createDataFrame([], schema)

    def extend(self, values: DataFrame) -> None:
        """Number the values of ``values`` (domain, value) that have none."""
        new = values.distinct().join(self.read(), ["domain", "value"], "left_anti")
        staged = f"{self.path}/staged"
        new.withColumn("_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(staged)
        new = self.spark.read.parquet(staged).withColumn("_part", F.shiftright("_at", 33))
        # where the numbers of a domain and writing task begin: one row each
        last = {r["domain"]: r["id"] + 1 for r in self.read().groupBy("domain").agg(F.max("id").alias("id")).collect()}
        starts = []
        for r in sorted(new.groupBy("domain", "_part").agg(F.count("*").alias("n")).collect(), key=lambda r: (r["domain"], r["_part"])):
            starts.append((r["domain"], r["_part"], last.get(r["domain"], 0)))
            last[r["domain"]] = last.get(r["domain"], 0) + r["n"]
        if starts:
            begin = F.broadcast(self.spark.createDataFrame(starts, "domain string, _part long, _start long"))
            place = F.row_number().over(Window.partitionBy("domain", "_part").orderBy("_at"))  # what one task wrote
            numbered = new.join(begin, ["domain", "_part"]).select(
                "domain", "value", (F.col("_start") + place - 1).cast("long").alias("id"))
            numbered.write.mode("append").parquet(f"{self.path}/numbers")


def slot_bitmaps(lr: DataFrame, dictionary: Dictionary, dims: str = "base") -> DataFrame:
    """The sets of each slot and group of ``lr`` as bitmaps: SLOT_NAMES,
    dimensions, kind, bucket, bits. Values without a number get one."""
    rows = _exploded(lr, dims).distinct()
    domain = F.create_map(*[F.lit(x) for kv in _DOMAIN.items() for x in kv])[F.col("kind")]
    rows = rows.withColumn("domain", domain)
    dictionary.extend(rows.select("domain", "value"))
    numbered = rows.join(dictionary.read(), ["domain", "value"])
    return numbered.groupBy(*SLOT_NAMES, *group_columns(dims), "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def _counted(sizes: DataFrame, group: list[str]) -> DataFrame:
    """One row per group from its set sizes (group, kind, n); ``deu`` as the
    reference counts it, one less than its set."""
    count = lambda k: F.coalesce(F.max(F.when(F.col("kind") == k, F.col("n"))), F.lit(0))
    return sizes.groupBy(*group).agg(*[(count(k) - (1 if k == "deu" else 0)).cast("bigint").alias(k) for k in COUNTS])


def merge_bitmaps(stored: DataFrame, group: list[str]) -> DataFrame:
    """Exact counts by ``group`` (any of the stored dimensions) of all slots of ``stored``."""
    union = stored.groupBy(*group, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return _counted(union.groupBy(*group, "kind").agg(F.sum(F.bitmap_count("bits")).alias("n")), group)


def slot_sketches(lr: DataFrame, dims: str = "base", lg_k: int = 12) -> DataFrame:
    """The sets of each slot and group as HLL sketches: SLOT_NAMES, dimensions, kind, sketch."""
    return _exploded(lr, dims).groupBy(*SLOT_NAMES, *group_columns(dims), "kind").agg(
        F.hll_sketch_agg("value", lg_k).alias("sketch"))


def merge_sketches(stored: DataFrame, group: list[str]) -> DataFrame:
    """Estimated counts by ``group`` of all slots of ``stored``."""
    union = stored.groupBy(*group, "kind").agg(F.hll_union_agg("sketch").alias("sketch"))
    return _counted(union.select(*group, "kind", F.hll_sketch_estimate("sketch").alias("n")), group)


def store_slots(sets: DataFrame, path: str, slots: list[dict]) -> None:
    """Replace the sets of ``slots`` (dicts of SLOT_NAMES)."""
    write_slot(sets, path, SLOT_NAMES, slots=slots)
