"""Common snapshots (G22-G25) and dictionary path resolution."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sinks.writers import _fs


def dict_table(d: DataFrame) -> DataFrame:
    """The dictionary rows as they are."""
    return d.select("id", "pid", "name", "value")


def dict_paths(d: DataFrame) -> DataFrame:
    """Every dictionary node with its path ``/root/child/...`` (roots
    have pid 0), by pointer doubling: a node knows the path from below some
    ancestor, and a round puts that ancestor's own piece in front, so pieces
    double and a depth of a thousand takes ten rounds. Every round is one join
    and one stored table, of which the last stays. Nodes whose ancestors end in
    an id that does not exist, or in a circle that no root leads to, have no
    path; a circle below a root is an error."""
    spark = d.sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/dict-{uuid.uuid4().hex}"

    def stored(df: DataFrame, n: int) -> DataFrame:
        df.write.parquet(f"{root}/{n}")
        return spark.read.schema(df.schema).parquet(f"{root}/{n}")

    rows = stored(d.select("id", F.col("pid").alias("_up"), F.concat(F.lit("/"), "name").alias("path"), "value"), 0)
    most = rows.count().bit_length() + 1
    for n in range(1, most + 2):
        rising = rows.filter(F.col("_up") != 0)
        if rising.isEmpty():
            break
        if n > most:  # more steps up than there are nodes: these walk in a circle, below an ancestor that has a path or not
            reached = rows.filter(F.col("_up") == 0).select(F.col("id").alias("_up"))
            if not rising.join(reached, "_up", "left_semi").isEmpty():
                raise ValueError("the dictionary's parent ids form a circle")
            break
        above = rows.select(F.col("id").alias("_up"), F.col("_up").alias("_next"), F.col("path").alias("_head"))
        risen = rising.join(above, "_up").select("id", F.col("_next").alias("_up"), F.concat("_head", "path").alias("path"), "value")
        rows = stored(rows.filter(F.col("_up") == 0).unionByName(risen), n)
        fs, p = _fs(spark, f"{root}/{n - 1}")
        fs.delete(p, True)
    return rows.filter(F.col("_up") == 0).select("id", "path", "value")


def dict_lookup(paths: DataFrame, kind: str = "string", default=None) -> DataFrame:
    """Typed value per path with a default when the text does not parse."""
    v = F.col("value") if kind == "string" else F.col("value").try_cast(kind)
    if default is not None:
        v = F.coalesce(v, F.lit(default).cast(kind))
    return paths.select("path", v.alias("value"))


def dict_children(d: DataFrame, paths: DataFrame) -> DataFrame:
    """Child values of each path (in id order)."""
    kids = d.select(F.col("pid").alias("id"), F.struct(F.col("id").alias("cid"), "value").alias("c"))
    g = kids.groupBy("id").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    out = paths.join(g, "id", "left")
    return out.select("path", F.coalesce(F.transform("cs", lambda c: c["value"]),
                                         F.array().cast("array<string>")).alias("children"))


def country(countries: DataFrame) -> DataFrame:
    """Country projection."""
    return countries.select("a2", "a3", "tz", "dcenter")


def currency(rates: DataFrame) -> DataFrame:
    """Currency rate projection."""
    return rates.select("cur_from", "cur_to", "exchange_rate")
