"""The corpus pipeline: five stages over ``documents``, each written as
Parquet and reread before the next.

1. toxicity: documents scored toxic (0.5 or more) go;
2. near-dedup: of each near-duplicate component (five-word shingles, Jaccard
   0.8) the document with the smallest id stays;
3. decontaminate: documents that hold half or more of a benchmark item go;
4. secrets: every reported secret is replaced by a tag of its kind, ``n_chars``
   follows the text;
5. mix: documents are repeated or left out as the target weights ask.

Defined results: rows with a null id are scored, scanned and mixed like any
other but not compared for duplicates; of rows that repeat id and text one
stays; null texts stay null and take no words; extra columns are carried along,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adpulse.llm import blob_ledger, decontam, mixing, near_dedup, toxicity
from adpulse.llm.common import map_batches, stored, table


def _columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[f"`{c}`" for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=lambda i: ~toxicity.held_out(i))
    scored = toxicity.score(docs, scorer, keep=tuple(docs.columns), prefix="__tox_")
    return _columns(scored.where(F.col("__tox_score") < 0.5), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = docs.where(F.col("doc_id").isNotNull())
    groups = near_dedup.near_duplicates(named)
    first = stored(groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__id")).distinct(),
                   "first-of-group")
    kept = named.join(first, F.col("doc_id") == F.col("__id"), "left_semi")
    kept = kept.withColumn("__sha", F.sha2(F.coalesce("text", F.lit("")), 256)).dropDuplicates(["doc_id", "__sha"])
    return _columns(kept, docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns), out_col="__found")
    return _columns(found.where(F.size("__found") == 0), docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ledger = blob_ledger.new_ledger(spark)
    paths = blob_ledger.scan_versions(docs, ledger)
    found = stored(paths.where(F.size("spans") > 0).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
                   .dropDuplicates(["__blob"]), "findings")
    joined = docs.withColumn("__sha", F.sha2(F.coalesce("text", F.lit("")), 256)).join(
        found, F.col("__sha") == F.col("__blob"), "left")
    masked = map_batches(joined, ["text", "__spans"], docs.columns, T.StructType([T.StructField("__text", T.StringType())]),
                         lambda: lambda texts, spans: ((_masked(t, s),) for t, s in zip(texts, spans)))
    out = masked.withColumn("text", F.col("__text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__text").isNull(), F.col("n_chars"))
                             .otherwise(F.char_length("__text")).cast(docs.schema["n_chars"].dataType))
    return _columns(out, docs.columns)


def _masked(text, spans):
    return blob_ledger.mask(text, [(s["kind"], s["start"], s["end"]) for s in spans] if spans else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents and ``copy``, from 1 to the document's copies
    (``copy_2`` or the next free number where documents have that name)."""
    used = ["doc_id", "text", "source"]
    names = {c: c if c in used else f"__in_{i}" for i, c in enumerate(docs.columns)}
    mixed = mixing.mix(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])).where("copies > 0")
    taken, copy, i = {c.lower() for c in docs.columns}, "copy", 1
    while copy in taken:
        i += 1
        copy = f"copy_{i}"
    return mixed.select(*[F.col(n).alias(c) for c, n in names.items()],
                        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]

# Viterbi decoding, sketches and Newton steps are not expressible in SQL: tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
