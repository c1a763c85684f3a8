"""The registered queries of this subpackage: each applies one operator to
its whole table and derives the contract's digest columns from the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, blob_ledger, collocations, decontam, kmeans_tree, licenses, mixing, near_dedup, perplexity, pii, style_tree,
               toxicity, warc)
from .common import table

TOKENIZERS = "/opt/tokenizers"  # folder of the vocabulary files, readable by the executors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kinds(spans: Column, kinds) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return pii.detect_pii(table(spark, sf_dir, "documents")).select(
        "doc_id", *[_count(spans, k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(_span_text(_of_kinds(spans, pii.BASE_KINDS)), 256).alias("base_sha256"),
        _span_text(spans).alias("spans"),
        F.coalesce(F.array_max(spans["score"]), F.lit(0.0)).alias("max_score"))


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    places, matches = F.col("places"), F.col("matches")
    base = F.array_sort(F.array_distinct(places["label"]))
    labels = F.array_sort(F.array_distinct(F.concat(places["label"], matches["label"])))
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places["start"]).cast("long").alias("first_word"),
        F.array_max(places["start"]).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce(F.array_max(matches["coverage"]), F.lit(0.0)),
                   F.when(F.size(places) > 0, 0.5).otherwise(0.0)).alias("score"))


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    ledger = blob_ledger.new_ledger(spark)
    return blob_ledger.scan_versions(table(spark, sf_dir, "documents"), ledger).select(
        "doc_id", *[_count(spans, k).alias(f"n_{k}") for k in blob_ledger.BASE_KINDS],
        F.sha2(_span_text(_of_kinds(spans, blob_ledger.BASE_KINDS)), 256).alias("base_sha256"),
        _span_text(spans).alias("spans"), "blob")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op7_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
           FROM pages),
     g AS (SELECT payload_digest, max(page_id) AS first_id FROM p WHERE payload_bytes >= 1000
           GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""


@query
def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and item."""
    found = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("h")).select(
        "doc_id", "h.item_id", "h.item_words", "h.covered", "h.coverage", F.size("h.tiles").alias("n_tiles"))


@query
def op6_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract_main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


@query
def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality(table(spark, sf_dir, "documents"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=lambda i: ~toxicity.held_out(i))
    return toxicity.score(docs, scorer).select(
        "doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_restored")


ORACLES["op9_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
       FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS i FROM w WHERE len(ws) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
smallest AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(smallest.y, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(smallest.y, w.doc_id)) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN smallest ON smallest.x = w.doc_id
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (SELECT lang, len, array_to_string(ws[i:i + len - 1], ' ') AS phrase
          FROM (SELECT lang, ws, len, unnest(generate_series(1, len(ws) - len + 1)) AS i
                FROM w, (SELECT unnest([1, 2, 3, 4]) AS len) s WHERE len(ws) >= len) x),
f AS (SELECT lang, len, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE len = 1 GROUP BY lang),
c AS (SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE len > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS first, array_to_string(ws[k + 1:len], ' ') AS rest
         FROM (SELECT *, unnest(generate_series(1, len - 1)) AS k FROM c) x),
scored AS (SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(a) AS outer_a
           FROM (SELECT lang, a, array_to_string(ws[lo:lo + m - 1], ' ') AS phrase
                 FROM (SELECT *, unnest(generate_series(1, len - m + 1)) AS lo
                       FROM (SELECT *, unnest(generate_series(2, len - 1)) AS m FROM c WHERE len > 2) y) z) v GROUP BY ALL),
ranked AS (SELECT lowest.lang, lowest.phrase, a, l, r, score,
                  row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank
           FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.phrase = lowest.phrase
           WHERE outer_a IS NULL OR 100::HUGEINT * outer_a < 80::HUGEINT * a)
SELECT ranked.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""


@query
def op12_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kmeans_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
