"""Secret scan with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. The
ledger is a Parquet table, one row per (blob, rule version) scanned so far. A
scan

1. lists the distinct blobs of the given versions (digests and ids only go
   through the shuffle) and removes the pairs the ledger has (anti join);
2. reads the text of one path per unseen blob and scans it;
3. appends the new (blob, rule version, findings) rows to the ledger;
4. joins the ledger back to all paths by blob.

A rerun or a copy under another path scans nothing; a new rule version scans
every blob once more, old rows stay.

The rules of a version propose spans; the kinds assign, access and hex are
reported as matched, further kinds (private keys, prefixed service tokens,
JSON web tokens, credentials in URLs) need their own exact shape. A private
key reaches from its BEGIN to its END line; without an END line, over the
header lines and base64 that follow.
Defined results: a null or empty text is the empty blob, without findings;
repeated rows keep their own result rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stored, map_batches, scratch

RULE_VERSION = "rules-1.1"

# Order of the kinds in a span list (fixed values).
KINDS = ("assign", "access", "hex", "private_key", "service_token", "web_token", "url_login")
BASE_KINDS = KINDS[:3]

SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("entropy", T.DoubleType())])
FINDINGS = T.StructType([T.StructField("spans", T.ArrayType(SPAN))])
LEDGER = T.StructType([
    T.StructField("blob", T.StringType()), T.StructField("rule_version", T.StringType()),
    T.StructField("spans", T.ArrayType(SPAN))])

_WORD = re.compile(r"(?:password|passwd|secret|token|api_?key)", re.I | re.A)
_ASSIGN_TAIL = re.compile(r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}+")
_KEY_LINE = re.compile(r"-----(BEGIN|END) (?:[A-Z0-9]+ )*?PRIVATE KEY(?: BLOCK)?-----")
_KEY_GAP = r"""(?:[\s"'`,;>#*|]|\\[nrt])*+"""  # between a key's lines, also quoted, commented or escaped ones
_KEY_HEAD = "Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID|Subject"
_KEY_BODY = re.compile(rf"(?:(?:{_KEY_GAP}(?:{_KEY_HEAD}):[^\n\\]*+)*+(?:{_KEY_GAP}[A-Za-z0-9+/=]{{16,}}+(?![^\s\"'`,;|\\-]))++)?")
_KEY_TAIL = re.compile(rf"{_KEY_GAP}(?:[A-Za-z0-9+/]{{1,15}}+={{0,2}}+(?=\s*(?:\Z|\n|\\[nrt]|[\"'`,;]|-----))"
                       r"|(?=[A-Za-z0-9+/]*(?:[0-9+/=]|[a-z][A-Z]))[A-Za-z0-9+/]{1,15}+={0,2}+)(?![A-Za-z0-9+/=])")
_SERVICE = re.compile(r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,250}"
                      r"|sk_live_[A-Za-z0-9]{24,}|AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9_-])")
_WEB_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")
_URL_LOGIN = re.compile(r"[a-z][a-z0-9+]{1,10}://[^\s/:@\"'<>]*+:([^\s/@\"'<>]++)@")


def entropy(s: str) -> float:
    n = len(s)
    return round(-sum(c / n * math.log2(c / n) for c in Counter(s).values()), 4) if n else 0.0


def _assignments(text: str):
    pos = 0
    while m := _WORD.search(text, pos):
        tail = _ASSIGN_TAIL.match(text, m.end())
        if tail is None:
            pos = m.start() + 1
            continue
        pos = tail.end()
        if len(tail[1]) >= 8:
            yield m.start(), tail.end(), tail[1]


def _private_keys(text: str):
    """(start, end) of the private keys; one pass over their BEGIN and END lines."""
    lines = list(_KEY_LINE.finditer(text))
    for m, after in zip(lines, lines[1:] + [None]):
        if m[1] == "END":
            continue
        if after is not None and after[1] == "END":
            yield m.start(), after.end()
            continue
        stop = len(text) if after is None else after.start()
        body = _KEY_BODY.match(text, m.end(), stop)
        tail = _KEY_TAIL.match(text, body.end(), stop) if body.end() > m.end() else None
        yield m.start(), (tail or body).end()


def find_secrets(text: str | None) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, entropy of the secret), by start, then kind."""
    text = text or ""
    out = [("assign", s, e, entropy(v)) for s, e, v in _assignments(text)]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), entropy(m[0])) for m in _ACCESS.finditer(text)
                if m.end() - m.start() >= 16]
    out += [("hex", m.start(), m.end(), entropy(m[0])) for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        out += [("private_key", s, e, 0.0) for s, e in _private_keys(text)]
    if "_" in text or "AIza" in text or "xox" in text:
        out += [("service_token", m.start(), m.end(), entropy(m[0])) for m in _SERVICE.finditer(text)]
    if "eyJ" in text:
        out += [("web_token", m.start(), m.end(), entropy(m[0])) for m in _WEB_TOKEN.finditer(text)]
    if "://" in text:
        out += [("url_login", m.start(), m.end(), entropy(m[1])) for m in _URL_LOGIN.finditer(text)]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda x: (x[1], order[x[0]]))


def new_ledger(spark: SparkSession) -> str:
    """Path of an empty ledger in the session's shared folder."""
    path = scratch(spark, "blob-ledger")
    spark.createDataFrame([], LEDGER).write.parquet(path)
    return path


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def scan_versions(df: DataFrame, ledger_path: str, path_col: str = "doc_id", text_col: str = "text",
                  rule_version: str = RULE_VERSION, rules=find_secrets) -> DataFrame:
    """One row per row of ``df``: path_col, blob, spans. Appends what was not
    yet scanned under ``rule_version`` to the ledger at ``ledger_path``; the
    append is one atomic Parquet commit, a lost task or job adds no rows."""
    spark = df.sparkSession
    src = df.select(F.col(f"`{path_col}`").alias("path"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    src = src.withColumn("blob", F.sha2(F.col("text"), 256))
    paths = Stored(src.select("path", "blob"), "paths")
    seen = read_ledger(spark, ledger_path).where(F.col("rule_version") == rule_version).select("blob")
    unseen = paths.df.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left_anti")
    # a blob whose every path is null has the null path: compare null-safely by a flag
    pick = unseen.select(F.col("path").alias("p"), F.col("blob").alias("b"))
    texts = src.join(pick, F.col("path").eqNullSafe(F.col("p")) & (F.col("blob") == F.col("b")), "left_semi")
    scanned = map_batches(texts.select("blob", "text"), ["text"], ["blob"], FINDINGS,
                          lambda: lambda batch: ((rules(t),) for t in batch))
    # repeated rows of one path carry the same blob twice: one ledger row per blob
    (scanned.groupBy("blob").agg(F.first("spans").alias("spans"))
     .select("blob", F.lit(rule_version).alias("rule_version"), "spans")
     .write.mode("append").parquet(ledger_path))
    ledger = read_ledger(spark, ledger_path).where(F.col("rule_version") == rule_version).select("blob", "spans")
    return (paths.df.join(ledger, "blob", "left")
            .select(F.col("path").alias(path_col), "blob", "spans"))


def mask(text: str | None, spans) -> str | None:
    """The text with every reported span replaced by a tag of its kind;
    overlapping spans become one tag, of the first span's kind."""
    if not spans or text is None:
        return text
    out, last, end = [], 0, -1
    for kind, s, e in sorted(((x[0], x[1], x[2]) for x in spans), key=lambda x: (x[1], -x[2])):
        if s >= end:
            out.append(text[last:s] + f"<{kind}>")
            last = end = e
        elif e > end:
            last = end = e
    return "".join(out) + text[last:]
