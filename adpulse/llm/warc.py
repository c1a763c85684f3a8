"""WARC archives: write, read back, and merge their capture index.

*Write.* One WARC/1.1 record per page. Pages with equal payloads of at least
``MIN_REVISIT`` bytes share one ``response``, that of the largest page id; the
others become ``revisit`` records, without payload but with its digest, its
length and the id they refer to. Only digests and ids are shuffled to find
them. Records are written as text files, gzip-compressed, whose line end is the
last byte of the record's closing CRLF pair: the decompressed files are
byte-exact WARC. Every archive holds at most ``RECORDS_PER_FILE`` records.

*Read.* Archives are read as binary files on any file system that Spark
reads, parsed by Content-Length (a payload may hold anything, record headers
too), and every response's digest is verified.

*Index.* Each archive yields a capture run, sorted locally by URL key and
timestamp. Range partitioning by (URL key, timestamp, page id) sends each key range of
all runs to one task, where a loser tree merges the k runs; sampled ranges
split a URL with very many captures by time. Partition order and order within partitions give
the globally ordered capture history.

Defined results: null html is an empty payload; null URLs are written as
``urn:null`` and read back as null; control characters in URLs are
percent-encoded; repeated page ids keep a record each (records that share
payload and largest id are all responses; a null id revisits any other).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stored, scratch

MIN_REVISIT = 1000
RECORDS_PER_FILE = 1000
CRLF = "\r\n"
EPOCH, EPOCH_SECONDS, YEAR = "2024-01-01T00:00:00Z", 1704067200, 31536000

CAPTURE = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("url_key", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("digest_ok", T.BooleanType()), T.StructField("archive", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])


def shared_payloads(digests: DataFrame) -> DataFrame:
    """(digest, first_id): payloads of at least MIN_REVISIT bytes that several
    records have, with the largest page id; ``digests`` has page_id, digest, bytes."""
    return (digests.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
            .agg(F.count("*").alias("c"), F.max("page_id").alias("first_id")).where("c > 1").drop("c"))


def _record(url, page_id, stamp, payload, digest, size, is_revisit, refers_to):
    """The text of one record without its last line end."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    size.cast("string"), F.lit(CRLF + CRLF))
    block = F.when(is_revisit, http).otherwise(F.concat(http, payload))
    extra = F.when(is_revisit, F.concat(
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + CRLF
              + "WARC-Refers-To: <urn:page:"), text(refers_to), F.lit(">" + CRLF))).otherwise("")
    return F.concat(
        F.lit("WARC/1.1" + CRLF + "WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"),
        F.lit(CRLF + "WARC-Target-URI: "), url, F.lit(CRLF + "WARC-Date: "), stamp,
        F.lit(CRLF + "WARC-Record-ID: <urn:page:"), text(page_id), F.lit(">" + CRLF + "WARC-Payload-Digest: sha1:"),
        digest, F.lit(CRLF + "WARC-Payload-Length: "), size.cast("string"), F.lit(CRLF), extra,
        F.lit("Content-Type: application/http; msgtype=response" + CRLF + "Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block, F.lit(CRLF + "\r"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               time_col: str | None = None) -> None:
    """Write the pages as WARC archives (``*.txt.gz``) under ``path``. Without
    a capture time the timestamp is the fixed ``EPOCH`` plus the page id in seconds."""
    ident = F.col(f"`{id_col}`").cast("long")
    taken = (F.col(f"`{time_col}`") if time_col else
             F.timestamp_seconds(F.lit(EPOCH_SECONDS) + F.pmod(F.coalesce(ident, F.lit(0)), F.lit(YEAR))))
    stamp = F.date_format(F.to_utc_timestamp(taken, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.col(f"`{url_col}`")
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x1F\\x7F]", "%3F")
    src = pages.select(ident.alias("page_id"), F.coalesce(clean, F.lit("urn:null")).alias("url"),
                       F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
                       F.coalesce(stamp, F.lit(EPOCH)).alias("stamp"))
    src = src.withColumn("digest", F.sha1("html")).withColumn("bytes", F.octet_length("html").cast("long"))
    shared = Stored(shared_payloads(src.select("page_id", "digest", "bytes")), "shared-payloads").df
    rows = src.join(shared, "digest", "left")
    is_revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    value = _record(F.col("url"), F.col("page_id"), F.col("stamp"), F.col("html"), F.col("digest"), F.col("bytes"),
                    is_revisit, F.col("first_id"))
    (rows.select(value.alias("value")).write.option("compression", "gzip").option("lineSep", "\n")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then the path and query."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    host = host.rsplit("@", 1)[-1].split(":", 1)[0].lower()
    if host.startswith("www."):
        host = host[4:]
    return ",".join(reversed(host.split("."))) + ")" + slash + path


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of one archive."""
    pos, size = 0, len(data)
    while pos < size:
        if data[pos:pos + 8] != b"WARC/1.1":
            raise ValueError(f"no WARC record at byte {pos}")
        head = data.index(b"\r\n\r\n", pos)
        fields = dict(line.split(": ", 1) for line in data[pos + 10:head].decode("utf-8", "surrogatepass").split(CRLF))
        body = head + 4
        end = body + int(fields["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {pos} does not end where it says")
        yield pos, end + 4 - pos, fields, data[body:end]
        pos = end + 4


def _captures(name: str, content: bytes) -> list[tuple]:
    import hashlib
    import zlib
    data = zlib.decompress(content, wbits=47)
    out = []
    for off, length, f, block in records(data):
        payload = block[block.index(b"\r\n\r\n") + 4:]
        kind, declared = f["WARC-Type"], f["WARC-Payload-Digest"].split(":", 1)[1]
        digest = hashlib.sha1(payload).hexdigest() if kind == "response" else declared
        ident = lambda s: None if (v := s[len("<urn:page:"):-1]) == "null" else int(v)
        url = None if f["WARC-Target-URI"] == "urn:null" else f["WARC-Target-URI"]
        out.append((ident(f["WARC-Record-ID"]), url, url_key(url), f["WARC-Date"], kind,
                    ident(f["WARC-Refers-To"]) if "WARC-Refers-To" in f else None,
                    len(payload) if kind == "response" else int(f["WARC-Payload-Length"]),
                    digest, digest == declared, name, off, length))
    out.sort(key=_order)
    return out


def _order(c) -> tuple:
    return (c[2] or "", c[3], c[0] is not None, c[0] or 0, c[9], c[10])


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The capture rows of all archives under ``path``; each archive is one
    locally sorted run."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("path", "content"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(CAPTURE)
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = _captures(name, content.as_py())
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, type=schema.field(i).type) for i, v in enumerate(zip(*rows))], schema=schema)

    return files.mapInArrow(run, CAPTURE)


class LoserTree:
    """k-way merge of sorted runs: an inner node keeps the loser of its match,
    so each output costs one comparison per level."""

    def __init__(self, runs: Iterable[Iterable], key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = max(1, len(self.runs))
        self.heads = [self._next(i) for i in range(self.k)]
        self.tree = [-1] * self.k
        for i in range(self.k):
            self._play(i, filling=True)

    def _next(self, i):
        row = next(self.runs[i], None) if i < len(self.runs) else None
        return None if row is None else (self.key(row), i, row)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x[:2] < y[:2])

    def _play(self, i: int, filling: bool = False) -> None:
        winner, node = i, (i + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if filling and other < 0:
                self.tree[node] = winner
                return
            if other >= 0 and self._less(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        while (head := self.heads[self.tree[0]]) is not None:
            yield head[2]
            i = self.tree[0]
            self.heads[i] = self._next(i)
            self._play(i)


def merge_index(captures: DataFrame, partitions: int | None = None) -> DataFrame:
    """The captures in global order of (url_key, timestamp, page_id): merged
    from the archives' sorted runs, one loser tree per key range. ``part`` and
    ``position`` give the order of rows across files."""
    spark = captures.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = captures.repartitionByRange(n, "url_key", "timestamp", "page_id", "archive", "offset")
    schema = T.StructType(CAPTURE.fields + [T.StructField("part", T.IntegerType()), T.StructField("position", T.LongType())])

    def merge(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        runs: dict[str, list] = {}
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                runs.setdefault(row[9], []).append(row)
        for rows in runs.values():  # a fetched block may come in pieces: restore the run's own order
            if any(_order(a) > _order(b) for a, b in zip(rows, rows[1:])):
                rows.sort(key=_order)
        part, out, pos = TaskContext.get().partitionId(), [], 0
        for row in LoserTree([runs[k] for k in sorted(runs)], _order) if runs else ():
            out.append((*row, part, pos))
            pos += 1
            if len(out) == 5000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=arrow.field(i).type) for i, v in enumerate(zip(*out))], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=arrow.field(i).type) for i, v in enumerate(zip(*out))], schema=arrow)

    return ranged.select(*[f.name for f in CAPTURE.fields]).mapInArrow(merge, schema)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages as WARC, read the archives back, merge their index."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_warc(pages, path)
    return merge_index(Stored(read_captures(spark, path), "capture-runs").df)
