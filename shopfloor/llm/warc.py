"""WARC archives: write captures, read them back, assemble transactions.

A capture is three records: the request, the response (or a revisit of an equal
payload kept elsewhere) and a metadata record; request and metadata name the
response in WARC-Concurrent-To.  Writing is DataFrame work: a record is a string
that ends in CR LF CR LF, so Spark's text sink with that separator and gzip
writes archives straight to the shared store.  Captures are dealt by size, so that an
archive holds ARCHIVE_BYTES of payload at most, or one capture.  Reading takes whole
archive files, cuts records by Content-Length, and `assemble` joins them by
concurrent-to into one nested row per capture.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, stage

ARCHIVE_BYTES = 64 << 20       # payload of one archive, so that a task can hold one
SIZES = (1 << 16, 1 << 20, 1 << 24)    # classes of payloads: below each of these, and the rest
MIN_REVISIT = 1000             # payloads from this many bytes on are kept once
DATE = "1970-01-01T00:00:00Z"  # the pages table has no capture time
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("path string, record_id string, type string, concurrent_to string, target_uri string, date string, "
          "refers_to string, payload_digest string, payload_bytes long, intact boolean, fields map<string,string>, "
          "block binary")


# ---------------------------------------------------------------- writing

def _record(headers: list[Column], block: Column) -> Column:
    """One record without its end: headers that are null are left out."""
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *headers, length), F.lit(END), block)


def _header(name: str, value) -> Column:
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value))


def _urn(kind: str, page: Column, mark: Column) -> Column:
    return F.concat(F.lit(f"<urn:{kind}:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"),
                    mark.cast("string"), F.lit(">"))


def captures(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
             min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Rows of `pages` with what their records say: payload, digest, and the
    capture that a revisit refers to.

    Equal payloads (by SHA-1 and length) of at least `min_revisit` bytes are
    kept by the largest id; the others revisit it.  Rows that repeat that id are
    responses too; null ids never win, and revisit where an id exists.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("payload"),
                        F.monotonically_increasing_id().alias("mark"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")) \
               .withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    size = F.lit(len(SIZES))
    for k in range(len(SIZES) - 1, -1, -1):
        size = F.when(F.col("bytes") < SIZES[k], k).otherwise(size)
    # written once: the marks that records are named by are the same in every later job
    path = fresh_path(pages.sparkSession, "warc-rows")
    rows = rows.withColumn("size", size)
    rows.write.partitionBy("size").parquet(path)
    rows = pages.sparkSession.read.schema(rows.schema).parquet(path)
    kept = stage(rows.where((F.col("bytes") >= min_revisit) & F.col("page_id").isNotNull())
                 .groupBy("digest", "bytes").agg(F.max(F.struct("page_id", "mark")).alias("first"),
                                                 F.count("*").alias("n")), "warc-kept")
    # a null id revisits whatever id exists, so its digest is looked up even where n is 1
    lone = rows.where("page_id is null").select("digest", "bytes").distinct()
    kept = kept.join(lone.withColumn("asked", F.lit(True)), ["digest", "bytes"], "left") \
               .where("n > 1 or asked").select("digest", "bytes", "first")
    rows = rows.join(stage(kept, "warc-groups"), ["digest", "bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first.page_id"), F.lit(False))
    return rows.withColumn("first", F.when(revisit, F.col("first")))


def transaction(c: DataFrame) -> Column:
    """The three records of a capture, ends between them."""
    # white space and control characters would end a header line
    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    me, page = _urn("capture", F.col("page_id"), F.col("mark")), F.col("page_id").cast("string")
    target, date = _header("WARC-Target-URI", uri), _header("WARC-Date", DATE)
    with_me = _header("WARC-Concurrent-To", me)
    host, path = F.regexp_extract(uri, r"^[^:/]+://([^/?#]*)", 1), F.regexp_extract(uri, r"^[^:/]+://[^/?#]*(.*)$", 1)
    request = _record(
        [_header("WARC-Type", "request"), _header("WARC-Record-ID", _urn("request", F.col("page_id"), F.col("mark"))),
         target, date, with_me, _header("Content-Type", "application/http;msgtype=request")],
        F.concat(F.lit("GET "), F.coalesce(F.when(path == "", "/").otherwise(path), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "),
                 F.coalesce(host, F.lit("")), F.lit(END)))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    digest = _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    first = F.col("first").isNotNull()
    refers = _header("WARC-Refers-To", _urn("capture", F.col("first.page_id"), F.col("first.mark")))
    response = _record(
        [_header("WARC-Type", F.when(first, "revisit").otherwise("response")), _header("WARC-Record-ID", me), target,
         date, digest, F.when(first, refers), F.when(first, _header("WARC-Profile", PROFILE)),
         _header("Content-Type", "application/http;msgtype=response")],
        F.when(first, http).otherwise(F.concat(http, F.col("payload"))))
    metadata = _record(
        [_header("WARC-Type", "metadata"),
         _header("WARC-Record-ID", _urn("metadata", F.col("page_id"), F.col("mark"))), target, date, with_me,
         _header("Content-Type", "application/warc-fields")],
        F.concat_ws("\r\n", _header("page-id", page), _header("payload-length", F.col("bytes").cast("string")),
                    F.lit("")))
    return F.concat(request, F.lit(END), response, F.lit(END), metadata)


def write(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, **columns) -> None:
    """Write `pages` as gzipped WARC archives below `path`, one folder for each class
    of sizes."""
    rows = captures(pages, **columns)
    for k, below in enumerate((*SIZES, None)):
        some = rows.where(F.col("size") == k)
        each = 1 if below is None else max(1, archive_bytes // below)
        (some.select(transaction(some).alias("value")).write.option("lineSep", END).option("compression", "gzip")
         .option("maxRecordsPerFile", each).text(f"{path}/size={k}"))


# ---------------------------------------------------------------- reading

def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of an archive.  Raises
    ValueError where the bytes are no record or end within one."""
    at = 0
    while at < len(data):
        head_end = data.find(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8", "replace").split("\r\n") if head_end >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        end = head_end + 4 + int(headers["content-length"])
        if end > len(data):
            raise ValueError(f"record at byte {at} is cut off")
        yield headers, data[head_end + 4:end]
        at = end + 4 if data[end:end + 4] == b"\r\n\r\n" else end


def _fields(block: bytes) -> list[tuple[str, str]]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return [(a.strip(), b.strip()) for a, _, b in pairs]


def read(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record of the archives below `path`.  For responses the
    payload's length and digest are measured and `intact` says whether the
    digest agrees with the header; revisits have the header's digest only.
    `blocks=False` leaves the block out, for callers that only need the digests."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    types = [pa.string()] * 8 + [pa.int64(), pa.bool_(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def one(file: str, h: dict[str, str], block: bytes) -> tuple:
        kind = h.get("warc-type", "")
        digest, size, intact = h.get("warc-payload-digest", "").removeprefix("sha1:") or None, None, None
        if kind == "response":
            payload = block[block.find(b"\r\n\r\n") + 4:]
            measured = hashlib.sha1(payload).hexdigest()
            digest, size, intact = measured, len(payload), digest in (None, measured)
        return (file, h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-target-uri"),
                h.get("warc-date"), h.get("warc-refers-to"), digest, size, intact,
                _fields(block) if kind == "metadata" else None, block if blocks else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("path"), b.column("content")):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                part: list[tuple] = []
                for h, block in parse(data):
                    part.append(one(file.as_py(), h, block))
                    if len(part) == 512:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names)
                        part = []
                if part:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names)

    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: `response` (response or revisit), and the
    `requests` and `metadata` records that name it in concurrent-to, in order of
    their ids.  Records that name a response which no archive holds give a row
    with a null response."""
    capture = F.col("type").isin("response", "revisit")
    row = F.struct("record_id", "type", "target_uri", "date", "refers_to", "payload_digest", "payload_bytes",
                   "intact", "fields", "block")
    each = records.withColumn("capture_id", F.when(capture, F.col("record_id"))
                              .otherwise(F.coalesce("concurrent_to", "record_id"))).withColumn("row", row)
    # maps cannot be ordered, so the lists are sorted by id alone
    by_id = lambda rows: F.array_sort(rows, lambda a, b: F.when(a.record_id < b.record_id, -1)
                                      .when(a.record_id > b.record_id, 1).otherwise(0))
    return each.groupBy("capture_id").agg(
        F.first(F.when(capture, F.col("row")), ignorenulls=True).alias("response"),
        by_id(F.collect_list(F.when(F.col("type") == "request", F.col("row")))).alias("requests"),
        by_id(F.collect_list(F.when(F.col("type") == "metadata", F.col("row")))).alias("metadata"))
