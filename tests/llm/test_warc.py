import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from shopfloor.llm import common, queries, warc
from llm_helpers import SF0001

DDL = "page_id long, url string, html string, digest string, first int"
BIG = "é" * 600                                            # 1,200 bytes


def roundtrip(spark, df, **options):
    path = common.fresh_path(spark, "warc-test")
    warc.write(df, path, **options)
    return path, warc.assemble(warc.read(spark, path))


def expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = max(ids, default=None)
        revisit = len(data) >= 1000 and first is not None and page != first
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


def digest_columns(captures):
    fields, r = F.col("metadata")[0]["fields"], F.col("response")
    return sorted((tuple(x) for x in captures.select(
        fields["page-id"].cast("long"), F.coalesce(r["payload_bytes"], fields["payload-length"].cast("long")),
        r["payload_digest"], r["type"],
        F.regexp_extract(r["refers_to"], "^<urn:capture:(-?[0-9]+):", 1).cast("long")).collect()), key=str)


ROWS = [(1, "http://a.example/x?y=1", BIG), (2, "http://b.example", BIG), (3, None, BIG), (4, "http://c.example/p", None),
        (5, "http://d.example/", "small"), (6, "http://e.example/", "small"), (7, "ftp:odd", ""),
        (8, "http://f/\r\nWARC-Type: evil", "WARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n\r\n" + "x" * 2000),
        (None, "http://g/", BIG), (None, "http://h/", "y" * 1500), (9, "http://i/", "z" * 200_000),
        (9, "http://i/", "z" * 200_000), (-3, "http://j/ü", "\x00\x0b😀")]


def test_roundtrip(spark, frame):
    path, captures = roundtrip(spark, frame([(*r, "d", 1) for r in ROWS], DDL), archive_bytes=2 << 16)
    assert digest_columns(captures) == expected(ROWS)
    by = {(r.metadata[0].fields.get("page-id"), r.response.type): r for r in captures.collect()}
    assert all(len(r.requests) == len(r.metadata) == 1 for r in by.values())
    r = by["8", "response"]
    assert r.response.intact and r.response.target_uri == "http://f/%20%20WARC-Type:%20evil"
    assert bytes(r.response.block).endswith(b"x" * 2000)
    assert bytes(by["1", "revisit"].response.block).endswith(b"\r\n\r\n")
    assert bytes(by["1", "revisit"].requests[0].block) == b"GET /x?y=1 HTTP/1.1\r\nHost: a.example\r\n\r\n"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content").collect()
    sizes = [sum(len(b) for h, b in warc.parse(gzip.decompress(f.content)) if h["warc-type"] == "response") for f in files]
    assert len(files) >= len(ROWS) / 2 and max(sizes) < 201_000           # two small captures, or a large one


def test_damage_and_lost_records_are_told(spark, frame, monkeypatch):
    """The query fails where an archive lost the record that a revisit names, or a payload changed."""
    real = warc.read
    lost = lambda *a, **k: real(*a, **k).where("NOT (type = 'response' AND payload_bytes > 1000)")
    hurt = lambda *a, **k: real(*a, **k).withColumn("intact", F.col("payload_bytes") < 1000)
    rows = [(1, "http://a/", BIG), (2, "http://b/", BIG)]
    monkeypatch.setattr(queries, "table", lambda *a: frame(rows, "page_id long, url string, html string"))
    assert sorted(tuple(r)[3:] for r in queries.op8_warc(spark, "").collect()) == [("response", None), ("revisit", 2)]
    for read in (lost, hurt):
        monkeypatch.setattr(warc, "read", read)
        with pytest.raises(Exception, match="damaged or refers to none"):
            queries.op8_warc(spark, "").collect()


def test_marks_are_written_once(spark, frame):
    """Every job reads the marks that the first one wrote, so names in one archive hold in another."""
    rows = warc.captures(frame([(*r, "d", 1) for r in ROWS], DDL))
    assert rows.inputFiles() and {r.mark for r in rows.collect()} == {r.mark for r in rows.repartition(5).collect()}


def test_records_are_joined_by_concurrent_to_not_by_order(spark, frame):
    path = common.fresh_path(spark, "warc-shuffled")
    warc.write(frame([(*r, "d", 1) for r in ROWS], DDL), path)
    records = warc.read(spark, path)
    shuffled = warc.assemble(records.repartition(7, F.xxhash64("record_id")))
    assert digest_columns(shuffled) == expected(ROWS)


def test_parse():
    one = b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 5\r\n\r\na: b\n\r\n\r\n"
    assert [(h["warc-type"], b) for h, b in warc.parse(one * 3)] == [("metadata", b"a: b\n")] * 3
    assert list(warc.parse(b"")) == []
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse(one[:-8]))
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.parse(b"junk" + one))


def test_foreign_archives(spark, tmp_path):
    """Members compressed one by one, a damaged payload, an orphan request."""
    def record(*headers, block=b""):
        return ("WARC/1.1\r\n" + "\r\n".join(headers) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    parts = [record("WARC-Type: warcinfo", "WARC-Record-ID: <i>"),
             record("WARC-Type: request", "WARC-Record-ID: <q>", "WARC-Concurrent-To: <r>", block=b"GET / HTTP/1.1\r\n\r\n"),
             record("WARC-Type: response", "WARC-Record-ID: <r>", "WARC-Payload-Digest: sha1:00", block=http),
             record("WARC-Type: request", "WARC-Record-ID: <o>", "WARC-Concurrent-To: <gone>")]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    got = {r.capture_id: r for r in warc.assemble(warc.read(spark, str(tmp_path))).collect()}
    assert set(got) == {"<i>", "<r>", "<gone>"}
    assert got["<r>"].response.intact is False and got["<r>"].response.payload_bytes == 4
    assert [q.record_id for q in got["<r>"].requests] == ["<q>"]
    assert got["<gone>"].response is None and got["<gone>"].requests[0].record_id == "<o>"


def test_empty_table(spark, frame):
    _, captures = roundtrip(spark, frame([], DDL))
    assert captures.collect() == []


def test_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF0001}/pages.parquet").select("page_id", "url", "html").collect()]
    got = sorted((tuple(r) for r in queries.op8_warc(spark, SF0001).collect()), key=str)
    assert got == expected(pages)
