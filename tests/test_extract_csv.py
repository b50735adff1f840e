"""Extract (A3-A8) and CSV sources."""

import datetime as dt
import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from core_helpers import SF0001, rows
from shopfloor.operators.clean import clean_sensor_data
from shopfloor.operators.ordered import ordered_pass
from shopfloor.operators.standardize import POSITION_COL, standardize_data
from shopfloor.plans import etl
from shopfloor.sources import csv
from shopfloor.sources import csv as csvsrc
from shopfloor.sources import extract, fixtures


def test_recency_filter_and_fallback(spark):  # A5, A6, Q17
    raw = fixtures.sensor_raw(spark, SF0001)
    assert extract.extract_sensor(raw, days_back=7, as_of="2024-01-31 00:00:00").count() == 206
    assert extract.extract_sensor(raw, days_back=7, as_of="2024-12-08 00:00:00").count() == 1000
    assert extract.extract_sensor(raw).count() == 1000
    kept = extract.extract_sensor(raw, days_back=7, as_of=dt.datetime(2024, 1, 31))
    assert kept.where("timestamp IS NULL").count() == 0


def test_completed_inspections(spark):  # A7, Q16
    q = fixtures.quality_raw(spark, SF0001)
    assert q.count() == 1020 and extract.extract_quality(q).count() == 712


def test_time_formats(spark):  # A3
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02T03:04:05.250000",),
                                ("2024/01/02",), ("02/01/2024 03:04:05",), ("2024-01-02 3:04:05",),
                                ("not a time",)], "`Date Time` string")
    out, col = extract.parse_first_time_column(df)
    got = [r[0] for r in out.collect()]
    assert col == "Date Time"
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 250000),
                   dt.datetime(2024, 1, 2), dt.datetime(2024, 2, 1, 3, 4, 5),   # month first
                   dt.datetime(2024, 1, 2, 3, 4, 5), None]


def test_more_time_layouts_and_rejects(spark):  # A3, C2
    at = dt.datetime(2024, 1, 1, 10, 0)
    want = {"2024-01-01T10:00:00Z": at, "2024-01-01T10:00:00+00:00": at, "2024-01-01 12:00+02:00": at,
            "2024-01-01T05:30:00-0430": at, "2024-01-01 10:00:00.123456789": at.replace(microsecond=123456),
            "1/2/2024 9:05": dt.datetime(2024, 1, 2, 9, 5), "13/01/2024 10:00": dt.datetime(2024, 1, 13, 10, 0),
            "01-02-2024 10:00:00": dt.datetime(2024, 1, 2, 10, 0), "Jan 1 2024": dt.datetime(2024, 1, 1),
            "1 January 2024 10:00": at, "Sept. 3, 2024 12:05 AM": dt.datetime(2024, 9, 3, 0, 5),
            "1/1/2024 12:00 PM": dt.datetime(2024, 1, 1, 12, 0), "2024-13-01": None, "2024-02-30": None,
            "31/31/2024": None, "2024-01-01 25:00": None, "2024-01-01 10:00 nonsense": None, "noon": None, "": None,
            "1/1/2024 13:00 PM": None, "Foo 1 2024": None}
    df = spark.createDataFrame([(k, i) for i, k in enumerate(want)] + [(None, -1)], "time string, i int")
    out, _ = extract.parse_first_time_column(df)
    got = {r.i: r.time for r in out.collect()}
    assert [got[i] for i in range(len(want))] == list(want.values()) and got[-1] is None
    counts = extract.rejected_times(df, "sensor").first()
    assert (counts.rows, counts.rejected) == (len(want) + 1, sum(v is None for v in want.values()))


def test_rfc4180_quotes_and_strict_numbers(spark):  # A1, A2
    d = tempfile.mkdtemp(prefix="sf-csv-")
    _write(os.path.join(d, "q.csv"), 'time,machine,note,v\n2024-01-01,1D,"two\nlines, and a ""quote""",1\n'
                                     '2024-01-02,2F,plain,2.5e1\n2024-01-03,0x10, 7 ,\n')
    df = csvsrc.read_csv(spark, d)
    assert dict(df.dtypes)["machine"] == "string" and dict(df.dtypes)["v"] == "double"
    got = [(r.machine, r.note, r.v) for r in df.orderBy(csvsrc.SEQ_COL).collect()]
    assert got == [("1D", 'two\nlines, and a "quote"', 1.0), ("2F", "plain", 25.0), ("0x10", " 7 ", None)]
    assert csvsrc.probe(spark, d) == ("UTF-8", True)


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_na_tokens_numeric_inference_and_order(spark):
    d = tempfile.mkdtemp(prefix="sf-csv-")
    tokens = ["NA", "N/A", "NULL", "None", "nan", "-nan", "#N/A", "<NA>", "n/a", "null", ""]
    lines = ["Time Stamp,Machine ID,Temperature,Note"]
    lines += [f"2024-01-01 00:0{i % 10}:00,M{i},{tok},x" for i, tok in enumerate(tokens)]
    lines += ["2024-01-01 00:30:00,M99,12.5,y", "2024-01-01 00:31:00,M98,abc,z"]
    _write(os.path.join(d, "part-0.csv"), "\n".join(lines) + "\n")
    df = csvsrc.read_csv(spark, d)
    assert dict(df.dtypes)["Temperature"] == "string"      # 'abc' keeps it text
    vals = [r.Temperature for r in df.orderBy(csvsrc.SEQ_COL).collect()]
    assert vals[: len(tokens)] == [None] * len(tokens)
    _write(os.path.join(d, "part-0.csv"), "a,b\n1,2.5\n3,NA\n")
    df2 = csvsrc.read_csv(spark, d)
    assert dict(df2.dtypes)["a"] == "bigint" and dict(df2.dtypes)["b"] == "double"


def test_encoding_detection(spark):  # A2
    d = tempfile.mkdtemp(prefix="sf-csv-")
    _write(os.path.join(d, "q.csv"), "timestamp,result\n2024-01-01 00:00:00,défaut\n", encoding="iso-8859-1")
    assert csvsrc.detect_encoding(spark, d) == "ISO-8859-1"
    assert csvsrc.scan_quality_csv(spark, d).first().result == "défaut"
    d2 = tempfile.mkdtemp(prefix="sf-csv-")
    _write(os.path.join(d2, "q.csv"), "timestamp,result\n2024-01-01 00:00:00,défaut\n")
    assert csvsrc.detect_encoding(spark, d2) == "UTF-8"
    assert csvsrc.scan_quality_csv(spark, d2).first().result == "défaut"


def test_missing_source_is_none(spark):  # A8
    assert csvsrc.scan_sensor_csv(spark, "/tmp/does-not-exist-shopfloor/x.csv") is None


def test_file_order_across_files(spark):
    d = tempfile.mkdtemp(prefix="sf-csv-")
    for f in range(3):
        body = "\n".join(f"{f * 100 + i},{i}" for i in range(50))
        _write(os.path.join(d, f"part-{f}.csv"), "n,v\n" + body + "\n")
    df = csvsrc.read_csv(spark, d)
    out = ordered_pass(df, csvsrc.csv_order(), position_col="pos")
    got = [r.n for r in out.orderBy("pos").collect()]
    assert got == sorted(got) and len(got) == 150


def test_declared_schema_skips_inference(spark):
    d = tempfile.mkdtemp(prefix="sf-csv-")
    _write(os.path.join(d, "s.csv"), "Time,Machine,Temp\n2024-01-01 00:00:00,7,12.5\n2024-01-01 00:01:00,8,oops\n")
    df = csvsrc.scan_sensor_csv(spark, d, schema={"Machine": "string", "Temp": "double"})
    assert dict(df.dtypes)["Machine"] == "string" and dict(df.dtypes)["Temp"] == "double"
    assert [r.Temp for r in df.orderBy(csvsrc.SEQ_COL).collect()] == [12.5, None]


# --- files that differ, that cannot be split, and rows that do not fit -------------

def _folder(**files):
    path = tempfile.mkdtemp(prefix="sf-csv-")
    for name, data in files.items():
        with open(os.path.join(path, name.replace("_", ".")), "wb") as f:
            f.write(data)
    return path


def test_encoding_and_quotes_are_decided_per_file(spark):
    path = _folder(a_csv="k,v\n1,é–\n".encode(), b_csv="k,v\n2,é\n".encode("latin-1"),
                   c_csv='k,v\n3,"two\nlines é"\n'.encode(), d_csv='v,k\n"x\nyé",4\n'.encode("latin-1"))
    got = csv.read_csv(spark, path, encoding=None)
    assert rows(got, "k", "v") == [(1, "é–"), (2, "é"), (3, "two\nlines é"), (4, "x\nyé")]
    assert csv.detect_encoding(spark, path) == "ISO-8859-1"
    with pytest.raises(ValueError, match="differ in their columns"):
        csv.read_csv(spark, _folder(a_csv=b"k,v\n1,x\n", b_csv="k,w\n2,é\n".encode("latin-1")), encoding=None)


def test_one_compressed_file_is_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(csv, "CHUNK_ROWS", 100)
    body = "row_no,temp_value\n" + "".join(f"{i},{'' if i % 3 else i % 140}\n" for i in range(1050))
    whole = _folder(a_csv=body.encode())
    packed = _folder(a_csv_gz=gzip.compress(body.encode()))
    plain, one = (csv.read_csv(spark, p) for p in (whole, packed))
    assert csv.CHUNK_COL in one.columns and csv.CHUNK_COL not in plain.columns
    assert one.groupBy(csv.CHUNK_COL).count().agg(F.max("count"), F.count("*")).first()[:2] == (100, 11)
    assert len(one.inputFiles()) >= 11                                       # read by many tasks from here on
    cleaned = [standardize_data(clean_sensor_data(df, csv.csv_order(df), position_col=POSITION_COL), csv.csv_order(df))
               for df in (plain, one)]
    want = rows(cleaned[0], "row_no", "temp_value", "data_quality", "record_id")
    assert rows(cleaned[1], "row_no", "temp_value", "data_quality", "record_id") == want and len(want) == 1050


def test_malformed_rows_are_kept_or_quarantined(spark):
    path = _folder(a_csv=b'a,b,c\n1,2,3\n1,2\n1,2,3,4\n"x,""y",2,"z"\n9,"open\n')
    assert csv.read_csv(spark, path, multi_line=False).count() == 5                   # kept, as they can be read
    found = csv.read_csv(spark, path, multi_line=False, malformed="quarantine")
    good, bad = csv.split_malformed(found)
    assert rows(good, "a", "b", "c") == [("1", 2, "3"), ('x,"y', 2, "z")]
    assert rows(bad, "first_field", "record", "fields", "reason") == [
        ("1", "1,2", 2, "short"), ("1", "1,2,3,4", 4, "long"), ("9", '9,"open', 2, "quote")]
    assert rows(csv.malformed_counts(found)) == [("long", 1), ("quote", 1), ("short", 1)]
    none = csv.read_csv(spark, _folder(a_csv=b"a,b\n1,2\n"), malformed="quarantine")
    assert csv.split_malformed(none)[0].count() == 1 and csv.malformed_counts(none).count() == 0


def test_job_counts_what_it_quarantines(spark):
    out = tempfile.mkdtemp(prefix="sf-job-")
    sensor = _folder(s_csv=b"timestamp,machine_id,temperature\n2024-01-01 08:00,m1,20\n2024-01-01 08:01,m1\n")
    quality = _folder(q_csv=b"timestamp,machine_id,result\n2024-01-01 08:00,m1,pass\n2024-01-01 08:00,m1,fail,late\n")
    report = etl.run_etl_pipeline(spark, sensor, quality, out, malformed="quarantine")
    assert (report.rows["sensor_readings"], report.rows["sensor_malformed"], report.rows["quality_malformed"]) == (1, 1, 1)
    set_aside = spark.read.parquet(f"{out}/quarantine/{report.run_id}/quality")
    assert rows(set_aside, "record", "reason") == [("2024-01-01 08:00,m1,fail,late", "long")]


def test_compressed_files_are_parsed_from_staged_lines(spark, monkeypatch):
    """What reads the packed file does no more than stage its lines; the fields are as read unpacked."""
    monkeypatch.setattr(csv, "CHUNK_ROWS", 3)
    bodies = {"a_csv": 'k,v,w\n\n1,"x,""y",NA\n2,é,\n3,z\n4,z,q,more\n   \n5, b ,""\n'.encode(),
              "b_csv": "k,v,w\n6,é,u\n7,,\n".encode("latin-1"), "c_csv": b"k,v,w\n"}
    plain = _folder(**bodies)
    packed = _folder(**{f"{n}_gz": gzip.compress(b) for n, b in bodies.items()})
    assert csv._scan_packed(spark, plain, None, None, "keep") is None
    for how in ({"encoding": None}, {"encoding": None, "malformed": "quarantine"}, {"encoding": "ISO-8859-1"},
                {"schema": {"k": "int"}, "multi_line": False}):
        want, got = csv.read_csv(spark, plain, **how), csv.read_csv(spark, packed, **how)
        assert got.drop(csv.CHUNK_COL).dtypes == want.dtypes
        assert rows(got.drop(*csv.ORDER_COLS)) == rows(want.drop(*csv.ORDER_COLS))
        if "malformed" in how:
            assert rows(csv.split_malformed(got)[1].drop(*csv.ORDER_COLS)) == rows(csv.split_malformed(want)[1].drop(*csv.ORDER_COLS))
    staged = csv.read_csv(spark, packed, encoding=None, infer_numeric=False)
    assert csv.CHUNK_COL in staged.columns and all(".gz" not in f for f in staged.inputFiles()) and len(staged.inputFiles()) >= 4
    broken = _folder(a_csv_gz=gzip.compress(b'k,v\n1,"two\nlines"\n'))
    assert rows(csv.read_csv(spark, broken, encoding=None), "k", "v") == [(1, "two\nlines")]
    with pytest.raises(ValueError, match="differ in their columns"):
        csv.read_csv(spark, _folder(a_csv_gz=gzip.compress(b"k,v\n1,x\n"), b_csv_gz=gzip.compress("k,w\n2,é\n".encode("latin-1"))), encoding=None)
