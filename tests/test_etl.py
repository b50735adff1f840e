"""End-to-end from CSV files through the public entry points."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from core_helpers import SF0001
from shopfloor.operators.integrate import NullKeyPairs
from shopfloor.plans import etl
from shopfloor.sources import csv as csvsrc
from shopfloor.sources import fixtures


def _stage(spark):
    d = tempfile.mkdtemp(prefix="sf-etl-")
    csvsrc.write_csv(fixtures.sensor_raw(spark, SF0001), f"{d}/sensors", order_by="row_no")
    csvsrc.write_csv(fixtures.quality_raw(spark, SF0001), f"{d}/quality", order_by="row_no",
                     encoding="ISO-8859-1")
    return d


def test_run_check_and_sql(spark):
    d = _stage(spark)
    rep = etl.run_etl_pipeline(spark, f"{d}/sensors", f"{d}/quality", f"{d}/db")
    assert rep.rows["sensor_readings"] == 1019 and rep.rows["hourly_summary"] == 937
    ok, report = etl.test_database_integrity(spark, f"{d}/db")
    assert ok is False                                   # NULL timestamps and repeated ids
    failed = {r.check for r in report.where("status = 'fail'").collect()}
    assert failed == {"critical_nulls", "duplicate_ids"}
    etl.register_views(spark, f"{d}/db")
    top = spark.sql("SELECT * FROM hourly_summary ORDER BY defect_rate DESC LIMIT 10").collect()
    assert len(top) == 10
    assert spark.sql("SELECT COUNT(*) AS n FROM sensor_readings").first().n == 1019


def test_missing_inputs(spark):
    d = _stage(spark)
    assert etl.run_etl_pipeline(spark, f"{d}/nope", f"{d}/quality", f"{d}/db") is None
    rep = etl.run_etl_pipeline(spark, f"{d}/sensors", f"{d}/nope", f"{d}/db2")
    assert rep.rows["quality_checks"] == 0               # published empty, with its contract
    t = etl.published(spark, f"{d}/db2")
    assert t.checks.count() == 0 and t.readings.count() == 1000
    sums = t.summary.agg(F.sum("defect_count").alias("d"), F.sum("total_checks").alias("n")).first()
    assert sums.d == 0 and sums.n == t.readings.where(
        "timestamp IS NOT NULL AND machine_id IS NOT NULL AND line_id IS NOT NULL").count()
    ok, report = etl.test_database_integrity(spark, f"{d}/db2")
    assert {r.status for r in report.where("metric = 'quality_checks'").collect()} == {"warn"}


def test_checks_on_empty_contract_tables(spark):
    from shopfloor.operators import load
    d = tempfile.mkdtemp(prefix="sf-empty-")
    load.create_database(spark, f"{d}/db")
    ok, report = etl.test_database_integrity(spark, f"{d}/db")
    assert ok is False
    got = {(r.check, r.metric): r.status for r in report.collect()}
    assert got[("row_counts", "sensor_readings")] == "fail"
    assert got[("row_counts", "quality_checks")] == "warn"
    assert got[("row_counts", "hourly_summary")] == "fail"
    assert got[("critical_nulls", "null_count")] == "pass"
    assert got[("temperature_bounds", "min_temp")] == "pass"
    assert not any(c == "quality_distribution" for c, _ in got)   # no flags, no shares


def test_settings_of_the_job_and_the_command(spark, capsys):
    from shopfloor import __main__ as command
    d = _stage(spark)
    files = ["--sensor", f"{d}/sensors", "--quality", f"{d}/quality", "--out", f"{d}/db"]
    base = ["--local", "4", "etl", *files]
    assert command.main([*base, "--null-keys", "sql", "--partition-days", "--multi-line", "no", "--keep-runs", "1"]) == 0
    assert command.main([*base, "--partition-days", "--keep-runs", "1"]) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    sql, match = (x["rows"]["joined"] for x in said)
    assert sql <= match and said[0]["rows"]["sensor_rejected_times"] == 0
    assert len(os.listdir(f"{d}/db/runs")) == 1                      # superseded runs are removed
    days = os.listdir(f"{d}/db/runs/{said[1]['run_id']}/sensor_readings")
    assert any(x.startswith("day=2024-01-") for x in days)
    with pytest.raises(NullKeyPairs, match="limit 3"):
        command.main([*base, "--max-null-pairs", "3"])
    assert command.main(["--local", "4", "sql", "--out", f"{d}/db", "--to", f"{d}/result",
                         "SELECT * FROM sensor_readings"]) == 0
    assert spark.read.parquet(f"{d}/result").count() == 1019
    assert etl.published(spark, f"{d}/db").readings.columns[:2] == ["record_id", "timestamp"]


def test_tables_have_one_schema_with_or_without_inspections(spark):
    d = _stage(spark)
    spark.read.option("header", True).csv(f"{d}/quality").limit(0).write.option("header", True).csv(f"{d}/none")
    etl.run_etl_pipeline(spark, f"{d}/sensors", f"{d}/quality", f"{d}/a")
    etl.run_etl_pipeline(spark, f"{d}/sensors", f"{d}/nope", f"{d}/b")
    a, b = etl.published(spark, f"{d}/a"), etl.published(spark, f"{d}/b")
    assert a.readings.schema == b.readings.schema and set(a.summary.columns) >= set(b.summary.columns)
