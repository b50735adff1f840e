"""Load rules (F), report rewrites (D10, D11), checks (K), entry contract."""

import os
import shutil
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from core_helpers import SF0001, rows
from shopfloor.functions import roles
from shopfloor.functions.scalars import hour_bucket
from shopfloor.operators import load
from shopfloor.plans import checks, pipeline, reports


@pytest.fixture(scope="module")
def tables(spark):
    p = pipeline.from_sf_dir(spark, SF0001)
    return reports.Tables(p.readings, p.checks, p.hourly)


def test_readings_mapping_chain():
    cols = ["row_no", "timestamp", "machine_id", "line_id", "temperature", "pressure", "vibration",
            "power", "data_quality", "record_id", "line_id_quality", "record_id_quality", "quality_status"]
    m = roles.readings_load_mapping(cols)
    assert m == {"timestamp": "timestamp", "machine_id": "machine_id", "line_id": "line_id",
                 "temperature": "temperature", "pressure": "pressure", "vibration": "vibration",
                 "power": "power", "data_quality": "data_quality", "record_id": "record_id"}


def test_checks_mapping_swallows_second_time_column():
    m = roles.checks_load_mapping(["inspect_time", "check_date", "Line", "Machine", "Result", "Fault Code"])
    assert m == {"inspect_time": "timestamp", "Line": "line_id", "Machine": "machine_id",
                 "Result": "result", "Fault Code": "defect_type"}


def test_publish_and_read_back(spark, tables):
    base = tempfile.mkdtemp(prefix="sf-pub-")
    run = load.publish_tables(spark, {"sensor_readings": tables.readings, "quality_checks": tables.checks,
                                      "hourly_summary": tables.summary}, base, partition_days=True)
    assert load.current_run(spark, base) == run
    back = load.read_published(spark, base, "hourly_summary")
    assert sorted(back.columns) == sorted(tables.summary.columns)
    assert back.count() == 937
    assert load.read_published(spark, base, "sensor_readings").count() == 1019


def test_machine_overview_rewrite_equals_naive_join(spark, tables):  # D11
    s, h = tables.readings.alias("s"), tables.summary.alias("h")
    naive = (s.join(h, F.col("s.machine_id") == F.col("h.machine_id"), "left")
             .groupBy(F.col("s.machine_id").alias("machine_id"))
             .agg(F.count(F.lit(1)).alias("reading_count"),
                  F.round(F.avg("s.temperature"), 6).alias("avg_temp"),
                  F.round(F.avg("h.defect_rate"), 6).alias("avg_defect_rate")))
    assert rows(reports.machine_overview(tables)) == rows(naive.select("machine_id", "reading_count", "avg_temp", "avg_defect_rate"))


def test_temp_vs_defects_rewrite_equals_naive_join(spark, tables):  # D10
    s = tables.readings.withColumn("s_hour", hour_bucket(F.col("timestamp"))).alias("s")
    h = tables.summary.alias("h")
    naive = (s.join(h, (F.col("s.machine_id") == F.col("h.machine_id")) & (F.col("s.s_hour") == F.col("h.hour")))
             .groupBy(F.col("h.machine_id").alias("machine_id"))
             .agg(F.round(F.avg("s.temperature"), 6).alias("avg_temp"),
                  F.round(F.avg("h.defect_rate"), 6).alias("avg_defect_rate")))
    assert rows(reports.temp_vs_defects(tables)) == rows(naive)


def test_line_literal_is_normalised(spark, tables):  # G2, Q19
    got = reports.line_recent_hours(tables, "Line_1").collect()
    assert len(got) == 10 and {r.line_id for r in got} == {"line_1"}


def test_checks_report(spark, tables):  # K4, K5, K11, K12, K1, K3
    assert checks.check_duplicate_ids(tables).first().duplicates == 19        # fan-out (Q8)
    assert checks.check_critical_nulls(tables).first().status == "fail"       # NULL timestamps
    status = checks.overall_status(tables).first()
    assert status.all_passed is False and status.failed_checks == 2
    assert {r.status for r in checks.check_tables_exist(spark, tables).collect()} == {"pass"}
    assert {r.status for r in checks.check_columns(spark, tables).collect()} == {"pass"}


def test_entry_contract(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.columns == ["machine_id", "avg_defect_rate"] and out.count() == 5
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)


ORACLE_SAMPLE = ["clean_sensor_data", "standardize_data", "join_sensor_quality", "hourly_summary",
                 "machine_overview", "temp_vs_defects", "validation_report", "line_pass_rate"]


@pytest.mark.parametrize("key", ORACLE_SAMPLE)
def test_oracle_agreement_sf0001(spark, key):
    import __spark_entry__ as E
    from shopfloor.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = E.queries()[key](spark, SF0001)
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    got = rows(df.select(*sorted(df.columns)))
    idx = [ocols.index(c) for c in sorted(ocols)]
    want = sorted((tuple(r[i] for i in idx) for r in res.fetchall()),
                  key=lambda t: tuple((v is None, v) for v in t))
    assert got == want


def test_contract_tables_and_published_checks(spark, tables):  # F1, K1 over published tables
    base = tempfile.mkdtemp(prefix="sf-db-")
    assert all(df is None for df in load.published_tables(spark, base).values())
    assert load.create_database(spark, base) is not None
    pub = load.published_tables(spark, base)
    assert {n: df.count() for n, df in pub.items()} == {"sensor_readings": 0, "quality_checks": 0,
                                                        "hourly_summary": 0}
    assert load.create_database(spark, base) is None        # already there: left alone
    t = reports.Tables(pub["sensor_readings"], None, pub["hourly_summary"])
    got = {r.table_name: r.status for r in checks.check_tables_exist(spark, t).collect()}
    assert got == {"sensor_readings": "pass", "quality_checks": "fail", "hourly_summary": "pass"}


def test_run_pipeline_observes_stage_rows(spark):  # F8, A10
    p = pipeline.from_sf_dir(spark, SF0001)
    rep = pipeline.run_pipeline(spark, p, tempfile.mkdtemp(prefix="sf-run-"))
    null_keys = p.joined.where("timestamp IS NULL OR machine_id IS NULL").count()
    assert rep.rows == {"joined": 1019, "sensor_readings": 1019, "quality_checks": 712,
                        "hourly_summary": 937, "joined_null_key_rows": null_keys}


def test_machine_trend_for_a_present_machine(spark, tables):  # G7 on a machine in the fixtures
    got = reports.machine_hourly_trend(tables, " Machine_1 ")
    want = tables.summary.where("machine_id = 'machine_1'").select(
        "hour", "avg_temperature", "avg_pressure", "avg_vibration", "defect_rate")
    assert got.count() == want.count() > 0
    assert [r.hour for r in got.collect()] == sorted((r.hour for r in want.collect()), reverse=True)


def test_published_tables_equal_the_lazy_ones(spark, tables):  # F8 sink pruning keeps results
    from shopfloor.plans.reports import round_doubles
    p = pipeline.from_sf_dir(spark, SF0001)
    base = tempfile.mkdtemp(prefix="sf-eq-")
    pipeline.run_pipeline(spark, p, base)
    pub = load.published_tables(spark, base)
    assert rows(pub["sensor_readings"].select(*tables.readings.columns)) == rows(tables.readings)
    assert rows(round_doubles(pub["hourly_summary"].select(*tables.summary.columns))) == \
        rows(round_doubles(tables.summary))
    assert rows(pub["quality_checks"]) == rows(tables.checks)


def test_pointer_survives_a_crash_and_old_runs_go(spark, tables):  # F5, F6
    base = tempfile.mkdtemp(prefix="sf-pointer-")
    one = {"sensor_readings": tables.readings.limit(1)}
    runs = [load.publish_tables(spark, one, base) for _ in range(2)]
    os.makedirs(f"{base}/pointers/version=3/_temporary/0")               # a pointer write that crashed
    assert load.current_run(spark, base) == runs[1]
    runs.append(load.publish_tables(spark, one, base, keep_runs=2))
    assert load.current_run(spark, base) == runs[2]
    assert sorted(os.listdir(f"{base}/runs")) == sorted(runs[1:])
    with pytest.raises(ValueError):
        load.drop_superseded(spark, base, 0)
    # runs without a pointer are not hidden behind empty tables
    shutil.rmtree(f"{base}/pointers")
    assert all(df is None for df in load.published_tables(spark, base).values())
    with pytest.raises(RuntimeError, match="no pointer"):
        load.create_database(spark, base)
