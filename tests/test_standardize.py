import pytest
from pyspark.sql import functions as F

from shopfloor.functions.scalars import record_id, strip_lower
from shopfloor.operators.standardize import (coerce_timestamps, normalize_column_names,
                                             normalize_identifiers, standardize_data)


def test_column_names(spark):  # C1, Q21
    df = spark.createDataFrame([(1, 2)], ["  Machine ID ", "Temp Sensor 1"])
    assert normalize_column_names(df).columns == ["machine_id", "temp_sensor_1"]
    with pytest.raises(ValueError):
        normalize_column_names(spark.createDataFrame([(1, 2)], ["Temp", "temp "]))


def test_identifiers_lower_and_strip_text_only(spark):  # C3
    df = spark.createDataFrame([("\t Machine_7 ", 3, "Line A")], "machine_id string, line_no long, sensor string")
    r = normalize_identifiers(df).first()
    assert (r.machine_id, r.line_no, r.sensor) == ("machine_7", 3, "line a")


def test_time_columns_coerced_numeric_left_alone(spark):  # C2, Q22 not reproduced
    df = spark.createDataFrame([("2024-01-02 03:04:05", "bad", 17)], "event_time string, shift_date string, downtime long")
    r = coerce_timestamps(df).first()
    assert str(r.event_time) == "2024-01-02 03:04:05" and r.shift_date is None and r.downtime == 17


def test_record_ids_replace_old_and_follow_order(spark):  # C4, C5
    df = spark.createDataFrame([(5, "x"), (2, "y"), (9, "z")], "row_no long, record_id string")
    out = standardize_data(df, "row_no", width=2)
    assert out.columns == ["row_no", "record_id"]
    assert {r.row_no: r.record_id for r in out.collect()} == {2: "REC_00000000", 5: "REC_00000001",
                                                              9: "REC_00000002"}


def test_record_id_not_truncated(spark):
    r = spark.range(1).select(record_id(F.lit(123456789)).alias("id")).first()
    assert r.id == "REC_123456789"


def test_strip_lower(spark):
    r = spark.range(1).select(strip_lower(F.lit("  MaChInE_01\n")).alias("v")).first()
    assert r.v == "machine_01"


def test_roles_of_every_stage():  # A9
    from shopfloor.functions import roles
    sensor = ["Event Time", "Machine ID", "Line", "Temp 1", "temp_2", "Pressure", "Power"]
    quality = ["Check Date", "Status", "Machine ID", "Result", "Fault"]
    joined = ["event_time", "machine_id", "line", "temp_1", "temp_2", "pressure", "power", "data_quality", "record_id",
              "check_date", "machine_id_quality", "result", "fault", "quality_status"]
    got = roles.describe_roles(sensor, quality, joined)
    assert [r[1:] for r in got if r[0] == "clean"] == [("temperature", "Temp 1"), ("temperature", "temp_2"),
                                                       ("pressure", "Pressure")]
    assert ("join", "quality_time", "check_date") in got and ("join", "result", "result") in got
    assert [r[1:] for r in got if r[0] == "hourly"] == [
        ("time", "event_time"), ("group", "machine_id"), ("group", "line"),
        ("temperature", "temp_2"), ("pressure", "pressure"), ("power", "power")]       # the last of a role
    load = dict(r[1:] for r in got if r[0] == "load_readings")
    assert load["temperature"] == "temp_1" and load["record_id"] == "record_id"           # the first of a role
    assert dict(r[1:] for r in got if r[0] == "load_checks") == {
        "timestamp": "check_date", "machine_id": "machine_id", "result": "result", "defect_type": "fault"}
