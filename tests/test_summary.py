"""Hourly roll-up semantics Q10-Q15."""

import datetime as dt

from shopfloor.operators.summary import hourly_summary

J = ("timestamp timestamp_ntz, machine_id string, line_id string, temperature double, "
     "pressure double, vibration double, power double, quality_status string")


def t(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def test_counts_rates_and_null_groups(spark):  # Q10, Q11, Q15
    data = [(t(8, 1), "m1", "l1", 10.0, 1.0, 1.0, 1.0, "pass"),
            (t(8, 30), "m1", "l1", 20.0, 1.0, 1.0, 1.0, "fail"),
            (t(8, 59), "m1", "l1", None, 1.0, 1.0, 1.0, "not_checked"),
            (t(9, 0), "m1", "l1", 5.0, 1.0, 1.0, 1.0, "not_checked"),
            (t(9, 0), None, "l1", 5.0, 1.0, 1.0, 1.0, "fail"),      # NULL key: dropped
            (None, "m1", "l1", 5.0, 1.0, 1.0, 1.0, "fail")]         # NULL hour: dropped
    out = hourly_summary(spark.createDataFrame(data, J))
    got = {r.hour: r for r in out.collect()}
    assert set(got) == {t(8), t(9)}
    h8 = got[t(8)]
    assert (h8.total_checks, h8.defect_count) == (3, 1)
    assert abs(h8.defect_rate - 100.0 / 3) < 1e-12
    assert (h8.avg_temperature, h8.min_temperature, h8.max_temperature) == (15.0, 10.0, 20.0)
    assert h8.std_temperature is not None
    h9 = got[t(9)]
    assert h9.std_temperature is None and h9.defect_rate == 0.0   # n = 1 -> NULL std


def test_right_side_group_column_is_a_key(spark):  # Q12
    data = [(t(8), "m1", "l1", "x", 1.0, "pass"), (t(8), "m1", "l1", None, 2.0, "pass")]
    df = spark.createDataFrame(data, "timestamp timestamp_ntz, machine_id string, line_id string, "
                                     "machine_type string, temperature double, quality_status string")
    out = hourly_summary(df)
    assert out.columns[:4] == ["hour", "machine_id", "line_id", "machine_type"]
    assert out.count() == 1      # the row with NULL machine_type is dropped


def test_last_column_of_a_role_wins_and_quality_excluded(spark):  # Q13
    df = spark.createDataFrame([(t(8), "m1", 1.0, 100.0, 7.0, "pass")],
                               "timestamp timestamp_ntz, machine_id string, temp_a double, temp_b double, "
                               "temp_quality double, quality_status string")
    r = hourly_summary(df).first()
    assert r.avg_temperature == 100.0


def test_date_only_time_gives_empty_summary(spark):  # Q14
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "m1", 1.0, "pass")],
                               "event_date timestamp_ntz, machine_id string, temperature double, quality_status string")
    assert hourly_summary(df).count() == 0
