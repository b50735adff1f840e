"""Cleaning semantics Q1-Q5 on hand-made rows."""

from core_helpers import rows
from shopfloor.operators.clean import clean_sensor_data

SCHEMA = "row_no long, machine string, temperature double, pressure double, vibration double, power double"


def clean(spark, data, schema=SCHEMA, **kw):
    return clean_sensor_data(spark.createDataFrame(data, schema), "row_no", **kw)


def by_row(df, *cols):
    return {r.row_no: tuple(r[c] for c in cols) for r in df.collect()}


def test_fill_is_global_not_per_machine(spark):  # Q1
    out = clean(spark, [(0, "a", 10.0, 1.0, 1.0, 1.0), (1, "b", None, 1.0, 1.0, 1.0),
                        (2, "a", None, 1.0, 1.0, 1.0)])
    assert by_row(out, "temperature") == {0: (10.0,), 1: (10.0,), 2: (10.0,)}


def test_error_codes_become_estimated_and_leading_invalid(spark):  # Q2, Q3
    out = clean(spark, [(0, "a", -999.0, 1.0, 1.0, 1.0), (1, "a", 20.0, 1.0, 1.0, 1.0),
                        (2, "a", -1.0, 1.0, 1.0, 1.0), (3, "a", 500.0, 1.0, 1.0, 1.0)])
    got = by_row(out, "temperature", "data_quality")
    assert got[0] == (None, "invalid")        # nothing before it to fill from
    assert got[1] == (20.0, "good")
    assert got[2] == (20.0, "estimated")      # error code, filled
    assert got[3] == (20.0, "estimated")      # out of range, filled: not 'invalid'


def test_flag_is_last_repaired_sensor(spark):  # Q4, both orders
    data = [(0, "a", None, 1.0, 1.0, 1.0),     # temp invalid (leading)
            (1, "a", 5.0, 1.0, None, 1.0),      # vibration estimated
            (2, "a", None, 1.0, 1.0, 1.0),      # temp estimated only
            (3, "a", None, None, 1.0, 1.0)]     # temp + pressure estimated
    got = by_row(clean(spark, data), "data_quality")
    assert got[0] == ("invalid",)
    # first row: temp invalid; vibration good -> 'invalid' stays (last non-good column)
    data2 = [(0, "a", 7.0, None, 1.0, 1.0), (1, "a", None, None, 1.0, 1.0)]
    got2 = by_row(clean(spark, data2), "data_quality")
    assert got2[0] == ("invalid",)             # pressure leading null
    assert got2[1] == ("invalid",)             # temp estimated, then pressure still invalid
    data3 = [(0, "a", None, 1.0, 1.0, 1.0), (1, "a", 3.0, 1.0, 1.0, 1.0), (2, "a", 4.0, None, 1.0, 1.0)]
    got3 = by_row(clean(spark, data3), "data_quality")
    assert got3[0] == ("invalid",) and got3[2] == ("estimated",)
    data4 = [(0, "a", 1.0, 1.0, None, 1.0), (1, "a", None, 1.0, None, 1.0)]
    got4 = by_row(clean(spark, data4), "data_quality")
    assert got4[1] == ("invalid",)             # temp estimated, vibration invalid -> invalid wins (later)


def test_range_ends_inclusive_and_power_untouched(spark):  # Q5
    data = [(0, "a", 0.0, 0.0, 0.0, -999.0), (1, "a", 150.0, 10.0, 100.0, -1.0),
            (2, "a", 150.01, 10.01, 100.01, 5.0)]
    got = by_row(clean(spark, data), "temperature", "pressure", "vibration", "power", "data_quality")
    assert got[0] == (0.0, 0.0, 0.0, -999.0, "good")
    assert got[1] == (150.0, 10.0, 100.0, -1.0, "good")
    assert got[2] == (150.0, 10.0, 100.0, 5.0, "estimated")


def test_nan_and_text_become_null(spark):
    out = clean(spark, [(0, "a", 5.0, 1.0, 1.0, 1.0), (1, "a", float("nan"), 1.0, 1.0, 1.0)])
    assert by_row(out, "temperature", "data_quality")[1] == (5.0, "estimated")
    text = clean(spark, [(0, "a", "12.5"), (1, "a", "oops")], "row_no long, machine string, temp_c string")
    assert by_row(text, "temp_c", "data_quality") == {0: (12.5, "good"), 1: (12.5, "estimated")}


def test_every_matching_column_is_cleaned_in_role_order(spark):
    # 'temp_inlet' and 'Temp_Outlet' are both temperature columns
    df = clean(spark, [(0, 1.0, 200.0), (1, None, 2.0)], "row_no long, temp_inlet double, Temp_Outlet double")
    assert by_row(df, "temp_inlet", "Temp_Outlet", "data_quality") == {
        0: (1.0, None, "invalid"), 1: (1.0, 2.0, "estimated")}


def test_column_in_two_roles_is_range_tested_twice(spark):
    # 'temp_pressure' is a temperature column and a pressure column
    df = clean(spark, [(0, 5.0), (1, 50.0), (2, None)], "row_no long, temp_pressure double")
    got = by_row(df, "temp_pressure", "data_quality")
    assert got[0] == (5.0, "good")
    assert got[1] == (5.0, "estimated")       # valid temperature, too high for pressure
    assert got[2] == (5.0, "estimated")


def test_bucketed_and_window_agree_on_flags(spark):
    data = [(i, "m", (None if i % 5 == 0 else float(i % 170)), float(i % 12), float(i % 110), 1.0)
            for i in range(200)]
    a = clean(spark, data, width=8)
    b = clean(spark, data, method="window")
    assert rows(a) == rows(b)
