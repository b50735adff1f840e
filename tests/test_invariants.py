"""Property tests for cleaning and invariants of the whole job."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from core_helpers import SF001
from shopfloor.operators.clean import clean_sensor_data
from shopfloor.plans import pipeline
from shopfloor.schemas import SENSOR_RANGES

SENSORS = ("temperature", "pressure", "vibration")
VALUES = st.sampled_from([None, float("nan"), -999.0, -1.0, -0.5, 0.0, 3.5, 9.99, 10.0, 10.5,
                          55.0, 100.0, 100.01, 150.0, 151.0])


def model(rows):
    """The rules stated row by row: per sensor, NULL/NaN/-999/-1 and
    out-of-range values are missing; missing values take the last valid value
    so far (any machine); the flag is that of the last sensor needing repair:
    'estimated' when filled, 'invalid' when nothing came before."""
    last = {s: None for s in SENSORS}
    out = []
    for vals in rows:
        flag = "good"
        filled = []
        for s, v in zip(SENSORS, vals):
            lo, hi = SENSOR_RANGES[s]
            ok = v is not None and not math.isnan(v) and v not in (-999.0, -1.0) and lo <= v <= hi
            if ok:
                last[s] = v
            else:
                flag = "invalid" if last[s] is None else "estimated"
            filled.append(last[s])
        out.append((*filled, flag))
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(VALUES, VALUES, VALUES), min_size=1, max_size=40), st.integers(1, 6))
def test_cleaning_matches_the_rules(spark, rows, width):
    data = [(i, f"m{i % 3}", *vals, 1.0) for i, vals in enumerate(rows)]
    df = spark.createDataFrame(data, "row_no long, machine string, temperature double, "
                                     "pressure double, vibration double, power double")
    got = clean_sensor_data(df, "row_no", width=width).orderBy("row_no").collect()
    assert [(r.temperature, r.pressure, r.vibration, r.data_quality) for r in got] == model(rows)


def test_job_invariants(spark):
    p = pipeline.from_sf_dir(spark, SF001)
    clean = p.sensor_std
    # filled values stay inside their ranges
    for s in SENSORS:
        lo, hi = SENSOR_RANGES[s]
        assert clean.where(F.col(s).isNotNull() & ~F.col(s).between(lo, hi)).isEmpty()
    # record ids are dense: REC_00000000 .. REC_<n-1>, one per sensor row
    n = clean.count()
    ids = clean.agg(F.countDistinct("record_id").alias("d"), F.max("record_id").alias("m")).first()
    assert ids.d == n and ids.m == f"REC_{n - 1:08d}"
    # every joined row with complete keys is counted once in total_checks
    keyed = p.joined.where("timestamp IS NOT NULL AND machine_id IS NOT NULL AND line_id IS NOT NULL").count()
    agg = p.hourly.agg(F.sum("total_checks").alias("n"), F.min("defect_rate").alias("lo"),
                       F.max("defect_rate").alias("hi")).first()
    assert agg.n == keyed and 0.0 <= agg.lo and agg.hi <= 100.0
