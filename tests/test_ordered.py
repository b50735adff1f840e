import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from core_helpers import SF0001, rows
from shopfloor.functions.scalars import in_range, null_error_codes
from shopfloor.operators.ordered import RowOrder, ordered_pass
from shopfloor.schemas import SENSOR_RANGES
from shopfloor.sources import fixtures

SENSORS = ("temperature", "pressure", "vibration")


def _fills():
    return {c: in_range(null_error_codes(F.col(c)), *SENSOR_RANGES[c]) for c in SENSORS}


@pytest.mark.parametrize("width", [1, 7, 64, 4096])
def test_bucketed_fill_equals_single_window(spark, width):
    raw = fixtures.sensor_raw(spark, SF0001)
    a = ordered_pass(raw, "row_no", _fills(), position_col="pos", width=width)
    b = ordered_pass(raw, "row_no", _fills(), position_col="pos", method="window")
    cols = ("row_no", "pos", *SENSORS)
    assert rows(a, *cols) == rows(b, *cols)


def test_positions_are_dense(spark):
    raw = fixtures.sensor_raw(spark, SF0001).where("row_no % 3 <> 1")  # gaps in row_no
    out = ordered_pass(raw, "row_no", position_col="pos", width=16)
    got = [r.pos for r in out.orderBy("row_no").select("pos").collect()]
    assert got == list(range(len(got)))


def test_explicit_buckets_equal_numeric_order(spark):
    raw = fixtures.sensor_raw(spark, SF0001)
    split = raw.withColumn("file", (F.col("row_no") / 300).cast("int")).withColumn(
        "block", ((F.col("row_no") % 300) / 100).cast("int"))
    a = ordered_pass(split, RowOrder.explicit(["file", "block"], "row_no"), _fills(), position_col="pos")
    b = ordered_pass(raw, "row_no", _fills(), position_col="pos", method="window")
    cols = ("row_no", "pos", *SENSORS)
    assert rows(a, *cols) == rows(b, *cols)


def test_no_single_partition_exchange_on_rows(spark):
    raw = fixtures.sensor_raw(spark, SF0001)
    plan = ordered_pass(raw, "row_no", _fills(), position_col="pos")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "hashpartitioning(__bucket" in plan
    # the only single-partition exchange sits on the per-bucket table (after an aggregate)
    single = plan.split("SinglePartition")
    assert len(single) == 2
    assert "HashAggregate" in single[1]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)), min_size=1, max_size=60),
       st.integers(1, 9))
def test_fill_matches_pandas_ffill(spark, values, width):
    ids = list(range(len(values)))
    random.Random(len(values)).shuffle(ids)  # rows arrive in any order
    df = spark.createDataFrame([(i, values[i]) for i in ids], "row_no long, v double")
    out = ordered_pass(df, "row_no", {"v": F.col("v")}, width=width)
    got = [r.v for r in out.orderBy("row_no").collect()]
    want = pd.Series(values, dtype="float64").ffill().tolist()
    assert [None if (w != w) else w for w in want] == got


SPACED = 1 << 33


def _positions(spark, kind):
    raw = fixtures.sensor_raw(spark, SF0001)
    n = F.col("row_no")
    return raw.withColumn("row_no", {
        "sparse": n * SPACED,                                                     # far apart
        "outlier": F.when(n == 999, F.lit((1 << 62) - 1)).otherwise(n),           # dense and one far away
        "clusters": n + F.floor(n / 100) * SPACED,
        "negative": (n - 500) * 7,
        "beyond doubles": n + F.lit(1 << 60),                                     # neighbours that doubles confuse
    }[kind].cast("long"))


@pytest.mark.parametrize("kind", ["sparse", "outlier", "clusters", "negative", "beyond doubles"])
def test_buckets_are_balanced_whatever_the_positions(spark, kind):
    from shopfloor.operators.ordered import RowOrder as Order
    from shopfloor.operators.ordered import _bucketed_rows
    raw = _positions(spark, kind)
    a = ordered_pass(raw, "row_no", _fills(), position_col="pos", width=20)
    b = ordered_pass(raw, "row_no", _fills(), position_col="pos", method="window")
    cols = ("row_no", "pos", *SENSORS)
    assert rows(a, *cols) == rows(b, *cols)
    if kind != "beyond doubles":
        sizes = [r[1] for r in _bucketed_rows(raw, Order.numeric("row_no"), 20).groupBy("__bucket").count().collect()]
        assert len(sizes) >= 45 and max(sizes) <= 2 * 20 + 2


def test_small_inputs_take_several_buckets(spark):
    from shopfloor.operators.ordered import MIN_BUCKETS, bucket_cuts
    raw = fixtures.sensor_raw(spark, SF0001)
    assert len(bucket_cuts(raw, "row_no")) >= MIN_BUCKETS - 1


def test_finer_quantiles_where_the_grid_is_too_coarse(spark, monkeypatch):
    from shopfloor.operators import ordered as mod
    monkeypatch.setattr(mod, "GRID", 8)
    raw = fixtures.sensor_raw(spark, SF0001)
    assert len(mod.bucket_cuts(raw, "row_no", 20)) >= 45
    monkeypatch.setattr(mod, "MAX_BUCKETS", 30)
    assert len(mod.bucket_cuts(raw, "row_no", 1)) <= 30


def test_null_position_fails_loudly(spark):
    df = spark.createDataFrame([(0, 1.0), (None, 2.0), (2, None)], "row_no long, v double")
    with pytest.raises(Exception, match="holds NULL"):
        ordered_pass(df, "row_no", {"v": F.col("v")}, position_col="pos").collect()
