"""Join semantics Q6-Q9, D2-D4."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from core_helpers import SF0001, rows
from shopfloor.operators import factorised, integrate
from shopfloor.operators.integrate import join_sensor_quality
from shopfloor.operators.summary import hourly_summary
from shopfloor.plans import pipeline
from shopfloor.plans.reports import round_doubles

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
T1 = dt.datetime(2024, 1, 1, 8, 5, 0)
S = "timestamp timestamp_ntz, machine_id string, record_id string, temperature double"
Q = "timestamp timestamp_ntz, machine_id string, result string"


def sensor(spark, data):
    return spark.createDataFrame(data, S)


def quality(spark, data, schema=Q):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("salt", [1, 4, 16])
def test_null_keys_match_by_default(spark, salt):  # Q6, salting keeps the result
    s = sensor(spark, [(None, "m1", "R0", 1.0), (T0, None, "R1", 2.0), (T0, "m1", "R2", 3.0)])
    q = quality(spark, [(None, "m1", "pass"), (None, "m1", "fail"), (T0, None, "FAIL x"), (T0, "m2", "pass")])
    out = join_sensor_quality(s, q, null_salt=salt)
    assert rows(out, "record_id", "result", "quality_status") == [
        ("R0", "fail", "fail"), ("R0", "pass", "pass"), ("R1", "FAIL x", "fail"),
        ("R2", None, "not_checked")]


def test_sql_null_rule(spark):
    s = sensor(spark, [(None, "m1", "R0", 1.0), (T0, "m1", "R2", 3.0)])
    q = quality(spark, [(None, "m1", "pass"), (T0, "m1", "pass")])
    out = join_sensor_quality(s, q, null_keys="sql")
    assert rows(out, "record_id", "result") == [("R0", None), ("R2", "pass")]


def test_fan_out_repeats_record(spark):  # Q8
    s = sensor(spark, [(T0, "m1", "R0", 1.0)])
    q = quality(spark, [(T0, "m1", "pass"), (T0, "m1", "fail"), (T1, "m1", "pass")])
    out = join_sensor_quality(s, q)
    assert [r.record_id for r in out.collect()] == ["R0", "R0"]


def test_status_rules(spark):  # Q9
    s = sensor(spark, [(T0, f"m{i}", f"R{i}", 1.0) for i in range(5)])
    q = quality(spark, [(T0, "m0", "Passed after fail"), (T0, "m1", "FAIL - rework"),
                        (T0, "m2", "inconclusive"), (T0, "m3", None), (T0, "m4", "PASS")])
    got = {r.record_id: r.quality_status for r in join_sensor_quality(s, q).collect()}
    assert got == {"R0": "pass", "R1": "fail", "R2": "not_checked", "R3": "not_checked", "R4": "pass"}


def test_first_machine_or_line_column_is_the_key(spark):  # Q7
    s = spark.createDataFrame([(T0, "l1", "m1", "R0")], "timestamp timestamp_ntz, line_id string, machine_id string, record_id string")
    q = spark.createDataFrame([(T0, "m9", "l1", "pass")], "timestamp timestamp_ntz, machine_id string, line_id string, result string")
    # sensor key = line_id ('l1'), quality key = machine_id ('m9'): no match
    out = join_sensor_quality(s, q)
    assert rows(out, "record_id", "quality_status") == [("R0", "not_checked")]
    # suffixes: quality's line_id collides -> line_id_quality; machine_id is its key and
    # named differently from the sensor key, so it is kept, colliding -> machine_id_quality
    assert out.columns == ["timestamp", "line_id", "machine_id", "record_id", "machine_id_quality",
                           "line_id_quality", "result", "quality_status"]


def test_time_only_when_a_side_has_no_machine(spark):  # D2
    s = spark.createDataFrame([(T0, "R0")], "timestamp timestamp_ntz, record_id string")
    q = quality(spark, [(T0, "m1", "pass"), (T0, "m2", "fail")])
    out = join_sensor_quality(s, q)
    assert rows(out, "record_id", "machine_id", "quality_status") == [("R0", "m1", "pass"), ("R0", "m2", "fail")]


def test_fallbacks(spark):  # D4
    s = sensor(spark, [(T0, "m1", "R0", 1.0)])
    no_time = spark.createDataFrame([("m1", "pass")], "machine_id string, result string")
    out = join_sensor_quality(s, no_time)
    assert out.columns == s.columns + ["quality_status"]
    assert out.first().quality_status == "not_checked"
    empty = quality(spark, [])
    out2 = join_sensor_quality(s, empty)
    assert out2.columns == s.columns + ["quality_status"]
    assert join_sensor_quality(s, None).first().quality_status == "not_checked"


def test_key_type_mismatch_raises(spark):
    s = spark.createDataFrame([(T0, 1, "R0")], "timestamp timestamp_ntz, machine_id long, record_id string")
    q = quality(spark, [(T0, "1", "pass")])
    with pytest.raises(TypeError):
        join_sensor_quality(s, q)


def test_text_time_on_quality_side_is_coerced(spark):  # D7
    s = sensor(spark, [(T0, "m1", "R0", 1.0)])
    q = spark.createDataFrame([("2024-01-01 08:00:00", "m1", "pass")], "timestamp string, machine_id string, result string")
    assert join_sensor_quality(s, q).first().quality_status == "pass"


def test_hot_null_key_spreads_over_tasks(spark):
    """A third of the sensor rows share one NULL-time key: with salting they
    meet the matching inspections in several join tasks, not one."""
    from pyspark.sql import functions as F

    hot = [(None, "m1", f"H{i}", 1.0) for i in range(150)]
    rest = [(T0 + dt.timedelta(seconds=i), f"m{i % 7}", f"R{i}", 2.0) for i in range(300)]
    s = sensor(spark, hot + rest)
    q = quality(spark, [(None, "m1", "pass"), (None, "m1", "fail")]
                + [(T0 + dt.timedelta(seconds=i), f"m{i % 7}", "pass") for i in range(0, 300, 3)])
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.adaptive.coalescePartitions.enabled",
                                            "spark.sql.adaptive.skewJoin.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")

        def tasks_for_hot(salt):
            out = join_sensor_quality(s, q, null_salt=salt).withColumn("pid", F.spark_partition_id())
            hot_rows = out.where(F.col("timestamp").isNull())
            assert hot_rows.count() == 300                       # 150 readings x 2 inspections
            return hot_rows.select("pid").distinct().count()

        assert tasks_for_hot(1) == 1
        assert tasks_for_hot(8) >= 4
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_latest_check_per_key_removes_fan_out(spark):  # SURVEY 4.3.6
    s = sensor(spark, [(T0, "m1", "R0", 1.0), (None, "m1", "R1", 2.0)])
    q = spark.createDataFrame([(1, T0, "m1", "pass"), (2, T0, "m1", "fail"), (3, None, "m1", "pass"),
                               (4, None, "m1", "FAIL late")],
                              "row_no long, timestamp timestamp_ntz, machine_id string, result string")
    out = join_sensor_quality(s, q, dedupe_checks="latest")
    assert rows(out, "record_id", "result", "quality_status") == [("R0", "fail", "fail"),
                                                                  ("R1", "FAIL late", "fail")]


def test_null_pairs_are_counted_without_pairing(spark):
    p = pipeline.from_sf_dir(spark, SF0001)
    null_rows, pairs = integrate.null_key_load(p.sensor_std, p.quality_std)
    null = "timestamp IS NULL OR machine_id IS NULL"
    assert null_rows == p.sensor_std.where(null).count()
    assert pairs == p.joined.where(f"({null}) AND record_id_quality IS NOT NULL").count() > 0
    few = pipeline.from_sf_dir(spark, SF0001, max_null_pairs=pairs - 1)
    with pytest.raises(integrate.NullKeyPairs):
        few.joined
    with pytest.raises(integrate.NullKeyPairs):
        few.readings
    sql = pipeline.from_sf_dir(spark, SF0001, null_keys="sql", max_null_pairs=0)
    assert sql.joined.where(f"({null}) AND record_id_quality IS NOT NULL").count() == 0
    assert (integrate.salt_for(0), integrate.salt_for(50_001), integrate.salt_for(10**12)) == (1, 2, 4096)


def test_totals_need_no_null_pairs(spark):
    """Summary and distribution under NULL = NULL, where no pair may be built."""
    whole, few = pipeline.from_sf_dir(spark, SF0001), pipeline.from_sf_dir(spark, SF0001, max_null_pairs=0)
    want = integrate.quality_status_distribution(whole.joined)
    assert rows(few.status_distribution.select(*want.columns)) == rows(want)
    want = hourly_summary(whole.joined)
    assert rows(round_doubles(few.summary.select(*want.columns))) == rows(round_doubles(want))
    with pytest.raises(integrate.NullKeyPairs):
        few.joined


@pytest.mark.parametrize("groups", ["line_id", "machine_id, line_id", "pack_line"])
def test_factorised_totals_of_any_grouping(spark, groups):
    """Keys that are no group of the summary, groups from the quality side (Q12), NULLs everywhere."""
    rng = random.Random(9)
    pick = lambda *xs: rng.choice(xs)
    left = [(pick(None, T0, T0 + dt.timedelta(hours=1)), T0 + dt.timedelta(minutes=rng.randint(0, 200)), pick(None, "m1", "m2"),
             pick("l1", "l2", None), pick(None, 1.0, 2.5, rng.random()), f"R{k}") for k in range(120)]
    right = [(pick(None, T0, T0 + dt.timedelta(hours=1)), pick(None, "m1", "m2"), pick("p1", None), pick("pass", "FAIL", None, "x"))
             for k in range(60)]
    s = spark.createDataFrame(left, "check_date timestamp_ntz, time timestamp_ntz, machine string, line_id string, temperature double, "
                                    "record_id string")
    s = s if "machine" in groups else s.withColumnRenamed("machine", "line_key").drop("line_id") if groups == "pack_line" else s
    q = spark.createDataFrame(right, "date timestamp_ntz, machine string, pack_line string, result string")
    joined = join_sensor_quality(s, q, null_salt=3)
    want = hourly_summary(joined)
    got = factorised.joined_hourly_summary(s, q)
    assert rows(round_doubles(got.select(*want.columns))) == rows(round_doubles(want)) and want.count() > 0
    want = integrate.quality_status_distribution(joined)
    assert rows(factorised.status_distribution(s, q).select(*want.columns)) == rows(want)


def test_factorised_without_inspections(spark):
    s = sensor(spark, [(T0, "m1", "R0", 1.0), (None, "m1", "R1", 2.0)])
    assert rows(factorised.status_distribution(s, None)) == [("not_checked", 2)]
    none = quality(spark, [])
    assert rows(factorised.status_distribution(s, none)) == [("not_checked", 2)]
    assert factorised.status_distribution(s.limit(0), none).count() == 0


def test_hot_real_key_is_salted_on_both_sides(spark):
    """One machine-time holds a third of the readings and of the inspections: the
    sketch finds it, both sides are dealt over salts, and the rows stay the same."""
    from pyspark.sql import functions as F

    hot_s = [(T0, "m1", f"H{i}", 1.0) for i in range(400)]
    rest = [(T0 + dt.timedelta(seconds=1 + i), f"m{i % 7}", f"R{i}", 2.0) for i in range(800)]
    s = sensor(spark, hot_s + rest + [(None, "m1", "N1", 3.0), (None, None, "N2", 3.0)])
    hot_q = [(T0, "m1", f"pass {i}") for i in range(90)]
    q = quality(spark, hot_q + [(T0 + dt.timedelta(seconds=1 + i), f"m{i % 7}", "fail") for i in range(0, 180)] + [(None, "m1", "pass")])
    keys = ["timestamp", "machine_id"]
    profiles = [integrate.key_profile(df, keys) for df in (s, q)]
    assert [p["rows"] for p in profiles] == [1202, 271] and [p["null_rows"] for p in profiles] == [2, 1]
    hot = integrate.hot_salts(*profiles, rows_per_salt=40)
    assert list(hot.values()) == [(10, 3)]
    assert integrate.hot_salts(*profiles) == {}                        # nothing is hot at the usual size
    only_left = integrate.hot_salts(profiles[0], None, rows_per_salt=40)
    other = {spark.range(1).select(F.xxhash64(F.lit(T0).cast("timestamp_ntz"), F.lit("nobody"))).first()[0]: (2, 2)}
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")          # no help from run-time splits
        for rule in ("match", "sql"):
            want = rows(join_sensor_quality(s, q, null_keys=rule))
            for salts in (hot, only_left, hot | other):
                assert rows(join_sensor_quality(s, q, null_keys=rule, hot=salts)) == want
        loads = (join_sensor_quality(s, q, hot=hot).where("record_id LIKE 'H%'").groupBy(F.spark_partition_id().alias("p"))
                 .count().collect())
        assert sum(r["count"] for r in loads) == 400 * 90
        assert len(loads) >= 4 and max(r["count"] for r in loads) < 400 * 90 / 2
        gone = quality(spark, hot_q[:0] + [(T0, "m2", "pass")])        # hot on the left, no inspection
        assert rows(join_sensor_quality(s, gone, hot=hot)) == rows(join_sensor_quality(s, gone))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


# --- NULL = NULL pairs that are many -----------------------------------------------

def _null_heavy(spark):
    left = [(None, f"m{i % 3}" if i % 5 else None, f"R{i}", float(i)) for i in range(120)] + [(T0, None, "X", 1.0), (T0, "m1", "Y", 2.0)]
    right = [(None, f"m{i % 2}" if i % 7 else None, "pass" if i % 2 else "fail") for i in range(60)] + [(T0, "m1", "pass")]
    return sensor(spark, left), quality(spark, right)


@pytest.mark.parametrize("columns", [("timestamp", "machine_id"), ("timestamp",)])
def test_many_null_pairs_are_joined_in_bounded_tasks(spark, monkeypatch, columns):
    s, q = _null_heavy(spark)
    if columns == ("timestamp",):
        s = s.drop("machine_id")
    want = join_sensor_quality(s, q)
    pairs = integrate.null_key_load(s, q)[1]
    assert pairs > 1000
    monkeypatch.setattr(integrate, "PAIRS_PER_TASK", 100)
    got = join_sensor_quality(s, q, null_pairs=pairs)
    assert rows(got.select(*want.columns)) == rows(want)                     # readings without a partner too
    by_task = got.withColumn("task", F.spark_partition_id()).where("timestamp is null and result is not null").groupBy("task").count()
    assert by_task.agg(F.max("count")).first()[0] <= 600 < pairs


def test_the_job_counts_its_null_pairs(spark, monkeypatch):
    s, q = _null_heavy(spark)
    s, q = (df.withColumn("row_no", F.monotonically_increasing_id()) for df in (s, q))
    q = q.withColumn("inspection_status", F.lit("completed"))
    want = rows(pipeline.build(s, q).joined)
    monkeypatch.setattr(integrate, "PAIRS_PER_TASK", 100)
    monkeypatch.setattr(pipeline, "PAIRS_PER_TASK", 100)
    found = pipeline.build(s, q)
    assert rows(found.joined) == want and found.null_pairs > 1000
    with pytest.raises(integrate.NullKeyPairs):
        pipeline.build(s, q, max_null_pairs=0).joined
