"""Streaming cleaner (fill carried across micro-batches), windows, incremental append."""

import datetime as dt
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from core_helpers import SF0001, rows
from shopfloor.operators.summary import hourly_summary
from shopfloor.plans import pipeline
from shopfloor.operators import load
from shopfloor.plans import checks as full_checks
from shopfloor.plans.reports import Tables, round_doubles
from shopfloor.sources import fixtures
from shopfloor.streaming import check_state, cleaning, hourly, incremental, snapshots


def test_stream_clean_equals_batch_across_batches(spark):
    raw = fixtures.sensor_raw(spark, SF0001)
    base = tempfile.mkdtemp(prefix="sf-stream-")
    src, out = f"{base}/src", f"{base}/out"
    for lo, hi in ((0, 100), (100, 101), (101, 640), (640, 1000)):   # uneven deliveries
        raw.where((F.col("row_no") >= lo) & (F.col("row_no") < hi)).write.mode("append").parquet(src)
        cleaning.run_clean_stream(spark, src, raw.schema, out)       # one micro-batch per delivery
    assert len(glob.glob(os.path.join(out, "batch=*"))) == 4
    got = spark.read.parquet(out).drop("batch")
    want = pipeline.from_sf_dir(spark, SF0001).sensor_std
    assert rows(got.select(*want.columns)) == rows(want)


def test_out_of_order_delivery_is_refused_or_set_aside(spark):
    raw = fixtures.sensor_raw(spark, SF0001)
    base = tempfile.mkdtemp(prefix="sf-order-")
    raw.where("row_no >= 10 and row_no < 500").write.parquet(f"{base}/first")
    raw.where("row_no < 10 or row_no >= 500").write.parquet(f"{base}/second")
    first, second = (spark.read.parquet(f"{base}/{k}") for k in ("first", "second"))
    cleaning.clean_batch(spark, first, 0, f"{base}/state", f"{base}/out")
    with pytest.raises(RuntimeError, match="at or before position 499"):
        cleaning.clean_batch(spark, second, 1, f"{base}/state", f"{base}/out")
    assert not os.path.exists(f"{base}/out/batch=1")                     # nothing was written
    cleaning.clean_batch(spark, second, 1, f"{base}/state", f"{base}/out", disorder="aside")
    assert spark.read.parquet(f"{base}/state/aside/batch=1").count() == 10
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == 990 and out.select("record_id").distinct().count() == 990
    with pytest.raises(RuntimeError, match="no carry"):                  # lost state is not a fresh start
        cleaning.clean_batch(spark, first, 3, f"{base}/elsewhere", f"{base}/out2")


def _joined(spark):
    p = pipeline.from_sf_dir(spark, SF0001)
    return p, p.joined.select("row_no", "timestamp", "machine_id", "line_id", "temperature", "pressure", "vibration",
                              "power", "quality_status")


def test_retried_batch_counts_once(spark):
    p, joined = _joined(spark)
    base = tempfile.mkdtemp(prefix="sf-retry-batch-")
    parts = hourly.deliveries(joined, "row_no")
    for k, part in enumerate(parts):
        hourly.absorb(spark, part, k, base)
    before = rows(round_doubles(hourly.read_windows(spark, base)))
    alerts = rows(round_doubles(hourly.read_alerts(spark, base)))
    hourly.absorb(spark, parts[2], 2, base)                              # the retry
    assert rows(round_doubles(hourly.read_windows(spark, base))) == before
    assert rows(round_doubles(hourly.read_alerts(spark, base))) == alerts
    want = round_doubles(p.hourly)
    assert rows(round_doubles(hourly.read_windows(spark, base)).select(*want.columns)) == rows(want)


def test_late_rows_and_open_windows_are_delivered(spark):
    p, joined = _joined(spark)
    base = tempfile.mkdtemp(prefix="sf-late-")
    parts = hourly.deliveries(joined, "row_no")
    for k, part in enumerate([parts[0], parts[2], parts[1]]):            # the middle comes last
        hourly.absorb(spark, part, k, base)
    late = hourly.read_late(spark, base)
    assert late.where("batch = 2").count() > 0 and late.where("batch < 2").count() == 0
    got = hourly.read_windows(spark, base)
    latest = joined.where("machine_id IS NOT NULL AND line_id IS NOT NULL").agg(F.max("timestamp")).first()[0]
    closed = F.col("hour") + F.expr("INTERVAL 3 HOURS") <= F.lit(latest)
    assert got.where(closed != (F.col("state") == "closed")).count() == 0
    assert got.where("state = 'open'").count() > 0
    want = round_doubles(p.hourly)
    assert rows(round_doubles(got).select(*want.columns)) == rows(want)  # late rows are in
    alerts = hourly.read_alerts(spark, base)
    assert rows(round_doubles(alerts)) == rows(round_doubles(hourly.alerts_of(p.hourly)))


def test_watermarked_plan_emits_the_closed_windows(spark):
    p, joined = _joined(spark)
    base = tempfile.mkdtemp(prefix="sf-win-")
    joined.write.parquet(f"{base}/src")
    plan = hourly.hourly_windows(spark.readStream.schema(joined.schema).parquet(f"{base}/src"))
    q = (plan.writeStream.outputMode("append").format("parquet").option("path", f"{base}/w")
         .option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start())
    q.awaitTermination()
    latest = joined.where("machine_id IS NOT NULL AND line_id IS NOT NULL").agg(F.max("timestamp")).first()[0]
    want = round_doubles(p.hourly.where(F.col("hour") + F.expr("INTERVAL 3 HOURS") <= F.lit(latest)))
    got = round_doubles(spark.read.parquet(f"{base}/w"))
    assert rows(got.select(*want.columns)) == rows(want)


def test_raw_stream_retry_keeps_windows(spark):
    p = pipeline.from_sf_dir(spark, SF0001)
    raw = fixtures.sensor_raw(spark, SF0001)
    base = tempfile.mkdtemp(prefix="sf-pipe-")
    for part in hourly.deliveries(raw, "row_no", 2):
        part.write.mode("append").parquet(f"{base}/src")
        hourly.run_raw_stream(spark, f"{base}/src", raw.schema, p.quality_std, f"{base}/clean", f"{base}/w")
    # the last batch again, as after a crash before its commit
    out = cleaning.clean_batch(spark, hourly.deliveries(raw, "row_no", 2)[1], 1, f"{base}/clean/_state", f"{base}/clean")
    hourly.absorb(spark, hourly.join_sensor_quality(spark.read.parquet(out), p.quality_std, check_empty=False), 1,
                  f"{base}/w")
    got = round_doubles(hourly.read_windows(spark, f"{base}/w"))
    want = round_doubles(p.hourly)
    assert rows(got.select(*want.columns)) == rows(want)


# --- X2 ----------------------------------------------------------------

SCHEMA = ("record_id string, timestamp timestamp_ntz, machine_id string, line_id string, temperature double, "
          "quality_status string")


def _readings(spark, *items):
    return spark.createDataFrame([(i, t and dt.datetime.fromisoformat(t), m, "l", v, s) for i, t, m, v, s in items],
                                 SCHEMA)


def _loads(spark):
    first = _readings(spark, ("R1", "2024-01-01T10:00", "a", 1.0, "not_checked"),
                      ("R2", "2024-01-01T10:00", "a", 2.0, "pass"),          # same time and machine
                      ("R3", None, "a", 3.0, "not_checked"), ("R4", None, "a", 4.0, "not_checked"),
                      ("R5", "2024-01-03T10:00", "b", 5.0, "pass"))
    second = _readings(spark, ("R1", "2024-01-01T10:00", "a", 1.0, "fail"),  # a late result, twice
                       ("R1", "2024-01-01T10:00", "a", 1.0, "pass"),
                       ("R4", None, "a", 4.5, "not_checked"), ("R6", None, "a", 6.0, "not_checked"),
                       ("R7", "2024-01-01T10:30", "a", 7.0, "pass"),
                       ("R5", "2024-01-04T10:00", "b", 5.0, "pass"))         # its time was corrected
    return first, second


def _want(spark):
    first, second = _loads(spark)
    return first.where("record_id in ('R2', 'R3')").unionByName(second)


def test_incremental_append_loses_nothing(spark):
    first, second = _loads(spark)
    assert rows(hourly_append(first, second)) == rows(_want(spark))
    assert rows(hourly_append(_want(spark), second)) == rows(_want(spark))     # again: no change
    got = incremental.refresh_summary(hourly_summary(first), first, second)
    assert rows(round_doubles(got)) == rows(round_doubles(hourly_summary(_want(spark)).select(*got.columns)))
    nameless = _readings(spark, (None, None, "a", 1.0, "pass"))
    with pytest.raises(Exception, match="record_id holds NULL"):
        hourly_append(first, nameless).collect()


def hourly_append(target, new):
    return incremental.incremental_append(target, new).select(*target.columns)


def test_incremental_load_on_disk(spark):
    first, second = _loads(spark)
    base = tempfile.mkdtemp(prefix="sf-inc-")
    for load in (first, second, second):                                       # a repeated load changes nothing
        incremental.incremental_load(spark, base, load)
    want = _want(spark)
    assert rows(incremental.read_joined(spark, base).select(*want.columns)) == rows(want)
    summary = hourly_summary(want)
    got = incremental.read_summary(spark, base).select(*summary.columns)
    assert rows(round_doubles(got)) == rows(round_doubles(summary))
    gone = dt.date(2024, 1, 3)
    now = snapshots.current(spark, base)
    assert gone not in now.days("joined") | now.days("hourly_summary")


def test_incremental_load_leaves_other_days_alone(spark):
    joined = pipeline.from_sf_dir(spark, SF0001).joined
    base = tempfile.mkdtemp(prefix="sf-days-")
    before = incremental.incremental_load(spark, base, joined.where("row_no < 700"))
    after = incremental.incremental_load(spark, base, joined.where("row_no >= 600 and timestamp is not null"))
    touched = {r[0] for r in joined.where("row_no >= 600").select(F.to_date("timestamp")).distinct().collect()}
    old = {e for e in before.folders if e[1] not in touched}
    assert old and old <= set(after.folders)
    want = joined.where("row_no < 700 or timestamp is not null")
    assert rows(incremental.read_joined(spark, base).select(*want.drop("record_id").columns)) == rows(want.drop("record_id"))
    full = hourly_summary(want)
    assert rows(round_doubles(incremental.read_summary(spark, base).select(*full.columns))) == rows(round_doubles(full))


def _raw(spark):
    return fixtures.sensor_raw(spark, SF0001), fixtures.quality_raw(spark, SF0001)


def test_deliveries_built_apart_keep_every_reading(spark):
    """Record ids start anew in every build; the readings are told apart all the same."""
    sensor, quality = _raw(spark)
    whole = pipeline.build(sensor, quality).joined
    base = tempfile.mkdtemp(prefix="sf-apart-")
    parts = [pipeline.build(sensor.where(cut), quality).joined for cut in ("row_no < 500", "row_no >= 500")]
    for part in (*parts, parts[0]):
        incremental.incremental_load(spark, base, part)
    got = incremental.read_joined(spark, base)
    assert rows(got, "row_no", "row_no_quality") == rows(whole, "row_no", "row_no_quality")
    ids = rows(got.select("row_no", "record_id").distinct())
    assert len(ids) == len({i for _, i in ids}) == sensor.count()


def test_raw_deliveries_equal_one_run(spark):
    whole = pipeline.from_sf_dir(spark, SF0001)
    base = tempfile.mkdtemp(prefix="sf-deliver-")
    parts = incremental.raw_deliveries(spark, SF0001)
    for k, (sensor, quality) in enumerate(parts):
        done = incremental.deliver(spark, base, sensor, quality, name=f"d{k}")
    assert incremental.deliver(spark, base, *parts[1], name="d1").version == done.version      # repeated
    assert incremental.deliver(spark, base, None, parts[3][1], name="d3").version == done.version
    with pytest.raises(incremental.DeliveryChanged):
        incremental.deliver(spark, base, parts[0][0], None, name="d1")
    got = incremental.read_joined(spark, base)
    assert rows(got.select(*whole.joined.columns)) == rows(whole.joined)
    summary = incremental.read_summary(spark, base)
    assert rows(round_doubles(summary.select(*whole.hourly.columns))) == rows(round_doubles(whole.hourly))


def test_check_state_equals_a_full_scan(spark):
    sensor, quality = _raw(spark)
    base = tempfile.mkdtemp(prefix="sf-state-")
    incremental.deliver(spark, base, None, quality.where("row_no >= 1500"))                # before any reading
    first = incremental.deliver(spark, base, sensor.where("row_no < 500"), quality.where("row_no < 800"))
    last = incremental.deliver(spark, base, sensor.where("row_no >= 500"), quality.where("row_no >= 800 and row_no < 1500"))
    kept = {e for e in first.folders if e[0] == "check_state"} & set(last.folders)
    assert kept                                                                            # untouched days
    state = incremental.read_check_state(spark, base)
    joined, checks = incremental.read_joined(spark, base), snapshots.read(spark, base, "inspections").drop("day")
    t = Tables(load.project_sensor_readings(joined), load.project_quality_checks(checks), incremental.read_summary(spark, base))
    assert rows(round_doubles(check_state.validation_report(state))) == rows(round_doubles(full_checks.validation_report(t)))
    assert check_state.top_machines(state).collect() == full_checks.check_top_machines(t).collect()


def test_delivery_without_name_readings_or_inspections(spark):
    sensor, quality = _raw(spark)
    base = tempfile.mkdtemp(prefix="sf-odd-")
    assert incremental.read_joined(spark, base) is None
    incremental.deliver(spark, base, None, quality.where("row_no < 400"))            # before any reading
    assert incremental.read_joined(spark, base) is None
    incremental.deliver(spark, base, sensor.where("row_no < 300"))
    incremental.deliver(spark, base, sensor.where("row_no >= 300 and row_no < 600"), quality.where(F.lit(False)))
    last = incremental.deliver(spark, base, sensor.where(F.lit(False)), quality.where("row_no >= 400"))
    assert incremental.deliver(spark, base, sensor.where("row_no < 300")).version == last.version
    want = pipeline.build(sensor.where("row_no < 600"), quality).joined
    got = incremental.read_joined(spark, base)
    assert rows(got.select(*want.columns)) == rows(want)


@pytest.mark.parametrize("step", ["hourly_summary", "manifest"])
def test_a_load_that_dies_leaves_the_old_pair(spark, monkeypatch, step):
    sensor, quality = _raw(spark)
    base = tempfile.mkdtemp(prefix="sf-dies-")
    first = incremental.deliver(spark, base, sensor.where("row_no < 500"), quality.where("row_no < 500"))
    before = rows(incremental.read_joined(spark, base)), rows(incremental.read_summary(spark, base))

    def dies(*args, real=snapshots.write, **kw):
        if step == "manifest":
            raise RuntimeError("lost")
        entries = real(*args)
        if args[2] == step:
            raise RuntimeError("lost")                                             # its files stand, nothing names them
        return entries

    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit" if step == "manifest" else "write", dies)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.deliver(spark, base, sensor.where("row_no >= 500"), quality.where("row_no >= 500"))
    os.makedirs(f"{base}/manifests/version={first.version + 1}")                   # a manifest write that died
    assert snapshots.current(spark, base).version == first.version
    assert (rows(incremental.read_joined(spark, base)), rows(incremental.read_summary(spark, base))) == before
    assert step == "manifest" or snapshots.drop_unnamed(spark, base) > 0
    incremental.deliver(spark, base, sensor.where("row_no >= 500"), quality.where("row_no >= 500"))
    want = pipeline.build(sensor, quality)
    assert rows(incremental.read_joined(spark, base).select(*want.joined.columns)) == rows(want.joined)


def test_readers_of_an_old_version_and_superseded_folders(spark):
    sensor, quality = _raw(spark)
    base = tempfile.mkdtemp(prefix="sf-old-")
    versions = [incremental.deliver(spark, base, sensor.where(f"row_no >= {lo} and row_no < {lo + 300}"),
                                    quality if lo == 600 else None) for lo in (0, 300, 600)]
    old = pipeline.build(sensor.where("row_no < 300"), quality.where("row_no < 0")).joined
    assert rows(incremental.read_joined(spark, base, versions[0]).select(*old.columns)) == rows(old)
    now = rows(incremental.read_joined(spark, base))
    assert snapshots.drop_superseded(spark, base, keep=2) > 0
    assert rows(incremental.read_joined(spark, base)) == now
    assert incremental.read_joined(spark, base, versions[1]).count() > 0
    with pytest.raises(snapshots.ConcurrentLoad):
        snapshots.commit(spark, base, versions[1], {})


def test_undated_rows_are_written_without_a_shuffle_by_day(spark):
    """They are joined with each other: a task that sorts them by day would hold all its copies."""
    base = tempfile.mkdtemp(prefix="sf-undated-")
    made = spark.range(400).repartition(8).selectExpr("id", "case when id % 4 = 0 then date'2024-01-01' end as day")
    entries = snapshots.write(made, base, "t", True)
    assert sorted((d is None, d) for _, d, _ in entries) == [(False, dt.date(2024, 1, 1)), (True, None)]
    undated = next(folder for _, d, folder in entries if d is None)
    files = glob.glob(f"{base}/{undated}/*.parquet")
    assert len(files) == 8                                                            # one of each task that made them
    got = snapshots.read(spark, base, "t", snapshots.of("t", made, entries))
    assert rows(got) == rows(made)
    dated = snapshots.write(made.where("day is not null"), base, "t", True)
    assert [d for _, d, _ in dated] == [dt.date(2024, 1, 1)]


def test_delivered_null_pairs_in_bounded_tasks(spark, monkeypatch):
    from shopfloor.operators import integrate
    sensor, quality = _raw(spark)
    sensor = sensor.withColumn("timestamp", F.expr("case when row_no % 5 > 0 then timestamp end"))
    quality = quality.withColumn("timestamp", F.expr("case when row_no % 5 > 0 then timestamp end"))
    want = pipeline.build(sensor, quality).joined
    monkeypatch.setattr(integrate, "PAIRS_PER_TASK", 200)
    base = tempfile.mkdtemp(prefix="sf-pairs-")
    incremental.deliver(spark, base, sensor.where("row_no < 500"), quality)
    incremental.deliver(spark, base, sensor.where("row_no >= 500"))
    assert rows(incremental.read_joined(spark, base).select(*want.columns)) == rows(want)
    full = hourly_summary(want)
    assert rows(round_doubles(incremental.read_summary(spark, base).select(*full.columns))) == rows(round_doubles(full))
