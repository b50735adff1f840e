"""Streaming hourly summary and defect alerts.

Every micro-batch reduces its joined readings to mergeable statistics per hour
group (count, mean, second moment, min, max, checks, defects).  The state is a
versioned store (``snapshots``) of three tables, committed once per batch with the
latest event time and the batch id, so a batch that is retried counts once:

* ``open``: statistics of the windows that may still get rows in time;
* ``windows``: those of the windows that ended at least ``delay`` before the latest
  event time, one row each, by day;
* ``alerts``: the last word on every closed window, by day.

A batch reads the open windows, its own rows and the days of windows that it closes
or that its late rows change -- not what earlier batches left behind.  Late rows are
merged like any other and listed in the ``late`` output of their batch.

``hourly_windows`` is the plain watermarked plan (append mode: each window once,
late rows dropped by Spark) for consumers that want only that.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import roles
from ..functions.scalars import defect_rate, hour_bucket
from ..operators.integrate import join_sensor_quality
from ..operators.load import DAY
from ..operators.stats import check_counts, combine_stats, group_columns, hour_stats, summary_of
from ..operators.summary import STAT_FUNCS
from ..schemas import DEFECT_ALERT_THRESHOLD
from ..sources.files import delete, parquet_if_any
from . import snapshots
from .snapshots import Snapshot

DELAY = "2 HOURS"


def hourly_windows(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """Watermark + tumbling hour windows (append mode)."""
    time, groups = roles.hourly_time_column(stream.columns), group_columns(stream.columns)
    sensors = roles.hourly_sensor_columns(stream.columns)
    # the watermark needs TIMESTAMP (with zone), not TIMESTAMP_NTZ; the session is UTC
    keyed = stream.dropna(subset=[time, *groups]).withColumn("event_time", F.col(time).cast("timestamp"))
    stats = [fn(F.col(c)).alias(f"{stat}_{role}") for role, c in sensors.items() for stat, fn in STAT_FUNCS]
    agg = (keyed.withWatermark("event_time", delay)
           .groupBy(F.window("event_time", "1 hour"), *groups).agg(*stats, *check_counts()))
    return agg.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), *groups,
                      *[f"{stat}_{role}" for role in sensors for stat, _ in STAT_FUNCS],
                      "total_checks", "defect_count",
                      defect_rate(F.col("defect_count"), F.col("total_checks")).alias("defect_rate"))


def _closed(hour: Column, latest: datetime | None, delay: str) -> Column:
    """The window ended at least ``delay`` before ``latest``."""
    if latest is None:
        return F.lit(False)
    return hour + F.expr("INTERVAL 1 HOUR") + F.expr(f"INTERVAL {delay}") <= F.lit(latest).cast("timestamp_ntz")


def alerts_of(summary: DataFrame, threshold: float = DEFECT_ALERT_THRESHOLD) -> DataFrame:
    """X3 rule on any summary frame."""
    return (summary.where(F.col("defect_rate") > F.lit(float(threshold)))
            .select("hour", *group_columns(summary.columns), "defect_rate", "defect_count", "total_checks"))


def _latest(snapshot: Snapshot) -> datetime | None:
    said = snapshot.notes.get("latest")
    return datetime.fromisoformat(said) if said else None


def _all(*parts: DataFrame | None) -> DataFrame:
    found = [p for p in parts if p is not None]
    out = found[0]
    for p in found[1:]:
        out = out.unionByName(p)
    return out


def absorb(spark: SparkSession, joined: DataFrame, batch_id: int, out_dir: str, delay: str = DELAY,
           threshold: float = DEFECT_ALERT_THRESHOLD) -> None:
    """foreachBatch body: merge one micro-batch into the state and commit it.  A
    batch that was committed before is left alone."""
    before = snapshots.current(spark, out_dir)
    if int(before.notes.get("batch", -1)) >= batch_id:
        return
    time, groups = roles.hourly_time_column(joined.columns), group_columns(joined.columns)
    scratch = session.scratch_path(spark, f"shopfloor-batch-{uuid.uuid4().hex}")
    passed = _latest(before)
    # rows without a time (the NULL = NULL pairs of the join among them) have no window and
    # are never late; their files hold no other rows, so the scan passes over them
    joined = joined.where(F.col(time).isNotNull()).persist()
    try:
        hour_stats(joined).write.parquet(f"{scratch}/stats")
        late = joined.where(_closed(hour_bucket(F.col(time)), passed, delay))
        late.write.mode("overwrite").parquet(f"{out_dir}/late/batch={batch_id}")
        reached = (joined.dropna(subset=[time, *groups])
                   .agg(F.max(F.col(time).cast("timestamp_ntz")).alias("latest")).first()["latest"])
    finally:
        joined.unpersist()
    now = max((t for t in (passed, reached) if t), default=None)

    stats = spark.read.parquet(f"{scratch}/stats")
    behind = _closed(F.col("hour"), passed, delay)                  # its late rows: their windows are closed
    waiting = snapshots.read(spark, out_dir, "open", before)
    waiting = None if waiting is None else waiting.drop(DAY)
    combine_stats(_all(waiting, stats.where(~behind))).write.parquet(f"{scratch}/pool")
    pool = spark.read.schema(stats.schema).parquet(f"{scratch}/pool")
    due = _closed(F.col("hour"), now, delay)
    changed = _all(pool.where(due), stats.where(behind)).withColumn(DAY, F.to_date("hour"))
    days = {r[0] for r in changed.select(DAY).distinct().collect()}   # calendar-bounded
    old = snapshots.read(spark, out_dir, "windows", before, days)
    closed = combine_stats(_all(None if old is None else old.drop(DAY), changed.drop(DAY))).withColumn(DAY, F.to_date("hour"))
    windows = snapshots.write(closed, out_dir, "windows")

    keys = changed.select("hour", *groups).distinct()
    written = snapshots.read(spark, out_dir, "windows", snapshots.of("windows", closed, windows))
    news = summary_of(written.drop(DAY).join(keys, ["hour", *groups], "left_semi")).select(
        "hour", *groups, "defect_rate", "defect_count", "total_checks",
        (F.col("defect_rate") > F.lit(float(threshold))).alias("active"), F.to_date("hour").alias(DAY))
    said = snapshots.read(spark, out_dir, "alerts", before, days)
    news = _all(None if said is None else said.join(keys, ["hour", *groups], "left_anti").select(*news.columns), news)
    still = pool.where(~due).withColumn(DAY, F.lit(None).cast("date"))
    snapshots.commit(
        spark, out_dir, before,
        {"windows": (closed, windows), "alerts": (news, snapshots.write(news, out_dir, "alerts")),
         "open": (still, snapshots.write(still, out_dir, "open"))},
        replaced={"windows": days, "alerts": days, "open": {None}},
        notes={"batch": str(batch_id)} | ({"latest": now.isoformat()} if now else {}))
    snapshots.drop_superseded(spark, out_dir, keep=2)               # one older version for its readers
    delete(spark, scratch)


def run_stream(spark: SparkSession, source_dir: str, schema, out_dir: str, delay: str = DELAY,
               threshold: float = DEFECT_ALERT_THRESHOLD, max_files_per_trigger: int | None = None) -> None:
    """X1 + X3 over every file of joined readings now in ``source_dir``
    (availableNow), then stop; the next run continues."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(source_dir).writeStream
         .foreachBatch(lambda df, k: absorb(spark, df, k, out_dir, delay, threshold))
         .option("checkpointLocation", f"{out_dir}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_raw_stream(spark: SparkSession, source_dir: str, schema, quality: DataFrame, cleaned_dir: str,
                   out_dir: str, delay: str = DELAY, threshold: float = DEFECT_ALERT_THRESHOLD,
                   disorder: str = "fail") -> None:
    """X1 end to end in one streaming query: raw readings are cleaned (fill and
    ids carried), joined with the standardised inspections by the batch job's
    join, and absorbed -- one batch id from the raw rows to the windows."""
    from . import cleaning

    def windows(cleaned: DataFrame, batch_id: int) -> None:
        absorb(spark, join_sensor_quality(cleaned, quality, check_empty=False), batch_id, out_dir, delay, threshold)

    cleaning.run_clean_stream(spark, source_dir, schema, cleaned_dir, disorder=disorder, then=windows)


def read_windows(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """Every window with ``state`` 'closed' or 'open'; None before the first batch."""
    now = snapshots.current(spark, out_dir)
    parts = [summary_of(rows.drop(DAY)).withColumn("state", F.lit(state))
             for table, state in (("windows", "closed"), ("open", "open"))
             if (rows := snapshots.read(spark, out_dir, table, now)) is not None]
    return _all(*parts) if parts else None


def read_late(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """Rows that came after their window had closed, with the batch they came in."""
    rows = parquet_if_any(spark, f"{out_dir}/late")
    done = int(snapshots.current(spark, out_dir).notes.get("batch", -1))
    return None if rows is None else rows.where(F.col("batch") <= done)


def read_alerts(spark: SparkSession, out_dir: str, threshold: float = DEFECT_ALERT_THRESHOLD) -> DataFrame | None:
    """Standing alerts: the last word of the alert sink on each closed window,
    and the open windows that are over the threshold now."""
    now = snapshots.current(spark, out_dir)
    sink, waiting = (snapshots.read(spark, out_dir, t, now) for t in ("alerts", "open"))
    parts = [] if sink is None else [sink.where("active").drop("active", DAY)]
    if waiting is not None:
        parts.append(alerts_of(summary_of(waiting.drop(DAY)), threshold))
    return _all(*parts) if parts else None


# --- registered queries ------------------------------------------------

def deliveries(df: DataFrame, order: str, parts: int = 3) -> list[DataFrame]:
    """``df`` cut into consecutive deliveries of about equal row counts."""
    cuts = df.selectExpr(f"percentile_approx({order}, array({','.join(str(k / parts) for k in range(1, parts))})) c") \
             .first()["c"] or []
    edges = [None, *cuts, None]
    out = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = df if lo is None else df.where(F.col(order) > F.lit(lo))
        out.append(part if hi is None else part.where(F.col(order) <= F.lit(hi)))
    return out


def _register():
    from ..plans import pipeline
    from ..plans.catalog import register
    from ..plans.oracle import P, summary_rounded
    from ..plans.reports import round_doubles
    from ..sources import fixtures

    def streamed(spark, sf_dir) -> str:
        """Joined readings in three deliveries, one micro-batch each."""
        p = pipeline.from_sf_dir(spark, sf_dir)
        base = session.scratch_path(spark, f"shopfloor-stream-{uuid.uuid4().hex}")
        for part in deliveries(p.joined, "row_no"):
            part.write.mode("append").parquet(f"{base}/source")
            run_stream(spark, f"{base}/source", p.joined.schema, f"{base}/windows")
        return f"{base}/windows"

    @register("stream_hourly_summary", f"SELECT {summary_rounded()} FROM summary")
    def q_stream_hourly_summary(spark, sf_dir):
        return round_doubles(read_windows(spark, streamed(spark, sf_dir)).drop("state"))

    @register("stream_pipeline_summary", f"SELECT {summary_rounded()} FROM summary")
    def q_stream_pipeline_summary(spark, sf_dir):
        """Raw sensor deliveries -> streaming clean -> stream-static join with
        the inspections -> windows, one micro-batch per delivery."""
        p = pipeline.from_sf_dir(spark, sf_dir)
        raw = fixtures.sensor_raw(spark, sf_dir)
        base = session.scratch_path(spark, f"shopfloor-stream-pipe-{uuid.uuid4().hex}")
        for part in deliveries(raw, "row_no"):
            part.write.mode("append").parquet(f"{base}/source")
            run_raw_stream(spark, f"{base}/source", raw.schema, p.quality_std, f"{base}/cleaned", f"{base}/windows")
        return round_doubles(read_windows(spark, f"{base}/windows").drop("state"))

    @register("defect_alerts", f"""
SELECT hour, machine_id, line_id, round(defect_rate, {P}) AS defect_rate, defect_count, total_checks
FROM summary WHERE defect_rate > 5.0""")
    def q_defect_alerts(spark, sf_dir):
        return round_doubles(read_alerts(spark, streamed(spark, sf_dir)))


_register()
