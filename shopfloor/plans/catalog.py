"""Registry: query key -> Spark callable (spark, sf_dir) and DuckDB oracle SQL.

tables (through the fixture views over ``events``) and runs over whole
tables; a LIMIT appears only where a top-k or a sample is the point.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions.scalars import hour_bucket, in_range, null_error_codes
from ..operators import clean, integrate, load, ordered, standardize, summary
from ..schemas import SENSOR_RANGES
from ..sources import extract, fixtures
from ..sources.files import exists, state
from ..sources.tables import read_table
from . import checks, pipeline, reports
from .oracle import P, summary_rounded, with_pipeline
from .reports import Tables


@dataclass(frozen=True)
class Query:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: str | None):
    def deco(fn):
        REGISTRY[key] = Query(key, fn, with_pipeline(sql) if sql is not None else None)
        return fn
    return deco


_PLANS: dict[tuple, pipeline.Pipeline] = {}


def _source(spark: SparkSession, sf_dir: str) -> tuple:
    """What a plan or a published run over one folder depends on."""
    return spark.sparkContext.applicationId, sf_dir, state(spark, f"{sf_dir}/events.parquet")


def _pipe(spark: SparkSession, sf_dir: str) -> pipeline.Pipeline:
    """The lazy pipeline over one folder, built once per Spark application and state
    of the folder's files.

    Only the logical plan is kept (no data is cached): every query still
    runs from the source tables.
    """
    session.configure(spark)
    key = _source(spark, sf_dir)
    if key not in _PLANS:
        _PLANS[key] = pipeline.from_sf_dir(spark, sf_dir)
    return _PLANS[key]


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    p = _pipe(spark, sf_dir)
    return Tables(p.readings, p.checks, p.hourly)


def _sensor(spark, sf_dir):
    session.configure(spark)
    return fixtures.sensor_raw(spark, sf_dir)


def _quality(spark, sf_dir):
    session.configure(spark)
    return fixtures.quality_raw(spark, sf_dir)


SENSORS = ("temperature", "pressure", "vibration")

# --- A: extract --------------------------------------------------------


@register("parse_event_time", "SELECT row_no, timestamp FROM sensor_raw")
def q_parse_event_time(spark, sf_dir):
    raw = _sensor(spark, sf_dir)
    as_text = raw.select("row_no", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"))
    parsed, _ = extract.parse_first_time_column(as_text)
    return parsed


@register("time_coverage", """
SELECT 'sensor' AS source, count(*) AS rows, min(timestamp) AS min_time, max(timestamp) AS max_time FROM sensor_raw
UNION ALL
SELECT 'quality' AS source, count(*) AS rows, min(timestamp) AS min_time, max(timestamp) AS max_time FROM quality_raw""")
def q_time_coverage(spark, sf_dir):
    return (extract.time_coverage(_sensor(spark, sf_dir), "sensor")
            .unionByName(extract.time_coverage(_quality(spark, sf_dir), "quality")))


@register("recency_filter", "SELECT * FROM sensor_raw WHERE timestamp >= TIMESTAMP '2024-01-24 00:00:00'")
def q_recency_filter(spark, sf_dir):
    return extract.extract_sensor(_sensor(spark, sf_dir), days_back=7, as_of="2024-01-31 00:00:00")


@register("recency_fallback", """
SELECT * FROM sensor_raw WHERE timestamp >= TIMESTAMP '2024-12-01 00:00:00'
  OR NOT EXISTS (SELECT 1 FROM sensor_raw WHERE timestamp >= TIMESTAMP '2024-12-01 00:00:00')""")
def q_recency_fallback(spark, sf_dir):
    return extract.extract_sensor(_sensor(spark, sf_dir), days_back=7, as_of="2024-12-08 00:00:00")


@register("completed_inspections", "SELECT * FROM quality_x")
def q_completed(spark, sf_dir):
    return extract.extract_quality(_quality(spark, sf_dir))


@register("stage_counts", """
SELECT 'sensor_raw' AS stage, count(*) AS rows FROM sensor_raw UNION ALL
SELECT 'quality_raw', count(*) FROM quality_raw UNION ALL
SELECT 'quality_completed', count(*) FROM quality_x UNION ALL
SELECT 'sensor_clean', count(*) FROM sensor_clean UNION ALL
SELECT 'joined', count(*) FROM joined UNION ALL
SELECT 'hourly_summary', count(*) FROM summary UNION ALL
SELECT 'quality_checks', count(*) FROM checks""")
def q_stage_counts(spark, sf_dir):
    p, run = _pipe(spark, sf_dir), _published(spark, sf_dir)
    # stages that the job has written are counted there (a reading per joined row)
    return extract.stage_counts({
        "sensor_raw": p.sensor_raw, "quality_raw": p.quality_raw,
        "quality_completed": p.quality_extracted, "sensor_clean": p.sensor_clean,
        "joined": run.readings, "hourly_summary": run.summary, "quality_checks": run.checks})


# --- B: cleaning -------------------------------------------------------

@register("null_error_codes", "SELECT row_no, t1 AS temperature, p1 AS pressure, v1 AS vibration FROM sensor_b1")
def q_null_error_codes(spark, sf_dir):
    raw = _sensor(spark, sf_dir)
    return raw.select("row_no", *[null_error_codes(F.col(c)).alias(c) for c in SENSORS])


@register("range_validate", "SELECT row_no, t2 AS temperature, p2 AS pressure, v2 AS vibration FROM sensor_b2")
def q_range_validate(spark, sf_dir):
    raw = _sensor(spark, sf_dir)
    return raw.select("row_no", *[in_range(null_error_codes(F.col(c)), *SENSOR_RANGES[c]).alias(c)
                                  for c in SENSORS])


@register("forward_fill", "SELECT row_no, t3 AS temperature, p3 AS pressure, v3 AS vibration FROM sensor_b3")
def q_forward_fill(spark, sf_dir):
    raw = _sensor(spark, sf_dir).select("row_no", *SENSORS)
    fills = {c: in_range(null_error_codes(F.col(c)), *SENSOR_RANGES[c]) for c in SENSORS}
    return ordered.ordered_pass(raw, "row_no", fills)


@register("quality_flag", "SELECT row_no, data_quality FROM sensor_clean")
def q_quality_flag(spark, sf_dir):
    return clean.clean_sensor_data(_sensor(spark, sf_dir)).select("row_no", "data_quality")


@register("quality_flag_distribution",
          "SELECT data_quality, count(*) AS count FROM sensor_clean GROUP BY data_quality")
def q_quality_flag_distribution(spark, sf_dir):
    return clean.quality_flag_distribution(clean.clean_sensor_data(_sensor(spark, sf_dir)))


@register("clean_sensor_data", "SELECT * FROM sensor_clean")
def q_clean_sensor_data(spark, sf_dir):
    return clean.clean_sensor_data(_sensor(spark, sf_dir))


# --- C: standardisation ------------------------------------------------

@register("normalize_column_names", """
SELECT row_no, timestamp AS time_stamp, machine_id, line_id, temperature AS temperature_c,
  pressure, vibration, power FROM sensor_raw""")
def q_normalize_column_names(spark, sf_dir):
    raw = _sensor(spark, sf_dir).toDF(" Row No", "Time Stamp ", "Machine ID", " Line ID",
                                      "Temperature C", "Pressure", "Vibration", "POWER")
    return standardize.normalize_column_names(raw)


@register("coerce_timestamps", """
SELECT row_no, timestamp, CAST(CAST(timestamp AS DATE) AS TIMESTAMP) AS shift_date FROM sensor_raw""")
def q_coerce_timestamps(spark, sf_dir):
    raw = _sensor(spark, sf_dir).select(
        "row_no", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.date_format("timestamp", "yyyy-MM-dd").alias("shift_date"))
    return standardize.coerce_timestamps(raw)


@register("normalize_identifiers",
          "SELECT row_no, lower(trim(machine_id)) AS machine_id, lower(trim(line_id)) AS line_id FROM sensor_raw")
def q_normalize_identifiers(spark, sf_dir):
    return standardize.normalize_identifiers(_sensor(spark, sf_dir).select("row_no", "machine_id", "line_id"))


@register("drop_existing_id", "SELECT row_no, record_id FROM sensor_std")
def q_drop_existing_id(spark, sf_dir):
    raw = _sensor(spark, sf_dir).select("row_no", F.concat(F.lit("OLD_"), F.col("row_no")).alias("record_id"))
    return standardize.assign_record_ids(raw, "row_no").select("row_no", "record_id")


@register("assign_record_id", "SELECT row_no, record_id FROM sensor_std")
def q_assign_record_id(spark, sf_dir):
    return standardize.assign_record_ids(_sensor(spark, sf_dir).select("row_no"), "row_no")


@register("standardize_data", "SELECT * FROM sensor_std")
def q_standardize_data(spark, sf_dir):
    return _pipe(spark, sf_dir).sensor_std


# --- D: joins ----------------------------------------------------------

@register("join_time_machine",
          "SELECT record_id, timestamp, machine_id, record_id_quality, result FROM joined")
def q_join_time_machine(spark, sf_dir):
    return _pipe(spark, sf_dir).joined.select("record_id", "timestamp", "machine_id",
                                              "record_id_quality", "result")


@register("join_time_only", """
SELECT s.record_id, s.timestamp, q.machine_id, q.record_id AS record_id_quality, q.result
FROM sensor_std s LEFT JOIN quality_std q ON s.timestamp IS NOT DISTINCT FROM q.timestamp""")
def q_join_time_only(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    sensor = p.sensor_std.drop("machine_id", "line_id")
    pairs = p.null_pairs_without("machine_id", "line_id")
    j = integrate.join_sensor_quality(sensor, p.quality_std, null_pairs=pairs)
    return j.select("record_id", "timestamp", "machine_id", "record_id_quality", "result")


@register("suffix_collisions",
          "SELECT record_id, row_no_quality, line_id_quality, record_id_quality FROM joined")
def q_suffix_collisions(spark, sf_dir):
    return _pipe(spark, sf_dir).joined.select("record_id", "row_no_quality", "line_id_quality",
                                              "record_id_quality")


@register("join_fallbacks", "SELECT record_id, 'not_checked' AS quality_status FROM sensor_std")
def q_join_fallbacks(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    j = integrate.join_sensor_quality(p.sensor_std, p.quality_std.drop("timestamp"))
    return j.select("record_id", "quality_status")


@register("quality_status", "SELECT record_id, result, quality_status FROM joined")
def q_quality_status(spark, sf_dir):
    return _pipe(spark, sf_dir).joined.select("record_id", "result", "quality_status")


@register("quality_status_distribution",
          "SELECT quality_status, count(*) AS count FROM joined GROUP BY quality_status")
def q_quality_status_distribution(spark, sf_dir):
    return _pipe(spark, sf_dir).status_distribution


@register("restandardize_quality", "SELECT record_id, record_id_quality, quality_status FROM joined")
def q_restandardize_quality(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    q_text = p.quality_std.withColumn("timestamp",
                                      F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    j = integrate.join_sensor_quality(p.sensor_std, q_text, null_pairs=p.null_pairs)
    return j.select("record_id", "record_id_quality", "quality_status")


@register("join_sensor_quality", "SELECT * FROM joined")
def q_join_sensor_quality(spark, sf_dir):
    return _pipe(spark, sf_dir).joined


@register("dedupe_checks_latest", """
SELECT s.record_id, q.result,
  CASE WHEN contains(lower(q.result), 'pass') THEN 'pass'
       WHEN contains(lower(q.result), 'fail') THEN 'fail' ELSE 'not_checked' END AS quality_status
FROM sensor_std s LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY timestamp, machine_id ORDER BY row_no DESC) AS rn
                 FROM quality_std) WHERE rn = 1) q
  ON s.timestamp IS NOT DISTINCT FROM q.timestamp AND s.machine_id IS NOT DISTINCT FROM q.machine_id""")
def q_dedupe_checks_latest(spark, sf_dir):
    """SURVEY 4.3.6: the last inspection per (time, machine) only, no fan-out."""
    p = pipeline.from_sf_dir(spark, sf_dir, dedupe_checks="latest")
    return p.joined.select("record_id", "result", "quality_status")


@register("readings_with_checks", """
SELECT s.timestamp, s.machine_id, s.temperature, q.result AS quality_result
FROM readings s LEFT JOIN checks q ON s.machine_id = q.machine_id AND s.timestamp = q.timestamp""")
def q_readings_with_checks(spark, sf_dir):
    return reports.readings_with_checks(_published(spark, sf_dir))


@register("temp_vs_defects", f"""
SELECT h.machine_id, round(avg(s.temperature), {P}) AS avg_temp, round(avg(h.defect_rate), {P}) AS avg_defect_rate
FROM readings s JOIN summary h ON s.machine_id = h.machine_id AND date_trunc('hour', s.timestamp) = h.hour
GROUP BY h.machine_id""")
def q_temp_vs_defects(spark, sf_dir):
    return reports.temp_vs_defects(_published(spark, sf_dir))


@register("machine_overview", f"""
SELECT s.machine_id, count(*) AS reading_count, round(avg(s.temperature), {P}) AS avg_temp,
  round(avg(h.defect_rate), {P}) AS avg_defect_rate
FROM readings s LEFT JOIN summary h ON s.machine_id = h.machine_id GROUP BY s.machine_id""")
def q_machine_overview(spark, sf_dir):
    return reports.machine_overview(_published(spark, sf_dir))


# --- E: hourly roll-up -------------------------------------------------

@register("hour_bucket", "SELECT record_id, timestamp, date_trunc('hour', timestamp) AS hour FROM readings")
def q_hour_bucket(spark, sf_dir):
    r = _tables(spark, sf_dir).readings
    return r.select("record_id", "timestamp", hour_bucket(F.col("timestamp")).alias("hour"))


@register("hourly_group_keys", "SELECT hour, machine_id, line_id FROM summary")
def q_hourly_group_keys(spark, sf_dir):
    return _tables(spark, sf_dir).summary.select("hour", "machine_id", "line_id")


_STAT_COLS = [f"{st}_{s}" for s in ("temperature", "pressure", "vibration", "power")
              for st in ("avg", "min", "max", "std")]


@register("hourly_sensor_stats", "SELECT hour, machine_id, line_id, "
          + ", ".join(f"round({c}, {P}) AS {c}" for c in _STAT_COLS) + " FROM summary")
def q_hourly_sensor_stats(spark, sf_dir):
    s = _tables(spark, sf_dir).summary
    return reports.round_doubles(s.select("hour", "machine_id", "line_id", *_STAT_COLS))


@register("hourly_quality_stats", "SELECT hour, machine_id, line_id, total_checks, defect_count FROM summary")
def q_hourly_quality_stats(spark, sf_dir):
    return _tables(spark, sf_dir).summary.select("hour", "machine_id", "line_id", "total_checks",
                                                 "defect_count")


@register("defect_rate", f"SELECT hour, machine_id, line_id, round(defect_rate, {P}) AS defect_rate FROM summary")
def q_defect_rate(spark, sf_dir):
    s = _tables(spark, sf_dir).summary
    return s.select("hour", "machine_id", "line_id", F.round("defect_rate", P).alias("defect_rate"))


@register("hourly_summary", f"SELECT {summary_rounded()} FROM summary")
def q_hourly_summary(spark, sf_dir):
    return reports.round_doubles(summary.hourly_summary(_pipe(spark, sf_dir).joined))


@register("ordered_sparse_positions", """
SELECT event_id, position, last_value(v IGNORE NULLS) OVER (ORDER BY spot ROWS UNBOUNDED PRECEDING) AS filled
FROM (SELECT event_id, spot, v, row_number() OVER (ORDER BY spot) - 1 AS position FROM (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id ELSE event_id * 8589934592 END AS spot,
         CASE WHEN event_type <> 'error' THEN value END AS v FROM events) e) n""")
def q_ordered_sparse_positions(spark, sf_dir):
    """The ordered pass over positions half dense, half 2^33 apart."""
    at = F.when(F.col("event_id") % 2 == 0, F.col("event_id")).otherwise(F.col("event_id") * F.lit(1 << 33))
    rows = read_table(spark, sf_dir, "events").select(
        "event_id", at.alias("at"), F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return ordered.ordered_pass(rows, "at", {"filled": F.col("v")}, position_col="position") \
        .select("event_id", "position", "filled")


# --- F: load -----------------------------------------------------------

@register("project_sensor_readings", "SELECT * FROM readings")
def q_project_sensor_readings(spark, sf_dir):
    return _tables(spark, sf_dir).readings


@register("project_quality_checks", "SELECT * FROM checks")
def q_project_quality_checks(spark, sf_dir):
    return _tables(spark, sf_dir).checks


@register("project_hourly_summary", f"SELECT {summary_rounded()} FROM summary")
def q_project_hourly_summary(spark, sf_dir):
    return reports.round_doubles(_tables(spark, sf_dir).summary)


_COUNTS_SQL = """
SELECT 'sensor_readings' AS table_name, count(*) AS rows FROM readings UNION ALL
SELECT 'quality_checks', count(*) FROM checks UNION ALL
SELECT 'hourly_summary', count(*) FROM summary"""


@register("verify_counts", _COUNTS_SQL)
def q_verify_counts(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return load.verify_counts(t.readings, t.checks, t.summary)


@register("run_pipeline", _COUNTS_SQL)
def q_run_pipeline(spark, sf_dir):
    """Write the three tables of one run, publish, read back."""
    import uuid

    p = _pipe(spark, sf_dir)
    base = session.scratch_path(spark, f"shopfloor-tables-{uuid.uuid4().hex}")
    pipeline.run_pipeline(spark, p, base)
    pub = load.published_tables(spark, base)
    return load.verify_counts(pub["sensor_readings"], pub["quality_checks"], pub["hourly_summary"])


@register("write_replace", _COUNTS_SQL)
def q_write_replace(spark, sf_dir):
    """a second run replaces the first (nothing is appended).  The first
    run is the job with a 7-day recency window, the second the full job."""
    import uuid

    p = _pipe(spark, sf_dir)
    week = pipeline.from_sf_dir(spark, sf_dir, days_back=7, as_of="2024-01-31 00:00:00")
    base = session.scratch_path(spark, f"shopfloor-replace-{uuid.uuid4().hex}")
    load.publish_tables(spark, week.tables(), base)
    load.publish_tables(spark, p.tables(), base)
    pub = load.published_tables(spark, base)
    return load.verify_counts(pub["sensor_readings"], pub["quality_checks"], pub["hourly_summary"])


@register("commit_rollback", _COUNTS_SQL)
def q_commit_rollback(spark, sf_dir):
    """a run that fails while writing leaves the published run in place.

    The full job is published, then a run of the last seven days (other row
    counts) breaks after its first tables were written.  The failure must be
    raised as simulated, and the counts must still be those of the full job.
    """
    import uuid

    p = _pipe(spark, sf_dir)
    base = session.scratch_path(spark, f"shopfloor-rollback-{uuid.uuid4().hex}")
    good = load.publish_tables(spark, p.tables(), base)
    broken = pipeline.from_sf_dir(spark, sf_dir, days_back=7, as_of="2024-01-31 00:00:00").tables()
    broken["hourly_summary"] = broken["hourly_summary"].withColumn(
        "defect_rate", F.raise_error(F.lit(_SIMULATED)).cast("double"))
    try:
        load.publish_tables(spark, broken, base, run_id="broken", parallel=False)
    except Exception as exc:  # noqa: BLE001 - any class; the message must be ours
        if _SIMULATED not in str(exc):
            raise
    else:
        raise AssertionError("the broken run was published")
    spark.read.parquet(f"{base}/runs/broken/sensor_readings").schema   # it did write before it broke
    if load.current_run(spark, base) != good:
        raise AssertionError("the pointer moved to the broken run")
    pub = load.published_tables(spark, base)
    return load.verify_counts(pub["sensor_readings"], pub["quality_checks"], pub["hourly_summary"])


_SIMULATED = "simulated failure while writing"


_RUNS: dict[tuple, str] = {}


def _published(spark, sf_dir) -> Tables:
    """The three tables as the job published them, for the queries that read
    tables (G, J, K).  The job runs once per Spark application and state of the
    folder's files, and again where its scratch folder is gone."""
    import uuid

    key = _source(spark, sf_dir)
    if key not in _RUNS or not exists(spark, _RUNS[key]):
        base = session.scratch_path(spark, f"shopfloor-run-{uuid.uuid4().hex}")
        pipeline.run_pipeline(spark, _pipe(spark, sf_dir), base)
        _RUNS[key] = base
    pub = load.published_tables(spark, _RUNS[key])
    return Tables(pub["sensor_readings"], pub["quality_checks"], pub["hourly_summary"])


@register("check_tables_exist", """
SELECT t.table_name, t.n IS NOT NULL AS present, CASE WHEN t.n IS NULL THEN 'fail' ELSE 'pass' END AS status
FROM (SELECT 'sensor_readings' AS table_name, (SELECT count(*) FROM readings) AS n UNION ALL
      SELECT 'quality_checks', (SELECT count(*) FROM checks) UNION ALL
      SELECT 'hourly_summary', (SELECT count(*) FROM summary)) t""")
def q_check_tables_exist(spark, sf_dir):
    """K1 over published tables."""
    return checks.check_tables_exist(spark, _published(spark, sf_dir))


@register("check_columns", """
SELECT column_name, true AS present, 'pass' AS status
FROM (SELECT unnest(['record_id', 'timestamp', 'line_id', 'machine_id', 'temperature', 'pressure', 'vibration',
                     'power', 'data_quality']) AS column_name)""")
def q_check_columns(spark, sf_dir):
    """K3 over the published readings table."""
    return checks.check_columns(spark, _published(spark, sf_dir))


# --- G: sample queries, set 1 ------------------------------------------

@register("total_readings", "SELECT count(*) AS total_readings FROM readings")
def q_total_readings(spark, sf_dir):
    return reports.total_readings(_published(spark, sf_dir))


@register("line_recent_hours", f"""
SELECT {summary_rounded()} FROM summary WHERE line_id = lower(trim('Line_1'))
ORDER BY hour DESC NULLS LAST, machine_id NULLS FIRST, line_id NULLS FIRST LIMIT 10""")
def q_line_recent_hours(spark, sf_dir):
    return reports.line_recent_hours(_published(spark, sf_dir))


@register("high_defect_hours", f"""
SELECT hour, line_id, machine_id, round(defect_rate, {P}) AS defect_rate FROM summary
WHERE defect_rate > 5.0""")
def q_high_defect_hours(spark, sf_dir):
    return reports.high_defect_hours(_published(spark, sf_dir))


@register("quality_distribution", "SELECT data_quality, count(*) AS count FROM readings GROUP BY data_quality")
def q_quality_distribution(spark, sf_dir):
    return reports.quality_distribution(_published(spark, sf_dir))


@register("machine_temperature_stats", f"""
SELECT machine_id, round(avg(temperature), {P}) AS avg_temp, min(temperature) AS min_temp,
  max(temperature) AS max_temp FROM readings GROUP BY machine_id""")
def q_machine_temperature_stats(spark, sf_dir):
    return reports.machine_temperature_stats(_published(spark, sf_dir))


@register("machine_hourly_trend", f"""
SELECT hour, round(avg_temperature, {P}) AS avg_temperature, round(avg_pressure, {P}) AS avg_pressure,
  round(avg_vibration, {P}) AS avg_vibration, round(defect_rate, {P}) AS defect_rate
FROM summary WHERE machine_id = lower(trim('Machine_7'))""")
def q_machine_hourly_trend(spark, sf_dir):
    return reports.machine_hourly_trend(_published(spark, sf_dir), "Machine_7")


@register("anomalous_readings", """
SELECT timestamp, machine_id, temperature, pressure, vibration, data_quality FROM readings
WHERE data_quality = 'invalid' OR temperature > 120 OR pressure > 8""")
def q_anomalous_readings(spark, sf_dir):
    return reports.anomalous_readings(_published(spark, sf_dir))


@register("line_pass_rate", """
SELECT line_id, count(*) AS total_checks,
  count(*) FILTER (WHERE result = 'pass') AS passed,
  count(*) FILTER (WHERE result = 'fail') AS failed,
  round(CAST(count(*) FILTER (WHERE result = 'pass') AS DOUBLE) * 100.0 / count(*), 2) AS pass_rate
FROM checks GROUP BY line_id""")
def q_line_pass_rate(spark, sf_dir):
    return reports.line_pass_rate(_published(spark, sf_dir))


@register("hour_of_day_profile", f"""
SELECT CAST(extract(hour FROM hour) AS BIGINT) AS hour_of_day, count(*) AS readings,
  round(avg(defect_rate), {P}) AS avg_defect_rate FROM summary GROUP BY 1""")
def q_hour_of_day_profile(spark, sf_dir):
    return reports.hour_of_day_profile(_published(spark, sf_dir))


# --- J: sample queries, set 2 ------------------------------------------

@register("sample_readings", """
SELECT * FROM readings ORDER BY record_id NULLS FIRST, timestamp NULLS FIRST, line_id NULLS FIRST,
  machine_id NULLS FIRST, temperature NULLS FIRST, pressure NULLS FIRST, vibration NULLS FIRST,
  power NULLS FIRST, data_quality NULLS FIRST LIMIT 10""")
def q_sample_readings(spark, sf_dir):
    return reports.sample_readings(_published(spark, sf_dir))


@register("worst_hours", f"""
SELECT {summary_rounded()} FROM summary
ORDER BY defect_rate DESC, hour NULLS FIRST, machine_id NULLS FIRST, line_id NULLS FIRST LIMIT 10""")
def q_worst_hours(spark, sf_dir):
    return reports.worst_hours(_published(spark, sf_dir))


@register("machine_sensor_means", f"""
SELECT machine_id, count(*) AS total_readings, round(avg(temperature), {P}) AS avg_temperature,
  round(avg(pressure), {P}) AS avg_pressure, round(avg(vibration), {P}) AS avg_vibration
FROM readings GROUP BY machine_id""")
def q_machine_sensor_means(spark, sf_dir):
    return reports.machine_sensor_means(_published(spark, sf_dir))


@register("line_defect_rate", f"""
SELECT line_id, round(avg(defect_rate), {P}) AS avg_defect_rate, count(*) AS hours_monitored
FROM summary GROUP BY line_id""")
def q_line_defect_rate(spark, sf_dir):
    return reports.line_defect_rate(_published(spark, sf_dir))


@register("quality_percentage", """
SELECT data_quality, count(*) AS count,
  round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM readings), 2) AS percentage
FROM readings GROUP BY data_quality""")
def q_quality_percentage(spark, sf_dir):
    return reports.quality_percentage(_published(spark, sf_dir))


@register("daily_temperature", f"""
SELECT CAST(timestamp AS DATE) AS date, round(avg(temperature), {P}) AS avg_temp,
  min(temperature) AS min_temp, max(temperature) AS max_temp FROM readings GROUP BY 1""")
def q_daily_temperature(spark, sf_dir):
    return reports.daily_temperature(_published(spark, sf_dir))


@register("machines_needing_attention", f"""
SELECT machine_id, round(avg(defect_rate), {P}) AS avg_defect_rate, count(*) AS hours_checked
FROM summary GROUP BY machine_id HAVING avg(defect_rate) > 5""")
def q_machines_needing_attention(spark, sf_dir):
    return reports.machines_needing_attention(_published(spark, sf_dir))


@register("line_hour_profile", f"""
SELECT line_id, strftime(hour, '%H') AS hour_of_day, round(avg(total_checks), {P}) AS avg_checks,
  round(avg(defect_rate), {P}) AS avg_defect_rate FROM summary GROUP BY line_id, hour_of_day""")
def q_line_hour_profile(spark, sf_dir):
    return reports.line_hour_profile(_published(spark, sf_dir))


@register("global_summary", f"""
SELECT count(DISTINCT machine_id) AS total_machines, count(DISTINCT line_id) AS total_lines,
  count(*) AS total_hours, round(avg(defect_rate), {P}) AS overall_defect_rate,
  round(avg(total_checks), {P}) AS avg_checks_per_hour FROM summary""")
def q_global_summary(spark, sf_dir):
    return reports.global_summary(_published(spark, sf_dir))


@register("overall_defect_rate", f"SELECT round(avg(defect_rate), {P}) AS avg_defect_rate FROM summary")
def q_overall_defect_rate(spark, sf_dir):
    return reports.overall_defect_rate(_published(spark, sf_dir))


# --- K: data checks ----------------------------------------------------

@register("check_row_counts", """
SELECT 'sensor_readings' AS table_name, count(*) AS rows,
  CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status FROM readings UNION ALL
SELECT 'quality_checks', count(*), CASE WHEN count(*) > 0 THEN 'pass' ELSE 'warn' END FROM checks UNION ALL
SELECT 'hourly_summary', count(*), CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END FROM summary""")
def q_check_row_counts(spark, sf_dir):
    return checks.check_row_counts(_published(spark, sf_dir))


@register("check_critical_nulls", """
SELECT count(*) FILTER (WHERE record_id IS NULL OR timestamp IS NULL) AS null_count,
  CASE WHEN count(*) FILTER (WHERE record_id IS NULL OR timestamp IS NULL) = 0 THEN 'pass' ELSE 'fail' END AS status
FROM readings""")
def q_check_critical_nulls(spark, sf_dir):
    return checks.check_critical_nulls(_published(spark, sf_dir))


@register("check_duplicate_ids", """
SELECT count(*) - count(DISTINCT record_id) AS duplicates,
  CASE WHEN count(*) - count(DISTINCT record_id) = 0 THEN 'pass' ELSE 'fail' END AS status FROM readings""")
def q_check_duplicate_ids(spark, sf_dir):
    return checks.check_duplicate_ids(_published(spark, sf_dir))


@register("check_temperature_bounds", f"""
SELECT min(temperature) AS min_temp, max(temperature) AS max_temp, round(avg(temperature), {P}) AS avg_temp,
  CASE WHEN min(temperature) IS NULL THEN 'pass'
       WHEN min(temperature) BETWEEN 0 AND 150 AND max(temperature) BETWEEN 0 AND 150 THEN 'pass'
       ELSE 'warn' END AS status
FROM readings WHERE temperature IS NOT NULL""")
def q_check_temperature_bounds(spark, sf_dir):
    return checks.check_temperature_bounds(_published(spark, sf_dir))


@register("check_quality_distribution", f"""
SELECT data_quality, count(*) AS count,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM readings) * 100.0, {P}) AS percentage
FROM readings GROUP BY data_quality""")
def q_check_quality_distribution(spark, sf_dir):
    return checks.check_quality_distribution(_published(spark, sf_dir))


@register("check_hourly_aggregates", f"""
SELECT count(*) AS total_hours, round(avg(defect_rate), {P}) AS avg_defect_rate,
  round(max(defect_rate), {P}) AS max_defect_rate,
  CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status FROM summary""")
def q_check_hourly_aggregates(spark, sf_dir):
    return checks.check_hourly_aggregates(_published(spark, sf_dir))


@register("check_top_machines", f"""
SELECT machine_id, round(avg(defect_rate), {P}) AS avg_defect_rate FROM summary GROUP BY machine_id
ORDER BY avg_defect_rate DESC NULLS LAST, machine_id NULLS FIRST LIMIT 5""")
def q_check_top_machines(spark, sf_dir):
    return checks.check_top_machines(_published(spark, sf_dir))


@register("check_result_distribution", "SELECT result, count(*) AS count FROM checks GROUP BY result")
def q_check_result_distribution(spark, sf_dir):
    return checks.check_result_distribution(_published(spark, sf_dir))


REPORT_SQL = f"""
SELECT 'row_counts' AS "check", 'sensor_readings' AS metric, CAST(count(*) AS DOUBLE) AS value,
  CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status FROM readings
UNION ALL SELECT 'row_counts', 'quality_checks', CAST(count(*) AS DOUBLE),
  CASE WHEN count(*) > 0 THEN 'pass' ELSE 'warn' END FROM checks
UNION ALL SELECT 'row_counts', 'hourly_summary', CAST(count(*) AS DOUBLE),
  CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END FROM summary
UNION ALL SELECT 'critical_nulls', 'null_count',
  CAST(count(*) FILTER (WHERE record_id IS NULL OR timestamp IS NULL) AS DOUBLE),
  CASE WHEN count(*) FILTER (WHERE record_id IS NULL OR timestamp IS NULL) = 0 THEN 'pass' ELSE 'fail' END
  FROM readings
UNION ALL SELECT 'duplicate_ids', 'duplicates', CAST(count(*) - count(DISTINCT record_id) AS DOUBLE),
  CASE WHEN count(*) - count(DISTINCT record_id) = 0 THEN 'pass' ELSE 'fail' END FROM readings
UNION ALL SELECT 'temperature_bounds', 'min_temp', min(temperature),
  CASE WHEN min(temperature) IS NULL THEN 'pass'
       WHEN min(temperature) BETWEEN 0 AND 150 AND max(temperature) BETWEEN 0 AND 150 THEN 'pass'
       ELSE 'warn' END FROM readings WHERE temperature IS NOT NULL
UNION ALL SELECT 'temperature_bounds', 'max_temp', max(temperature),
  CASE WHEN min(temperature) IS NULL THEN 'pass'
       WHEN min(temperature) BETWEEN 0 AND 150 AND max(temperature) BETWEEN 0 AND 150 THEN 'pass'
       ELSE 'warn' END FROM readings WHERE temperature IS NOT NULL
UNION ALL SELECT 'hourly_aggregates', 'total_hours', CAST(count(*) AS DOUBLE),
  CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END FROM summary
UNION ALL SELECT 'hourly_aggregates', 'avg_defect_rate', round(avg(defect_rate), {P}),
  CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END FROM summary
UNION ALL SELECT 'hourly_aggregates', 'max_defect_rate', round(max(defect_rate), {P}),
  CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END FROM summary
UNION ALL SELECT 'quality_distribution', 'share_' || coalesce(data_quality, 'null'),
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM readings) * 100.0, {P}), 'pass'
  FROM readings GROUP BY data_quality"""


@register("validation_report", REPORT_SQL)
def q_validation_report(spark, sf_dir):
    return checks.validation_report(_published(spark, sf_dir))


@register("overall_status", f"""
SELECT bool_and(status <> 'fail') AS all_passed, count(*) FILTER (WHERE status = 'fail') AS failed_checks
FROM ({REPORT_SQL}) r""")
def q_overall_status(spark, sf_dir):
    return checks.overall_status(_published(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.run for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}
