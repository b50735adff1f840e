"""Analysis queries over the three tables.

Each function takes the tables (readings, checks, summary) as DataFrames,
so the same code runs on the lazy pipeline or on published tables.
Averages and deviations are rounded to ``PLACES`` decimals in the output
(float sums depend on summation order; the stored tables keep full
precision).  Queries that end in LIMIT get a unique tie-break.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import hour_bucket, strip_lower
from ..operators.integrate import left_join_sql_nulls

PLACES = 6


@dataclass
class Tables:
    readings: DataFrame
    checks: DataFrame
    summary: DataFrame


def round_doubles(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Round every double column (presentation of float aggregates)."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def _avg(c: str, alias: str):
    return F.round(F.avg(c), PLACES).alias(alias)


# --- set 1 -------------------------------------------------------------

def total_readings(t: Tables) -> DataFrame:
    """G1."""
    return t.readings.agg(F.count(F.lit(1)).alias("total_readings"))


def line_recent_hours(t: Tables, line: str = "Line_1", limit: int = 10) -> DataFrame:
    """Latest hours of one line.  The literal is normalised like the
    stored ids (strip + lower), so 'Line_1' finds 'line_1'."""
    want = strip_lower(F.lit(line))
    out = (t.summary.where(F.col("line_id") == want)
           .orderBy(F.col("hour").desc_nulls_last(), F.col("machine_id").asc_nulls_first(),
                    F.col("line_id").asc_nulls_first())
           .limit(limit))
    return round_doubles(out)


def high_defect_hours(t: Tables, threshold: float = 5.0) -> DataFrame:
    """G3 (also the alert rule of X3)."""
    return (t.summary.where(F.col("defect_rate") > F.lit(float(threshold)))
            .select("hour", "line_id", "machine_id", F.round("defect_rate", PLACES).alias("defect_rate"))
            .orderBy(F.col("defect_rate").desc(), "hour", "machine_id", "line_id"))


def quality_distribution(t: Tables) -> DataFrame:
    """G4."""
    return t.readings.groupBy("data_quality").agg(F.count(F.lit(1)).alias("count"))


def readings_with_checks(t: Tables, limit: int | None = None) -> DataFrame:
    """Readings LEFT JOIN checks on machine and time, SQL NULL rule
    (NULL keys never match).  ``limit`` gives the reference's preview; the
    registered query returns the whole join."""
    s = t.readings.select("timestamp", "machine_id", "temperature")
    q = t.checks.select(F.col("timestamp").alias("q_ts"), F.col("machine_id").alias("q_machine"),
                        F.col("result").alias("quality_result"))
    # NULL-key readings match nothing; they are spread instead of sent to one task
    out = (left_join_sql_nulls(s, q, [("machine_id", "q_machine"), ("timestamp", "q_ts")])
           .select("timestamp", "machine_id", "temperature", "quality_result"))
    if limit is not None:
        out = out.orderBy(*[F.col(c).asc_nulls_first() for c in out.columns]).limit(limit)
    return out


def machine_temperature_stats(t: Tables) -> DataFrame:
    """G6."""
    return t.readings.groupBy("machine_id").agg(
        _avg("temperature", "avg_temp"), F.min("temperature").alias("min_temp"),
        F.max("temperature").alias("max_temp"))


def machine_hourly_trend(t: Tables, machine: str = "machine_01") -> DataFrame:
    """One machine's hours, newest first (literal normalised as in G2).
    The other columns break ties, so the range-partitioned sort never puts
    every row of one hour value into one partition."""
    want = strip_lower(F.lit(machine))
    cols = ["hour", "avg_temperature", "avg_pressure", "avg_vibration", "defect_rate"]
    return round_doubles(
        t.summary.where(F.col("machine_id") == want).select(*cols)
        .orderBy(F.col("hour").desc(), *[F.col(c).asc_nulls_first() for c in cols[1:]]))


def anomalous_readings(t: Tables) -> DataFrame:
    """Newest first.  The remaining columns break ties, so a hot
    timestamp (or the NULL ones) spreads over the sort's range partitions."""
    cols = ["timestamp", "machine_id", "temperature", "pressure", "vibration", "data_quality"]
    return (t.readings.where((F.col("data_quality") == "invalid") | (F.col("temperature") > 120)
                             | (F.col("pressure") > 8))
            .select(*cols)
            .orderBy(F.col("timestamp").desc(), *[F.col(c).asc_nulls_first() for c in cols[1:]]))


def line_pass_rate(t: Tables) -> DataFrame:
    """Exact match on result (result text is not lower-cased)."""
    passed = F.count_if(F.col("result") == "pass")
    return t.checks.groupBy("line_id").agg(
        F.count(F.lit(1)).alias("total_checks"), passed.alias("passed"),
        F.count_if(F.col("result") == "fail").alias("failed"),
        F.round(passed.cast("double") * F.lit(100.0) / F.count(F.lit(1)), 2).alias("pass_rate"))


def hour_of_day_profile(t: Tables) -> DataFrame:
    """G10."""
    return (t.summary.groupBy(F.hour("hour").cast("long").alias("hour_of_day"))
            .agg(F.count(F.lit(1)).alias("readings"), _avg("defect_rate", "avg_defect_rate"))
            .orderBy("hour_of_day"))


# --- set 2 -------------------------------------------------------------

def sample_readings(t: Tables, limit: int = 10) -> DataFrame:
    """A sample of readings (the preview is the feature; ordered by id)."""
    return t.readings.orderBy(*[F.col(c).asc_nulls_first() for c in t.readings.columns]).limit(limit)


def worst_hours(t: Tables, limit: int = 10) -> DataFrame:
    """Top hours by defect rate."""
    return round_doubles(
        t.summary.orderBy(F.col("defect_rate").desc(), F.col("hour").asc_nulls_first(),
                          F.col("machine_id").asc_nulls_first(), F.col("line_id").asc_nulls_first())
        .limit(limit))


def machine_sensor_means(t: Tables) -> DataFrame:
    """J3."""
    return t.readings.groupBy("machine_id").agg(
        F.count(F.lit(1)).alias("total_readings"), _avg("temperature", "avg_temperature"),
        _avg("pressure", "avg_pressure"), _avg("vibration", "avg_vibration"))


def line_defect_rate(t: Tables) -> DataFrame:
    """J4."""
    return (t.summary.groupBy("line_id")
            .agg(_avg("defect_rate", "avg_defect_rate"), F.count(F.lit(1)).alias("hours_monitored"))
            .orderBy(F.col("avg_defect_rate").desc(), "line_id"))


def quality_percentage(t: Tables) -> DataFrame:
    """Share of each flag against the table total.  The reference's
    scalar subquery would scan the table twice; the total is the sum of the
    per-flag counts, taken by a window over those few rows."""
    counts = t.readings.groupBy("data_quality").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select("data_quality", "count",
                         F.round(F.col("count").cast("double") * F.lit(100.0) / total, 2)
                         .alias("percentage"))


def daily_temperature(t: Tables) -> DataFrame:
    """J6."""
    return (t.readings.groupBy(F.to_date("timestamp").alias("date"))
            .agg(_avg("temperature", "avg_temp"), F.min("temperature").alias("min_temp"),
                 F.max("temperature").alias("max_temp"))
            .orderBy("date"))


def machines_needing_attention(t: Tables, threshold: float = 5.0) -> DataFrame:
    """GROUP BY machine HAVING AVG(defect_rate) > threshold."""
    return (t.summary.groupBy("machine_id")
            .agg(F.avg("defect_rate").alias("__avg"), F.count(F.lit(1)).alias("hours_checked"))
            .where(F.col("__avg") > F.lit(float(threshold)))
            .select("machine_id", F.round("__avg", PLACES).alias("avg_defect_rate"), "hours_checked")
            .orderBy(F.col("avg_defect_rate").desc(), "machine_id"))


def temp_vs_defects(t: Tables) -> DataFrame:
    """Readings JOIN summary on machine and same hour, then per
    machine AVG(temperature) and AVG(defect_rate) over the joined rows.

    Exact rewrite without the row-level join: both sides are first reduced
    to one row per (machine, hour) -- counts and sums -- and joined there.
    A reading meets n_h summary rows and a summary row meets n_s readings,
    so the joined averages are sums weighted by those counts.
    """
    r = (t.readings.where(F.col("timestamp").isNotNull() & F.col("machine_id").isNotNull())
         .groupBy("machine_id", hour_bucket(F.col("timestamp")).alias("hour"))
         .agg(F.count(F.lit(1)).alias("n_s"), F.sum("temperature").alias("sum_t"),
              F.count("temperature").alias("cnt_t")))
    h = (t.summary.where(F.col("hour").isNotNull() & F.col("machine_id").isNotNull())
         .groupBy("machine_id", "hour")
         .agg(F.count(F.lit(1)).alias("n_h"), F.sum("defect_rate").alias("sum_r"),
              F.count("defect_rate").alias("cnt_r")))
    j = r.join(h, ["machine_id", "hour"], "inner")
    return j.groupBy("machine_id").agg(
        F.round(F.try_divide(F.sum(F.col("sum_t") * F.col("n_h")),
                             F.sum(F.col("cnt_t") * F.col("n_h"))), PLACES).alias("avg_temp"),
        F.round(F.try_divide(F.sum(F.col("sum_r") * F.col("n_s")),
                             F.sum(F.col("cnt_r") * F.col("n_s"))), PLACES).alias("avg_defect_rate"))


def line_hour_profile(t: Tables) -> DataFrame:
    """Hour of day as two-digit text, as SQLite's strftime('%H')."""
    return (t.summary.groupBy("line_id", F.date_format("hour", "HH").alias("hour_of_day"))
            .agg(_avg("total_checks", "avg_checks"), _avg("defect_rate", "avg_defect_rate"))
            .orderBy("line_id", "hour_of_day"))


def global_summary(t: Tables) -> DataFrame:
    """J10."""
    return t.summary.agg(
        F.countDistinct("machine_id").alias("total_machines"),
        F.countDistinct("line_id").alias("total_lines"),
        F.count(F.lit(1)).alias("total_hours"),
        _avg("defect_rate", "overall_defect_rate"),
        _avg("total_checks", "avg_checks_per_hour"))


def overall_defect_rate(t: Tables) -> DataFrame:
    """J11."""
    return t.summary.agg(_avg("defect_rate", "avg_defect_rate"))


def machine_overview(t: Tables, limit: int | None = None) -> DataFrame:
    """Readings LEFT JOIN summary on machine only, per machine
    COUNT(*), AVG(temperature), AVG(defect_rate).

    The row-level join is a per-machine cross product (readings x hours).
    Exact rewrite: per machine n_s readings and n_h summary rows; every
    reading repeats max(n_h, 1) times, so COUNT = n_s * max(n_h, 1), the
    temperature average is unchanged and the rate average is the summary's
    own per-machine average (NULL when no summary row matches; a NULL
    machine never matches).
    """
    r = t.readings.groupBy("machine_id").agg(
        F.count(F.lit(1)).alias("n_s"), F.avg("temperature").alias("avg_t"))
    h = (t.summary.where(F.col("machine_id").isNotNull()).groupBy("machine_id")
         .agg(F.count(F.lit(1)).alias("n_h"), F.avg("defect_rate").alias("avg_r"))
         .withColumnRenamed("machine_id", "h_machine"))
    j = r.join(h, F.col("machine_id") == F.col("h_machine"), "left")
    out = j.select("machine_id",
                   (F.col("n_s") * F.greatest(F.coalesce(F.col("n_h"), F.lit(0)), F.lit(1)))
                   .alias("reading_count"),
                   F.round("avg_t", PLACES).alias("avg_temp"),
                   F.round("avg_r", PLACES).alias("avg_defect_rate"))
    if limit is not None:
        out = out.orderBy(F.col("machine_id").asc_nulls_first()).limit(limit)
    return out
