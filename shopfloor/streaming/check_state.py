"""Data checks that a load brings up to date by its own days.

Each day has a few rows of mergeable state: counts, minima, maxima and sums per
table, per quality flag and per machine.  A reading has one time, so its id lies in
one day and distinct ids add up over days.  A load replaces the state of the days it
touches; the report merges the rows of all days and reads no table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import roles
from ..operators.load import DAY
from ..plans.reports import PLACES
from ..schemas import CHECKS_TABLE, READINGS_TABLE, SUMMARY_TABLE

VALUES = {"n": "long", "ids": "long", "nulls": "long", "lo": "double", "hi": "double", "total": "double"}
READINGS, FLAG, CHECKS, HOURS, MACHINE = "readings", "flag", "checks", "hours", "machine"


def _rows(df: DataFrame, kind: str, name: str | None = None, **values: Column) -> DataFrame:
    """State rows of one kind: by day, and by the column ``name`` where given."""
    aggs = {"n": F.count(F.lit(1)), **values}
    grouped = df.groupBy(DAY, *([F.col(name).alias("name")] if name else [])).agg(
        *[aggs[v].cast(t).alias(v) if v in aggs else F.lit(None).cast(t).alias(v) for v, t in VALUES.items()])
    return grouped.select(F.lit(kind).alias("kind"), F.col("name") if name else F.lit(None).cast("string").alias("name"),
                          *VALUES, DAY)


def day_state(joined: DataFrame | None, inspections: DataFrame | None, summary: DataFrame | None) -> DataFrame | None:
    """State of the days that the three tables (with ``day``) hold rows of."""
    parts = []
    if joined is not None:
        mapping = roles.readings_load_mapping(joined.columns)
        readings = joined.select(*[F.col(s).alias(t) for s, t in mapping.items()], DAY)
        absent = F.count_if(F.col("record_id").isNull() | F.col("timestamp").isNull())
        parts.append(_rows(readings, READINGS, ids=F.count_distinct("record_id"), nulls=absent,
                           lo=F.min("temperature"), hi=F.max("temperature")))
        if "data_quality" in readings.columns:
            parts.append(_rows(readings, FLAG, "data_quality"))
    if inspections is not None:
        parts.append(_rows(inspections, CHECKS))
    if summary is not None:
        rate = F.col("defect_rate")
        parts += [_rows(summary, HOURS, hi=F.max(rate), total=F.sum(rate)),
                  _rows(summary, MACHINE, "machine_id", total=F.sum(rate))]
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def top_machines(state: DataFrame, k: int = 5) -> DataFrame:
    """K9 from the state."""
    rate = F.round(F.sum("total") / F.sum("n"), PLACES)
    return (state.where(F.col("kind") == MACHINE).groupBy(F.col("name").alias("machine_id")).agg(rate.alias("avg_defect_rate"))
            .orderBy(F.col("avg_defect_rate").desc_nulls_last(), F.col("machine_id").asc_nulls_first()).limit(k))


def validation_report(state: DataFrame) -> DataFrame:
    """K11 from the state: the rows of ``checks.validation_report``."""
    def of(kind: str, value: str, fold=F.sum) -> Column:
        return fold(F.when(F.col("kind") == kind, F.col(value)))

    def count(kind: str, value: str = "n") -> Column:
        return F.coalesce(of(kind, value), F.lit(0))

    sums = state.agg(
        count(READINGS).alias("rows"), count(READINGS, "nulls").alias("nulls"),
        (count(READINGS) - count(READINGS, "ids")).alias("dupes"),
        of(READINGS, "lo", F.min).alias("lo"), of(READINGS, "hi", F.max).alias("hi"),
        count(CHECKS).alias("checks"), count(HOURS).alias("hours"),
        F.round(of(HOURS, "total") / of(HOURS, "n"), PLACES).alias("rate"), F.round(of(HOURS, "hi", F.max), PLACES).alias("worst"))

    def status(ok: Column, bad: str = "fail") -> Column:
        return F.when(ok, "pass").otherwise(bad)

    some, hours = status(F.col("rows") > 0), status(F.col("hours") > 0)
    bounds = F.when(F.col("lo").isNull(), "pass").otherwise(status(F.col("lo").between(0, 150) & F.col("hi").between(0, 150), "warn"))
    lines = [("row_counts", READINGS_TABLE, "rows", some), ("critical_nulls", "null_count", "nulls", status(F.col("nulls") == 0)),
             ("duplicate_ids", "duplicates", "dupes", status(F.col("dupes") == 0)),
             ("temperature_bounds", "min_temp", "lo", bounds), ("temperature_bounds", "max_temp", "hi", bounds),
             ("row_counts", CHECKS_TABLE, "checks", status(F.col("checks") > 0, "warn")),
             ("row_counts", SUMMARY_TABLE, "hours", hours), ("hourly_aggregates", "total_hours", "hours", hours),
             ("hourly_aggregates", "avg_defect_rate", "rate", hours), ("hourly_aggregates", "max_defect_rate", "worst", hours)]
    report = sums.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(metric).alias("metric"), F.col(value).cast("double").alias("value"),
                 verdict.alias("status")) for check, metric, value, verdict in lines])))
    flags = state.where(F.col("kind") == FLAG).groupBy("name").agg(F.sum("n").alias("n"))
    whole = F.sum("n").over(Window.partitionBy())                   # over the few flags
    share = F.round(F.col("n").cast("double") / whole * F.lit(100.0), PLACES)
    return report.unionByName(flags.select(
        F.lit("quality_distribution").alias("check"), F.concat(F.lit("share_"), F.coalesce("name", F.lit("null"))).alias("metric"),
        share.alias("value"), F.lit("pass").alias("status")))
