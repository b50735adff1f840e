"""Post-load data checks (K1-K13) as DataFrames.

Every check is one aggregate over one table (no per-check driver loop);
``validation_report`` unions them into rows (check, metric, value,
status) and ``overall_status`` folds the statuses.  Status is 'pass',
'warn' (informative) or 'fail' (the reference's hard failures).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import CHECKS_TABLE, READINGS_COLUMNS, READINGS_TABLE, SUMMARY_TABLE
from .reports import PLACES, Tables, machine_overview


def _lit(text: str):
    return lambda: F.lit(text)


PASS, WARN, FAIL = _lit("pass"), _lit("warn"), _lit("fail")


def _status(ok: Column, bad=FAIL) -> Column:
    return F.when(ok, PASS()).otherwise(bad())


def check_tables_exist(spark: SparkSession, t: Tables) -> DataFrame:
    """K1: each table is defined (driver metadata; a missing table fails)."""
    rows = [(name, df is not None) for name, df in
            ((READINGS_TABLE, t.readings), (CHECKS_TABLE, t.checks), (SUMMARY_TABLE, t.summary))]
    df = spark.createDataFrame(rows, "table_name string, present boolean")
    return df.withColumn("status", _status(F.col("present")))


def check_row_counts(t: Tables) -> DataFrame:
    """K2: readings and summary must have rows; an empty checks table warns."""
    def one(name, df, bad):
        n = F.count(F.lit(1))
        return df.agg(F.lit(name).alias("table_name"), n.alias("rows"), _status(n > 0, bad).alias("status"))
    return (one(READINGS_TABLE, t.readings, FAIL)
            .unionByName(one(CHECKS_TABLE, t.checks, WARN))
            .unionByName(one(SUMMARY_TABLE, t.summary, FAIL)))


def check_columns(spark: SparkSession, t: Tables) -> DataFrame:
    """K3: the nine expected readings columns (schema metadata)."""
    present = set(t.readings.columns)
    rows = [(c, c in present) for c in READINGS_COLUMNS]
    df = spark.createDataFrame(rows, "column_name string, present boolean")
    return df.withColumn("status", _status(F.col("present")))


def check_critical_nulls(t: Tables) -> DataFrame:
    """K4: no NULL record_id or timestamp."""
    n = F.count_if(F.col("record_id").isNull() | F.col("timestamp").isNull())
    return t.readings.agg(n.alias("null_count"), _status(n == 0).alias("status"))


def check_duplicate_ids(t: Tables) -> DataFrame:
    """K5: COUNT - COUNT(DISTINCT record_id); join fan-out makes it fail."""
    d = F.count(F.lit(1)) - F.countDistinct("record_id")
    return t.readings.agg(d.alias("duplicates"), _status(d == 0).alias("status"))


def check_temperature_bounds(t: Tables) -> DataFrame:
    """K6: min / max / avg of non-null temperature; out of 0-150 only warns."""
    temp = t.readings.where(F.col("temperature").isNotNull())
    lo, hi = F.min("temperature"), F.max("temperature")
    ok = lo.between(0, 150) & hi.between(0, 150)
    return temp.agg(lo.alias("min_temp"), hi.alias("max_temp"),
                    F.round(F.avg("temperature"), PLACES).alias("avg_temp"),
                    F.when(lo.isNull(), PASS()).otherwise(_status(ok, WARN)).alias("status"))


def check_quality_distribution(t: Tables) -> DataFrame:
    """K7: count and share (percent, unrounded in the reference) per flag."""
    counts = t.readings.groupBy("data_quality").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # over the few flag rows, not the table
    return counts.select("data_quality", "count",
                         F.round(F.col("count").cast("double") / total * F.lit(100.0), PLACES)
                         .alias("percentage"))


def check_hourly_aggregates(t: Tables) -> DataFrame:
    """K8: hours, average and maximum defect rate; no hours fails."""
    n = F.count(F.lit(1))
    return t.summary.agg(n.alias("total_hours"),
                         F.round(F.avg("defect_rate"), PLACES).alias("avg_defect_rate"),
                         F.round(F.max("defect_rate"), PLACES).alias("max_defect_rate"),
                         _status(n > 0).alias("status"))


def check_top_machines(t: Tables, k: int = 5) -> DataFrame:
    """K9: top k machines by average defect rate (ties by machine)."""
    return (t.summary.groupBy("machine_id")
            .agg(F.round(F.avg("defect_rate"), PLACES).alias("avg_defect_rate"))
            .orderBy(F.col("avg_defect_rate").desc_nulls_last(), F.col("machine_id").asc_nulls_first())
            .limit(k))


def check_join_performance(t: Tables) -> DataFrame:
    """The machine overview join (timed by the bench, not here)."""
    return machine_overview(t)


def check_result_distribution(t: Tables) -> DataFrame:
    """Rows per inspection result in the checks table."""
    return t.checks.groupBy("result").agg(F.count(F.lit(1)).alias("count"))


def validation_report(t: Tables) -> DataFrame:
    """One row per (check, metric) with a double value and a status.

    One aggregate per table computes every metric of that table in a
    single scan; the metric columns are then unpivoted into rows.  The
    flag shares come from one group-by whose total is a window over its
    (few) result rows, not a second scan.
    """
    n = F.count(F.lit(1))
    nulls = F.count_if(F.col("record_id").isNull() | F.col("timestamp").isNull())
    dupes = n - F.countDistinct("record_id")
    lo, hi = F.min("temperature"), F.max("temperature")
    temp_status = (F.when(lo.isNull(), PASS())
                   .otherwise(_status(lo.between(0, 150) & hi.between(0, 150), WARN)))
    r = t.readings.agg(
        n.cast("double").alias("m_rows"), _status(n > 0).alias("s_rows"),
        nulls.cast("double").alias("m_nulls"), _status(nulls == 0).alias("s_nulls"),
        dupes.cast("double").alias("m_dupes"), _status(dupes == 0).alias("s_dupes"),
        lo.alias("m_lo"), hi.alias("m_hi"), temp_status.alias("s_temp"))
    c = t.checks.agg(n.cast("double").alias("m_rows"), _status(n > 0, WARN).alias("s_rows"))
    h = t.summary.agg(
        n.cast("double").alias("m_rows"), _status(n > 0).alias("s_rows"),
        F.round(F.avg("defect_rate"), PLACES).alias("m_avg"),
        F.round(F.max("defect_rate"), PLACES).alias("m_max"))

    def unpivot(df: DataFrame, items: list[tuple[str, str, str, str]]) -> DataFrame:
        """items: (check, metric, value column, status column)."""
        entries = [F.struct(F.lit(ck).alias("check"), F.lit(mt).alias("metric"),
                            F.col(v).alias("value"), F.col(st).alias("status"))
                   for ck, mt, v, st in items]
        return df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")

    parts = [
        unpivot(r, [("row_counts", READINGS_TABLE, "m_rows", "s_rows"),
                    ("critical_nulls", "null_count", "m_nulls", "s_nulls"),
                    ("duplicate_ids", "duplicates", "m_dupes", "s_dupes"),
                    ("temperature_bounds", "min_temp", "m_lo", "s_temp"),
                    ("temperature_bounds", "max_temp", "m_hi", "s_temp")]),
        unpivot(c, [("row_counts", CHECKS_TABLE, "m_rows", "s_rows")]),
        unpivot(h, [("row_counts", SUMMARY_TABLE, "m_rows", "s_rows"),
                    ("hourly_aggregates", "total_hours", "m_rows", "s_rows"),
                    ("hourly_aggregates", "avg_defect_rate", "m_avg", "s_rows"),
                    ("hourly_aggregates", "max_defect_rate", "m_max", "s_rows")]),
    ]
    share = check_quality_distribution(t).select(
        F.lit("quality_distribution").alias("check"),
        F.concat(F.lit("share_"), F.coalesce(F.col("data_quality"), F.lit("null"))).alias("metric"),
        F.col("percentage").alias("value"), PASS().alias("status"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.unionByName(share)


def overall_status(t: Tables) -> DataFrame:
    """All hard checks passed?"""
    rep = validation_report(t)
    return rep.agg(F.bool_and(F.col("status") != "fail").alias("all_passed"),
                   F.count_if(F.col("status") == "fail").alias("failed_checks"))
