"""Mergeable statistics of hour groups: parts of the readings are reduced apart
(micro-batches, NULL-key rows) and merged into the hourly summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import roles
from ..functions.scalars import defect_rate, hour_bucket
from ..schemas import STATUS_FAIL
from .integrate import STATUS_COL


def group_columns(columns: list[str]) -> list[str]:
    return [c for c in roles.hourly_group_columns(columns) if c != "hour"]


def check_counts() -> list[Column]:
    return [F.count(F.col(STATUS_COL)).alias("total_checks"),
            F.count_if(F.col(STATUS_COL) == F.lit(STATUS_FAIL)).alias("defect_count")]


def hour_stats(joined: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per hour group (and value of the columns ``by``): for each sensor n,
    mean, m2 (sum of squared distances from the mean), min and max; checks and
    defects."""
    time, groups = roles.hourly_time_column(joined.columns), group_columns(joined.columns)
    aggs = []
    for role, c in roles.hourly_sensor_columns(joined.columns).items():
        n = F.count(F.col(c))
        aggs += [n.alias(f"n_{role}"), F.avg(F.col(c)).alias(f"mean_{role}"),
                 (F.var_pop(F.col(c)) * n).alias(f"m2_{role}"),
                 F.min(F.col(c)).alias(f"min_{role}"), F.max(F.col(c)).alias(f"max_{role}")]
    rows = joined.withColumn("hour", hour_bucket(F.col(time))).dropna(subset=["hour", *groups])
    return rows.groupBy("hour", *groups, *(by or [])).agg(*aggs, *check_counts())


def sensors_of(stats: DataFrame) -> list[str]:
    return [c.removeprefix("m2_") for c in stats.columns if c.startswith("m2_")]


def combine_stats(stats: DataFrame) -> DataFrame:
    """One row per hour group from any number of them (one per part that touched it)."""
    groups = ["hour", *group_columns(stats.columns)]
    same = Window.partitionBy(*groups)
    out, aggs = stats, []
    for s in sensors_of(stats):
        n, mean = F.col(f"n_{s}"), F.col(f"mean_{s}")
        out = out.withColumn(f"whole_{s}", F.try_divide(F.sum(n * mean).over(same), F.sum(n).over(same)))
        apart = n * F.pow(mean - F.col(f"whole_{s}"), F.lit(2))
        aggs += [F.sum(n).alias(f"n_{s}"), F.first(f"whole_{s}").alias(f"mean_{s}"),
                 F.sum(F.col(f"m2_{s}") + apart).alias(f"m2_{s}"),
                 F.min(f"min_{s}").alias(f"min_{s}"), F.max(f"max_{s}").alias(f"max_{s}")]
    return out.groupBy(*groups).agg(*aggs, F.sum("total_checks").alias("total_checks"),
                                    F.sum("defect_count").alias("defect_count"))


def summary_of(stats: DataFrame) -> DataFrame:
    """The hourly summary of groups that have one row each."""
    groups = ["hour", *group_columns(stats.columns)]
    cols = []
    for s in sensors_of(stats):
        n = F.col(f"n_{s}")
        cols += [F.col(f"mean_{s}").alias(f"avg_{s}"), F.col(f"min_{s}"), F.col(f"max_{s}"),
                 F.when(n > 1, F.sqrt(F.col(f"m2_{s}") / (n - 1))).alias(f"std_{s}")]
    return stats.select(*groups, *cols, "total_checks", "defect_count",
                        defect_rate(F.col("defect_count"), F.col("total_checks")).alias("defect_rate"))


def merge_stats(stats: DataFrame) -> DataFrame:
    """The hourly summary from the statistics of any number of parts."""
    return summary_of(combine_stats(stats))
