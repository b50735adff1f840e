"""Hourly roll-up (E1-E6): one partial/final hash aggregate.

The reference runs two group-bys (sensor statistics, quality counts) and
merges them on the keys; both have the same keys and the same rows, so
here they are one ``groupBy().agg()``: map-side partial aggregation, one
shuffle of at most (groups x map tasks) rows, no join.  A group that holds
a third of all rows costs one partial row per map task, nothing more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import roles
from ..functions.scalars import defect_rate, hour_bucket
from ..schemas import STATUS_FAIL
from .integrate import STATUS_COL

STAT_FUNCS = (("avg", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev_samp))


def hourly_summary(joined: DataFrame) -> DataFrame:
    """E6.  Group keys: hour + every line/machine column without 'quality'
    (right-side ones included); groups with a NULL key are dropped.
    Per mapped sensor: avg, min, max, sample std (NULL for one value).
    total_checks counts every joined row (not_checked included);
    defect_rate = fails / total_checks * 100, 0 when undefined."""
    tcol = roles.hourly_time_column(joined.columns)
    if tcol is None:
        # no usable time column: an empty summary with the group columns
        return joined.where(F.lit(False)).select(
            F.lit(None).cast("timestamp_ntz").alias("hour"))
    with_hour = joined.withColumn("hour", hour_bucket(F.col(tcol)))
    groups = ["hour"] + [c for c in roles.hourly_group_columns(with_hour.columns) if c != "hour"]
    sensors = roles.hourly_sensor_columns(with_hour.columns)

    keyed = with_hour.dropna(subset=groups)
    aggs = [fn(F.col(col)).alias(f"{stat}_{role}")
            for role, col in sensors.items() for stat, fn in STAT_FUNCS]
    status = F.col(STATUS_COL) if STATUS_COL in joined.columns else F.lit(None)
    aggs += [F.count(status).alias("total_checks"),
             F.count_if(status == F.lit(STATUS_FAIL)).alias("defect_count")]
    summary = keyed.groupBy(*groups).agg(*aggs)
    return summary.withColumn("defect_rate", defect_rate(F.col("defect_count"), F.col("total_checks")))
