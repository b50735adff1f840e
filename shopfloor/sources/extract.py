"""Extract-stage operators over a raw frame.

All lazy.  The recency fallback (use every row when the window is empty)
is a scalar subquery over ``max(time)``, not a separate job on the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import roles
from ..functions.scalars import parse_event_time


def _ts_literal(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def parse_first_time_column(df: DataFrame) -> tuple[DataFrame, str | None]:
    """A3: the first column named like 'time'/'date' becomes timestamp_ntz;
    values that do not parse become NULL."""
    tcol = roles.first_time_column(df.columns)
    if tcol is None:
        return df, None
    dtype = df.schema[tcol].dataType
    parsed = parse_event_time(F.col(tcol), dtype)
    return df.withColumn(tcol, parsed), tcol


def rejected_times(raw: DataFrame, source: str) -> DataFrame:
    """Rows of one source whose time is text that no layout fits (they become
    NULL: outside the hourly summary, and NULL keys of the join)."""
    tcol = roles.first_time_column(raw.columns)
    if tcol is None:
        return raw.agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("rejected"))
    parsed = parse_event_time(F.col(tcol), raw.schema[tcol].dataType)
    return raw.agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("rows"),
                   F.count_if(F.col(tcol).isNotNull() & parsed.isNull()).alias("rejected"))


def time_coverage(df: DataFrame, source: str) -> DataFrame:
    """A4: rows, first and last event time of one source."""
    tcol = roles.first_time_column(df.columns)
    ts = F.col(tcol) if tcol else F.lit(None).cast("timestamp_ntz")
    return df.agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("rows"),
                  F.min(ts).alias("min_time"), F.max(ts).alias("max_time"))


def recency_filter(df: DataFrame, time_col: str, days_back: int | None,
                   as_of=None, fallback: bool = True) -> DataFrame:
    """Keep rows with time >= as_of - days_back.

    ``days_back=None`` keeps everything (unparsable times included).  When
    the window holds no row and ``fallback`` is on, every row is kept, as
    the reference re-reads the whole file.  ``as_of`` defaults to the
    wall clock (``localtimestamp()``); tests pin it.
    """
    if days_back is None:
        return df
    now = F.localtimestamp().cast("timestamp_ntz") if as_of is None else _ts_literal(as_of)
    cutoff = now - F.make_dt_interval(F.lit(int(days_back)))
    in_window = F.col(time_col) >= cutoff
    if not fallback:
        return df.where(in_window)
    latest = df.select(F.max(time_col)).scalar()
    window_empty = F.coalesce(latest < cutoff, F.lit(True))
    return df.where(in_window | window_empty)


def completed_inspections(df: DataFrame) -> DataFrame:
    """Rows whose first 'status' column is not null (any value)."""
    scol = roles.first_status_column(df.columns)
    return df if scol is None else df.where(F.col(scol).isNotNull())


def extract_sensor(df: DataFrame, days_back: int | None = None, as_of=None) -> DataFrame:
    """extract_sensor_data over an already-scanned frame."""
    df, tcol = parse_first_time_column(df)
    if tcol is not None and days_back is not None:
        df = recency_filter(df, tcol, days_back, as_of)
    return df


def extract_quality(df: DataFrame) -> DataFrame:
    """extract_quality_data over an already-scanned frame."""
    df, _ = parse_first_time_column(df)
    return completed_inspections(df)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """A10 as a query: one (stage, rows) row per named frame."""
    parts = [frame.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"))
             for name, frame in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observe_rows(df: DataFrame, name: str, **extra: Column | None) -> tuple[DataFrame, "object"]:
    """A10 in a running job: count rows as they pass, without an extra job
    (plus any named aggregate in ``extra``).  Returns the frame and the
    Observation to read after an action."""
    from pyspark.sql import Observation

    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [agg.alias(k) for k, agg in extra.items() if agg is not None]
    return df.observe(obs, *metrics), obs
