"""Scalar column expressions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (ERROR_CODES, RECORD_ID_FORMAT, STATUS_FAIL, STATUS_NOT_CHECKED, STATUS_PASS,
                       TIME_FORMATS, TIME_SPELLINGS)


def parse_event_time(c: Column, dtype: T.DataType | None = None) -> Column:
    """Any time-like value -> timestamp_ntz; text that fits no layout -> NULL.

    Text is a date, then optionally a time of day and an offset.  Dates: year
    first (- or /), named month (``Jan 1 2024``, ``1 Jan 2024``), or numbers with
    the year last (/ - or .), month first unless that is no month.  Times: hours
    and minutes, seconds with up to nine decimals (kept to microseconds), AM or
    PM.  ``Z`` and offsets shift the time to UTC."""
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    text = F.trim(c.cast("string"))
    for pattern, written in TIME_SPELLINGS:
        text = F.regexp_replace(text, pattern, written)
    # the rewritten text is bound once, not repeated in each attempt
    moment = F.transform(F.array(text), lambda t: F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in TIME_FORMATS]))
    return F.element_at(moment, 1).cast("timestamp_ntz")


def hour_bucket(ts: Column) -> Column:
    """Floor a timestamp_ntz to the hour, staying in timestamp_ntz."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def strip_lower(c: Column) -> Column:
    """Lower-case and strip leading/trailing whitespace (tabs too)."""
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def null_error_codes(c: Column) -> Column:
    """Error codes and NaN -> NULL."""
    return F.when(c.isin(*ERROR_CODES) | F.isnan(c), F.lit(None)).otherwise(c)


def in_range(c: Column, lo: float, hi: float) -> Column:
    """Value kept when inside the inclusive range, else NULL."""
    return F.when(c.between(F.lit(lo), F.lit(hi)), c)


def quality_status(result: Column | None) -> Column:
    """'pass' if the text contains pass (any case), else 'fail' if it
    contains fail, else 'not_checked'.  Pass is tested first."""
    if result is None:
        return F.lit(STATUS_NOT_CHECKED)
    low = F.lower(result.cast("string"))
    return (F.when(low.contains("pass"), F.lit(STATUS_PASS))
            .when(low.contains("fail"), F.lit(STATUS_FAIL))
            .otherwise(F.lit(STATUS_NOT_CHECKED)))


def record_id(position: Column) -> Column:
    return F.format_string(RECORD_ID_FORMAT, position)


def defect_rate(defects: Column, total: Column) -> Column:
    """defects / total * 100; 0 when undefined."""
    return F.coalesce(F.try_divide(defects * F.lit(100.0), total), F.lit(0.0))
