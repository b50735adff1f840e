"""Standardisation (C1-C6): names, times, identifiers, record ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import roles
from ..functions.scalars import parse_event_time, record_id, strip_lower
from .ordered import ROWS_PER_BUCKET, ordered_pass

POSITION_COL = "__position"


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Strip, lower-case, inner spaces -> '_'.  Two names that become
    equal would make later column references ambiguous, so that is an error."""
    names = [roles.normalized_name(c) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalisation: {dupes}")
    return df.toDF(*names)


def coerce_timestamps(df: DataFrame) -> DataFrame:
    """Every time/date column holding text, date or timestamp ->
    timestamp_ntz (unparsable -> NULL).  Numeric columns are not touched."""
    targets = set(roles.time_like_columns(df))
    if not targets:
        return df
    return df.select(*[parse_event_time(F.col(f.name), f.dataType).alias(f.name)
                       if f.name in targets else F.col(f.name) for f in df.schema.fields])


def normalize_identifiers(df: DataFrame) -> DataFrame:
    """Lower-case and strip machine / line / sensor text columns."""
    targets = set(roles.identifier_columns(df))
    if not targets:
        return df
    return df.select(*[strip_lower(F.col(c)).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


def assign_record_ids(df: DataFrame, order="row_no", position_col: str = POSITION_COL,
                      method: str = "bucketed", width: int = ROWS_PER_BUCKET) -> DataFrame:
    """Drop any incoming record_id and number rows 'REC_%08d' from 0
    in row order.  A dense position computed earlier in the same ordered
    pass (column ``position_col``) is reused instead of a second shuffle."""
    if position_col not in df.columns:
        df = ordered_pass(df, order, position_col=position_col, method=method, width=width)
    keep = [c for c in df.columns if c not in ("record_id", position_col)]
    return df.select(*keep, record_id(F.col(position_col)).alias("record_id"))


def standardize_data(df: DataFrame, order="row_no", assign_ids: bool = True,
                     position_col: str = POSITION_COL, method: str = "bucketed",
                     width: int = ROWS_PER_BUCKET) -> DataFrame:
    """C1-C5 in the reference's order.  ``order`` names the row-order
    column after name normalisation."""
    out = normalize_column_names(df)
    out = coerce_timestamps(out)
    out = normalize_identifiers(out)
    if assign_ids:
        if isinstance(order, str):
            order = roles.normalized_name(order)
        out = assign_record_ids(out, order, position_col, method, width)
    return out
