"""Sensor cleaning (B1-B6): error codes, range test, ordered fill, flags.

Per sensor column, in processing order (every temp column, then press,
then vibr):

* error codes -1 / -999 and NaN become NULL, *then* out-of-range values
  become NULL (so an error code is never flagged by range);
* the column is forward-filled in global row order (not per machine);
* the row flag is set where the cleaned value was NULL: 'estimated' if
  the fill found a value, else 'invalid'.  Later columns overwrite earlier
  flags, so the flag is that of the last column needing repair, else
  'good'.  An out-of-range value that gets filled is therefore
  'estimated', not 'invalid'.

All fills (and, when asked, the dense position used for record ids) come
out of one ``ordered_pass``: one shuffle for every sensor together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import roles
from ..functions.scalars import in_range, null_error_codes
from ..schemas import FLAG_ESTIMATED, FLAG_GOOD, FLAG_INVALID, SENSOR_RANGES
from .ordered import ROWS_PER_BUCKET, ordered_pass


def _as_double(types: dict, name: str) -> Column:
    dtype = types[name]
    c = F.col(name)
    if isinstance(dtype, T.DoubleType):
        return c
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    return c.try_cast("double")  # text in a numeric column -> NULL


def clean_sensor_data(df: DataFrame, order="row_no", position_col: str | None = None,
                      method: str = "bucketed", width: int = ROWS_PER_BUCKET,
                      flag_col: str = "data_quality", carry_in: dict[int, Column] | None = None,
                      offset_in: Column | None = None, keep_fills: bool = False) -> DataFrame:
    """B6.  ``carry_in`` (step index -> last cleaned value before these rows)
    and ``offset_in`` continue an earlier frame, as the streaming cleaner
    does per micro-batch; ``keep_fills`` keeps the per-step filled columns
    ``__filled_<i>`` (their values at the last row are the next carry)."""
    columns = df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    steps = roles.sensor_cleaning_steps(columns)
    fills: dict[str, Column] = {}    # __filled_<i> -> row-local value it fills from
    tested: list[Column] = []        # per step: the value whose NULL needs repair
    source: dict[str, Column] = {}   # column -> row-local value cleaned so far
    last_fill: dict[str, str] = {}   # column -> its latest filled column
    for i, (role, name) in enumerate(steps):
        lo, hi = SENSOR_RANGES[role]
        if name not in source:
            cleaned = in_range(null_error_codes(_as_double(types, name)), lo, hi)
            tested.append(cleaned)
        else:
            # a column in a second role: its filled values are range-tested again
            cleaned = in_range(source[name], lo, hi)
            tested.append(in_range(F.col(last_fill[name]), lo, hi))
        fills[f"__filled_{i}"] = cleaned
        source[name] = cleaned
        last_fill[name] = f"__filled_{i}"

    out = ordered_pass(df, order, fills, position_col=position_col, method=method, width=width,
                       carry_in={f"__filled_{i}": c for i, c in (carry_in or {}).items()},
                       offset_in=offset_in)

    # the flag of the last step that needed repair (later steps overwrite)
    flag = F.lit(FLAG_GOOD)
    for value, filled in zip(tested, fills):
        status = F.when(value.isNull(),
                        F.when(F.col(filled).isNull(), F.lit(FLAG_INVALID))
                        .otherwise(F.lit(FLAG_ESTIMATED)))
        flag = F.coalesce(status, flag)

    final = {name: F.col(fill) for name, fill in last_fill.items()}
    cols = [final[c].alias(c) if c in final else F.col(c) for c in columns]
    if position_col is not None and position_col not in columns:
        cols.append(F.col(position_col))
    cols.append(flag.alias(flag_col))
    if keep_fills:
        cols += [F.col(f) for f in fills]
    return out.select(*cols)


def quality_flag_distribution(cleaned: DataFrame, flag_col: str = "data_quality") -> DataFrame:
    """Rows per flag."""
    return cleaned.groupBy(flag_col).agg(F.count(F.lit(1)).alias("count"))
