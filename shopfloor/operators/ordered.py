"""Global order without one-task windows: forward fill and dense positions.

A plain ``last(x, ignorenulls) OVER (ORDER BY row_no)`` has no partition
key, so Spark moves every row into one task (``Exchange SinglePartition``).
Here rows are grouped into *buckets* of the order: ranges between quantiles of
a numeric position, so that buckets hold about equal rows however sparse,
clustered or far apart the positions are; or the file splits of a CSV scan.

1. one shuffle by bucket; inside each bucket a partitioned window gives the
   local fill and the local row number;
2. a partial (map-side) aggregate gives per bucket the last non-null value
   of every filled expression and the row count;
3. a scan over that *bucket table* (one row per bucket, at most MAX_BUCKETS of
   them for a numeric position; for (file, split) buckets one scan per file
   and one over the files) turns them into the carry-in value and the position
   offset;
4. the carry table is joined back on the bucket key.  The big side is
   already hash-partitioned by bucket after step 1, so only the bucket table
   moves (or AQE broadcasts it once it has measured its size).

A task of step 1 holds the rows of whole buckets: about ``rows_per_bucket`` each
while the input has fewer than MAX_BUCKETS times that, then about 1/MAX_BUCKETS
of the rows (quantiles are approximate, to within a tenth of a bucket).  The
quantiles cost one job that reads the position column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1 << 20
MIN_BUCKETS = 16                 # even small inputs are spread (and take the same path as large ones)
GRID, MAX_BUCKETS = 1 << 10, 1 << 14    # quantiles asked for at first, and at most
ACCURACY_PER_BUCKET = 20         # rank error of a quantile: 1/20 of a bucket


@dataclass(frozen=True)
class RowOrder:
    """How rows are ordered: buckets (compared left to right) then a sequence.

    ``numeric(col)`` buckets a unique numeric position by quantiles (``cuts``, if the
    caller has them from a job of its own, else one job finds them);
    ``explicit(bucket_cols, seq)`` uses columns that already name the bucket,
    e.g. a file and split start for a scan.
    """

    seq: str
    bucket_exprs: tuple = field(default=())
    bucket_names: tuple = field(default=("__bucket",))
    cuts: tuple[float, ...] | None = None

    @staticmethod
    def numeric(col: str, cuts: list[float] | None = None) -> "RowOrder":
        return RowOrder(seq=col, cuts=None if cuts is None else tuple(cuts))

    @staticmethod
    def explicit(bucket_cols: list[str], seq: str) -> "RowOrder":
        return RowOrder(seq=seq, bucket_exprs=tuple(F.col(c) for c in bucket_cols),
                        bucket_names=tuple(f"__bucket{i}" for i in range(len(bucket_cols))))


def quantile_aggs(col: str, parts: int = GRID) -> list[Column]:
    """Aggregates that ``bucket_cuts`` reads: rows (``n``) and the values at k/parts (``at``)."""
    at = F.percentile_approx(col, [k / parts for k in range(1, parts)], ACCURACY_PER_BUCKET * parts)
    return [F.count(col).alias("n"), at.alias("at")]


def _quantiles(df: DataFrame, col: str, parts: int) -> tuple[int, list]:
    row = df.agg(*quantile_aggs(col, parts)).first()
    return row["n"], row["at"] or []


def bucket_cuts(df: DataFrame, col: str, rows_per_bucket: int = ROWS_PER_BUCKET,
                seen: tuple[int, list] | None = None) -> list[float]:
    """Increasing inner edges of the buckets of a numeric position.  ``seen``: rows
    and quantiles that a job of the caller's found with ``quantile_aggs``."""
    if rows_per_bucket < 1:
        raise ValueError("rows per bucket must be positive")
    parts = GRID
    n, at = seen or _quantiles(df, col, parts)
    want = min(MAX_BUCKETS, max(MIN_BUCKETS, -(-n // rows_per_bucket)))
    if want > parts:
        parts = want
        _, at = _quantiles(df, col, parts)
    step = max(1, parts // want)
    return sorted({float(v) for v in at[step - 1::step]})


def _bucketed_rows(df: DataFrame, order: RowOrder, rows_per_bucket: int) -> DataFrame:
    """``df`` with the order's bucket columns."""
    if order.bucket_exprs:
        return df.select("*", *[e.alias(n) for e, n in zip(order.bucket_exprs, order.bucket_names)])
    (name,) = order.bucket_names
    cuts = bucket_cuts(df, order.seq, rows_per_bucket) if order.cuts is None else list(order.cuts)
    if not cuts:
        return df.select("*", F.lit(0).cast("long").alias(name))
    # a binary search in the JVM; only its monotony matters, so positions that
    # doubles cannot tell apart share a bucket and stay in order inside it
    edges = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__at", outputCol="__slot",
                       handleInvalid="keep")
    found = edges.transform(df.withColumn("__at", F.col(order.seq).cast("double")))
    return found.withColumn(name, F.col("__slot").cast("long")).drop("__at", "__slot")


def as_order(order: "RowOrder | str") -> RowOrder:
    return order if isinstance(order, RowOrder) else RowOrder.numeric(order)


def ordered_pass(df: DataFrame, order: "RowOrder | str", fills: dict[str, Column] | None = None,
                 position_col: str | None = None, method: str = "bucketed",
                 width: int = ROWS_PER_BUCKET, carry_in: dict[str, Column] | None = None,
                 offset_in: Column | None = None) -> DataFrame:
    """Add forward-filled columns and/or a zero-based dense position.

    ``fills`` maps an output column name to the expression whose last
    non-null value (in row order, current row included) it receives; rows
    before the first non-null stay null.  ``position_col`` receives
    0, 1, 2, ... in row order.  ``method='window'`` is the plain one-task
    form, kept to check the bucketed one.  ``width`` is the rows per bucket
    that a numeric position aims at.

    ``carry_in`` (per fill, a scalar column) and ``offset_in`` continue an
    earlier pass: values before this frame's rows, and the number of rows
    already numbered (used by the streaming cleaner, one micro-batch at a
    time).
    """
    fills = dict(fills or {})
    if not fills and position_col is None:
        return df
    order = as_order(order)
    if method == "window":
        return _single_window(df, order, fills, position_col)
    if method != "bucketed":
        raise ValueError(f"unknown method {method!r}")
    out = _bucketed(df, order, fills, position_col, width)
    if carry_in or offset_in is not None:
        new = {name: F.coalesce(F.col(name), carry_in[name]) for name in fills if carry_in and name in carry_in}
        if position_col is not None and offset_in is not None:
            new[position_col] = F.col(position_col) + offset_in
        out = out.select(*_in_place(out.columns, new))
    return out


def _bucketed(df: DataFrame, order: RowOrder, fills: dict[str, Column],
              position_col: str | None, rows_per_bucket: int) -> DataFrame:
    bnames = list(order.bucket_names)
    tmp = {name: f"__fill_src_{i}" for i, name in enumerate(fills)}
    # a NULL position has no place in the order: fail the job, never number it
    raw_seq = F.col(order.seq)
    guard = F.assert_true(raw_seq.isNotNull(), F.lit(f"row order column {order.seq!r} holds NULL"))
    seq_type = dict(df.dtypes)[order.seq]
    staged = _bucketed_rows(df, order, rows_per_bucket).select(
        "*",
        F.coalesce(guard.cast(seq_type), raw_seq).alias("__seq"),
        *[expr.alias(tmp[name]) for name, expr in fills.items()],
    )
    seq = F.col("__seq")

    # 1. local fill and local row number inside each bucket
    w_local = Window.partitionBy(*bnames).orderBy(seq)
    w_run = w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local_cols = [F.last(tmp[name], ignorenulls=True).over(w_run).alias(f"__local_{i}")
                  for i, name in enumerate(fills)]
    if position_col is not None:
        local_cols.append((F.row_number().over(w_local) - F.lit(1)).cast("long").alias("__local_pos"))
    local = staged.select("*", *local_cols)

    # 2. per-bucket tail values and counts (partial aggregation before the shuffle)
    tail_aggs = [F.max_by(F.col(tmp[name]), F.when(F.col(tmp[name]).isNotNull(), seq)).alias(f"__tail_{i}")
                 for i, name in enumerate(fills)]
    tail_aggs.append(F.count(F.lit(1)).alias("__n"))
    buckets = staged.groupBy(*bnames).agg(*tail_aggs)

    # 3. carry-in per bucket: a scan over the bucket table
    carry = _bucket_carry(buckets, bnames, len(fills), position_col is not None)

    # 4. join back on the bucket key
    joined = local.join(carry, on=bnames, how="left")
    out = {name: F.coalesce(F.col(f"__local_{i}"), F.col(f"__carry_{i}"))
           for i, name in enumerate(fills)}
    if position_col is not None:
        out[position_col] = F.col("__local_pos") + F.col("__offset")
    return joined.select(*_in_place(df.columns, out))


def _bucket_carry(buckets: DataFrame, bnames: list[str], nfills: int, offsets: bool) -> DataFrame:
    """Per bucket: the last non-null tail of all earlier buckets, and the
    number of rows before it.

    Buckets of a numeric position are few (MAX_BUCKETS), so one window scans
    them.  (file, split) buckets are scanned file by file, and a window over
    the files (one row each) gives what precedes each of them.
    """
    tails = [f"__tail_{i}" for i in range(nfills)]
    if len(bnames) == 1:
        before = Window.orderBy(*bnames).rowsBetween(Window.unboundedPreceding, -1)
        cols = [*bnames, *[F.last(t, ignorenulls=True).over(before).alias(f"__carry_{i}") for i, t in enumerate(tails)]]
        if offsets:
            cols.append(F.coalesce(F.sum("__n").over(before), F.lit(0)).cast("long").alias("__offset"))
        return buckets.select(*cols)

    keyed = buckets.withColumn("__super", F.col(bnames[0]))
    w_in = Window.partitionBy("__super").orderBy(*bnames).rowsBetween(Window.unboundedPreceding, -1)
    inner = keyed.select(
        *bnames, "__super",
        *[F.last(t, ignorenulls=True).over(w_in).alias(f"__in_{i}") for i, t in enumerate(tails)],
        F.coalesce(F.sum("__n").over(w_in), F.lit(0)).alias("__in_off"))

    supers = keyed.groupBy("__super").agg(
        *[F.max_by(F.col(t), F.when(F.col(t).isNotNull(), F.struct(*bnames))).alias(f"__st_{i}")
          for i, t in enumerate(tails)],
        F.sum("__n").alias("__sn"))
    w_sup = Window.orderBy("__super").rowsBetween(Window.unboundedPreceding, -1)
    sup_carry = supers.select(
        "__super",
        *[F.last(f"__st_{i}", ignorenulls=True).over(w_sup).alias(f"__sc_{i}") for i in range(nfills)],
        F.coalesce(F.sum("__sn").over(w_sup), F.lit(0)).alias("__s_off"))

    both = inner.join(sup_carry, "__super", "left")
    cols = [*bnames, *[F.coalesce(F.col(f"__in_{i}"), F.col(f"__sc_{i}")).alias(f"__carry_{i}")
                       for i in range(nfills)]]
    if offsets:
        cols.append((F.col("__in_off") + F.col("__s_off")).cast("long").alias("__offset"))
    return both.select(*cols)


def _single_window(df: DataFrame, order: RowOrder, fills: dict[str, Column],
                   position_col: str | None) -> DataFrame:
    sort = [*order.bucket_exprs, F.col(order.seq)]      # a numeric position needs no bucket here
    w = Window.orderBy(*sort)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {name: F.last(expr, ignorenulls=True).over(w_run) for name, expr in fills.items()}
    if position_col is not None:
        out[position_col] = (F.row_number().over(w) - F.lit(1)).cast("long")
    return df.select(*_in_place(df.columns, out))


def _in_place(columns: list[str], new: dict[str, Column]) -> list[Column]:
    """Existing columns keep their place (replaced where named); new ones go last."""
    cols = [new[c].alias(c) if c in new else F.col(c) for c in columns]
    return cols + [expr.alias(name) for name, expr in new.items() if name not in columns]
