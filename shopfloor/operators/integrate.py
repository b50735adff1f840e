"""Sensor x quality integration.

LEFT equi-join on (time, machine) -- or time alone when a side has no
machine/line column -- with the reference's key rule: NULL matches NULL
(``null_keys='match'``, pandas merge).  ``null_keys='sql'`` gives the SQL
rule instead, ``'none'`` says that neither side holds a NULL key.

Scale notes
* Stays an equi-join (hash / sort-merge), never a nested loop.
* NULL keys all hash to one value, so under the 'match' rule the NULL-key
  rows of one machine meet in one task.  Those rows are salted: a left row
  with a NULL key takes one of ``null_salt`` salts, the right NULL-key rows
  are copied once per salt, and the salt joins the key.  Every match is
  still produced exactly once, and the hot group spreads over
  ``null_salt`` tasks.
* Their pairs grow with the square of their number, while what a task reads stays
  small, so no limit on bytes splits it.  Where the pairs were counted (``null_pairs``,
  see ``null_key_load``) and are many, the NULL-key rows are joined apart: dealt over
  S x T cells like hot keys, in as many tasks as keep each near PAIRS_PER_TASK.
* Hot real keys, which a heavy-hitter sketch finds (``key_profile``), are salted
  on both sides (``hot``): their left rows take one of S salts, their right rows one
  of T, and each is copied over the other side's salts, so S x T tasks share the
  key.  What the sketch leaves out is split by AQE where it must be.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import roles
from ..functions.scalars import parse_event_time, quality_status
from ..schemas import QUALITY_SUFFIX

STATUS_COL = "quality_status"
DEFAULT_NULL_SALT = 16           # where the NULL rows were not counted
ROWS_PER_SALT, MAX_SALT = 50_000, 4_096
MAX_NULL_PAIRS = 1_000_000_000   # NULL = NULL output rows a job may write unless told otherwise
HOT_KEYS, SKETCH_ITEMS = 64, 8_192    # keys that are salted, at most; entries of the heavy-hitter sketch
MAX_HOT_SALT = 256
EXACT_TEXT = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)   # equal where their text is
PAIRS_PER_TASK, CELLS_PER_TASK = 2_000_000, 8    # NULL = NULL pairs of a task; cells hashed to it, so that tasks come out even


class NullKeyPairs(ValueError):
    """The join would emit more NULL = NULL pairs than allowed."""


def _not_checked(sensor: DataFrame) -> DataFrame:
    return sensor.withColumn(STATUS_COL, F.lit("not_checked"))


def join_plan(sensor_cols: list[str], quality_cols: list[str]):
    """Driver-side: key pairs and the output name of each right column."""
    s_time, q_time = roles.join_time_column(sensor_cols), roles.join_time_column(quality_cols)
    if s_time is None or q_time is None:
        return None
    s_mach, q_mach = roles.join_machine_column(sensor_cols), roles.join_machine_column(quality_cols)
    keys = [(s_time, q_time)]
    if s_mach and q_mach:
        keys.append((s_mach, q_mach))
    merged = {q for s, q in keys if s == q}  # same-named key pairs appear once
    renames = {}
    for c in quality_cols:
        if c in merged:
            continue
        renames[c] = c + QUALITY_SUFFIX if c in sensor_cols else c
    return keys, renames


def latest_per_key(quality: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The last row (by ``order_col``) of every key; NULL keys form one group.

    A grouped ``max_by`` rather than a window: partial aggregation keeps one
    candidate per key and map task, so a hot key never gathers in one task.
    """
    rest = [c for c in quality.columns if c not in keys]
    if not rest:
        return quality.select(*keys).distinct()
    last = quality.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias("__last"))
    return last.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in rest]).select(*quality.columns)


def join_sensor_quality(sensor: DataFrame, quality: DataFrame | None, null_keys: str = "match",
                        null_salt: int = DEFAULT_NULL_SALT, check_empty: bool = True,
                        dedupe_checks: str = "none", checks_order: str | None = None,
                        hot: dict[int, tuple[int, int]] | None = None, null_pairs: int = 0) -> DataFrame:
    """Left join + quality_status.  ``hot``: see ``hot_salts``; ``null_pairs``: the
    pairs that NULL keys make, where they were counted.

    ``check_empty`` reproduces "no quality rows -> only sensor columns"
    with a one-row probe job; without it an empty quality side simply
    yields 'not_checked' everywhere (same rows, extra NULL columns).
    ``dedupe_checks='latest'`` keeps only the last inspection (by
    ``checks_order``, default ``row_no`` or ``record_id``) of each join key,
    so a reading is never repeated (the reference's fan-out is the default).
    """
    if null_keys not in ("match", "sql", "none"):
        raise ValueError("null_keys must be 'match', 'sql' or 'none'")
    if dedupe_checks not in ("none", "latest"):
        raise ValueError("dedupe_checks must be 'none' or 'latest'")
    if quality is None:
        return _not_checked(sensor)
    plan = join_plan(sensor.columns, quality.columns)
    if plan is None:
        return _not_checked(sensor)
    if check_empty and quality.isEmpty():
        return _not_checked(sensor)
    keys, renames = plan

    # The right time key is coerced again (no-op when already a timestamp)
    q_time = keys[0][1]
    quality = quality.withColumn(q_time, parse_event_time(F.col(q_time), quality.schema[q_time].dataType))

    if dedupe_checks == "latest":
        order_col = checks_order or next((c for c in ("row_no", "record_id") if c in quality.columns), None)
        if order_col is None:
            raise ValueError("dedupe_checks='latest' needs an order column (checks_order=)")
        quality = latest_per_key(quality, [q for _, q in keys], order_col)

    s_types = {f.name: f.dataType for f in sensor.schema.fields}
    q_types = {f.name: f.dataType for f in quality.schema.fields}
    for s, q in keys:
        if type(s_types[s]) is not type(q_types[q]) and not (
                isinstance(s_types[s], T.NumericType) and isinstance(q_types[q], T.NumericType)):
            raise TypeError(f"join keys {s!r} and {q!r} have different types "
                            f"({s_types[s].simpleString()} vs {q_types[q].simpleString()})")

    right_keys = [f"__rk{i}" for i in range(len(keys))]
    right = quality.select(*[F.col(q).alias(rk) for (_, q), rk in zip(keys, right_keys)],
                           *[F.col(c).alias(n) for c, n in renames.items()])

    pairs = [(s, rk) for (s, _), rk in zip(keys, right_keys)]
    if hot and dedupe_checks == "none":
        hot_left, hot_right = (F.xxhash64(*[F.col(c) for c in names]).isin(*hot) for names in zip(*pairs))
        hot_left = hot_left & ~_any_null([F.col(s) for s, _ in pairs])      # a hash may meet another key's
        hot_right = hot_right & ~_any_null([F.col(rk) for _, rk in pairs])
        joined = _left_join(sensor.where(~hot_left), right.where(~hot_right), pairs, null_keys, null_salt, null_pairs).unionByName(
            _hot_join(sensor.where(hot_left), right.where(hot_right), pairs, hot))
    else:
        joined = _left_join(sensor, right, pairs, null_keys, null_salt, null_pairs)

    out_cols = [F.col(c) for c in sensor.columns]
    out_cols += [F.col(n) for n in renames.values()]
    joined = joined.select(*out_cols)

    rcol = roles.result_column(joined.columns)
    return joined.withColumn(STATUS_COL, quality_status(F.col(rcol) if rcol else None))


def _left_join(sensor: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], null_keys: str,
               null_salt: int, null_pairs: int = 0) -> DataFrame:
    """LEFT equi-join under one of the three rules for NULL keys."""
    if null_keys == "none":
        return sensor.join(right, _and([F.col(s) == F.col(rk) for s, rk in pairs]), "left")
    if null_keys == "sql":
        return left_join_sql_nulls(sensor, right, pairs, null_salt)
    salt = max(1, int(null_salt))
    left_null = _any_null([F.col(s) for s, _ in pairs])
    right_null = _any_null([F.col(rk) for _, rk in pairs])
    types = [{df.schema[c].dataType for df, c in ((sensor, s), (right, rk))} for s, rk in pairs]
    if null_pairs > PAIRS_PER_TASK and all(len(t) == 1 and isinstance(*t, EXACT_TEXT) for t in types):
        keyed = _left_join(sensor.where(~left_null), right.where(~right_null), pairs, "none", salt)
        return keyed.unionByName(_null_join(sensor.where(left_null), right.where(right_null), pairs, null_pairs))
    # left: NULL-key rows spread over salts by a hash of the whole row
    left = sensor.withColumn(
        "__salt", F.when(left_null, F.pmod(F.xxhash64(*[F.col(c) for c in sensor.columns]),
                                           F.lit(salt))).otherwise(F.lit(0)).cast("int"))
    # right: NULL-key rows copied once per salt, the rest once
    right = right.withColumn(
        "__rsalt", F.explode(F.when(right_null, F.sequence(F.lit(0), F.lit(salt - 1)))
                            .otherwise(F.array(F.lit(0)))))
    cond = [F.col(s).eqNullSafe(F.col(rk)) for s, rk in pairs]
    cond.append(F.col("__salt") == F.col("__rsalt"))
    return left.join(right, on=_and(cond), how="left").drop("__salt", "__rsalt")


def _null_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], null_pairs: int) -> DataFrame:
    """LEFT equi-join, NULL = NULL, of the rows with a NULL key: left rows take one of
    ``side`` salts, right rows too, and each is copied over the other side's.  The number
    of tasks is given, as AQE would join small inputs with a large output in few."""
    tasks = -(-null_pairs // PAIRS_PER_TASK)
    side = math.isqrt(tasks * CELLS_PER_TASK - 1) + 1

    def dealt(df: DataFrame, names: list[str], cell: str, own_first: bool) -> DataFrame:
        # by content, so that a task that is run again deals its rows as before
        own = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(side)).cast("int")
        copies = df.withColumn("__own", own).withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
        at = ("__own", "__copy") if own_first else ("__copy", "__own")
        # one key without NULLs, so that the join takes the partitions as they are; only a
        # machine, the last key, can hold the separator
        parts = [F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(c).cast("string"))) for c in names]
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in at], *parts)
        return copies.withColumn(cell, key).drop("__own", "__copy").repartition(tasks, cell)

    own, other = [s for s, _ in pairs], [rk for _, rk in pairs]
    met = dealt(left, own, "__cell", True).join(dealt(right, other, "__rcell", False).hint("merge"),
                                                F.col("__cell") == F.col("__rcell")).drop("__cell", "__rcell")
    keys = right.select(*[F.col(c).alias(f"__n{i}") for i, c in enumerate(other)]).distinct()
    alone = left.join(keys, _and([F.col(c).eqNullSafe(F.col(f"__n{i}")) for i, c in enumerate(own)]), "left_anti")
    return met.unionByName(alone.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]))


def _hot_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]],
              hot: dict[int, tuple[int, int]]) -> DataFrame:
    """LEFT equi-join of the rows of hot keys, dealt over S x T salts each."""
    def salts(side: int, names: list[str]) -> Column:
        sizes = F.create_map(*[F.lit(x) for h, st in hot.items() for x in (h, st[side])])
        return F.element_at(sizes, F.xxhash64(*[F.col(c) for c in names]))

    own, other = [s for s, _ in pairs], [rk for _, rk in pairs]

    def dealt(df: DataFrame, names: list[str], side: int) -> DataFrame:
        # by content, so that a task that is run again deals its rows as before
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), salts(side, names)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), salts(1 - side, names) - F.lit(1)))
        first, second = ("__s", "__t") if side == 0 else ("__rt", "__rs")
        return df.withColumn(first, spread).withColumn(second, copies)

    equal = [F.col(s) == F.col(rk) for s, rk in pairs]
    met = dealt(left, own, 0).join(dealt(right, other, 1), _and([*equal, F.col("__s") == F.col("__rs"),
                                                                 F.col("__t") == F.col("__rt")])).drop("__s", "__t", "__rs", "__rt")
    keys = right.select(*other).distinct()                                   # a few: they are combined before the shuffle
    alone = left.join(keys, _and(equal), "left_anti")
    return met.unionByName(alone.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]))


def key_profile(df: DataFrame, keys: list[str], aggs: list[Column] | None = None):
    """One job over the key columns: rows (``rows``), rows with a NULL key
    (``null_rows``), a heavy-hitter sketch of the other keys' hashes (``heavy``:
    hash and estimate), and further aggregates."""
    absent = _any_null([F.col(c) for c in keys])
    frame = df.withColumn("__key", F.when(~absent, F.xxhash64(*[F.col(c) for c in keys])))
    return frame.agg(F.count(F.lit(1)).alias("rows"), F.count_if(absent).alias("null_rows"),
                     F.expr(f"approx_top_k(__key, {HOT_KEYS}, {SKETCH_ITEMS})").alias("heavy"), *(aggs or [])).first()


def hot_salts(left, right, rows_per_salt: int = ROWS_PER_SALT) -> dict[int, tuple[int, int]]:
    """Key hash -> (left salts, right salts), of the keys that either profile shows
    with more than ``rows_per_salt`` rows.  The sketches name no key that is not
    frequent, and miss none that has more than about 1/6,000 of a side's rows."""
    def salts(profile) -> dict[int, int]:
        return {h.item: min(MAX_HOT_SALT, -(-h["count"] // rows_per_salt)) for h in profile["heavy"] or []
                if h.item is not None and h["count"] > rows_per_salt} if profile is not None else {}

    a, b = salts(left), salts(right)
    return {h: (a.get(h, 1), b.get(h, 1)) for h in sorted(a.keys() | b.keys())}


def left_join_sql_nulls(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]],
                        null_salt: int = DEFAULT_NULL_SALT) -> DataFrame:
    """LEFT equi-join with the SQL rule (a NULL key matches nothing).

    Left rows with a NULL key cannot match, but would all hash to one
    reducer.  They carry a salt 1..n that joins the key (the right side
    carries 0, or -1 for its own NULL keys), so they spread over n tasks and
    still find no partner.  Column names of the two sides must be disjoint.
    """
    salt = max(1, int(null_salt))
    l_null = _any_null([F.col(a) for a, _ in pairs])
    r_null = _any_null([F.col(b) for _, b in pairs])
    left = left.withColumn("__nk", F.when(l_null, F.lit(1) + F.pmod(
        F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salt))).otherwise(F.lit(0)).cast("int"))
    right = right.withColumn("__rnk", F.when(r_null, F.lit(-1)).otherwise(F.lit(0)))
    cond = [F.col(a) == F.col(b) for a, b in pairs] + [F.col("__nk") == F.col("__rnk")]
    return left.join(right, on=_and(cond), how="left").drop("__nk", "__rnk")


def null_key_load(sensor: DataFrame, quality: DataFrame) -> tuple[int, int]:
    """(sensor rows with a NULL key, pairs they would make under 'match').  Rows
    are counted per key on each side first, so nothing is paired to count it."""
    plan = join_plan(sensor.columns, quality.columns)
    if plan is None:
        return 0, 0
    keys, _ = plan

    def counted(df: DataFrame, names: list[str], prefix: str) -> DataFrame:
        cols = [F.col(c) for c in names]
        return (df.where(_any_null(cols)).groupBy(*[c.alias(f"{prefix}{i}") for i, c in enumerate(cols)])
                .agg(F.count(F.lit(1)).alias(f"{prefix}n")))

    left, right = counted(sensor, [s for s, _ in keys], "l"), counted(quality, [q for _, q in keys], "r")
    same = _and([F.col(f"l{i}").eqNullSafe(F.col(f"r{i}")) for i in range(len(keys))])
    pairs = F.sum(F.col("ln").cast("decimal(38,0)") * F.coalesce("rn", F.lit(0)))
    row = left.join(right, same, "left").agg(F.sum("ln").alias("rows"), pairs.alias("pairs")).first()
    return int(row["rows"] or 0), int(row["pairs"] or 0)


def salt_for(null_rows: int) -> int:
    return max(1, min(MAX_SALT, -(-null_rows // ROWS_PER_SALT)))


def refuse_null_pairs(pairs: int, limit: int | None) -> None:
    if limit is not None and pairs > limit:
        raise NullKeyPairs(f"rows without a time or machine would be joined into {pairs} pairs (limit {limit}); "
                           "use null_keys='sql', repair the keys, or raise max_null_pairs")


def _and(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _any_null(cols: list[Column]) -> Column:
    out = cols[0].isNull()
    for c in cols[1:]:
        out = out | c.isNull()
    return out


def quality_status_distribution(joined: DataFrame) -> DataFrame:
    """Rows per quality_status."""
    return joined.groupBy(STATUS_COL).agg(F.count(F.lit(1)).alias("count"))
