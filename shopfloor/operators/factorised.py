"""What the joined readings add up to, without building the NULL = NULL pairs.

Under the reference's rule rows without a time or machine match each other, so their
joined rows grow with the square of their number.  Totals need no pairs: a reading
repeats once for each inspection of its key, so the statistics of a key's readings
are multiplied by the counts of the key's inspections.  Both sides are reduced first
(map-side), so a key that holds a third of the rows is one row when the sides meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import roles
from ..functions.scalars import hour_bucket, parse_event_time, quality_status
from ..schemas import STATUS_FAIL, STATUS_NOT_CHECKED, STATUS_PASS
from .integrate import STATUS_COL, join_plan, join_sensor_quality
from .stats import combine_stats, group_columns, hour_stats, summary_of
from .summary import hourly_summary


def _null(names: list[str]) -> Column:
    out = F.col(names[0]).isNull()
    for c in names[1:]:
        out = out | F.col(c).isNull()
    return out


def _counted(quality: DataFrame, keys: list[tuple[str, str]], groups: list[tuple[str, str]]) -> DataFrame:
    """Inspections per key (``__k0``, ...) and right-side group column: how many, and
    how many passed and failed."""
    rcol = roles.result_column(quality.columns)
    status = quality_status(F.col(rcol) if rcol else None)
    rows = quality.select(
        *[parse_event_time(F.col(q), quality.schema[q].dataType).alias(f"__k{i}") if i == 0 else F.col(q).alias(f"__k{i}")
          for i, (_, q) in enumerate(keys)],
        *[F.col(q).alias(name) for q, name in groups], status.alias("__status"))
    return rows.groupBy(*[f"__k{i}" for i in range(len(keys))], *[name for _, name in groups]).agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(F.col("__status") == STATUS_PASS).alias("__pass"),
        F.count_if(F.col("__status") == STATUS_FAIL).alias("__fail"))


def _meet(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    cond = F.col(keys[0][0]).eqNullSafe(F.col("__k0"))
    for i, (s, _) in enumerate(keys[1:], 1):
        cond = cond & F.col(s).eqNullSafe(F.col(f"__k{i}"))
    return left.join(right, cond, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def status_distribution(sensor: DataFrame, quality: DataFrame | None) -> DataFrame:
    """D6 of ``join_sensor_quality(sensor, quality)``: joined rows per quality_status,
    from counts per key."""
    plan = None if quality is None else join_plan(sensor.columns, quality.columns)
    if plan is None:
        return (sensor.agg(F.count(F.lit(1)).alias("count")).where("count > 0")
                .select(F.lit(STATUS_NOT_CHECKED).alias(STATUS_COL), "count"))
    keys, _ = plan
    readings = sensor.groupBy(*[s for s, _ in keys]).agg(F.count(F.lit(1)).alias("__r"))
    met = _meet(readings, _counted(quality, keys, []), keys).na.fill(0, ["__pass", "__fail"])
    rest = F.when(F.col("__n").isNull(), F.lit(1)).otherwise(F.col("__n") - F.col("__pass") - F.col("__fail"))
    sums = met.agg(*[F.sum(F.col("__r") * times).alias(name) for name, times in (
        (STATUS_PASS, F.col("__pass")), (STATUS_FAIL, F.col("__fail")), (STATUS_NOT_CHECKED, rest))])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias(STATUS_COL), F.col(c).alias("count")) for c in sums.columns]))
    return sums.select(rows.alias("row")).select("row.*").where("count > 0")


def joined_hourly_summary(sensor: DataFrame, quality: DataFrame | None,
                          hot: dict[int, tuple[int, int]] | None = None) -> DataFrame:
    """E6 of ``join_sensor_quality(sensor, quality)``.  Rows with all keys are joined
    as usual.  NULL-key readings fall out of the summary where every key is one of its
    groups (or its time); else their statistics are multiplied as described above."""
    plan = None if quality is None else join_plan(sensor.columns, quality.columns)
    if plan is None:
        return hourly_summary(join_sensor_quality(sensor, None))
    keys, renames = plan
    own, other = [s for s, _ in keys], [q for _, q in keys]
    quality_time = parse_event_time(F.col(other[0]), quality.schema[other[0]].dataType)
    checks = quality.withColumn(other[0], quality_time)
    keyed = join_sensor_quality(sensor.where(~_null(own)), checks.where(~_null(other)), null_keys="none",
                                check_empty=False, hot=hot)
    time = roles.hourly_time_column(keyed.columns)
    groups = group_columns(keyed.columns)
    if time is None or set(own) <= {time, *groups}:
        return hourly_summary(keyed)
    if time not in sensor.columns or not set(roles.hourly_sensor_columns(keyed.columns).values()) <= set(sensor.columns):
        return hourly_summary(join_sensor_quality(sensor, checks, check_empty=False, hot=hot))   # measured on the right side
    stray = sensor.where(_null(own))
    left_groups = [c for c in groups if c in sensor.columns]
    right_groups = [(q, name) for q, name in renames.items() if name in groups]
    sensors = roles.hourly_sensor_columns(keyed.columns)
    part = hour_stats(stray.select(
        *[F.col(c).alias(f"__own{i}") for i, c in enumerate(own)], F.col(time), *left_groups, *set(sensors.values()),
        F.lit(STATUS_NOT_CHECKED).alias(STATUS_COL)), by=[f"__own{i}" for i in range(len(own))])
    met = _meet(part, _counted(checks.where(_null(other)), [(f"__own{i}", q) for i, q in enumerate(other)], right_groups),
                [(f"__own{i}", q) for i, q in enumerate(other)]).dropna(subset=groups)
    times = F.coalesce("__n", F.lit(1))
    scaled = {f"{x}_{s}": F.col(f"{x}_{s}") * times for s in sensors for x in ("n", "m2")}
    scaled |= {"defect_count": F.col("total_checks") * F.coalesce("__fail", F.lit(0)),
               "total_checks": F.col("total_checks") * times}
    whole = hour_stats(keyed)
    return summary_of(combine_stats(whole.unionByName(met.withColumns(scaled).select(*whole.columns))))
