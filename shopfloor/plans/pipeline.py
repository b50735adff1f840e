"""The batch job (F8) as one lazy plan.

extract -> clean + record ids (one ordered pass) -> standardise -> join ->
hourly roll-up -> three table projections.  Nothing runs until a table is
written or queried; ``run_pipeline`` writes all three from one staged join.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import roles
from ..operators.clean import clean_sensor_data
from ..operators.factorised import joined_hourly_summary, status_distribution
from ..operators.integrate import (DEFAULT_NULL_SALT, MAX_NULL_PAIRS, STATUS_COL, hot_salts, join_plan,
                                   join_sensor_quality, key_profile, null_key_load, quality_status_distribution,
                                   refuse_null_pairs, salt_for, PAIRS_PER_TASK)
from ..operators.load import (project_hourly_summary, project_quality_checks,
                              project_sensor_readings, publish_tables)
from ..operators.ordered import ROWS_PER_BUCKET, RowOrder, bucket_cuts, quantile_aggs
from ..operators.standardize import POSITION_COL, standardize_data
from ..operators.summary import hourly_summary
from ..schemas import CHECKS_TABLE, READINGS_TABLE, SUMMARY_TABLE, TABLE_SCHEMAS
from ..sources import extract, fixtures
from ..sources.files import delete


class Pipeline:
    """The frames of one run, each planned when it is first asked for, so that only
    the jobs run that its plan needs: one over each source's keys (and, for the
    sensor rows, their positions), and one more for the quality positions where
    inspections get ids."""

    def __init__(self, sensor_raw: DataFrame, quality_raw: DataFrame | None, sensor_order, quality_order,
                 days_back: int | None, as_of, null_keys: str, null_salt: int | None, max_null_pairs: int | None,
                 method: str, width: int, quality_ids: bool, check_empty: bool, dedupe_checks: str):
        self.sensor_raw, self.quality_raw = sensor_raw, quality_raw
        self.sensor_extracted = extract.extract_sensor(sensor_raw, days_back=days_back, as_of=as_of)
        self.quality_extracted = extract.extract_quality(quality_raw) if quality_raw is not None else None
        self._sensor_order, self._quality_order = sensor_order, quality_order
        self._null_keys, self._null_salt, self._max_null_pairs = null_keys, null_salt, max_null_pairs
        self._method, self._width, self._ids = method, width, quality_ids
        self._check_empty, self._dedupe = check_empty, dedupe_checks

    @cached_property
    def _sensor_plain(self) -> DataFrame:
        """Readings as the join sees their keys, without the ordered pass."""
        return standardize_data(self.sensor_extracted, assign_ids=False)

    @cached_property
    def _quality_plain(self) -> DataFrame | None:
        return None if self.quality_extracted is None else standardize_data(self.quality_extracted, assign_ids=False)

    @cached_property
    def _keys(self) -> list[tuple[str, str]] | None:
        plan = None if self._quality_plain is None else join_plan(self._sensor_plain.columns, self._quality_plain.columns)
        return None if plan is None else plan[0]

    @cached_property
    def _sensor_profile(self):
        """Keys and positions of the readings, in one job."""
        order = self._numeric_order
        aggs = quantile_aggs(order) if order else []
        return key_profile(self._sensor_plain, [s for s, _ in self._keys], aggs) if self._keys else None

    @cached_property
    def _quality_profile(self):
        return key_profile(self._quality_plain, [q for _, q in self._keys]) if self._keys else None

    @property
    def _numeric_order(self) -> str | None:
        """The readings' position column after normalisation, where buckets lie between its quantiles."""
        plain = isinstance(self._sensor_order, str) and self._method == "bucketed"
        return roles.normalized_name(self._sensor_order) if plain else None

    @cached_property
    def sensor_clean(self) -> DataFrame:
        # fill and dense position share one ordered pass over the sensor rows
        order = self._sensor_order
        if self._numeric_order and self._sensor_profile is not None:
            seen = self._sensor_profile["n"], self._sensor_profile["at"] or []
            order = RowOrder.numeric(order, bucket_cuts(self.sensor_extracted, order, self._width, seen))
        return clean_sensor_data(self.sensor_extracted, order=order, position_col=POSITION_COL,
                                 method=self._method, width=self._width)

    @cached_property
    def sensor_std(self) -> DataFrame:
        return standardize_data(self.sensor_clean, order=self._sensor_order, method=self._method, width=self._width)

    @cached_property
    def quality_std(self) -> DataFrame | None:
        if self._quality_plain is None or not self._ids:
            return self._quality_plain
        return standardize_data(self.quality_extracted, order=self._quality_order, method=self._method, width=self._width)

    @cached_property
    def _hot(self) -> dict[int, tuple[int, int]]:
        """Real keys to salt: those that a sketch of either side shows hot."""
        return hot_salts(self._sensor_profile, self._quality_profile) if self._keys else {}

    def _unless_empty(self, quality: DataFrame | None) -> DataFrame | None:
        """The reference joins nothing where there is no inspection."""
        return None if self._check_empty and self._keys and self._quality_profile["rows"] == 0 else quality

    @cached_property
    def null_pairs(self) -> int:
        """NULL = NULL pairs of the join, from counts per key."""
        return null_key_load(self._sensor_plain, self._quality_plain)[1]

    def null_pairs_without(self, *columns: str) -> int:
        """The same where the readings lack ``columns``."""
        return null_key_load(self._sensor_plain.drop(*columns), self._quality_plain)[1]

    def _join(self, quality: DataFrame | None) -> DataFrame:
        quality = self._unless_empty(quality)
        salt, pairs = self._null_salt or DEFAULT_NULL_SALT, 0
        if self._null_keys == "match" and quality is not None and self._keys and self._null_salt is None:
            left, right = self._sensor_profile["null_rows"], self._quality_profile["null_rows"]
            limit = self._max_null_pairs
            if self._dedupe == "none" and left * right > (PAIRS_PER_TASK if limit is None else min(limit, PAIRS_PER_TASK)):      # else they are few
                pairs = self.null_pairs
                refuse_null_pairs(pairs, limit)
            salt = salt_for(left)
        return join_sensor_quality(self.sensor_std, quality, null_keys=self._null_keys, null_salt=salt,
                                   check_empty=False, dedupe_checks=self._dedupe, hot=self._hot, null_pairs=pairs)

    @cached_property
    def joined(self) -> DataFrame:
        return self._join(self.quality_std)

    @cached_property
    def joined_without_check_ids(self) -> DataFrame:
        """``joined`` for what reads no inspection id, which saves the quality positions' job."""
        plain = self._quality_plain
        by_id = self._dedupe == "latest" and plain is not None and "row_no" not in plain.columns
        return self.joined if by_id else self._join(plain)

    @cached_property
    def summary(self) -> DataFrame:
        if self._null_keys == "match" and self._dedupe == "none":
            return joined_hourly_summary(self.sensor_std, self._unless_empty(self._quality_plain), self._hot)     # no NULL = NULL pairs
        return hourly_summary(self.joined_without_check_ids)

    @cached_property
    def status_distribution(self) -> DataFrame:
        if self._null_keys == "match" and self._dedupe == "none":
            return status_distribution(self._sensor_plain, self._quality_plain)
        return quality_status_distribution(self.joined_without_check_ids)

    @cached_property
    def readings(self) -> DataFrame | None:
        return project_sensor_readings(self.joined_without_check_ids)

    @cached_property
    def checks(self) -> DataFrame | None:
        return None if self._quality_plain is None else project_quality_checks(self._quality_plain)

    @cached_property
    def hourly(self) -> DataFrame:
        return project_hourly_summary(self.summary)

    def tables(self) -> dict[str, DataFrame]:
        return {READINGS_TABLE: self.readings, CHECKS_TABLE: self.checks,
                SUMMARY_TABLE: self.hourly}


def build(sensor_raw: DataFrame, quality_raw: DataFrame | None, sensor_order="row_no",
          quality_order="row_no", days_back: int | None = None, as_of=None,
          null_keys: str = "match", null_salt: int | None = None,
          max_null_pairs: int | None = MAX_NULL_PAIRS,
          method: str = "bucketed", width: int = ROWS_PER_BUCKET,
          quality_ids: bool = True, check_empty: bool = True,
          dedupe_checks: str = "none") -> Pipeline:
    """``null_keys='match'`` joins rows without a time or machine with each other,
    as the reference does.  Joined rows (``joined``, ``readings``) are refused above
    ``max_null_pairs`` such pairs; the summary and the status distribution need no
    pairs and have no limit.  ``'sql'`` is the setting for large inputs: such rows
    find no partner."""
    return Pipeline(sensor_raw, quality_raw, sensor_order, quality_order, days_back, as_of, null_keys, null_salt,
                    max_null_pairs, method, width, quality_ids, check_empty, dedupe_checks)


def from_sf_dir(spark: SparkSession, sf_dir: str, **options) -> Pipeline:
    """The pipeline over the fixture views of a scale-factor folder.  The queries' SQL
    asks for every NULL = NULL pair, so none is refused unless ``options`` say so."""
    session.configure(spark)
    options.setdefault("max_null_pairs", None)
    return build(fixtures.sensor_raw(spark, sf_dir), fixtures.quality_raw(spark, sf_dir),
                 **options)


def sink_columns(joined: DataFrame) -> DataFrame:
    """Only the joined columns the two sinks read: the readings mapping and
    the summary's time, group, sensor and status columns, in their original
    order (the role rules pick the same columns from the narrower frame).
    Everything else -- e.g. the quality side's record ids and the whole
    ordered pass behind them -- is pruned before the checkpoint."""
    cols = joined.columns
    need = set(roles.readings_load_mapping(cols))
    tcol = roles.hourly_time_column(cols)
    if tcol is not None:
        need.add(tcol)
        need.update(roles.hourly_group_columns(cols))
        need.update(roles.hourly_sensor_columns(cols).values())
    need.add(STATUS_COL)
    return joined.select(*[c for c in cols if c in need])


@dataclass
class RunReport:
    run_id: str
    rows: dict[str, int]


def run_pipeline(spark: SparkSession, pipeline: Pipeline, out_base: str,
                 run_id: str | None = None, stage_join: bool = True,
                 partition_days: bool = False, keep_runs: int | None = None) -> RunReport:
    """F8: write the three tables of one run and publish them together.

    The joined columns feed two sinks (readings, summary); they are written once
    as Parquet in the cluster's checkpoint folder, so each sink reads only its
    columns and a lost executor re-reads files instead of repeating the scan, the
    ordered pass and the join.  That copy is removed once the run is published.
    Row counts (A10) are observed on the jobs that run anyway, never by extra
    counts.  ``partition_days`` and ``keep_runs``: see ``publish_tables``.
    """
    observed = {}

    def watch(df: DataFrame | None, name: str) -> DataFrame | None:
        if df is None:
            return None
        df, obs = extract.observe_rows(df, name)
        observed[name] = obs
        return df

    joined = sink_columns(pipeline.joined_without_check_ids)
    staged = None
    if stage_join:
        # observed once, on the one job that computes it; the NULL-key count
        # shows how much of the join came from NULL = NULL matches (4.3.5)
        joined, obs = extract.observe_rows(
            joined, "joined",
            null_key_rows=F.count_if(F.col("timestamp").isNull() | F.col("machine_id").isNull())
            if {"timestamp", "machine_id"} <= set(joined.columns) else None)
        observed["joined"] = obs
        staged = session.scratch_path(spark, f"shopfloor-joined-{uuid.uuid4().hex}")
        schema = joined.schema
        joined.write.parquet(staged)
        joined = spark.read.schema(schema).parquet(staged)
    summary = project_hourly_summary(hourly_summary(joined))
    tables = {READINGS_TABLE: watch(project_sensor_readings(joined), READINGS_TABLE),
              CHECKS_TABLE: watch(pipeline.checks, CHECKS_TABLE),
              SUMMARY_TABLE: watch(summary, SUMMARY_TABLE)}
    # a table this run cannot produce is published empty with its contract,
    # as a table created by the DDL and never loaded
    empty = [name for name, df in tables.items() if df is None]
    for name in empty:
        tables[name] = spark.createDataFrame([], TABLE_SCHEMAS[name])
    rid = publish_tables(spark, tables, out_base, run_id, partition_days=partition_days, keep_runs=keep_runs)
    if staged is not None:
        delete(spark, staged)
    rows = {name: int(obs.get.get("rows", 0)) for name, obs in observed.items()}
    rows.update({name: 0 for name in empty})
    null_keys = observed["joined"].get.get("null_key_rows") if "joined" in observed else None
    if null_keys is not None:
        rows["joined_null_key_rows"] = int(null_keys)
    return RunReport(rid, rows)
