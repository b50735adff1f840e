"""Load stage (F1-F7): project the three tables and publish them together.

Sinks are Parquet folders.  A run writes all three tables under
``<base>/runs/<run_id>/<table>`` and only then adds a one-row pointer
``<base>/pointers/version=<n>``; readers take the highest version whose write
completed, so a failed run never leaves a mix of old and new tables and no
moment is without a valid pointer (F6): nothing is replaced in place.  Plain
Parquet has no multi-table transaction; the pointer is the commit point.  Two
writers that race for one version cannot both write it: the second fails.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import roles
from ..schemas import (CHECKS_TABLE, READINGS_COLUMNS, READINGS_TABLE, SUMMARY_TABLE,
                       TABLE_SCHEMAS)
from ..sources.files import delete, exists, parquet_if_any

DAY = "day"      # partition column of tables written by day; readers drop it


def _dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of equally named columns (by position)."""
    seen, keep = set(), []
    for i, c in enumerate(df.columns):
        if c not in seen:
            seen.add(c)
            keep.append(i)
    if len(keep) == len(df.columns):
        return df
    return df.select(*[df[i] for i in keep])


def project_sensor_readings(joined: DataFrame) -> DataFrame | None:
    """map roles, keep the target columns that exist, in target order.
    Returns None when no record_id maps (the reference then skips the table)."""
    joined = _dedupe_columns(joined)
    mapping = roles.readings_load_mapping(joined.columns)
    by_target = {t: s for s, t in mapping.items()}
    if "record_id" not in by_target:
        return None
    return joined.select(*[F.col(by_target[t]).alias(t) for t in READINGS_COLUMNS if t in by_target])


def project_quality_checks(quality: DataFrame) -> DataFrame:
    """map roles, keep mapped columns in source order."""
    mapping = roles.checks_load_mapping(quality.columns)
    return quality.select(*[F.col(s).alias(t) for s, t in mapping.items()])


def project_hourly_summary(summary: DataFrame) -> DataFrame:
    """lower-case names, keep everything."""
    return summary.toDF(*[c.lower() for c in summary.columns])


def table_contracts() -> dict:
    """declared contracts of the three tables (StructType)."""
    return dict(TABLE_SCHEMAS)


def publish_tables(spark: SparkSession, tables: dict[str, DataFrame], base: str,
                   run_id: str | None = None, partition_days: bool = False,
                   parallel: bool = True, keep_runs: int | None = None) -> str:
    """write every table of this run, then add its pointer.

    ``partition_days`` writes each table partitioned by the day of its time
    column so later reads prune by date.  The summary is sorted within each
    task by (machine, hour) -- a local sort, no shuffle -- so Parquet row-group
    statistics let machine filters skip row groups.

    With ``parallel`` the table writes are submitted as concurrent jobs (the
    small ones fill slots the big one leaves idle); the pointer is written
    only after every table write succeeded.  ``keep_runs`` removes all but the
    newest runs afterwards (None keeps all).
    """
    run_id = run_id or uuid.uuid4().hex
    base = base.rstrip("/")

    def write(name: str, df: DataFrame) -> None:
        time = "hour" if name == SUMMARY_TABLE else "timestamp"
        by_day = partition_days and time in df.columns
        if by_day:
            # a day in few files: its rows meet, and AQE splits days that are too large for a task
            df = df.withColumn(DAY, F.to_date(time)).hint("rebalance", DAY)
        if name == SUMMARY_TABLE and {"machine_id", "hour"} <= set(df.columns):
            df = df.sortWithinPartitions(*[DAY] * by_day, "machine_id", "hour")
        writer = df.write.mode("overwrite")
        (writer.partitionBy(DAY) if by_day else writer).parquet(f"{base}/runs/{run_id}/{name}")

    todo = [(n, df) for n, df in tables.items() if df is not None]
    if parallel and len(todo) > 1:
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            for fut in [pool.submit(write, n, df) for n, df in todo]:
                fut.result()   # re-raises the first failure; the pointer stays
    else:
        for n, df in todo:
            write(n, df)
    version = 1 + max(_pointers(spark, base), default=0)
    while exists(spark, f"{base}/pointers/version={version}"):    # left by a pointer write that crashed
        version += 1
    (spark.createDataFrame([(run_id,)], "run_id string").coalesce(1)
     .write.mode("errorifexists").parquet(f"{base}/pointers/version={version}"))
    if keep_runs is not None:
        drop_superseded(spark, base, keep_runs)
    return run_id


def _pointers(spark: SparkSession, base: str) -> dict[int, str]:
    """version -> run id of every completed pointer (one row per published run)."""
    found = parquet_if_any(spark, f"{base.rstrip('/')}/pointers", "run_id string, version int")
    return {} if found is None else {r.version: r.run_id for r in found.collect()}


def drop_superseded(spark: SparkSession, base: str, keep: int) -> list[str]:
    """Remove the files and pointers of all but the newest ``keep`` runs
    (readers that opened an older run need it to stay: choose ``keep`` for the
    longest reader).  Returns the removed run ids."""
    if keep < 1:
        raise ValueError("the published run is kept: keep >= 1")
    base = base.rstrip("/")
    old = sorted(_pointers(spark, base).items())[:-keep]
    for version, run_id in old:
        delete(spark, f"{base}/pointers/version={version}")   # first: no pointer without files
        delete(spark, f"{base}/runs/{run_id}")
    return [run_id for _, run_id in old]


def current_run(spark: SparkSession, base: str) -> str:
    found = _pointers(spark, base)
    if not found:
        raise FileNotFoundError(f"no published run under {base}")
    return found[max(found)]


def read_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/runs/{current_run(spark, base)}/{name}").drop(DAY)


def published_tables(spark: SparkSession, base: str) -> dict[str, DataFrame | None]:
    """The current run's tables; a table that is absent maps to None (K1).
    Only a missing folder counts as absent: any other failure is raised."""
    if not _pointers(spark, base):
        return {n: None for n in TABLE_SCHEMAS}
    run = f"{base.rstrip('/')}/runs/{current_run(spark, base)}"
    found = {name: parquet_if_any(spark, f"{run}/{name}") for name in TABLE_SCHEMAS}
    return {name: df if df is None else df.drop(DAY) for name, df in found.items()}


def create_database(spark: SparkSession, base: str) -> str | None:
    """publish empty tables with the declared contracts when nothing is
    published yet (CREATE TABLE IF NOT EXISTS).  Returns the new run id.
    Runs without a pointer are never hidden behind empty tables: that is an error."""
    if _pointers(spark, base):
        return None
    if exists(spark, f"{base.rstrip('/')}/runs"):
        raise RuntimeError(f"{base} holds runs but no pointer to one; publish again or remove them")
    empty = {name: spark.createDataFrame([], schema) for name, schema in TABLE_SCHEMAS.items()}
    return publish_tables(spark, empty, base)


def verify_counts(readings: DataFrame, checks: DataFrame, summary: DataFrame) -> DataFrame:
    """one (table, rows) row per table."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
             for name, df in ((READINGS_TABLE, readings), (CHECKS_TABLE, checks),
                              (SUMMARY_TABLE, summary))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
