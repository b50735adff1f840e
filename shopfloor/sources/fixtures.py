"""Production-line inputs derived from the driver's ``events`` table.

The two views below are the portable fixtures of FIXTURES.md: the sensor
text runs unchanged in Spark SQL and in DuckDB (where ``events`` is a
registered view); the quality view shares its select list and filter and
differs only in how each event is doubled (a generator in Spark, the
document's constant cross join in DuckDB).  So the Spark pipeline and its
SQL oracle start from identical rows.  ``row_no`` carries file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

SENSOR_RAW_SQL = """
SELECT event_id AS row_no,
 CASE WHEN event_id % 211 = 0 THEN NULL ELSE ts END AS timestamp,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE ' Machine_' || CAST(user_id % 20 AS STRING) END AS machine_id,
 'Line_' || CAST(user_id % 4 AS STRING) AS line_id,
 CASE WHEN event_id < 3 THEN NULL WHEN event_id % 41 = 0 THEN -999.0 WHEN event_id % 43 = 0 THEN -1.0 WHEN event_id % 47 = 0 THEN NULL ELSE CAST(value AS DOUBLE) END AS temperature,
 CASE WHEN event_id % 53 = 0 THEN -1.0 ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 8.0 END AS pressure,
 CASE WHEN event_id < 5 THEN 500.0 WHEN event_id % 59 = 0 THEN NULL ELSE CAST((event_id * 7919) % 1010 AS DOUBLE) / 8.0 - 0.5 END AS vibration,
 CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST((event_id * 31) % 4000 AS DOUBLE) / 4.0 END AS power
FROM {events}
"""

_QUALITY_SELECT = """
SELECT event_id * 2 + dup AS row_no,
 CASE WHEN event_id % 211 = 0 THEN NULL ELSE ts END AS timestamp,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'MACHINE_' || CAST(user_id % 20 AS STRING) || ' ' END AS machine_id,
 'Line_' || CAST(user_id % 4 AS STRING) AS line_id,
 CASE WHEN event_id % 13 = 0 OR event_id % 4 = 0 THEN NULL ELSE 'completed' END AS inspection_status,
 CASE WHEN dup = 1 THEN 'fail' WHEN event_type = 'error' THEN 'FAIL - rework' WHEN event_type = 'view' THEN 'inconclusive' WHEN event_type = 'signup' THEN NULL WHEN event_type = 'click' THEN 'Passed after fail' ELSE 'pass' END AS result,
 CASE WHEN event_type = 'error' OR dup = 1 THEN 'defect_' || CAST(event_id % 3 AS STRING) END AS defect_type
"""
# Every event has an inspection; those without a status were not carried out.
# Some events have a second one (dup = 1): a repeated inspection that failed.
_TWICE = "CASE WHEN event_id % 50 = 1 THEN {twice} ELSE {once} END"

# As written in FIXTURES.md (run by the DuckDB oracle).
QUALITY_RAW_SQL = _QUALITY_SELECT + "FROM (SELECT *, unnest({dups}) AS dup FROM {{events}})\n".format(
    dups=_TWICE.format(twice="[0, 1]", once="[0]"))
QUALITY_RAW_SPARK_SQL = _QUALITY_SELECT + "FROM {{events}} LATERAL VIEW explode({dups}) d AS dup\n".format(
    dups=_TWICE.format(twice="array(0, 1)", once="array(0)"))


def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SENSOR_RAW_SQL, events=read_table(spark, sf_dir, "events"))


def quality_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(QUALITY_RAW_SPARK_SQL, events=read_table(spark, sf_dir, "events"))


def sql_for_duckdb(text: str) -> str:
    return text.format(events="events")
