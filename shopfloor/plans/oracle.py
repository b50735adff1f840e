"""Reference SQL (DuckDB dialect) for every registered query.

The pipeline is restated as plain SQL over the driver's ``events`` view:
fixtures -> cleaning with a global window fill -> standardised ids ->
null-safe LEFT JOIN -> hourly GROUP BY -> three tables.  It shares no code
with the Spark operators (only the fixture text), so agreement checks the
DataFrame implementation, its bucketed fill and its rewrites.
"""

from __future__ import annotations

from ..sources.fixtures import QUALITY_RAW_SQL, SENSOR_RAW_SQL, sql_for_duckdb

P = 6  # rounding places, as in reports.PLACES


def _flag(c2: str, c3: str) -> str:
    return f"CASE WHEN {c2} IS NULL THEN CASE WHEN {c3} IS NULL THEN 'invalid' ELSE 'estimated' END END"


def _stats(col: str, name: str) -> str:
    return (f"avg({col}) AS avg_{name}, min({col}) AS min_{name}, max({col}) AS max_{name}, "
            f"stddev_samp({col}) AS std_{name}")


PIPELINE_CTES = f"""
sensor_raw AS ({sql_for_duckdb(SENSOR_RAW_SQL)}),
quality_raw AS ({sql_for_duckdb(QUALITY_RAW_SQL)}),
quality_x AS (SELECT * FROM quality_raw WHERE inspection_status IS NOT NULL),
sensor_b1 AS (
  SELECT *,
    CASE WHEN temperature IN (-999.0, -1.0) OR isnan(temperature) THEN NULL ELSE temperature END AS t1,
    CASE WHEN pressure IN (-999.0, -1.0) OR isnan(pressure) THEN NULL ELSE pressure END AS p1,
    CASE WHEN vibration IN (-999.0, -1.0) OR isnan(vibration) THEN NULL ELSE vibration END AS v1
  FROM sensor_raw),
sensor_b2 AS (
  SELECT *,
    CASE WHEN t1 BETWEEN 0 AND 150 THEN t1 END AS t2,
    CASE WHEN p1 BETWEEN 0 AND 10 THEN p1 END AS p2,
    CASE WHEN v1 BETWEEN 0 AND 100 THEN v1 END AS v2
  FROM sensor_b1),
sensor_b3 AS (
  SELECT *,
    last_value(t2 IGNORE NULLS) OVER w AS t3,
    last_value(p2 IGNORE NULLS) OVER w AS p3,
    last_value(v2 IGNORE NULLS) OVER w AS v3
  FROM sensor_b2
  WINDOW w AS (ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
sensor_clean AS (
  SELECT row_no, timestamp, machine_id, line_id, t3 AS temperature, p3 AS pressure,
    v3 AS vibration, power,
    COALESCE({_flag('v2', 'v3')}, {_flag('p2', 'p3')}, {_flag('t2', 't3')}, 'good') AS data_quality
  FROM sensor_b3),
sensor_std AS (
  SELECT row_no, timestamp, lower(trim(machine_id)) AS machine_id, lower(trim(line_id)) AS line_id,
    temperature, pressure, vibration, power, data_quality,
    printf('REC_%08d', row_number() OVER (ORDER BY row_no) - 1) AS record_id
  FROM sensor_clean),
quality_std AS (
  SELECT row_no, timestamp, lower(trim(machine_id)) AS machine_id, lower(trim(line_id)) AS line_id,
    inspection_status, result, defect_type,
    printf('REC_%08d', row_number() OVER (ORDER BY row_no) - 1) AS record_id
  FROM quality_x),
joined AS (
  SELECT s.*, q.row_no AS row_no_quality, q.line_id AS line_id_quality, q.inspection_status,
    q.result, q.defect_type, q.record_id AS record_id_quality,
    CASE WHEN contains(lower(q.result), 'pass') THEN 'pass'
         WHEN contains(lower(q.result), 'fail') THEN 'fail' ELSE 'not_checked' END AS quality_status
  FROM sensor_std s LEFT JOIN quality_std q
    ON s.timestamp IS NOT DISTINCT FROM q.timestamp AND s.machine_id IS NOT DISTINCT FROM q.machine_id),
summary_base AS (
  SELECT date_trunc('hour', timestamp) AS hour, machine_id, line_id,
    {_stats('temperature', 'temperature')}, {_stats('pressure', 'pressure')},
    {_stats('vibration', 'vibration')}, {_stats('power', 'power')},
    count(quality_status) AS total_checks,
    count(*) FILTER (WHERE quality_status = 'fail') AS defect_count
  FROM joined
  WHERE timestamp IS NOT NULL AND machine_id IS NOT NULL AND line_id IS NOT NULL
  GROUP BY 1, 2, 3),
summary AS (
  SELECT *, COALESCE(CAST(defect_count AS DOUBLE) * 100.0 / total_checks, 0.0) AS defect_rate
  FROM summary_base),
readings AS (
  SELECT record_id, timestamp, line_id, machine_id, temperature, pressure, vibration, power,
    data_quality FROM joined),
checks AS (SELECT timestamp, machine_id, line_id, result, defect_type FROM quality_std)
"""


def with_pipeline(select: str) -> str:
    return f"WITH {PIPELINE_CTES}\n{select}"


def summary_rounded(alias: str = "") -> str:
    """Summary columns with doubles rounded, as reports.round_doubles."""
    a = f"{alias}." if alias else ""
    cols = [f"{a}hour AS hour", f"{a}machine_id AS machine_id", f"{a}line_id AS line_id"]
    for sensor in ("temperature", "pressure", "vibration", "power"):
        for stat in ("avg", "min", "max", "std"):
            cols.append(f"round({a}{stat}_{sensor}, {P}) AS {stat}_{sensor}")
    cols += [f"{a}total_checks AS total_checks", f"{a}defect_count AS defect_count",
             f"round({a}defect_rate, {P}) AS defect_rate"]
    return ", ".join(cols)
