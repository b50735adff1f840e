"""Column roles found by name fragments (driver-side metadata, no job).

Input files name their columns freely, so each stage discovers its columns
by substring rules.  The rules differ per stage in case handling, in
exclusions and in which match wins (first, last or all); each function
below states its rule.  Only ``DataFrame.columns`` / ``schema`` is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..schemas import (DEFECT_FRAGMENTS, EXCLUDED_FRAGMENT, FLAG_COLUMN, IDENTIFIER_FRAGMENTS,
                       KEY_FRAGMENTS, POWER_FRAGMENT, RECORD_ID_COLUMN, RESULT_FRAGMENT,
                       SENSOR_ROLE_FRAGMENTS, STATUS_FRAGMENT, TIME_FRAGMENTS)

TEMP, PRESS, VIBR = (SENSOR_ROLE_FRAGMENTS[r] for r in ("temperature", "pressure", "vibration"))
Q = EXCLUDED_FRAGMENT


def _has_any(name: str, fragments: tuple[str, ...]) -> bool:
    return any(f in name for f in fragments)


def first_time_column(columns: list[str], lower: bool = True) -> str | None:
    """First column whose name contains 'time' or 'date'."""
    for c in columns:
        name = c.lower() if lower else c
        if _has_any(name, TIME_FRAGMENTS):
            return c
    return None


def first_status_column(columns: list[str]) -> str | None:
    """First column whose lower-cased name contains 'status'."""
    return next((c for c in columns if STATUS_FRAGMENT in c.lower()), None)


def sensor_cleaning_steps(columns: list[str]) -> list[tuple[str, str]]:
    """(role, column) pairs in processing order: every 'temp' column, then
    every 'press' column, then every 'vibr' column (frame order inside)."""
    steps = []
    for role, fragment in SENSOR_ROLE_FRAGMENTS.items():
        steps += [(role, c) for c in columns if fragment in c.lower()]
    return steps


def identifier_columns(df: DataFrame) -> list[str]:
    """String columns named like 'machine', 'line' or 'sensor'."""
    return [f.name for f in df.schema.fields
            if _has_any(f.name, IDENTIFIER_FRAGMENTS)
            and isinstance(f.dataType, T.StringType)]


def time_like_columns(df: DataFrame) -> list[str]:
    """Columns with 'time' or 'date' in the name that can hold a time:
    text, date or timestamp (numeric ones are left alone)."""
    ok = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields
            if _has_any(f.name, TIME_FRAGMENTS) and isinstance(f.dataType, ok)]


def join_machine_column(columns: list[str]) -> str | None:
    """First column containing 'machine' or 'line' (names already lower)."""
    return next((c for c in columns if _has_any(c, KEY_FRAGMENTS)), None)


def join_time_column(columns: list[str]) -> str | None:
    """First column containing 'time' or 'date' (names already lower)."""
    return first_time_column(columns, lower=False)


def result_column(columns: list[str]) -> str | None:
    """First column whose lower-cased name contains 'result'."""
    return next((c for c in columns if RESULT_FRAGMENT in c.lower()), None)


def hourly_time_column(columns: list[str]) -> str | None:
    """First column containing 'time' (case-sensitive) and not 'quality'."""
    return next((c for c in columns if TIME_FRAGMENTS[0] in c and Q not in c), None)


def hourly_group_columns(columns: list[str]) -> list[str]:
    """Every column with 'line' or 'machine' (any case) and no 'quality'."""
    return [c for c in columns
            if _has_any(c.lower(), KEY_FRAGMENTS) and Q not in c]


@dataclass(frozen=True)
class Rule:
    """How one role finds its columns by (lower-cased) name.

    exact: the whole name must be the fragment.  plain: names that hold
    'quality' do not count.  pick: which of the matching columns the role
    takes, 0 the first, -1 the last.  greedy: the other matching columns are
    used up too, they are not left for later roles.
    """

    role: str
    fragments: tuple[str, ...]
    exact: bool = False
    plain: bool = False
    pick: int = 0
    greedy: bool = False

    def matches(self, name: str) -> bool:
        found = name in self.fragments if self.exact else _has_any(name, self.fragments)
        return found and not (self.plain and Q in name)


# roles in order of priority
READINGS_RULES = (
    Rule("record_id", (RECORD_ID_COLUMN,), exact=True),
    Rule("timestamp", TIME_FRAGMENTS),
    Rule("line_id", ("line",), plain=True),
    Rule("machine_id", ("machine",), plain=True),
    Rule("temperature", (TEMP,), plain=True),
    Rule("pressure", (PRESS,), plain=True),
    Rule("vibration", (VIBR,), plain=True),
    Rule("power", (POWER_FRAGMENT,), plain=True),
    Rule("data_quality", (FLAG_COLUMN,), exact=True),
)
CHECKS_RULES = (
    Rule("timestamp", TIME_FRAGMENTS, greedy=True),
    Rule("line_id", ("line",)),
    Rule("machine_id", ("machine",)),
    Rule("result", (RESULT_FRAGMENT,)),
    Rule("defect_type", DEFECT_FRAGMENTS, greedy=True),
)
HOURLY_SENSOR_RULES = tuple(
    Rule(role, (fragment,), pick=-1, greedy=True)
    for role, fragment in (*SENSOR_ROLE_FRAGMENTS.items(), ("power", POWER_FRAGMENT)))


def resolve(columns: list[str], rules: tuple[Rule, ...]) -> dict[str, str]:
    """role -> column.  Roles choose one after another from the columns that
    earlier roles left; the result is in the frame's column order."""
    pool = list(columns)
    chosen: dict[str, tuple[int, str]] = {}
    for rule in rules:
        found = [c for c in pool if rule.matches(c.lower())]
        if found:
            taken = found[rule.pick]
            chosen[rule.role] = (columns.index(found[0]), taken)
            used = set(found) if rule.greedy else {taken}
            pool = [c for c in pool if c not in used]
    return {role: c for role, (_, c) in sorted(chosen.items(), key=lambda item: item[1][0])}


def hourly_sensor_columns(columns: list[str]) -> dict[str, str]:
    """role -> column over temp, press, vibr, power; the last column of a role wins."""
    return resolve([c for c in columns if Q not in c], HOURLY_SENSOR_RULES)


def readings_load_mapping(columns: list[str]) -> dict[str, str]:
    """source column -> target name for the readings table."""
    return {c: role for role, c in resolve(columns, READINGS_RULES).items()}


def checks_load_mapping(columns: list[str]) -> dict[str, str]:
    """source column -> target name for the checks table; further time and
    defect columns are used up by those roles."""
    return {c: role for role, c in resolve(columns, CHECKS_RULES).items()}


def normalized_name(name: str) -> str:
    """Strip, lower-case, inner spaces to underscores."""
    return name.strip().lower().replace(" ", "_")


def describe_roles(sensor_cols: list[str], quality_cols: list[str],
                   joined_cols: list[str]) -> list[tuple[str, str, str]]:
    """A9 as rows (stage, role, column) for the given column lists."""
    out = []

    def add(stage, role, col):
        if col is not None:
            out.append((stage, role, col))

    add("extract", "time", first_time_column(sensor_cols))
    add("extract_quality", "time", first_time_column(quality_cols))
    add("extract_quality", "status", first_status_column(quality_cols))
    for role, col in sensor_cleaning_steps(sensor_cols):
        add("clean", role, col)
    add("join", "sensor_time", join_time_column([normalized_name(c) for c in sensor_cols]))
    add("join", "sensor_machine", join_machine_column([normalized_name(c) for c in sensor_cols]))
    add("join", "quality_time", join_time_column([normalized_name(c) for c in quality_cols]))
    add("join", "quality_machine", join_machine_column([normalized_name(c) for c in quality_cols]))
    add("join", "result", result_column(joined_cols))
    add("hourly", "time", hourly_time_column(joined_cols))
    for c in hourly_group_columns(joined_cols):
        add("hourly", "group", c)
    for role, c in hourly_sensor_columns(joined_cols).items():
        add("hourly", role, c)
    for src, target in readings_load_mapping(joined_cols).items():
        add("load_readings", target, src)
    for src, target in checks_load_mapping([normalized_name(c) for c in quality_cols]).items():
        add("load_checks", target, src)
    return out
