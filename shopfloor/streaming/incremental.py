"""Incremental loads, of raw deliveries and of joined readings.

``deliver`` takes raw readings and raw inspections as they arrive.  A ledger keeps,
for each delivery, what it held and which record ids were reserved for it, and the
carry of the fill; so deliveries that are built apart continue each other's ids and
fill, and a repeated one changes nothing.  The join matches equal times, hence only
rows of one day: a delivery rewrites the joined rows and the summary of the days
that its readings or inspections (late ones too) name, and no others.

``incremental_load`` takes joined rows of whole readings (a reading with several
inspections has several) and replaces readings by their identity: the position in
the source where the rows carry it, since record ids start anew in every build, else
the record id.

Both write the joined rows and the summary as one version (``snapshots``): a reader
sees both from before a load or both from after it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import roles
from ..functions.scalars import hour_bucket, record_id
from ..operators.clean import clean_sensor_data
from ..operators.integrate import (MAX_NULL_PAIRS, join_plan, join_sensor_quality, null_key_load, refuse_null_pairs,
                                   salt_for)
from ..operators.load import DAY
from ..operators.ordered import ordered_pass
from ..operators.standardize import POSITION_COL, standardize_data
from ..operators.summary import hourly_summary
from ..schemas import RECORD_ID_COLUMN
from ..sources import csv, extract
from . import check_state, snapshots
from .snapshots import Snapshot

POSITION = "row_no"      # a reading's place in its source, where the source has one
JOINED, SUMMARY, SENSOR, INSPECTIONS, STATE = "joined", "hourly_summary", "sensor", "inspections", "check_state"


class DeliveryChanged(ValueError):
    """A delivery came again under its name with other rows."""


def identity(columns: list[str]) -> list[str]:
    """What tells readings of different deliveries apart."""
    return [POSITION] if POSITION in columns else [RECORD_ID_COLUMN]


def _identified(new: DataFrame, key: list[str]) -> DataFrame:
    """``new``; a row without identity could neither be replaced nor repeated, so it fails the job."""
    def guarded(c: str):
        guard = F.assert_true(F.col(c).isNotNull(), F.lit(f"incremental load: {c} holds NULL"))
        return F.coalesce(guard.cast(new.schema[c].dataType), F.col(c))

    return new.withColumns({c: guarded(c) for c in key})


def incremental_append(target: DataFrame, new: DataFrame, key: str | list[str] = RECORD_ID_COLUMN) -> DataFrame:
    """The target after a load: readings of ``new`` replace theirs, others stay."""
    key = [key] if isinstance(key, str) else key
    new = _identified(new, key)
    return target.join(new.select(*key), key, "left_anti").select(*target.columns).unionByName(new)


def refresh_summary(old_summary: DataFrame, target: DataFrame, new: DataFrame,
                    key: str | list[str] = RECORD_ID_COLUMN) -> DataFrame:
    """The summary after a load of ``new`` onto ``target``: groups that hold a
    row of ``new`` or of a reading it replaces are recomputed, others kept."""
    key = [key] if isinstance(key, str) else key
    time = roles.hourly_time_column(target.columns)
    groups = roles.hourly_group_columns(target.columns)
    combined = incremental_append(target, new, key)
    replaced = target.join(new.select(*key), key, "left_semi")
    touched = (replaced.select(time, *groups).unionByName(new.select(time, *groups))
               .select(hour_bucket(F.col(time)).alias("hour"), *groups).dropna().distinct())
    rows = combined.withColumn("hour", hour_bucket(F.col(time)))
    again = hourly_summary(rows.join(touched, ["hour", *groups], "left_semi").drop("hour"))
    kept = old_summary.join(touched, ["hour", *groups], "left_anti")
    return kept.select(*old_summary.columns).unionByName(again.select(*old_summary.columns))


def _days(*frames: DataFrame | None) -> set:
    """The days that any of the frames hold (calendar-bounded)."""
    return {r[0] for df in frames if df is not None for r in df.select(DAY).distinct().collect()}


def _both(old: DataFrame | None, new: DataFrame | None) -> DataFrame | None:
    if old is None or new is None:
        return new if old is None else old
    return old.unionByName(new, allowMissingColumns=True)


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back."""
    path = session.scratch_path(df.sparkSession, f"shopfloor-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _commit_days(spark: SparkSession, base: str, before: Snapshot, joined: DataFrame, days: set,
                 added: dict | None = None, notes: dict[str, str] | None = None,
                 inspections: DataFrame | None = None) -> Snapshot:
    """Write ``joined`` (all rows of ``days``), those days' summary and check state, as one version."""
    entries = snapshots.write(joined, base, JOINED, True)
    stored = snapshots.read(spark, base, JOINED, snapshots.of(JOINED, joined, entries))
    summary = hourly_summary(stored.where(F.col(DAY).isNotNull()).drop(DAY))
    summary = summary.withColumn(DAY, F.to_date("hour"))
    hours = snapshots.write(summary, base, SUMMARY)
    state = check_state.day_state(stored, inspections, snapshots.read(spark, base, SUMMARY, snapshots.of(SUMMARY, summary, hours)))
    return snapshots.commit(
        spark, base, before, {**(added or {}), JOINED: (joined, entries), SUMMARY: (summary, hours),
                              STATE: (state, snapshots.write(state, base, STATE))},
        replaced={JOINED: days, SUMMARY: days, STATE: days}, notes=notes)


def read_joined(spark: SparkSession, base: str, snapshot: Snapshot | None = None) -> DataFrame | None:
    found = snapshots.read(spark, base.rstrip("/"), JOINED, snapshot)
    return None if found is None else found.drop(DAY)


def read_summary(spark: SparkSession, base: str, snapshot: Snapshot | None = None) -> DataFrame | None:
    found = snapshots.read(spark, base.rstrip("/"), SUMMARY, snapshot)
    return None if found is None else found.drop(DAY)


def read_check_state(spark: SparkSession, base: str, snapshot: Snapshot | None = None) -> DataFrame | None:
    """What the last load left for ``check_state.validation_report``.  Inspections are
    counted for deliveries alone (joined rows do not tell them apart)."""
    return snapshots.read(spark, base.rstrip("/"), STATE, snapshot)


def incremental_load(spark: SparkSession, base: str, new_joined: DataFrame,
                     key: str | list[str] | None = None) -> Snapshot:
    """X2 on disk: load whole joined readings and refresh the days of the summary
    they touch: the days of the incoming rows and those that hold an older version of
    an incoming reading (the search reads the key columns of the table).

    ``key`` (default ``identity``) tells readings apart.  Where that is not the
    record id, readings the table does not hold get ids from a range reserved for
    this load, and those it holds keep theirs.  A repeated load changes no row.
    """
    base = base.rstrip("/")
    session.ensure_checkpoint_dir(spark)
    before = snapshots.current(spark, base)
    key = [key] if isinstance(key, str) else key or identity(new_joined.columns)
    new = _identified(new_joined, key).withColumn(DAY, F.to_date(roles.hourly_time_column(new_joined.columns)))
    new = _staged(new, "load")
    target = snapshots.read(spark, base, JOINED, before)
    notes = {}
    if key != [RECORD_ID_COLUMN] and RECORD_ID_COLUMN in new.columns:
        local = F.regexp_extract(RECORD_ID_COLUMN, r"(\d+)$", 1).try_cast("long")
        first = int(before.notes.get("next_id", 0))
        most = new.agg(F.max(local)).first()[0]
        notes["next_id"] = str(first if most is None else first + most + 1)
        own = F.when(local.isNotNull(), record_id(local + F.lit(first))).otherwise(F.col(RECORD_ID_COLUMN))
        if target is not None:
            held = target.groupBy(*key).agg(F.min(RECORD_ID_COLUMN).alias("__held"))
            new = new.join(held, key, "left")
            own = F.coalesce("__held", own)
        new = _staged(new.withColumn(RECORD_ID_COLUMN, own).select(*[c for c in new.columns if c != "__held"]), "load")
    days, rows = _days(new), new
    if target is not None:
        days |= _days(target.join(new.select(*key), key, "left_semi"))
        rows = incremental_append(snapshots.read(spark, base, JOINED, before, days), new, key)
    return _commit_days(spark, base, before, rows, days, notes=notes)


# --- raw deliveries ----------------------------------------------------

def _content(df: DataFrame | None) -> str:
    """Row count and an order-free hash of a frame's rows."""
    if df is None:
        return "none"
    cols = sorted(c for c in df.columns if c not in csv.ORDER_COLS)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("h")).first()
    return f"{row.n}:{row.h or 0}:{','.join(cols)}"


def _by_day(df: DataFrame) -> DataFrame:
    time = roles.join_time_column(df.columns)
    if time is None:
        raise ValueError("a delivery needs a time column")
    return df.withColumn(DAY, F.to_date(time))


def clean_delivery(sensor_raw: DataFrame, carry: dict | None = None, order="row_no") -> tuple[DataFrame, dict]:
    """Standardised readings of one delivery (staged) that continue the fill and the
    ids of the deliveries before it, and the carry for the next one: the last
    cleaned value of each sensor step and the next id."""
    carry = carry or {"next_id": 0, "tails": []}
    raw = extract.extract_sensor(sensor_raw)
    steps = roles.sensor_cleaning_steps(raw.columns)
    tails = carry["tails"] or [None] * len(steps)
    cleaned = clean_sensor_data(raw, order=order, position_col=POSITION_COL, offset_in=F.lit(carry["next_id"]),
                                carry_in={i: F.lit(v).cast("double") for i, v in enumerate(tails)})
    std = _staged(standardize_data(cleaned, order=order), "delivery")
    at = F.regexp_extract(RECORD_ID_COLUMN, r"(\d+)$", 1).cast("long")
    names = [roles.normalized_name(c) for _, c in steps]
    row = std.agg(F.count(F.lit(1)).alias("n"), *[F.max_by(F.col(c), at).alias(f"t{i}") for i, c in enumerate(names)]).first()
    last = [row[f"t{i}"] for i in range(len(names))] if row.n else tails
    return std, {"next_id": carry["next_id"] + row.n, "tails": last}


def deliver(spark: SparkSession, base: str, sensor_raw: DataFrame | None = None, quality_raw: DataFrame | None = None,
            name: str | None = None, sensor_order="row_no", quality_order="row_no",
            null_keys: str = "match", max_null_pairs: int | None = MAX_NULL_PAIRS) -> Snapshot:
    """X2 from raw rows: one delivery of readings, inspections or both.

    Deliveries count in the order they are loaded: readings fill and are numbered
    after all earlier ones, by ``sensor_order`` inside a delivery.  ``name`` (a file or
    batch name; default a hash of the rows) is the delivery's identity in the ledger:
    the same rows again under it change nothing, other rows raise DeliveryChanged.
    """
    base = base.rstrip("/")
    session.configure(spark)
    session.ensure_checkpoint_dir(spark)
    before = snapshots.current(spark, base)
    content = f"{_content(sensor_raw)}|{_content(quality_raw)}"
    note = f"delivery:{content if name is None else name}"
    if note in before.notes:
        if json.loads(before.notes[note])["content"] != content:
            raise DeliveryChanged(f"delivery {name!r} is known with other rows")
        return before
    carry = json.loads(before.notes.get("carry", "null"))
    next_check = int(before.notes.get("next_check", 0))
    entry = {"content": content, "first_id": carry["next_id"] if carry else 0, "first_check": next_check}

    sensor = quality = None
    added = {}
    if sensor_raw is not None:
        std, carry = clean_delivery(sensor_raw, carry, sensor_order)
        sensor = _by_day(std)
        added[SENSOR] = (sensor, snapshots.write(sensor, base, SENSOR))
    if quality_raw is not None:
        raw = standardize_data(extract.extract_quality(quality_raw), assign_ids=False)
        raw = ordered_pass(raw, quality_order, position_col=POSITION_COL, offset_in=F.lit(next_check))
        quality = _staged(_by_day(standardize_data(raw)), "inspections")
        next_check += quality.count()
        added[INSPECTIONS] = (quality, snapshots.write(quality, base, INSPECTIONS))

    days = _days(sensor, quality)
    all_sensor = _both(snapshots.read(spark, base, SENSOR, before, days), sensor)
    all_quality = _both(snapshots.read(spark, base, INSPECTIONS, before, days), quality)
    notes = {note: json.dumps(entry), "next_check": str(next_check)} | ({"carry": json.dumps(carry)} if carry else {})
    if all_sensor is None:                              # inspections before any reading: they wait
        state = check_state.day_state(None, all_quality, None)
        added[STATE] = state, snapshots.write(state, base, STATE)
        return snapshots.commit(spark, base, before, added, {STATE: days}, notes)
    all_sensor, inspections, salt, pairs = all_sensor.drop(DAY), all_quality, 1, 0
    if all_quality is not None:
        all_quality = all_quality.drop(DAY)
        if null_keys == "match" and join_plan(all_sensor.columns, all_quality.columns):
            null_rows, pairs = null_key_load(all_sensor, all_quality)
            refuse_null_pairs(pairs, max_null_pairs)
            salt = salt_for(null_rows)
    joined = _by_day(join_sensor_quality(all_sensor, all_quality, null_keys=null_keys, null_salt=salt, check_empty=False,
                                         null_pairs=pairs))
    return _commit_days(spark, base, before, joined, days, added, notes, inspections)


# --- registered queries ------------------------------------------------

def raw_deliveries(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame | None, DataFrame | None]]:
    """The raw readings in three deliveries and the raw inspections in two, the
    second of them after the last reading, so it brings late results for all days."""
    from ..sources import fixtures
    from .hourly import deliveries

    sensor = deliveries(fixtures.sensor_raw(spark, sf_dir), "row_no", 3)
    quality = deliveries(fixtures.quality_raw(spark, sf_dir), "row_no", 2)
    return [(sensor[0], quality[0]), (sensor[1], None), (sensor[2], None), (None, quality[1])]


def two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads of joined readings built from two raw deliveries: the second has
    the rest of the readings, with all inspections, and every earlier reading that a
    late inspection belongs to."""
    from ..sources import fixtures
    from .hourly import deliveries

    session.configure(spark)
    raw = deliveries(fixtures.sensor_raw(spark, sf_dir), "row_no", 2)
    checks = deliveries(fixtures.quality_raw(spark, sf_dir), "row_no", 2)
    early, late = (standardize_data(extract.extract_quality(q), assign_ids=False) for q in checks)
    one, carry = clean_delivery(raw[0])
    two, _ = clean_delivery(raw[1], carry)
    named = late.select(F.col("timestamp").alias("__t"), F.col("machine_id").alias("__m")).distinct()
    changed = one.join(named, F.col("timestamp").eqNullSafe(F.col("__t")) & F.col("machine_id").eqNullSafe(F.col("__m")),
                       "left_semi")
    first = join_sensor_quality(one, early, check_empty=False)
    second = join_sensor_quality(two.unionByName(changed), early.unionByName(late), check_empty=False)
    return first, second


def _register():
    from ..operators.load import project_sensor_readings
    from ..plans.catalog import REPORT_SQL, register
    from ..plans.oracle import summary_rounded
    from ..plans.reports import round_doubles

    def delivered(spark, sf_dir) -> str:
        """All deliveries, and one of them twice.  The SQL asks for every NULL = NULL pair: none is refused."""
        base = session.scratch_path(spark, f"shopfloor-deliveries-{uuid.uuid4().hex}")
        parts = raw_deliveries(spark, sf_dir)
        for k, (sensor, quality) in enumerate([*parts, parts[1]]):
            deliver(spark, base, sensor, quality, name=f"delivery-{k % len(parts) + k // len(parts)}", max_null_pairs=None)
        return base

    @register("incremental_load", f"SELECT {summary_rounded()} FROM summary")
    def q_incremental_load(spark, sf_dir):
        """Raw deliveries, each built apart, one repeated, inspections late: the
        summary read back equals the one-shot summary."""
        return round_doubles(read_summary(spark, delivered(spark, sf_dir)))

    @register("incremental_readings", "SELECT * FROM readings")
    def q_incremental_readings(spark, sf_dir):
        """The readings after those deliveries: none lost, ids as in one run."""
        return project_sensor_readings(read_joined(spark, delivered(spark, sf_dir)))

    @register("incremental_report", REPORT_SQL)
    def q_incremental_report(spark, sf_dir):
        """K11 after those deliveries, from the state they left: no table is scanned."""
        return check_state.validation_report(read_check_state(spark, delivered(spark, sf_dir)))

    @register("incremental_append", f"SELECT {summary_rounded()} FROM summary")
    def q_incremental_append(spark, sf_dir):
        first, second = two_loads(spark, sf_dir)
        return round_doubles(refresh_summary(hourly_summary(first), first, second))


_register()
