"""Tables partitioned by day whose days are replaced together (copy on write).

Every load writes new folders ``<base>/<table>/load=<id>/day=<d>`` and then one
manifest ``<base>/manifests/version=<n>`` that names, for each table and day, the
folders that count.  Nothing that a manifest names is ever changed: readers see
the pair of tables of one version, before a load or after it, and a load that
dies leaves the old version as it was.  A manifest holds a row for each folder
(calendar-bounded) and notes, such as the ledger of deliveries.

One load runs at a time; a second one that commits meanwhile is refused.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.load import DAY
from ..sources.files import children, delete, exists, parquet_if_any

NULL_DAY = "__HIVE_DEFAULT_PARTITION__"     # Spark's folder name for a NULL partition value
_ROW = "kind string, name string, day date, value string"


class ConcurrentLoad(RuntimeError):
    """Another load was committed since this one read its snapshot."""


@dataclass(frozen=True)
class Snapshot:
    """One version: folders by table and day, and notes by name."""

    version: int = 0
    folders: tuple[tuple[str, dt.date | None, str], ...] = ()
    notes: dict[str, str] = field(default_factory=dict)

    def days(self, table: str) -> set[dt.date | None]:
        return {day for name, day, _ in self.folders if name == table}


def _versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions, oldest first (a manifest whose write did not finish has no success mark)."""
    found = [int(name.removeprefix("version=")) for name in children(spark, f"{base}/manifests")
             if name.startswith("version=")]
    return [v for v in sorted(found) if exists(spark, f"{base}/manifests/version={v}/_SUCCESS")]


def _load(spark: SparkSession, base: str, version: int) -> Snapshot:
    rows = spark.read.schema(_ROW).parquet(f"{base}/manifests/version={version}").collect()
    return Snapshot(version, tuple((r.name, r.day, r.value) for r in rows if r.kind == "folder"),
                    {r.name: r.value for r in rows if r.kind == "note"})


def current(spark: SparkSession, base: str) -> Snapshot:
    """The newest committed version; an empty one before the first load."""
    versions = _versions(spark, base)
    return _load(spark, base, versions[-1]) if versions else Snapshot()


def read(spark: SparkSession, base: str, table: str, snapshot: Snapshot | None = None,
         days: set[dt.date | None] | None = None) -> DataFrame | None:
    """A table's rows with ``day``, of all days or some; None if nothing was ever
    loaded into it.  Columns that older days were written without read as NULL."""
    snapshot = current(spark, base) if snapshot is None else snapshot
    if f"schema:{table}" not in snapshot.notes:
        return None
    schema = T.StructType.fromJson(json.loads(snapshot.notes[f"schema:{table}"]))
    paths = [f"{base}/{folder}" for name, day, folder in snapshot.folders
             if name == table and (days is None or day in days)]
    if not paths:
        return spark.createDataFrame([], T.StructType(schema.fields).add(DAY, "date"))
    rows = spark.read.schema(schema).option("basePath", f"{base}/{table}").parquet(*paths)
    return rows.drop("load").withColumn(DAY, F.col(DAY).cast("date"))


def write(rows: DataFrame, base: str, table: str, undated_apart: bool = False) -> list[tuple[str, dt.date | None, str]]:
    """Write rows (with ``day``) to a new folder; returns its entries, one for each day.
    They count only once a manifest names them.

    ``undated_apart``: rows without a day go to their folder straight from the tasks
    that make them.  They are joined with each other, and their copies compress so well
    that the shuffle by day would give a task, by bytes, far more rows than it can sort."""
    spark, folder = rows.sparkSession, f"{table}/load=l{uuid.uuid4().hex}"
    if undated_apart:
        undated = f"{folder}/{DAY}={NULL_DAY}"
        entries = write_dated(rows.where(F.col(DAY).isNotNull()), base, table, folder)
        rows.where(F.col(DAY).isNull()).drop(DAY).write.parquet(f"{base}/{undated}")
        if spark.read.schema(rows.drop(DAY).schema).parquet(f"{base}/{undated}").isEmpty():
            delete(spark, f"{base}/{undated}")
            return entries
        return [*entries, (table, None, undated)]
    return write_dated(rows, base, table, folder)


def write_dated(rows: DataFrame, base: str, table: str, folder: str) -> list[tuple[str, dt.date | None, str]]:
    """The rows of a day meet, and AQE splits days that are too large for a task."""
    rows.hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{base}/{folder}")
    written = parquet_if_any(rows.sparkSession, f"{base}/{folder}")
    held = [] if written is None else written.select(F.col(DAY).cast("date")).distinct().collect()
    return [(table, day, f"{folder}/{DAY}={NULL_DAY if day is None else day.isoformat()}") for (day,) in held]


def of(table: str, rows: DataFrame, entries: list[tuple[str, dt.date | None, str]]) -> Snapshot:
    """What ``write`` gave for one table, to ``read`` it before it is committed."""
    return Snapshot(folders=tuple(entries), notes={f"schema:{table}": _schema_note(Snapshot(), table, rows)})


def _schema_note(before: Snapshot, table: str, rows: DataFrame) -> str:
    """The table's columns so far, then those that are new in ``rows``."""
    old = before.notes.get(f"schema:{table}")
    fields = T.StructType.fromJson(json.loads(old)).fields if old else []
    known = {f.name: f.dataType for f in fields}
    for f in rows.drop(DAY).schema.fields:
        if f.name not in known:
            fields.append(T.StructField(f.name, f.dataType))
        elif known[f.name] != f.dataType and not isinstance(f.dataType, T.NullType):
            raise TypeError(f"{table}.{f.name} is {known[f.name].simpleString()}, the load has {f.dataType.simpleString()}")
    return json.dumps(T.StructType(fields).jsonValue())


def commit(spark: SparkSession, base: str, before: Snapshot, added: dict[str, tuple[DataFrame, list]],
           replaced: dict[str, set[dt.date | None]] | None = None, notes: dict[str, str] | None = None) -> Snapshot:
    """Make one new version from ``before``: ``added`` has by table the rows' frame
    (for its columns) and the entries that ``write`` gave; the days in ``replaced``
    lose their older folders.  Writing the manifest is the commit."""
    replaced = replaced or {}
    folders = [e for e in before.folders if e[1] not in replaced.get(e[0], ())]
    folders += [e for _, entries in added.values() for e in entries]
    noted = before.notes | {f"schema:{t}": _schema_note(before, t, rows) for t, (rows, _) in added.items()} | (notes or {})
    version = before.version + 1
    while exists(spark, f"{base}/manifests/version={version}") and version not in _versions(spark, base):
        version += 1                                   # left by a manifest write that died
    rows = [("folder", *e) for e in folders] + [("note", k, None, v) for k, v in noted.items()]
    if [v for v in _versions(spark, base) if v > before.version]:
        raise ConcurrentLoad(f"{base} has a newer version than {before.version}, which this load has read")
    (spark.createDataFrame(rows, _ROW).coalesce(1).write.mode("errorifexists")
     .parquet(f"{base}/manifests/version={version}"))
    if [v for v in _versions(spark, base) if before.version < v < version]:
        delete(spark, f"{base}/manifests/version={version}")
        raise ConcurrentLoad(f"{base} got another version while this load was committed")
    return Snapshot(version, tuple(folders), noted)


def drop_superseded(spark: SparkSession, base: str, keep: int = 1) -> int:
    """Remove what only versions older than the newest ``keep`` name (readers that
    opened one need it: choose ``keep`` for the longest reader).  Returns the number
    of folders removed.  Folders of loads that died are in no manifest and stay;
    ``drop_unnamed`` removes them while no load runs."""
    if keep < 1:
        raise ValueError("the newest version is kept: keep >= 1")
    versions = _versions(spark, base)
    live = {e[2] for v in versions[-keep:] for e in _load(spark, base, v).folders}
    gone = {e[2] for v in versions[:-keep] for e in _load(spark, base, v).folders} - live
    for v in versions[:-keep]:
        delete(spark, f"{base}/manifests/version={v}")           # first: no manifest without its files
    for folder in gone:
        delete(spark, f"{base}/{folder}")
    return len(gone)


def drop_unnamed(spark: SparkSession, base: str) -> int:
    """Remove the load folders that no version names.  No load may be running."""
    named = {e[2].rsplit("/", 1)[0] for v in _versions(spark, base) for e in _load(spark, base, v).folders}
    found = [f"{table}/{load}" for table in children(spark, base) if table != "manifests"
             for load in children(spark, f"{base}/{table}") if load.startswith("load=")]
    gone = [f for f in found if f not in named]
    for folder in gone:
        delete(spark, f"{base}/{folder}")
    return len(gone)
