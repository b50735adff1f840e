"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.files import delete

_PATHS: list[str] = []      # scratch folders of this driver, in the order they were named


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _PATHS.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet below the shared checkpoint folder and read it
    back.  Cuts the lineage: a lost executor costs a re-read, not a re-run."""
    return stage_with(df, name, [])


def stage_with(df: DataFrame, name: str, paths: list[str]) -> DataFrame:
    """`stage`, whose folder is added to `paths`: what several steps wrote in one
    schema can then be read by one scan."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> tuple[DataFrame, str]:
    """`make()` written and read back, and its folder.  Scratch folders that were
    named while it was made are removed: nothing reads them any more."""
    first = len(_PATHS)
    out = stage(make(), name)
    path = _PATHS.pop()
    for used in _PATHS[first:]:
        delete(spark, used)
    _PATHS[first:] = [path]
    return out, path


ARROW_ROWS = 1000     # whole texts that are handed to Python at once, at most


def text_batches(df: DataFrame) -> DataFrame:
    """`df`, whose session hands Python at most ARROW_ROWS rows at a time: whole
    texts are long, and a batch is held by the JVM and by the worker at once."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))
    return df


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of an undirected graph by contraction.

    `edges` has long columns (a, b).  Returns (node, label) for every node that
    has an edge to another node; label is the smallest node reachable.

    Each round points every super-node at the smallest of itself and its
    neighbours, replaces both ends of each edge by what they point at and drops
    loops.  A node that is not a local minimum disappears in every round, so the
    edge table shrinks geometrically on the graphs met here.  All steps are
    min-aggregates (combined map-side) and equi-joins whose one side is unique,
    and every round is written to the shared folder.
    """
    spark = edges.sparkSession
    edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                               F.greatest("a", "b").alias("b")).distinct(), name)
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stage(nodes.select("node", F.col("node").alias("label")), name)
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stage(both.groupBy("a").agg(F.min("b").alias("m"))
                       .select(F.col("a").alias("node"), F.least("a", "m").alias("parent")), name)
        pa = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        pb = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = stage(edges.join(pa, "a").join(pb, "b").where("pa <> pb")
                      .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                      .distinct(), name)
        pl = parent.select(F.col("node").alias("label"), "parent")
        labels = stage(labels.join(pl, "label", "left")
                       .select("node", F.coalesce("parent", "label").alias("label")), name)
    return labels
