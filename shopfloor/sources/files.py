"""File steps Spark's readers and writers lack, on whatever store a path names."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _located(spark, path)
    return store.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    store, where = _located(spark, path)
    return [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []


def state(spark: SparkSession, path: str) -> tuple:
    """(name, bytes, time of change) of a file, or of what a folder holds: differs once the data do."""
    store, where = _located(spark, path)
    if not store.exists(where):
        return ()
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in store.listStatus(where)))


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder with all it holds; False when there is none."""
    store, where = _located(spark, path)
    return store.delete(where, True)


def parquet_if_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is no such folder or it
    holds no file yet.  Every other failure is raised."""
    if not exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
