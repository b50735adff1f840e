"""Streaming form of the global forward fill and record ids (X1 input side).

The fill runs over the whole stream in row order, so it cannot be a
per-key state: one key would put every row in one task.  Each micro-batch
instead runs the *batch* operator (the bucketed ordered pass, spread over
the cluster), seeded with a one-row carry table that the previous batch
wrote: the last cleaned value of every sensor step, the number of rows
numbered so far and the last row position.  The batch then writes its own
carry, from the output it has written.  All outputs are keyed by batch id, so
a retried batch rewrites the same folders.

Contract: rows of a later delivery follow those of earlier ones in row order
(inside a batch any order is fine).  A batch that holds a row at or before the
last position breaks it: ``disorder='fail'`` stops the stream before anything
is written, ``'aside'`` writes those rows to ``_state/aside/batch=<k>``
untouched and cleans the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import roles
from ..operators.clean import clean_sensor_data
from ..operators.standardize import POSITION_COL, standardize_data
from ..sources.files import children, parquet_if_any


def _read_carry(spark: SparkSession, state_dir: str, batch_id: int) -> Row | None:
    """The carry of the latest earlier batch (that folder alone is read).  None only
    where no carry was ever written; a stream that has written carries and lost the
    earlier ones fails."""
    row = None
    earlier = [int(n.removeprefix("batch=")) for n in children(spark, f"{state_dir}/carry") if n.startswith("batch=")]
    for batch in sorted((b for b in earlier if b < batch_id), reverse=True):
        carry = parquet_if_any(spark, f"{state_dir}/carry/batch={batch}")     # None: its write died
        if carry is not None:
            row = carry.first()
            break
    if row is None and batch_id > 0:
        raise RuntimeError(f"batch {batch_id} has no carry to continue from in {state_dir}/carry")
    return row


def clean_batch(spark: SparkSession, batch: DataFrame, batch_id: int, state_dir: str,
                out_dir: str, order: str = "row_no", disorder: str = "fail") -> str:
    """foreachBatch body: clean + standardise one micro-batch, continue the
    fill and the ids from the previous batch, write output and next carry.
    Returns the folder of the batch's output."""
    if disorder not in ("fail", "aside"):
        raise ValueError("disorder must be 'fail' or 'aside'")
    steps = roles.sensor_cleaning_steps(batch.columns)
    prev = _read_carry(spark, state_dir, batch_id)
    carry_in = offset_in = None
    if prev is not None:
        carry_in = {i: F.lit(prev[f"tail_{i}"]).cast("double") for i in range(len(steps))}
        offset_in = F.lit(prev["rows"])
        if prev["last"] is not None:
            behind = batch.where(F.col(order) <= F.lit(prev["last"]))
            if disorder == "aside":
                behind.write.mode("overwrite").parquet(f"{state_dir}/aside/batch={batch_id}")
                batch = batch.where((F.col(order) > F.lit(prev["last"])) | F.col(order).isNull())
            elif not behind.isEmpty():
                raise RuntimeError(f"batch {batch_id} holds rows at or before position {prev['last']}, "
                                   "which earlier batches have passed")

    cleaned = clean_sensor_data(batch, order, position_col=POSITION_COL, carry_in=carry_in,
                                offset_in=offset_in)
    out = f"{out_dir}/batch={batch_id}"
    standardize_data(cleaned, order).write.mode("overwrite").parquet(out)

    # next carry, read back from what was written: the values at the last row
    # (they already hold the carry-in) and the running row count
    written = spark.read.parquet(out)
    names = [roles.normalized_name(c) for _, c in steps]
    at = roles.normalized_name(order)
    tails = written.agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("last"),
                        *[F.max_by(F.col(c), F.col(at)).alias(f"tail_{i}") for i, c in enumerate(names)])
    before = dict(prev.asDict()) if prev is not None else {}
    carry = tails.select(
        *[F.when(F.col("n") > 0, F.col(f"tail_{i}")).otherwise(F.lit(before.get(f"tail_{i}")).cast("double"))
          .alias(f"tail_{i}") for i in range(len(names))],
        (F.col("n") + F.lit(before.get("rows", 0))).alias("rows"),
        F.coalesce("last", F.lit(before.get("last")).cast("long")).cast("long").alias("last"))
    carry.write.mode("overwrite").parquet(f"{state_dir}/carry/batch={batch_id}")
    return out


def run_clean_stream(spark: SparkSession, source_dir: str, schema, out_dir: str,
                     order: str = "row_no", max_files_per_trigger: int | None = None,
                     disorder: str = "fail", then: Callable[[DataFrame, int], None] | None = None) -> None:
    """Clean every file that arrived in ``source_dir`` since the last run
    (availableNow) and stop; the next run resumes from the checkpoint.  By
    default each run is one micro-batch, whatever the number of files.

    ``then(cleaned, batch_id)`` continues with a batch's written output in the
    same micro-batch, so what it writes by batch id is retried with it."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    state_dir = f"{out_dir}/_state"

    def body(df: DataFrame, batch_id: int) -> None:
        out = clean_batch(spark, df, batch_id, state_dir, out_dir, order, disorder)
        if then is not None:
            then(spark.read.parquet(out), batch_id)

    q = (reader.parquet(source_dir).writeStream.foreachBatch(body)
         .option("checkpointLocation", f"{out_dir}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _register():
    from ..plans.catalog import register
    from ..sources import fixtures

    @register("stream_clean_sensor", "SELECT * FROM sensor_std")
    def q_stream_clean_sensor(spark, sf_dir):
        """Sensor rows arrive in three deliveries (thirds of the row order,
        each written by a parallel job); the stream runs after each delivery,
        so three micro-batches clean them with the fill and ids carried over."""
        session.configure(spark)
        raw = fixtures.sensor_raw(spark, sf_dir)
        base = session.scratch_path(spark, f"shopfloor-stream-clean-{uuid.uuid4().hex}")
        src, out = f"{base}/source", f"{base}/out"
        lo, hi = raw.agg(F.min("row_no"), F.max("row_no")).first()
        step = (hi - lo) // 3 + 1
        for k in range(3):
            part = raw.where((F.col("row_no") >= lo + k * step) & (F.col("row_no") < lo + (k + 1) * step))
            part.write.mode("append").parquet(src)
            run_clean_stream(spark, src, raw.schema, out)
        return spark.read.parquet(out).drop("batch")


_register()
