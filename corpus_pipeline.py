"""The corpus pipeline: five training-data operators in a row over `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.  All stages but the last
return the columns of documents; the last returns the tokens.

Every stage keeps the rows of an empty table empty, carries columns through by
name, and gives repeated rows the same fate.  Null and empty texts fail the base
rules and go in the first stage; given to a later one, they are scored like any
text, share one fingerprint (the document with the smallest id, nulls first, stays),
count no words in the mix and have no tokens.  Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import bpe, mixing, pu_quality, quality_rules, simhash_vp
from shopfloor.llm.common import settle, table
from shopfloor.llm.queries import BITS, MIX_EPOCHS, MIX_SEED, MIX_WEIGHTS, SHINGLE, vocabulary_path
from shopfloor.sources.files import delete


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Base rules and trees over document statistics: rejected documents go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Positive-unlabelled classifier: rejected documents go."""
    return pu_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: the document with the smallest id of each group stays."""
    return simhash_vp.keep_one(docs, shingle=SHINGLE, bits=BITS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source mixture: each document as often as the mix takes it."""
    return mixing.mix(docs, MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids of each document (little-endian unsigned 32-bit integers), decoded
    again: the digests of the text and of what the ids give agree."""
    coded = bpe.encode(docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)), vocabulary_path())
    back = bpe.decode(coded.drop("text"), vocabulary_path())
    return back.select("doc_id", "lang", "source", "n_tokens", "token_ids", "text_sha256",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("simhash_dedup", dedup),
          ("source_mixing", mix), ("bpe_encoding", tokens)]

#: Models, fingerprints and merges have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again.
    What a stage has read, and its scratch tables, go once its output stands."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        docs, path = settle(spark, lambda: step(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            delete(spark, before)
        before = path
    return docs
