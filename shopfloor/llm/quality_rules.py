"""Quality rules: fixed base rules, then gradient-boosted trees over document
statistics with monotonic constraints, scored from flat numpy node arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import docstats, gbt
from .common import stage, text_batches

SAMPLE = 20_000        # labelled rows the trees are fitted on (bound; a hash share of the ids beyond it)
KEEP = 0.5             # score from which the trees keep a document

# A document may not gain from more of these, nor lose from more of the last.
MONOTONE = {"symbol_rate": -1, "repeat_share": -1, "dup_line_share": -1, "top_word_share": -1,
            "exclaim_rate": -1, "bar_share": -1, "upper_rate": -1, "function_share": +1}


def fit(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        prepare=lambda rows: rows) -> gbt.Forest:
    """Trees for `labels.quality` from rows that are not held out."""
    rows = docstats.labelled_sample(rows, labels, "quality", sample, id_col, prepare)
    x, y = docstats.collect_sample(rows, sample, id_col)
    return gbt.train(x, y, monotone={docstats.FEATURES.index(f): s for f, s in MONOTONE.items()})


def judge(stats: DataFrame, forest: gbt.Forest, keep_score: float = KEEP) -> DataFrame:
    """`stats` without the features, plus base_failed, quality_score and kept.

    kept is false where a base rule fails (under 50 words; over half of the
    words in repeated 3-word windows), else the trees' verdict."""
    made = ("features", "base_failed", "quality_score", "kept")
    keep = [c for c in stats.columns if c not in made]
    schema = stats.select(*keep).schema.add("base_failed", "boolean").add("quality_score", "double") \
                  .add("kept", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            n = b.column("n_words").to_numpy(zero_copy_only=False)
            repeats = b.column("n_repeat_words").to_numpy(zero_copy_only=False)
            failed = (n < docstats.MIN_WORDS) | (100 * repeats > docstats.MAX_REPEAT_PERCENT * n)
            score = forest.score(x) if len(x) else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(failed), pa.array(score),
                 pa.array(~failed & (score >= keep_score))], names=schema.names)

    return stats.mapInArrow(run, schema)


def rate(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, the base counts, base_failed, quality_score, kept.

    Null and empty texts have no words, so they fail a base rule; repeated rows
    each give a row; an empty table gives none; without labels of both kinds the
    trees are the base rate alone and keep what the base rules keep (or nothing,
    where every label is 0); other columns are not read.
    """
    stats = stage(docstats.with_stats(docs, text, id_col=id_col), "quality-stats")
    return judge(stats, fit(stats, labels, id_col=id_col))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that the rules keep, with their own columns: the
    verdict is made on the row's own text, so repeated ids need no join."""
    forest = fit(docs, labels, id_col=id_col, prepare=lambda rows: docstats.with_stats(rows, text, id_col=id_col))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [docstats.document_stats(t.as_py()) for t in b.column(names.index(text))]
            x = np.array([r[1] for r in rows]).reshape(len(rows), -1)
            good = np.array([not docstats.base_failed(r[0][0], r[0][4]) for r in rows], dtype=bool)
            yield b.filter(pa.array(good & (forest.score(x) >= KEEP)))

    return text_batches(docs).mapInArrow(run, docs.schema)
