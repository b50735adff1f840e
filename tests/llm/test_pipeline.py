"""The corpus pipeline: each stage against a brute-force version of its decision."""

import importlib
import os
import sys

import numpy as np
import pytest

import corpus_pipeline
from shopfloor import session
from shopfloor.llm import bpe, docstats, mixing, pu_quality, quality_rules, simhash_vp
from shopfloor.llm.common import stage, table
from llm_helpers import SF001, union_find

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage."""
    docs, out = table(spark, SF001, "documents"), []
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, docs, SF001), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_stages(stages):
    assert [n for n, _, _ in stages] == ["quality_rules", "quality_classifier", "simhash_dedup", "source_mixing",
                                         "bpe_encoding"]
    for name, before, after in stages[:-1]:
        assert after.columns == DOCUMENTS
        if name != "source_mixing":
            assert after.exceptAll(before).isEmpty()


def test_rules_and_classifier(spark, stages):
    _, docs, kept = stages[0]
    labels = table(spark, SF001, "labels")
    verdict = {r.doc_id: r.kept for r in quality_rules.rate(docs, labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, k in verdict.items() if k}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    ok = {i for i, t in texts.items() if not docstats.base_failed(docstats.document_stats(t)[0][0],
                                                                  docstats.document_stats(t)[0][4])}
    assert all(verdict[i] for i, q in truth.items() if q == 1 and i in ok)          # clean documents stay
    assert sum(verdict[i] for i, q in truth.items() if q == 0) <= 0.1 * sum(q == 0 for q in truth.values())
    _, docs, kept = stages[1]
    predicted = {r.doc_id: r.predicted for r in pu_quality.score(docs, labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, p in predicted.items() if p == 1}


def test_dedup(stages):
    _, docs, kept = stages[2]
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    prints = np.array([simhash_vp.simhash(r.text) for r in rows], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 2
    label = union_find(len(rows), zip(*np.nonzero(np.triu(near, 1))))
    assert {r.doc_id for r in kept.collect()} == {rows[k].doc_id for k in label}
    assert len(rows) > kept.count()


def test_mixing_and_tokens(stages):
    _, docs, mixed = stages[3]
    sized = docs.select("doc_id", "source", mixing.word_count("text").alias("size"))
    plan = mixing.apply(sized, mixing.fit(sized, [5, 2, 1], 3, 17), 17).where("copies > 0")
    want = {r.doc_id: r.copies for r in plan.collect()}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want
    _, docs, out = stages[4]
    texts = {r.doc_id: r.text for r in docs.collect()}
    own = bpe.vocabulary(corpus_pipeline.vocabulary_path())
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(own.decode(bytes(r.token_ids)) == texts[r.doc_id] and r.n_tokens * 4 == len(r.token_ids) for r in rows)


def test_run_is_the_stages(spark, stages):
    folder = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    there = set(os.listdir(folder))
    got, want = corpus_pipeline.run(spark, SF001), stages[-1][2]
    left = set(os.listdir(folder)) - there
    assert len(left) == 1 and left.pop().startswith("pipeline-bpe_encoding")     # scratch tables are gone
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_entry_lists_the_queries_and_works_without_them():
    import __spark_entry__ as entry
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("shopfloor.llm"):
                raise ModuleNotFoundError(name, name="shopfloor.llm" if "llm" in name else name)

    hidden = {n: m for n, m in sys.modules.items() if n == "corpus_pipeline" or n.startswith("shopfloor.llm")}
    finder = Gone()
    try:
        for n in hidden:
            del sys.modules[n]
        sys.meta_path.insert(0, finder)
        bare = importlib.reload(entry).queries()
        assert "pipeline" not in bare and not any(n.startswith("op1") for n in bare) and "run_pipeline" in bare
    finally:
        sys.meta_path.remove(finder)
        sys.modules.update(hidden)
        importlib.reload(entry)
