import zlib

import numpy as np
import pytest

from shopfloor.llm import queries, toxicity
from llm_helpers import SF001


def features(text, learned=frozenset()):
    return dict(zip(toxicity.FEATURES, toxicity.toxicity_stats(text, learned)[1]))


@pytest.mark.parametrize("text", [None, "", " \n\t"])
def test_empty_texts(text):
    assert set(features(text).values()) == {0.0}


@pytest.mark.parametrize("text,strong,mild,hidden", [
    ("you idiot", 1, 0, 0), ("You IDIOT!!!", 1, 0, 0), ("what a stupid thing", 0, 1, 0), ("1d10t", 1, 0, 1),
    ("$tup1d", 0, 1, 1), ("s.t.u.p.i.d", 0, 1, 1), ("mooooron", 1, 0, 1), ("idiot&&& trash***", 2, 0, 0),
    ("imbécil y basura", 2, 0, 0), ("assassin classic shitake", 0, 0, 0), ("nothing here 2024 4x4 $100", 0, 0, 0)])
def test_lexicon(text, strong, mild, hidden):
    f, n = features(text), len(text.split())
    assert (round(f["strong_rate"] * n), round(f["mild_rate"] * n), round(f["hidden_rate"] * n)) == (strong, mild, hidden)


def test_other_features():
    near = features("you are an idiot")["near_rate"]
    far = features("you " + "word " * 20 + "idiot")["near_rate"]
    assert near > 0 and far == 0
    assert features("SHUT UP NOW")["shout_share"] == 1 and features("Shut up")["shout_share"] == 0
    assert features("wh4t th1s")["mixed_share"] == 1 and features("noooo")["run_share"] == 1
    assert features("a zzword b", frozenset(["zzword"]))["learned_rate"] == pytest.approx(1 / 3)


def test_isotonic_is_least_squares_and_monotone():
    rng = np.random.default_rng(1)
    raw = rng.random(400)
    label = (rng.random(400) < raw).astype(int)
    fit = toxicity.isotonic(raw, label)
    out = fit(np.sort(raw))
    assert (np.diff(out) >= -1e-12).all() and 0 <= out.min() and out.max() <= 1
    assert abs(out.mean() - label.mean()) < 0.05
    assert toxicity.isotonic(np.array([0.1, 0.9]), np.array([1, 0]))(np.array([0.1, 0.9])).tolist() == [0.5, 0.5]
    assert toxicity.isotonic(np.empty(0), np.empty(0))(np.array([0.3])).tolist() == [0.3]


def test_learned_words_come_from_toxic_rows(frame):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, f"plain words{i} of prose " + ("Zorblat, qux" if toxic else "and more")))
        labels.append((i, int(toxic)))
    got = toxicity.learn_words(frame(rows, "doc_id long, text string"), frame(labels, "doc_id long, toxic int"))
    assert got == {"zorblat", "qux"}


def test_edge_cases(frame):
    docs = frame([(1, None, 1), (2, "", 1), (2, "you idiot", 1), (None, "x " * 60_000, 1)],
                 "doc_id long, text string, predicted int")
    none = frame([], "doc_id long, toxic int")
    got = toxicity.score(docs, none).collect()
    assert len(got) == 4 and {r.predicted for r in got} == {0}
    one = frame([(i, 0, "z") for i in range(30)], "doc_id long, toxic int, text string")
    assert {r.predicted for r in toxicity.score(docs, one).collect()} == {0}
    assert toxicity.score(frame([], "doc_id long, text string"), none).collect() == []


def test_query_on_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.op9_toxicity(spark, SF001).collect()}
    assert len(got) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.toxic) for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()
            if got[r.doc_id].held_out]
    # few labels at this size: clean rows stay clean, insults of the stated list are caught
    assert np.mean([p for p, t in held if not t]) < 0.03
    assert np.mean([p == t for p, t in held]) > 0.93
