"""Document statistics, trees, quality rules and the positive-unlabelled classifier."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import docstats, gbt, pu_quality, queries, quality_rules
from llm_helpers import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, g in enumerate(zip(words, words[1:], words[2:])):
        if grams[g] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


TEXTS = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x x", "l\nl\n\n l\nl ", "é😀 <b> # a|b *",
         "a\x0bb\x0cc\rd a\x0bb\x0cc\rd", "nbsp\xa0x \x1c y", "\n".join(["same line here"] * 40)]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert docstats.document_stats(text)[0] == plain_base(text)
    assert len(docstats.document_stats(text)[1]) == len(docstats.FEATURES)


def test_base_counts_of_random_texts():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "é", " ", " ", "\n", "#", "|"]) for _ in range(rng.randrange(120)))
        assert docstats.document_stats(text)[0] == plain_base(text)


def test_repeats_with_huge_vocabularies():
    words = [str(i).encode() for i in range(2_000_100)] + [b"1", b"2", b"3"]
    assert docstats.repeat_words(words, list(Counter(words))) == 6


# ---------------------------------------------------------------- trees

def _sample(seed, n=3000):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - 1.5 * x[:, 1] + np.sin(3 * x[:, 2]))))
    return x, (rng.random(n) < p).astype(int)


def test_trees_learn_and_score_like_a_walk():
    x, y = _sample(1)
    f = gbt.train(x[:2000], y[:2000])
    assert ((f.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.74
    for row in x[:50]:                                       # the flat arrays against following the nodes
        margin = f.base
        for at in f.roots:
            while f.left[at] != at:
                at = f.left[at] if row[f.feature[at]] <= f.threshold[at] else f.right[at]
            margin += f.value[at]
        assert f.margin(row[None])[0] == pytest.approx(margin)


@pytest.mark.parametrize("sign", [1, -1])
def test_monotone_constraints_hold(sign):
    x, y = _sample(2)
    f = gbt.train(x, y, monotone={0: sign, 1: -1}, depth=4)
    for feature, s in ((0, sign), (1, -1)):
        grid = np.repeat(x[:40], 50, axis=0)
        grid[:, feature] = np.tile(np.linspace(-4, 4, 50), 40)
        steps = np.diff(f.margin(grid).reshape(40, 50), axis=1)
        assert (s * steps >= -1e-12).all()


def test_trees_without_both_labels():
    x = np.ones((5, 2))
    assert 0.5 < gbt.train(x, np.ones(5)).score(x)[0] < 1
    assert gbt.train(np.empty((0, 2)), np.empty(0)).score(x)[0] == 0.5
    assert len(gbt.train(x, np.array([0, 1, 0, 1, 1])).score(x)) == 5      # constant features


# ---------------------------------------------------------------- rules

DDL = "doc_id long, text string, kept string, n_words int"


def test_rules_edge_cases(frame):
    labels = frame([], "doc_id long, quality int, toxic int")
    rows = [(1, None), (2, ""), (3, "w " * 49), (4, " ".join(f"w{i}" for i in range(50))), (5, "spam and eggs " * 30),
            (4, " ".join(f"w{i}" for i in range(50))), (None, " ".join(f"x{i}" for i in range(90_000)))]
    df = frame([(*r, "k", 0) for r in rows], DDL)
    got = {}
    for r in quality_rules.rate(df, labels).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.base_failed, r.kept))
    assert got == {1: [(0, True, False)], 2: [(0, True, False)], 3: [(49, True, False)], 4: [(50, False, True)] * 2,
                   5: [(90, True, False)], None: [(90_000, False, True)]}
    good = quality_rules.keep_good(df, labels)
    assert good.columns == df.columns
    assert sorted(r.doc_id or 0 for r in good.collect()) == [0, 4, 4]
    assert quality_rules.rate(frame([], DDL), labels).collect() == []


def test_labels_held_out_null_and_repeated(frame):
    rows = [(i, i % 2) for i in range(50)] + [(None, 1), (51, None), (1, 0), (1, 1)]
    got = {r.doc_id: r.label for r in docstats.label_sample(
        frame([(*r, 0) for r in rows], "doc_id long, quality int, x int"), "quality", 1000).collect()}
    assert got == {i: i % 2 for i in range(50) if zlib.crc32(str(i).encode()) % 5}
    many = frame([(i, 1) for i in range(5000)], "doc_id long, quality int")
    assert 350 < docstats.label_sample(many, "quality", 500).count() < 650


def _auc(score, label):
    order = np.argsort(np.argsort(score))
    ones = label == 1
    return (order[ones].mean() - (ones.sum() - 1) / 2) / (~ones).sum()


@pytest.fixture(scope="module")
def labelled(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet").join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id")
    return {r.doc_id: r for r in d.collect()}


def test_rules_query(spark, labelled):
    got = {r.doc_id: r for r in queries.op7_rules(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        r, base = got[d.doc_id], plain_base(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r.base_failed and r.kept)
    held = [r for i, r in labelled.items() if zlib.crc32(str(i).encode()) % 5 == 0 and not got[i].base_failed]
    assert np.mean([got[r.doc_id].kept == bool(r.quality) for r in held]) > 0.95


# ---------------------------------------------------------------- positive-unlabelled

def test_risk_recovers_a_plane():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(9000, 5))
    y = (x[:, 0] + 0.5 * x[:, 1] > -1).astype(int)
    net = pu_quality.train(x[:4000][y[:4000] == 1], x[4000:8000], y.mean(), steps=210)
    assert _auc(net.score(x[8000:]), y[8000:]) > 0.95
    assert ((net.score(x[8000:]) >= 0.5) == y[8000:]).mean() > 0.9


def test_risk_and_slope_by_hand():
    """Against the formula written out, and its numerical slope on both sides of zero."""
    rng = np.random.default_rng(4)
    seen = set()
    for _ in range(200):
        za, zb, prior = rng.normal(0, 3, 4), rng.normal(-1, 3, 6), rng.uniform(0.05, 0.95)

        def parts(za, zb):
            plus = sum(np.log(1 + np.exp(-z)) for z in za) / 4
            minus = sum(np.log(1 + np.exp(z)) for z in zb) / 6 - prior * sum(np.log(1 + np.exp(z)) for z in za) / 4
            return prior * plus, minus

        risk, slope = pu_quality.pu_risk(za, zb, prior)
        plus, minus = parts(za, zb)
        assert risk == pytest.approx(plus + max(0, minus))
        seen.add(minus >= 0)
        at = np.concatenate([za, zb])
        for k in range(10):
            up, down = at.copy(), at.copy()
            up[k] += 1e-6
            down[k] -= 1e-6
            (p1, m1), (p0, m0) = parts(up[:4], up[4:]), parts(down[:4], down[4:])
            want = (p1 + m1 - p0 - m0) / 2e-6 if minus >= 0 else -(m1 - m0) / 2e-6     # below zero: climb out
            assert slope[k] == pytest.approx(want, abs=1e-5)
    assert seen == {True, False}


@pytest.mark.parametrize("prior", [0.15, 0.5, 0.85])
def test_prior_from_positives_and_unlabelled_rows(prior):
    """Labels hold another share of positives than the text does; only positives are given."""
    rng = np.random.default_rng(5)
    y = rng.random(12_000) < prior
    web = np.where(y[:, None], rng.normal(1.2, 1, (12_000, 4)), rng.normal(-1.2, 1, (12_000, 4)))
    positive = rng.normal(1.2, 1, (1_500, 4))
    assert prior - 0.1 < pu_quality.estimate_prior(positive, web) < prior + 0.03       # rather too low than too high
    weighted = pu_quality.estimate_prior(positive, np.concatenate([web[:6_000], web[:6_000]]), np.full(12_000, 3.0))
    assert prior - 0.1 < weighted < prior + 0.05
    assert pu_quality.estimate_prior(positive[:2], web) == 0.5


def test_unlabelled_rows_speak_for_all(frame):
    """Weights add up to all rows; a crowd of copies is one row with their weight."""
    rng = np.random.default_rng(6)
    width = len(docstats.FEATURES)
    x = rng.normal(size=(3_000, width))
    x[2_000:] = x[1_999]
    rows = frame([(min(k, 1_999), v.tolist()) for k, v in enumerate(x)], "doc_id long, features array<double>", 7)
    web, n = pu_quality.unlabelled(rows)
    assert n.sum() == pytest.approx(3_000)
    near = np.isclose(web, x[1_999]).all(1)
    assert near.sum() <= 1 and (not near.any() or n[near][0] >= 1_000)
    assert np.allclose(n @ web / 3_000, x.mean(0), atol=0.05)
    again, m = pu_quality.unlabelled(rows.repartition(3))                   # whatever the order
    assert np.array_equal(web, again) and np.array_equal(n, m)
    assert pu_quality.unlabelled(rows.limit(0))[1].size == 0


def test_a_pass_reads_every_row(frame):
    """Sums, slopes and counts over all rows, against the formulas written out."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2_500, len(docstats.FEATURES)))
    x[2_000:] = x[0]
    side = np.arange(2_500) % 3 % 2
    rows = frame([(v.tolist(), int(k)) for v, k in zip(x, side)], "features array<double>, side int", 5)
    nets = [pu_quality.train(x[:50] + 1, x[:400], 0.5, steps=k) for k in (20, 30, 40)]
    found = pu_quality.sums_of_all(rows, nets, [0, 1, None])
    for net, (n, sums), on in zip(nets, found, (side == 0, side == 1, side >= 0)):
        z = np.tanh(net.prepare(x[on]) @ net.w1 + net.b1) @ net.w2 + net.b2
        assert n == on.sum() and sums[0] == pytest.approx(np.log1p(np.exp(z)).sum(), abs=1e-4)
        up, down = (pu_quality.Network(net.mean, net.scale, net.w1, net.b1, net.w2, net.b2 + e) for e in (1e-5, -1e-5))
        by_hand = (pu_quality.softplus_sums(up, x[on])[0] - pu_quality.softplus_sums(down, x[on])[0]) / 2e-5
        assert sums[-1] == pytest.approx(by_hand, rel=1e-4)
        w1 = net.w1.copy()
        w1[3, 5] += 1e-5
        moved = pu_quality.softplus_sums(pu_quality.Network(net.mean, net.scale, w1, net.b1, net.w2, net.b2), x[on])[0]
        assert sums[1 + 3 * pu_quality.HIDDEN + 5] == pytest.approx((moved - sums[0]) / 1e-5, rel=1e-2, abs=0.5)
    at = [np.array([0.2, 0.5, 0.9]), np.array([0.4])]
    for net, (n, above), k, edges in zip(nets, pu_quality.counts_above(rows, nets[:2], [0, 1], at), (0, 1), at):
        score = net.score(x[side == k])
        assert n == len(score) and above.tolist() == [(score >= e).sum() for e in edges]


def test_the_fit_lowers_the_risk_over_all_rows(frame, monkeypatch):
    """Where few rows are drawn, those that are not count as well."""
    monkeypatch.setattr(pu_quality, "DRAWN", 1)
    monkeypatch.setattr(pu_quality, "CELL_ROWS", 1)
    monkeypatch.setattr(pu_quality, "CELLS", 4)
    monkeypatch.setattr(pu_quality, "PLANES", 2)
    monkeypatch.setattr(pu_quality, "estimate_prior", lambda *args: 0.5)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1_500, len(docstats.FEATURES)))
    x[::2] += 0.5
    rows = frame([(k, v.tolist()) for k, v in enumerate(x)], "doc_id long, features array<double>", 4)
    labels = frame([(k, 1) for k in range(0, 600, 2)], "doc_id long, quality int")
    learned = {r.doc_id for r in docstats.label_sample(labels, "quality", 1_000).collect()}
    positive = x[sorted(learned)]
    web, n = pu_quality.unlabelled(rows)
    assert len(web) < 50                                                    # drawn of 1,500

    def risk(net):
        z = [np.tanh(net.prepare(v) @ net.w1 + net.b1) @ net.w2 + net.b2 for v in (positive, x)]
        return pu_quality.pu_risk(*z, 0.5)[0]

    assert risk(pu_quality.fit(rows, labels)) < 0.9 * risk(pu_quality.train(positive, web, 0.5, n))


def test_keep_good_edge_cases(frame):
    labels = frame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    good, bad = "Plain words make a sentence here. " * 12, "!!! $$$ ### " * 30
    rows = [(k, good if k % 2 else bad, "kept", k) for k in range(40)] + [(100, None, "x", 1), (101, "", "x", 1),
                                                                          (102, good * 2_000, "x", 1), (3, good, "kept", 3), (None, bad, "x", 1)]
    docs = frame(rows, "doc_id long, text string, features string, score int")
    kept = pu_quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    predicted = {}
    for r in pu_quality.score(docs.select("doc_id", "text"), labels).collect():
        predicted.setdefault(r.doc_id, set()).add(r.predicted)
    want = [r for r in docs.collect() if 1 in predicted[r.doc_id]]
    assert sorted(map(str, kept.collect())) == sorted(map(str, want))
    assert pu_quality.keep_good(docs.limit(0), labels).count() == 0


def test_without_positives_the_score_is_the_prior():
    net = pu_quality.train(np.empty((0, 3)), np.ones((4, 3)), 0.7)
    assert net.score(np.ones((2, 3))) == pytest.approx([0.7, 0.7])
    assert pu_quality.train(np.empty((0, 3)), np.empty((0, 3)), 0.5).score(np.zeros((0, 3))).shape == (0,)


def test_pu_edge_cases(frame):
    labels = frame([(i, 1, None) for i in range(20)], "doc_id long, quality int, text string")
    df = frame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "words " * 60, "x"), (4, "y" * 100_000, None)],
               "doc_id long, text string, score string")
    got = pu_quality.score(df, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert pu_quality.score(frame([], "doc_id long, text string"), labels).collect() == []


def test_pu_query_on_held_out_rows(spark, labelled):
    got = {r.doc_id: r for r in queries.op4_quality(spark, SF001).collect()}
    assert len(got) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i], r) for i, r in labelled.items() if got[i].held_out]
    assert _auc(np.array([g.score for g, _ in held]), np.array([r.quality for _, r in held])) > 0.95
    assert np.mean([g.predicted == r.quality for g, r in held]) > 0.95


def test_scores_do_not_depend_on_held_out_labels(spark):
    """Flipping every held-out label changes no score."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(docstats.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(tuple(r) for r in pu_quality.score(docs, x).collect()) for x in (labels, flipped))
    assert a == b
