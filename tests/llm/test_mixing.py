import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from shopfloor.llm import mixing, queries
from llm_helpers import SF0001


def fill(sizes, weights, epochs):
    """Clamp and reshare until none is above its cap, in exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap = {s: epochs * sizes[s] for s in names}
    target, open_ = {}, set(names)
    while open_:
        left = sum(sizes.values()) - sum(target.values())
        share = {s: Fraction(weight[s] * left, sum(weight[t] for t in open_)) for s in open_}
        above = [s for s in open_ if share[s] > cap[s]]
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = Fraction(cap[s])
            open_.remove(s)
    return target


def run(frame, rows, weights=(5, 2, 1), epochs=3, seed=1):
    df = frame(rows, "doc_id long, source string, size long")
    return mixing.apply(df, mixing.fit(df, list(weights), epochs, seed), seed).collect()


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5000, None: 40}, {"é": 7, "z": 0, "Z": 900, "": 30},
    {"a": 10}, {f"s{i}": (i * 37) % 101 for i in range(11)}, {"a": 0, "b": 0}, {"null": 5, None: 500}])
def test_targets_equal_iterated_clamping(frame, sizes):
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items())]
    want = fill(sizes, [5, 2, 1], 3)
    for r in run(frame, rows):
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(want[r.source]), rel=1e-12)


def test_taken_comes_near_the_target(frame):
    rows = [(i, "ab c"[i % 4] if i % 3 else "a", 10 + i * 7 % 200) for i in range(4000)]
    got = run(frame, rows)
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in run(frame, rows))
    by = {}
    for r in got:
        assert r.taken in {r.size * k for k in range(4)} and r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    for source in by.values():
        assert abs(sum(r.taken for r in source) - source[0].target) <= max(r.size for r in source) / 2 + 1e-6


def test_the_rest_is_one_prefix_of_the_order(frame):
    """Against sorting each source whole."""
    rows = [(i, f"s{i % 3}", (i * 31) % 50) for i in range(600)] + [(5, "s2", 11), (5, "s2", 11)]
    df = frame(rows, "doc_id long, source string, size long")
    got = mixing.apply(df.withColumn("h", mixing.place("doc_id", 1)), mixing.fit(df, [5, 2, 1], 3, 1), 1).collect()
    for s in ("s0", "s1", "s2"):
        mine = [r for r in got if r.source == s]
        places = {}
        for r in mine:
            places.setdefault((r.h, r.doc_id), [0, r.copies])[0] += r.size
        rate = mine[0].target / mine[0].source_size
        want, ahead = (rate - int(rate)) * mine[0].source_size, 0
        for key in sorted(places):
            size, copies = places[key]
            assert copies == int(rate) + (want > 0 and ahead + size / 2 <= want)
            ahead += size


def test_edge_cases(frame):
    assert run(frame, []) == []
    got = run(frame, [(None, None, None), (None, "a", 5), (1, "a", 5), (1, "a", 5), (2, "a", 0)])
    assert len(got) == 5 and {r.taken for r in got if r.size in (0, None)} == {0}
    assert len({r.copies for r in got if r.doc_id == 1}) == 1               # rows that share an id are taken alike


def test_word_count(frame):
    texts = [None, "", " \t", "a", "a  b\x0bc\rd\x0ce\n", "a b c", "😀 \x1c x"]
    df = frame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r.n for r in df.select("i", mixing.word_count("t").alias("n")).collect()}
    assert [got[i] for i in range(len(texts))] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_mix_repeats_rows(frame):
    rows = [(i, "w " * (i % 9), "en", f"s{i % 4}", "extra") for i in range(200)] + [(7, None, "en", None, "e")]
    df = frame(rows, "doc_id long, text string, lang string, source string, size string")
    out = mixing.mix(df, [5, 2, 1], 3, 17)
    assert out.columns == df.columns
    sized = df.select("doc_id", "source", mixing.word_count("text").alias("size"))
    plan = mixing.apply(sized, mixing.fit(sized, [5, 2, 1], 3, 17), 17)
    want = {r.doc_id: r.copies for r in plan.where("copies > 0").collect()}
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == want


def test_query_over_the_corpus(spark):
    got = queries.op3_mixing(spark, SF0001)
    per = got.join(spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "source"), "doc_id") \
             .groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("x"), F.max("size").alias("m"),
                                    F.first("source_size").alias("s"))
    rows = per.collect()
    want = fill({r.source: r.s for r in rows}, [5, 2, 1], 3)
    for r in rows:
        assert r.x == pytest.approx(float(want[r.source])) and abs(r.t - r.x) <= r.m / 2 + 1e-6
