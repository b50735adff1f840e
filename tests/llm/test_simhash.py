import numpy as np
import pytest
import xxhash

from shopfloor.llm import common, queries, simhash_vp
from llm_helpers import SF001, union_find


def plain_simhash(text, shingle=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "Two WORDS", "a b c", "É ß Éé x\x0by\x0cz É ß Éé",
                                  "a b a b a b a b", "x " * 999, "nbsp\xa0stays one\x1cword"])
def test_fingerprint(text):
    assert simhash_vp.simhash(text) == plain_simhash(text)


def test_long_text_in_steps(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(70_000))
    assert simhash_vp.simhash(text) == plain_simhash(text)


def _components(points, links):
    index = {int(p): i for i, p in enumerate(points)}
    return union_find(len(points), [(index[int(a)], index[int(b)]) for a, b in links])


def _brute(points, bits):
    near = np.bitwise_count(points[:, None] ^ points[None]) <= bits
    return union_find(len(points), zip(*np.nonzero(np.triu(near, 1))))


def _clustered(rng, n):
    seeds = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    flips = [seeds ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) for _ in range(3)]
    return np.unique(np.concatenate([seeds, flips[0], flips[0] ^ flips[1] ^ seeds, rng.integers(0, 64, 40, dtype=np.uint64)]))


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_tree_loses_no_link(monkeypatch, bits):
    monkeypatch.setattr(simhash_vp, "LEAF", 32)
    points = _clustered(np.random.default_rng(bits), 500)
    assert _components(points, simhash_vp.local_links(points, bits)) == _brute(points, bits)


def test_dense_ball_larger_than_a_leaf(monkeypatch):
    monkeypatch.setattr(simhash_vp, "LEAF", 16)
    points = np.arange(1 << 9, dtype=np.uint64)                # every point links with many others
    assert set(_components(points, simhash_vp.local_links(points, 2))) == {0}


def test_pairs_meet_in_a_shard():
    rng = np.random.default_rng(9)
    points = _clustered(rng, 2000)
    tree = simhash_vp.grow(points[::3], 3.0, 300, 2)
    shards = {}
    for leaf, idx in simhash_vp.route(tree, points, 2):
        for i in idx:
            shards.setdefault(int(points[i]), set()).add(leaf)
    assert len({s for x in shards.values() for s in x}) > 4 and len(shards) == len(points)
    near = np.bitwise_count(points[:, None] ^ points[None]) <= 2
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        assert shards[int(points[i])] & shards[int(points[j])]


def test_components_by_contraction(frame):
    rng = np.random.default_rng(4)
    n = 300
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, n, (220, 2))] + [(i, i + 1) for i in range(100, 140)]
    pairs += [(299, i) for i in range(200, 230)]                # a star whose centre is the largest
    got = {r.node: r.label for r in common.components(frame(pairs, "a long, b long")).collect()}
    want = union_find(n, pairs)
    assert got == {i: want[i] for i in range(n) if any(i in p and p[0] != p[1] for p in pairs)}
    assert common.components(frame([(3, 3)], "a long, b long")).collect() == []


def test_edge_cases(frame):
    ddl = "doc_id long, text string, fp string, component_id int, label string"
    rows = [(5, None), (4, ""), (9, "\n"), (7, "some text here now"), (7, "some text here now"), (None, "SOME text here now"),
            (None, "alone it is"), (8, "w " * 50_000)]
    df = frame([(*r, "x", 1, "y") for r in rows], ddl)
    got = sorted(((r.doc_id, r.component_id) for r in simhash_vp.near_duplicates(df).collect()),
                 key=lambda t: [(v is None, v) for v in t])
    assert got == [(4, 4), (5, 4), (7, 7), (7, 7), (8, 8), (9, 4), (None, 7), (None, None)]
    kept = simhash_vp.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 4), (False, 7), (False, 8), (True, None)]
    assert simhash_vp.near_duplicates(frame([], ddl)).collect() == []


@pytest.mark.parametrize("shard_rows", [100, 20_000])
def test_query_against_brute_force(spark, shard_rows):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    docs = sorted(docs, key=lambda d: d.doc_id)
    prints = np.array([plain_simhash(d.text) for d in docs], dtype=np.uint64)
    labels = _brute(prints, 2)
    want = {(d.doc_id, f"{int(p):016x}", docs[k].doc_id) for d, p, k in zip(docs, prints, labels)}
    if shard_rows == 20_000:
        got = {tuple(r) for r in queries.op10_simhash(spark, SF001).collect()}
    else:
        df = simhash_vp.near_duplicates(spark.read.parquet(f"{SF001}/documents.parquet"), shard_rows=shard_rows)
        got = {(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in df.collect()}
    assert got == want
