import numpy as np
import pytest

from shopfloor.llm import nn_descent as nnd
from llm_helpers import union_find

DDL = "vec_id long, embedding array<double>, kept string, unit int"


def brute(rows, threshold=0.95):
    units = []
    for _, v in rows:
        ok = v and None not in v and np.isfinite(v).all() and any(v)
        x = np.array(v, dtype=float) / np.abs(v).max() if ok else None
        units.append(None if x is None else x / np.sqrt(x @ x))
    n = len(rows)
    near = [(i, j) for i in range(n) for j in range(i) if units[i] is not None and units[j] is not None
            and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold]
    label = union_find(n, near)
    ids = {}
    for i, k in enumerate(label):
        if rows[i][0] is not None:
            ids[k] = min(ids.get(k, 1 << 60), rows[i][0])
    links = [0] * n
    for i, j in near:
        links[i] += 1
        links[j] += 1
    return sorted(((r[0], links[i], ids.get(label[i]), r[0] == ids.get(label[i])) for i, r in enumerate(rows)),
                  key=lambda t: [(x is None, x) for x in t])


def run(frame, rows, **options):
    df = frame([(*r, "k", 1) for r in rows], DDL)
    return sorted((tuple(r) for r in nnd.near_duplicates(df, **options).collect()),
                  key=lambda t: [(x is None, x) for x in t])


def corpus(seed, n=400, dim=16):
    """Loose background, pairs, a tight crowd, a chain and copies."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    near = lambda v, s: v + s * rng.normal(size=dim) * np.linalg.norm(v) / np.sqrt(dim)
    rows = [*x, *(near(v, 0.05) for v in x[:40]), *(near(x[50], 0.03) for _ in range(60)), *(x[60] for _ in range(25))]
    v = x[70]
    for _ in range(12):                                       # neighbours link, the ends do not
        v = v / np.linalg.norm(v) + 0.25 * rng.normal(size=dim) / np.sqrt(dim)
        rows.append(v)
    order = rng.permutation(len(rows))
    return [(int(i) * 3, [float(c) for c in rows[k]]) for i, k in enumerate(order)]


def test_links_equal_brute_force(frame):
    rows = corpus(1)
    assert run(frame, rows) == brute(rows)


def test_many_groups_crowds_and_tiles(frame, monkeypatch):
    """Small bounds, so that trees, salts, crowds and large components are taken."""
    for name, value in (("GROUP", 64), ("BLOCK", 16), ("CROWD", 4), ("TILE", 8), ("K", 4)):
        monkeypatch.setattr(nnd, name, value)
    rows = corpus(2)
    got, want = run(frame, rows), brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there * 0.99 <= found <= there
    assert sum(a == b for a, b in zip(got, want)) >= 0.98 * len(want)


def test_counting_is_exact_for_given_components(frame, monkeypatch):
    """Core by size, rim by tiles, against all pairs."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=8)
    x = np.array([centre / np.linalg.norm(centre) + rng.normal(size=8) * s for s in np.linspace(0, 0.2, 120)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    copies = rng.integers(1, 4, len(x))
    nodes = frame([(i, bytearray(v.tobytes()), 8, int(c)) for i, (v, c) in enumerate(zip(x, copies))],
                  "node long, unit binary, dim int, copies long")
    labels = frame([(i, 0) for i in range(len(x))], "node long, label long")
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    want = {i: int(near[i] @ copies) for i in range(len(x))}
    for tile in (1000, 16):
        got = {r.node: r.links for r in nnd.count_links(nodes, labels, 0.95, tile=tile).collect()}
        assert got == want


def test_audit_measures_recall_and_finds_missing_links(frame):
    x = np.repeat(np.eye(4), 3, axis=0) + 0.01 * np.random.default_rng(0).normal(size=(12, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    nodes = frame([(i, bytearray(v.tobytes()), 4) for i, v in enumerate(x)], "node long, unit binary, dim int")
    whole = frame([(i, i // 3 * 3) for i in range(12)], "node long, label long")
    recall, missing = nnd.audit(nodes, whole, 0.95)
    assert recall == 1.0 and missing.isEmpty()
    recall, missing = nnd.audit(nodes, whole.where("node >= 3"), 0.95)     # the first three were not joined
    assert recall < 1 and union_find(12, [(r.a, r.b) for r in missing.collect()])[:3] == [0, 0, 0]


def _nodes(frame, x):
    x = x / np.linalg.norm(x, axis=1)[:, None]
    return frame([(i, bytearray(v.tobytes()), x.shape[1]) for i, v in enumerate(x)], "node long, unit binary, dim int")


def test_audit_sees_lost_pairs_beside_a_crowd(frame):
    """A found crowd of 400, and 40 pairs of which every other was lost."""
    at = np.concatenate([np.zeros(400, dtype=int), np.repeat(np.arange(1, 41), 2)])
    x = np.eye(41)[at] + 0.002 * np.random.default_rng(0).normal(size=(480, 41))
    first = {k: int(np.flatnonzero(at == k)[0]) for k in range(41)}
    labels = frame([(i, first[k]) for i, k in enumerate(at.tolist()) if k % 2 == 0], "node long, label long")
    recall, missing = nnd.audit(_nodes(frame, x), labels, 0.95)
    assert recall < nnd.RECALL
    assert {r.a for r in missing.collect()} == {i for i, k in enumerate(at.tolist()) if k % 2}
    assert nnd.recalls([(1, 1), (0, 1), (3, 3), (2, 2), (400, 400)]) == {1: (2, 0.5), 2: (2, 1.0), 256: (1, 1.0)}


def test_crowded_leaves_are_cut_by_projections(frame, monkeypatch):
    """A sample too small for the leaves: pairs still meet in one group."""
    for name, value in (("GROUP", 64), ("BLOCK", 64), ("SAMPLE", 32), ("MAX_SAMPLE", 32)):
        monkeypatch.setattr(nnd, name, value)
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(300, 12)), 2, axis=0) + 0.001 * rng.normal(size=(600, 12))
    found = nnd.start(_nodes(frame, x), 1, 1, 0.95).where("kind = 's'").collect()
    assert sum(r.node // 2 == r.nbr // 2 for r in found) >= 270


def test_saturated_lists_are_enlarged_outside_their_component(frame):
    """Two tight groups of 30, a few of whose members link: every list is full
    of its own group, and the links between them are still found."""
    rng = np.random.default_rng(6)
    angle = np.concatenate([np.full(28, 0.0), [0.1, 0.1], np.full(28, 0.5), [0.4, 0.4]])   # cos 0.3 > 0.95 > cos 0.4
    x = np.stack([np.cos(angle), np.sin(angle), *np.zeros((6, 60))], axis=1) + 0.001 * rng.normal(size=(60, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    nodes = nnd.singles(_nodes(frame, x))
    s = x @ x.T - 2 * np.eye(60)
    graph = frame([(i, int(j), float(s[i, j]), False) for i in range(60) for j in np.argsort(-s[i])[:nnd.K]
                   if (i < 30) == (j < 30)], "node long, nbr long, sim float, fresh boolean")
    assert graph.count() == 60 * nnd.K and graph.where("sim < 0.95").isEmpty()
    edges = graph.selectExpr("node as a", "nbr as b").union(
        frame([(i, i - i % 30) for i in range(60)], "a long, b long"))
    _, labels = nnd.joined(nodes, graph, edges, 0.95, 1, nnd.ROUNDS)
    assert {r.label for r in labels.collect()} == {0}


def test_plans_of_links_do_not_grow_with_the_rounds(frame, monkeypatch):
    """What the steps met is read and checked at once, and no link is lost by it:
    the driver plans and keeps as much after six rounds as after one."""
    monkeypatch.setattr(nnd, "STILL", -1)                     # every round runs
    monkeypatch.setattr(nnd, "K", 4)
    x = np.array([v for _, v in corpus(7, n=80)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    nodes = nnd.singles(_nodes(frame, x)).cache()
    none = frame([], "node long, label long")
    near, met = x @ x.T >= 0.95, []
    joins = lambda df: df._jdf.queryExecution().logical().toString().count("Join ")
    for rounds in (1, 4):
        links, graph = nnd.descend(nodes, nnd.start(nodes, 1, 1, 0.95), 0.95, rounds)
        more = nnd.enlarge(nodes, graph, none, 0.95, 1, 2, rounds)
        met.append((joins(links), joins(more)))
    assert met == [(2, 2), (2, 2)]
    assert {frozenset((r.node, r.nbr)) for r in graph.collect() if near[r.node, r.nbr]} \
        <= {frozenset(r) for r in links.collect()}
    whole = union_find(len(x), list(zip(*np.nonzero(near))))
    assert union_find(len(x), [tuple(r) for r in links.collect()]) == whole
    assert union_find(len(x), [tuple(r) for r in links.union(more).collect()]) == whole


def test_edge_cases(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 1.0]),
            (8, [2.0, 2.0]), (9, [1.0, 1.0, 0.0]), (10, [1e308, 1e308]), (11, [1e-300, 1e-300]), (12, [-1.0, -1.0]),
            (7, [1.0, 1.0]), (None, [1.0, 1.001]), (None, None)]
    got = run(frame, rows)
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r[1:])
    for i in (1, 2, 3, 4, 5, 6, 9, 12):
        assert by[i] == [(0, i, True)]
    assert by[7] == [(5, 7, True)] * 2                        # rows that repeat an id are vectors of their own
    assert by[8] == by[10] == by[11] == [(5, 7, False)]
    assert sorted(by[None], key=str) == sorted([(5, 7, False), (0, None, True)], key=str)
    assert run(frame, []) == []


@pytest.mark.parametrize("threshold", [0.8, 0.999])
def test_other_thresholds(frame, threshold):
    rows = corpus(5, n=150)
    got = [r[:3] for r in run(frame, rows, threshold=threshold)]
    want = [r[:3] for r in brute(rows, threshold)]
    assert sum(a == b for a, b in zip(got, want)) >= 0.98 * len(want)


def test_low_recall_is_told(frame, monkeypatch):
    """No result is given whose last audit still misses links."""
    rows = frame([(k, [1.0, k / 50, 0.0]) for k in range(30)], "vec_id long, embedding array<double>")
    real = nnd.audit
    monkeypatch.setattr(nnd, "ATTEMPTS", 2)
    monkeypatch.setattr(nnd, "audit", lambda *a, **k: (0.5, real(*a, **k)[1]))
    with pytest.raises(nnd.LowRecall, match="recall 0.5000 after 2 searches"):
        nnd.near_duplicates(rows)
