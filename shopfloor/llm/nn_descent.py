"""Embedding near-duplicates by NN-descent.

1. Vectors become unit vectors; equal ones collapse to one node with a count.
2. Random-projection trees, fitted on a bounded sample, deal the nodes to groups;
   in each group small blocks are compared exactly.  That starts the neighbour
   graph (the `K` nearest of each node).
3. Rounds of NN-descent: around each node its neighbours and the nodes that name
   it as a neighbour are compared with each other, where one of the two is new,
   until hardly a list changes.
4. Every comparison that reaches the threshold is a link.  Groups emit stars of
   linked nodes, not all pairs, and connected components over the stars give
   the near-duplicate components.
5. An audit compares a bounded query set, drawn uniformly, with all nodes by brute
   force.  Recall is averaged over queries, and over those with about as many
   links; links it finds between components are added, and where any of these
   averages is below `RECALL` more trees and rounds run.
6. Lists that are saturated (all of their neighbours are links) are enlarged by
   the K nearest outside their component, found by trees and rounds as before,
   as long as this joins components.  Within it the list is the whole component:
   links are counted exactly, by blocks, and within a ball of half the
   threshold's angle by its size alone.

All similarities that decide a link are products of unit vectors in double
precision; single precision is used to order the search.
"""

from __future__ import annotations

import itertools
import logging
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stage, stage_with

THRESHOLD = 0.95
K = 8                   # neighbours kept in a list
TREES, ROUNDS = 6, 6    # trees that start the graph; most rounds of descent
OUTSIDE_TREES = 2       # trees that start the lists of saturated nodes outside their component
STILL = 0.002           # share of changed list entries at which descent ends
# vectors the trees are fitted on: so many a group, within these bounds
PER_GROUP, SAMPLE, MAX_SAMPLE = 32, 1 << 12, 1 << 16
GROUP, BLOCK = 4096, 256        # nodes of a group (one task row set); of a block compared exactly
CROWD = 24              # nodes that name one node as neighbour and are compared at once
ATTEMPTS = 5            # searches, each audited and with twice the trees of the one before, until recall holds
HALVINGS = 30           # times a leaf that the sample left crowded is cut in two, at most
QUERIES, RECALL = 256, 0.99     # audit: query nodes at first, share of their links that must be found
MOST_QUERIES, FEW = 4096, 64    # query nodes at most; drawn until so many of them have 1 to K links
ENOUGH = 16             # queries of about as many links whose recall counts by itself
TILE = 1024             # nodes per side of a tile when large components are counted
SLACK = 1e-6            # what single precision may be off


# ---------------------------------------------------------------- vectors

def unit(vector) -> tuple[bytes | None, int]:
    """(unit vector as doubles, dimension); None for null and zero vectors and
    those that hold null or non-finite components."""
    if vector is None or any(x is None for x in vector):
        return None, 0
    v = np.array(vector, dtype=np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None, 0
    top = np.abs(v).max()
    if top == 0:
        return None, 0
    v = v / top                                     # keeps the squares in range
    return (v / math.sqrt(float(v @ v)) + 0.0).tobytes(), len(v)


def with_units(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, unit, dim) of every row."""
    schema = df.select(F.col(id_col).cast("long").alias("vec_id")).schema.add("unit", "binary").add("dim", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [unit(v.as_py()) for v in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m[0] for m in made], pa.binary()),
                                              pa.array([m[1] for m in made], pa.int32())], names=schema.names)

    return df.select(F.col(id_col).cast("long").alias("vec_id"), vector).mapInArrow(run, schema)


def _matrix(units, dtype=np.float64) -> np.ndarray:
    units = list(units)
    return np.frombuffer(b"".join(units), dtype=dtype).reshape(len(units), -1)


# ---------------------------------------------------------------- start of the graph

def grow(sample: np.ndarray, scale: float, rng: np.random.Generator) -> list:
    """Random-projection tree: [direction, cut, below, above] or a leaf number."""
    leaves = iter(range(1 << 31))

    def node(x: np.ndarray):
        if len(x) * scale <= GROUP or len(x) < PER_GROUP:
            return next(leaves)
        a, b = x[rng.choice(len(x), 2, replace=False)]
        p = x @ (a - b)
        cut = float(np.median(p))
        if (p <= cut).all() or not (p <= cut).any():
            return next(leaves)
        return [a - b, cut, node(x[p <= cut]), node(x[p > cut])]

    return node(sample)


def _route(tree, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    stack = [(tree, np.arange(len(x)))]
    while stack:
        at, idx = stack.pop()
        if isinstance(at, int):
            out[idx] = at
        elif len(idx):
            below = x[idx] @ at[0] <= at[1]
            stack += [(at[2], idx[below]), (at[3], idx[~below])]
    return out


def _blocks(x: np.ndarray, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Indices of blocks of at most BLOCK nearby rows."""
    stack = [np.arange(len(x))]
    while stack:
        idx = stack.pop()
        if len(idx) <= BLOCK:
            yield idx
            continue
        a, b = x[idx[rng.choice(len(idx), 2, replace=False)]]
        order = np.argsort(x[idx] @ (a - b), kind="stable")
        stack += [idx[order[:len(idx) // 2]], idx[order[len(idx) // 2:]]]


def stars(linked: np.ndarray) -> np.ndarray:
    """Index of the smallest node reachable, from a symmetric matrix of links."""
    n = len(linked)
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(linked, label[None], n).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


_FOUND = "kind string, node long, nbr long, sim float"


def _found(kinds, nodes, nbrs, sims) -> pd.DataFrame:
    return pd.DataFrame({"kind": np.concatenate(kinds), "node": np.concatenate(nodes),
                         "nbr": np.concatenate(nbrs), "sim": np.concatenate(sims).astype(np.float32)})


def block_links(node: np.ndarray, x: np.ndarray, k: int, threshold: float, rng,
                label: np.ndarray | None = None) -> pd.DataFrame:
    """Nearest neighbours (kind 'n') and stars of links (kind 's') of a group;
    given `label`, only between nodes of different labels."""
    out: list[list] = [[], [], [], []]
    for idx in _blocks(x, rng):
        s = x[idx] @ x[idx].T
        if label is not None:
            s[label[idx][:, None] == label[idx][None]] = -2
        linked = s >= threshold
        np.fill_diagonal(linked, False)
        if linked.any():
            least = stars(linked)
            far = np.flatnonzero(least != np.arange(len(idx)))
            for column, value in zip(out, (["s"] * len(far), node[idx[far]], node[idx[least[far]]], np.ones(len(far)))):
                column.append(np.array(value))
        np.fill_diagonal(s, -2)
        m = min(k, len(idx) - 1)
        if m:
            near = np.argpartition(-s, m - 1, axis=1)[:, :m]
            for column, value in zip(out, (np.full(near.size, "n"), np.repeat(node[idx], m), node[idx[near]].ravel(),
                                           np.take_along_axis(s, near, 1).ravel())):
                column.append(value)
    return _found(*out) if out[0] else pd.DataFrame({"kind": [], "node": [], "nbr": [], "sim": []}).astype(
        {"kind": str, "node": "int64", "nbr": "int64", "sim": "float32"})


def halved(dealt: DataFrame, seed: int) -> DataFrame:
    """`dealt` with crowded leaves cut in two by a further projection each, until
    none exceeds GROUP rows: the sample is bounded, the leaves' number is not."""
    keys = ["tree", "dim", "leaf"]
    whole, crowded = dealt, dealt.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select(*keys)
    crowded = stage(crowded, "nnd-crowded")
    if crowded.isEmpty():
        return dealt
    done = whole.join(F.broadcast(crowded), keys, "left_anti").withColumn("depth", F.lit(0))
    rows = stage(whole.join(F.broadcast(crowded), keys).withColumn("depth", F.lit(0)), "nnd-leaves")
    keys = [*keys, "depth"]
    schema = rows.select("*").schema.add("p", "double")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = [float(np.frombuffer(u.as_py()) @ (np.frombuffer(x.as_py()) - np.frombuffer(y.as_py())))
                 for u, x, y in zip(b.column("unit"), b.column("x"), b.column("y"))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in schema.names[:-1]), pa.array(p, pa.float64())],
                                             names=schema.names)

    for step in range(HALVINGS):
        h = F.xxhash64("node", F.lit(seed), F.lit(step))
        ends = rows.groupBy(*keys).agg(F.min_by("unit", h).alias("x"), F.max_by("unit", h).alias("y"))
        names = schema.names[:-1]
        laid = stage(rows.join(ends, keys).select(*names, "x", "y").mapInArrow(project, schema), "nnd-leaves")
        cuts = laid.groupBy(*keys).agg(F.percentile_approx("p", 0.5).alias("cut"), F.max("p").alias("top"))
        sides = laid.join(cuts, keys)
        done = done.unionByName(sides.where("top <= cut").select(*names))            # cannot be cut
        cut = sides.where("top > cut").withColumn("leaf", F.expr("2 * leaf + cast(p > cut as long)")) \
                   .withColumn("depth", F.col("depth") + 1).select(*names)
        cut = stage(cut, "nnd-leaves")
        sizes = cut.groupBy(*keys).agg(F.count("*").alias("n"))
        crowded = stage(sizes.where(F.col("n") > GROUP).select(*keys), "nnd-crowded")
        done, rows = done.unionByName(cut.join(crowded, keys, "left_anti").select(*names)), cut.join(crowded, keys, "left_semi")
        if crowded.isEmpty():
            break
    else:
        done = done.unionByName(rows.select(*names))
    # leaves of other depths are others; a tree's own leaves stay below 2 ** 31
    return done.withColumn("leaf", F.when(F.col("depth") == 0, F.col("leaf")).otherwise(
        F.xxhash64("leaf", "depth").bitwiseOR(F.lit(1 << 62)))).drop("depth")


def start(nodes: DataFrame, trees: int, seed: int, threshold: float) -> DataFrame:
    """What the trees find: rows of _FOUND; only between nodes of different
    labels where `nodes` has `label`."""
    outside = ["label"] if "label" in nodes.columns else []
    n = nodes.count()
    sample = min(MAX_SAMPLE, max(SAMPLE, PER_GROUP * n // GROUP))
    some = nodes.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(max(1, n // sample))) == 0) \
                .select("unit", "dim").limit(2 * sample).toPandas()
    dims = some["dim"].tolist()
    dim = max(set(dims), key=lambda d: (dims.count(d), d), default=0)      # others go to one leaf each
    x = _matrix(some["unit"][some["dim"] == dim]) if dim else np.empty((0, 1))
    rng = np.random.default_rng(seed)
    forest = [grow(x, n / max(1, len(x)), rng) for _ in range(trees)]

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for own_dim, part in f.groupby("dim"):
                v = _matrix(part["unit"])
                for t, tree in enumerate(forest):
                    yield pd.DataFrame({"tree": t, "dim": own_dim, "node": part["node"], "unit": part["unit"],
                                        "leaf": _route(tree, v) if own_dim == dim else 0,
                                        **{c: part[c] for c in outside}})

    dealt = nodes.select("node", "dim", "unit", *outside).mapInPandas(
        deal, "tree int, dim int, node long, unit binary, leaf long" + "".join(f", {c} long" for c in outside))
    dealt = halved(dealt, seed)
    # what no projection could cut is salted anew in each tree
    sizes = dealt.groupBy("tree", "dim", "leaf").agg(F.count("*").alias("n"))
    salts = F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP)).cast("int")
    dealt = dealt.join(F.broadcast(sizes.select("tree", "dim", "leaf", salts.alias("salts"))), ["tree", "dim", "leaf"])
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("node", "tree", F.lit(seed)), F.col("salts")))

    def link(f: pd.DataFrame) -> pd.DataFrame:
        return block_links(f["node"].to_numpy(), _matrix(f["unit"]), K, threshold,
                           np.random.default_rng([seed, int(f["tree"].iloc[0])]),
                           f["label"].to_numpy() if outside else None)

    return dealt.groupBy("tree", "dim", "leaf", "salt").applyInPandas(link, _FOUND)


# ---------------------------------------------------------------- descent

def nearest(found: DataFrame) -> DataFrame:
    """The K nearest distinct neighbours per node: (node, nbr, sim, fresh)."""
    n = found.repartition("node").groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("sim", "nbr", "fresh")), asc=False), 1, K)
    return n.groupBy("node").agg(best.alias("best")).select("node", F.inline("best")) \
            .select("node", "nbr", "sim", "fresh")


def _worst(lists: DataFrame) -> DataFrame:
    """(member, worst): the similarity that an entry of a full list must exceed.
    Rows without a `sim` name members only."""
    return lists.groupBy("node").agg(F.min("sim").alias("worst"), F.count("sim").alias("n")) \
                .select(F.col("node").alias("member"), F.when(F.col("n") >= K, F.col("worst")).otherwise(-2.0)
                        .cast("float").alias("worst"))


def around(graph: DataFrame, nodes: DataFrame, threshold: float, worst: DataFrame | None = None) -> DataFrame:
    """One round of local joins: rows of _FOUND, plus pairs too close to the
    threshold for single precision (kind 'c').  Where `nodes` has `label`, only
    nodes of different labels are compared; neighbours are found for the
    members of `worst` alone, if given, else for all."""
    crowds = graph.groupBy("nbr").agg(F.ceil(F.count("*") / CROWD).cast("int").alias("crowds"))
    back = graph.join(crowds, "nbr").select(
        F.col("nbr").alias("at"), F.pmod(F.xxhash64("node"), F.col("crowds")).cast("int").alias("crowd"),
        F.col("node").alias("member"), "fresh")
    own = graph.join(crowds.withColumnRenamed("nbr", "at"), graph["node"] == F.col("at"), "left").select(
        F.col("node").alias("at"), F.explode(F.sequence(F.lit(0), F.coalesce("crowds", F.lit(1)) - 1)).alias("crowd"),
        F.col("nbr").alias("member"), "fresh")
    members = own.union(back).groupBy("at", "crowd", "member").agg(F.max("fresh").alias("fresh"))
    some = worst is not None
    worst, absent = (worst, F.lit(2.0).cast("float")) if some else (_worst(graph), F.lit(-2.0).cast("float"))
    label = F.col("label") if "label" in nodes.columns else F.col("node")
    vectors = nodes.select(F.col("node").alias("member"), "single", label.alias("label"))
    local = members.join(vectors, "member").join(worst, "member", "left").groupBy("at", "crowd").agg(
        F.collect_list(F.struct("member", "fresh", F.coalesce("worst", absent).alias("worst"),
                                "single", "label")).alias("members"), F.max("fresh").alias("any"))
    if some:
        local = local.where("any")
    names = ["kind", "node", "nbr", "sim"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("members")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            ids, fresh, worst, label = (flat.field(c).to_numpy(zero_copy_only=False)
                                        for c in ("member", "fresh", "worst", "label"))
            x = _matrix(flat.field("single").to_pylist(), np.float32)
            kinds, nodes_, nbrs, sims = [], [], [], []
            for lo, hi in zip(ends[:-1], ends[1:]):
                s = x[lo:hi] @ x[lo:hi].T
                s[label[lo:hi, None] == label[None, lo:hi]] = -2
                new = fresh[lo:hi, None] | fresh[None, lo:hi]
                np.fill_diagonal(new, False)
                better = new & (s > worst[lo:hi, None])
                i, j = np.nonzero(better)
                kinds.append(np.full(len(i), "n")), nodes_.append(ids[lo + i])
                nbrs.append(ids[lo + j]), sims.append(s[i, j])
                linked = s >= threshold + SLACK
                np.fill_diagonal(linked, False)
                if linked.any():
                    least = stars(linked)
                    far = np.flatnonzero(least != np.arange(hi - lo))
                    kinds.append(np.full(len(far), "s")), nodes_.append(ids[lo + far])
                    nbrs.append(ids[lo + least[far]]), sims.append(np.ones(len(far)))
                i, j = np.nonzero(np.triu(np.abs(s - threshold) < SLACK, 1))
                if len(i):
                    kinds.append(np.full(len(i), "c")), nodes_.append(ids[lo + i])
                    nbrs.append(ids[lo + j]), sims.append(s[i, j])
            columns = [np.concatenate(c) for c in (kinds, nodes_, nbrs, sims)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3].astype(np.float32), pa.float32())], names=names)

    return local.select("members").mapInArrow(run, _FOUND)


def checked(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (node, nbr) whose product in double precision reaches the threshold."""
    a = nodes.select("node", F.col("unit").alias("x"), F.col("dim").alias("dx"))
    b = nodes.select(F.col("node").alias("nbr"), F.col("unit").alias("y"), F.col("dim").alias("dy"))
    both = pairs.select("node", "nbr").distinct().join(a, "node").join(b, "nbr").where("dx = dy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = [float(np.frombuffer(x.as_py()) @ np.frombuffer(y.as_py())) >= threshold
                     for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["node", "nbr"]).filter(pa.array(close, pa.bool_()))

    return both.select("node", "nbr", "x", "y").mapInArrow(run, "node long, nbr long")


def descend(nodes: DataFrame, found: DataFrame, threshold: float, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) met by the start and the rounds of descent, and the lists."""
    paths: list[str] = []
    found = stage_with(found, "nnd-start", paths)
    graph = stage(nearest(found.where("kind = 'n'").select("node", "nbr", "sim", F.lit(True).alias("fresh"))), "nnd-graph")
    for _ in range(rounds):
        found = stage_with(around(graph, nodes, threshold), "nnd-round", paths)
        graph = stage(nearest(graph.withColumn("fresh", F.lit(False)).union(
            found.where("kind = 'n'").select("node", "nbr", "sim", F.lit(True)))), "nnd-graph")
        changed = graph.agg(F.avg(F.col("fresh").cast("int")).alias("share")).first()["share"] or 0
        if changed <= STILL:
            break
    return met(paths, graph, nodes, threshold), graph


def met(paths: list[str], lists: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that were met by the steps that wrote `paths` (rows of _FOUND),
    and the lists themselves, in double precision where single precision came
    near.  All steps are read by one scan and checked by one join: the plan, and
    with it what the driver keeps of it, does not grow with the rounds."""
    found = nodes.sparkSession.read.schema(_FOUND).parquet(*paths)
    close = lists.where(F.col("sim") >= threshold - SLACK).select("node", "nbr")
    close = found.where("kind = 'c'").select("node", "nbr").union(close)
    return found.where("kind = 's'").select("node", "nbr").union(checked(close, nodes, threshold)).toDF("a", "b")


def enlarge(nodes: DataFrame, graph: DataFrame, labels: DataFrame, threshold: float, trees: int, seed: int,
            rounds: int) -> DataFrame:
    """Links (a, b) between components that saturated lists had no room for.

    Nodes whose K entries all reach the threshold get K more: the nearest of
    other components.  Trees start these lists, and rounds of local joins over
    both lists improve them; nodes of one component are not compared again."""
    full = stage(graph.groupBy("node").agg(F.min("sim").alias("least"), F.count("*").alias("n"))
                 .where((F.col("n") >= K) & (F.col("least") >= threshold - SLACK)).select("node"), "nnd-full")
    none = full.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    if full.isEmpty():
        return none
    named = stage(nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "nnd-named")
    inside = stage(graph.withColumn("fresh", F.lit(False)), "nnd-inside")
    paths: list[str] = []
    found = stage_with(start(named, trees, seed, threshold), "nnd-outside", paths)
    near = lambda f: f.where("kind = 'n' and sim > -2").select("node", "nbr", "sim", F.lit(True).alias("fresh"))
    lists = stage(nearest(near(found).join(full, "node", "left_semi")), "nnd-lists")
    for _ in range(rounds):
        worst = _worst(lists.select("node", "sim").union(full.select("node", F.lit(None).cast("float"))))
        found = stage_with(around(inside.union(lists), named, threshold, worst), "nnd-outside", paths)
        lists = stage(nearest(lists.withColumn("fresh", F.lit(False)).union(near(found))), "nnd-lists")
        if (lists.agg(F.avg(F.col("fresh").cast("int")).alias("share")).first()["share"] or 0) <= STILL:
            break
    return met(paths, lists, named, threshold)


# ---------------------------------------------------------------- audit

def audit(nodes: DataFrame, labels: DataFrame, threshold: float, queries: int = QUERIES) -> tuple[float, DataFrame]:
    """(recall, missing links): a bounded query set against all nodes.

    A link is found where both ends have the same component.  The queries are
    drawn uniformly from all nodes, whether or not a link of theirs was found.
    Recall is the mean over queries that have links, or over those with about as
    many links (see `recalls`) where that is less.  Missing links are given as
    (a, b), one per query and component."""
    each = nodes.join(labels, "node", "left").select("node", "dim", "unit", F.coalesce("label", "node").alias("label"))
    each = stage(each, "nnd-audit")
    n, drawn, links, missing = each.count(), 0, [], None
    h = F.pmod(F.xxhash64("node", F.lit(99)), F.lit(1 << 40))
    while True:
        q = each.orderBy(h, "node").limit(max(queries, 4 * drawn)).collect()[drawn:]
        seen = stage(_compared(each, q, threshold), "nnd-audited")
        lost = seen.where("b >= 0").select("a", "b")
        missing = lost if missing is None else missing.union(lost)
        links += [(r.hit, r["all"]) for r in seen.where("b < 0").groupBy("a").agg(
            F.sum("hit").alias("hit"), F.sum("all").alias("all")).where(F.col("all") > 0).collect()]
        drawn += len(q)
        if drawn >= min(n, max(queries, MOST_QUERIES)) or sum(of <= K for _, of in links) >= FEW:
            break
    each_size = recalls(links)
    logging.getLogger(__name__).info("%d queries; recall by links (queries, recall): %s", drawn, each_size)
    counts = [r for many, r in each_size.values() if many >= ENOUGH]
    return min([sum(hit / of for hit, of in links) / len(links) if links else 1.0, *counts]), missing


def recalls(links: list[tuple[int, int]]) -> dict[int, tuple[int, float]]:
    """{links: (queries, mean recall)} of queries with (found links, links); one
    entry from each power of two to the next."""
    by: dict[int, list[float]] = {}
    for hit, of in links:
        by.setdefault(1 << (of.bit_length() - 1), []).append(hit / of)
    return {k: (len(v), sum(v) / len(v)) for k, v in sorted(by.items())}


def _compared(each: DataFrame, q: list, threshold: float) -> DataFrame:
    """Queries against `each`: rows (a, b, 0, 0) of query a that misses links to
    component b, and (a, -1, hit, all), links per query, to be summed."""
    q_id, q_label = np.array([r.node for r in q], dtype=np.int64), np.array([r.label for r in q], dtype=np.int64)
    by_dim = {d: (np.array([i for i, r in enumerate(q) if r.dim == d]), _matrix(r.unit for r in q if r.dim == d))
              for d in {r.dim for r in q}}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for dim, part in (x for f in frames for lo in range(0, len(f), 1024) for x in f[lo:lo + 1024].groupby("dim")):
            if dim not in by_dim:
                continue
            at, x = by_dim[dim]
            ids, label = part["node"].to_numpy(), part["label"].to_numpy()
            i, j = np.nonzero((x @ _matrix(part["unit"]).T >= threshold) & (q_id[at][:, None] != ids[None]))
            same = q_label[at[i]] == label[j]
            lost = np.unique(np.stack([q_id[at[i[~same]]], label[j[~same]]], axis=1), axis=0)
            asked, of = np.unique(i, return_counts=True)
            hit = np.bincount(i[same], minlength=len(at))[asked]
            none = np.zeros(len(lost), dtype=np.int64)
            yield pd.DataFrame({"a": np.append(lost[:, 0], q_id[at[asked]]),
                                "b": np.append(lost[:, 1], np.full(len(asked), -1)),
                                "hit": np.append(none, hit), "all": np.append(none, of)})

    return each.mapInPandas(run, "a long, b long, hit long, all long")


# ---------------------------------------------------------------- counting

def _tile_counts(members: DataFrame, threshold: float, keys: list[str]) -> DataFrame:
    """(node, links) summed over tiles.  `members` has the keys of a tile, and
    node, copies, unit, asks (its links are counted here) and told (nodes of the
    tile that it is compared with have their links to it counted too)."""
    tiles = members.groupBy(*keys).agg(F.collect_list(F.struct("node", "copies", "asks", "told", "unit")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.column("m"):
                flat = row.values
                node, copies, asks, told = (flat.field(c).to_numpy(zero_copy_only=False)
                                            for c in ("node", "copies", "asks", "told"))
                x = _matrix(flat.field("unit").to_pylist())
                ask, tell = np.flatnonzero(asks), np.flatnonzero(~asks)
                near = x[ask] @ x[tell].T >= threshold if len(tell) else np.zeros((len(ask), 0), dtype=bool)
                near &= node[ask][:, None] != node[tell][None]
                back = near[:, told[tell]].T @ copies[ask]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([node[ask], node[tell][told[tell]]])),
                     pa.array(np.concatenate([near @ copies[tell], back]).astype(np.int64))], names=["node", "links"])

    return tiles.select("m").mapInArrow(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def count_links(nodes: DataFrame, labels: DataFrame, threshold: float, tile: int = TILE) -> DataFrame:
    """(node, label, links): links to other nodes of the component, by copies.

    Components of up to `tile` nodes are one tile.  In larger ones the nodes
    within half the threshold's angle of the label's vector are all linked to
    each other (triangle inequality), so those links are the sum of copies; the
    other nodes are compared with the whole component tile by tile."""
    each = stage(nodes.join(labels, "node").select("node", "label", "copies", "unit"), "nnd-members")
    sizes = stage(each.groupBy("label").agg(F.count("*").alias("n")), "nnd-sizes")
    small = each.join(sizes.where(F.col("n") <= tile).select("label"), "label")
    # every node asks, and every node is there to be compared with
    both = small.withColumn("asks", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("told", F.lit(False))
    counted = _tile_counts(both, threshold, ["label"])
    large = sizes.where(F.col("n") > tile)
    if not large.isEmpty():
        reach = math.cos(math.acos(threshold) / 2 - SLACK)
        centre = nodes.select(F.col("node").alias("label"), F.col("unit").alias("centre"))
        rows = each.join(large, "label").join(centre, "label")

        def core(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                near = [float(np.frombuffer(u.as_py()) @ np.frombuffer(c.as_py())) >= reach
                        for u, c in zip(b.column("unit"), b.column("centre"))]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("node", "label", "copies", "unit")),
                                                  pa.array(near, pa.bool_())],
                                                 names=["node", "label", "copies", "unit", "core"])

        rows = stage(rows.mapInArrow(core, "node long, label long, copies long, unit binary, core boolean"), "nnd-core")
        sums = stage(rows.groupBy("label").agg(
            F.sum(F.when(F.col("core"), F.col("copies")).otherwise(0)).alias("core_copies"),
            F.ceil(F.sum((~F.col("core")).cast("int")) / tile).cast("int").alias("rims"),
            F.ceil(F.count("*") / tile).cast("int").alias("alls")), "nnd-sums")
        inside = rows.where("core").join(sums, "label").select(
            "node", (F.col("core_copies") - F.col("copies")).alias("links"))
        tiled = rows.join(sums.where("rims > 0"), "label")
        to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        own = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
        columns = ["label", "rim", "all", "node", "copies", "unit", "asks", "told"]
        rim = tiled.where("not core").withColumn("rim", own("rims", 1)).withColumn("all", to("alls")) \
                   .withColumn("asks", F.lit(True)).withColumn("told", F.lit(False))
        all_ = tiled.withColumn("all", own("alls", 2)).withColumn("rim", to("rims")) \
                    .withColumn("asks", F.lit(False)).withColumn("told", F.col("core"))
        outside = _tile_counts(rim.select(*columns).union(all_.select(*columns)), threshold, ["label", "rim", "all"])
        counted = counted.union(inside.union(outside).groupBy("node").agg(F.sum("links").alias("links")))
    return labels.join(counted, "node", "left").select("node", "label", F.coalesce("links", F.lit(0)).alias("links"))


# ---------------------------------------------------------------- operator

class LowRecall(RuntimeError):
    """The audit still misses links after the last search."""


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
                    threshold: float = THRESHOLD, trees: int = TREES, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: (vec_id, n_links, component_id, kept).

    n_links: other rows whose cosine with this one is at least `threshold`;
    component_id: the smallest id reachable over links, its own included; kept:
    whether the row has that id.  Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, and vectors of different
    dimensions do not link.  Rows with equal vectors are linked; rows that repeat
    an id are vectors of their own (and kept together); null ids never win.  An
    empty table gives no rows; other columns are not read.  A result whose audited
    recall stays below RECALL is not given: LowRecall is raised.
    """
    rows = stage(with_units(vectors, id_col, vector), "nnd-units")
    nodes = rows.where("unit is not null").groupBy("unit", "dim").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    nodes = stage(singles(nodes.withColumn("node", F.monotonically_increasing_id())), "nnd-nodes")
    edges, graph = descend(nodes, start(nodes, trees, 1, threshold), threshold, rounds)
    for attempt in itertools.count(2):
        edges, labels = joined(nodes, graph, edges, threshold, attempt, rounds)
        recall, missing = audit(nodes, labels, threshold)
        edges = edges.union(missing)
        if recall >= RECALL:
            break
        if attempt == ATTEMPTS + 1:
            raise LowRecall(f"recall {recall:.4f} after {ATTEMPTS} searches, {RECALL} asked for")
        trees *= 2
        more, graph = descend(nodes, start(nodes, trees, attempt, threshold), threshold, rounds)
        edges = edges.union(more)
    if not missing.isEmpty():
        labels = components(edges, "nnd-components")
    counted = count_links(nodes, labels, threshold)
    known = stage(nodes.join(counted, "node", "left").select(
        "unit", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("label", "node").alias("label")), "nnd-known")
    first = known.groupBy("label").agg(F.min("rep").alias("component_id"))
    known = stage(known.join(first, "label").select("unit", "n_links", "component_id"), "nnd-result")
    out = rows.where("unit is not null").join(known, "unit").select("vec_id", "n_links", "component_id")
    alone = rows.where("unit is null").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return out.union(alone).withColumn("kept", F.expr("vec_id <=> component_id"))


def joined(nodes: DataFrame, graph: DataFrame, edges: DataFrame, threshold: float, seed: int,
           rounds: int) -> tuple[DataFrame, DataFrame]:
    """(links, components) after saturated lists were enlarged until that joins
    no further components."""
    edges = stage(edges.distinct(), "nnd-links")
    labels = components(edges, "nnd-components")
    for turn in itertools.count(1):
        more = stage(enlarge(nodes, graph, labels, threshold, OUTSIDE_TREES, 1000 * seed + turn, rounds).distinct(),
                     "nnd-enlarged")
        if more.isEmpty():
            return edges, labels
        # links between components, so that each turn leaves fewer of them
        edges = stage(edges.union(more).distinct(), "nnd-links")
        labels = components(edges, "nnd-components")


def singles(nodes: DataFrame) -> DataFrame:
    """`nodes` with `single`, the unit vector in single precision."""
    schema = nodes.select("*").schema.add("single", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [np.frombuffer(u.as_py()).astype(np.float32).tobytes() for u in b.column("unit")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.binary())], names=schema.names)

    return nodes.mapInArrow(run, schema)
