"""SimHash near-duplicates through vantage-point trees.

1. Every text becomes a 64-bit SimHash of its word shingles (`fingerprints`).
2. Equal fingerprints collapse to one row, so copies are never paired.
3. A vantage-point tree, fitted on a bounded sample of the distinct
   fingerprints, deals them to shards.  A node with vantage point v and radius
   m sends a fingerprint at Hamming distance d to the inner branch when
   d <= m and to the outer branch when d > m - bits.  By the triangle
   inequality two fingerprints within `bits` differ by at most `bits` in their
   distance to v, so both always meet in one branch: only the boundary belt is
   dealt twice and every other cross-branch pair is pruned.
4. Each shard grows its own tree below by the same rule down to small leaves,
   compares all pairs of a leaf exactly, and emits a star per linked group of a
   leaf, never all pairs.
5. Connected components over the stars give the groups.

The links are exact: whatever the tree, each pair within `bits` meets in a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, stage, text_batches

SEED = 42
LEAF = 768            # largest leaf compared pair by pair in one block
SHARD_ROWS = 20000    # distinct fingerprints a shard is meant to hold
# Fingerprints the sharding tree is fitted on: so many a shard, within these bounds.  Past the
# upper one (some 10^8 distinct fingerprints) shards grow with the input, not the sample.
PER_SHARD, SAMPLE, MAX_SAMPLE = 64, 1 << 14, 1 << 20
USELESS = 0.95        # a split that keeps more than this share in a branch is not made


# ---------------------------------------------------------------- fingerprints

def simhash(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash.  Words are split at ASCII white space after
    lower-casing A-Z; no words (null, empty, only white space): 0; fewer words
    than a shingle: the whole sequence is the one shingle; repeats count."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))   # one past the space behind each word
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    n = len(words) - shingle + 1
    step = 1 << 16                                       # bounds the memory of very long texts
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        h = np.array([digest(line[s:e - 1], SEED)
                      for s, e in zip(starts[lo:hi], ends[lo + shingle - 1:hi + shingle - 1])],
                     dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3,
                 out: str = "fp", keep_text: bool = False) -> DataFrame:
    """`docs` plus `out`, the SimHash as a signed long; without the text unless asked."""
    keep = [c for c in docs.columns if c != out and (keep_text or c != text)]
    schema = docs.select(*keep).schema.add(out, "long")
    names = [*keep, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((simhash(t.as_py(), shingle) for t in b.column(text)),
                             dtype=np.uint64, count=b.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(fp)], names=names)

    return text_batches(docs).select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


# ---------------------------------------------------------------- tree

def _distance(points: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ v)


def _split(points: np.ndarray, bits: int, rng: np.random.Generator):
    """(vantage point, radius) of the best of a few tries, or None.  Best: the
    fewest comparisons left, which counts both balance and the doubled belt."""
    n, best = len(points), None
    probe = points if n <= 4096 else points[rng.integers(0, n, 4096)]
    for v in probe[rng.integers(0, len(probe), 6)]:
        count = np.cumsum(np.bincount(_distance(probe, v), minlength=65 + bits)) / len(probe)
        inner = count[:65]
        outer = 1 - np.concatenate([np.zeros(bits), count])[:65]   # d > m - bits
        worst = np.maximum(inner, outer)
        cost = np.where(worst <= USELESS, inner**2 + outer**2, np.inf)
        m = int(np.argmin(cost))
        if np.isfinite(cost[m]) and (best is None or cost[m] < best[0]):
            best = (cost[m], v, m)
    return best and best[1:]


def grow(sample: np.ndarray, scale: float, rows: int, bits: int) -> list:
    """Tree as nested lists [vantage, radius, inner, outer]; a leaf is its number.
    `scale`: rows that each sample point stands for; branches end at `rows`."""
    rng, leaves = np.random.default_rng(SEED), iter(range(1 << 62))

    def node(points: np.ndarray):
        if len(points) * scale <= rows or len(points) < PER_SHARD or not (cut := _split(points, bits, rng)):
            return next(leaves)
        v, m = cut
        d = _distance(points, v)
        return [int(v), m, node(points[d <= m]), node(points[d > m - bits])]

    return node(sample)


def route(tree, points: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, indices of the points dealt to it)."""
    stack = [(tree, np.arange(len(points)))]
    while stack:
        node, idx = stack.pop()
        if not len(idx):
            continue
        if isinstance(node, int):
            yield node, idx
            continue
        d = _distance(points[idx], np.uint64(node[0]))
        stack.append((node[2], idx[d <= node[1]]))
        stack.append((node[3], idx[d > node[1] - bits]))


def _leaf_links(points: np.ndarray, bits: int) -> np.ndarray:
    """Index of the smallest linked point for each point, by sweeps of
    min-labels over blocks of exact comparisons."""
    n = len(points)
    label = np.arange(n)
    blocks = [slice(i, min(n, i + LEAF)) for i in range(0, n, LEAF)]
    near = None
    while True:
        before = label.copy()
        for a in blocks:
            for b in blocks:
                if near is None or len(blocks) > 1:
                    hit = np.bitwise_count(points[a, None] ^ points[None, b]) <= bits
                    if len(blocks) == 1:
                        near = hit
                        if hit.sum() == n:
                            return label
                else:
                    hit = near
                label[a] = np.minimum(label[a], np.where(hit, label[b][None], n).min(axis=1))
        label = label[label]
        if (label == before).all():
            return label


def local_links(points: np.ndarray, bits: int) -> np.ndarray:
    """Star links (a, b) of distinct points that join every pair within `bits`."""
    rng, out = np.random.default_rng(SEED), []
    stack = [points]
    while stack:
        p = stack.pop()
        if len(p) < 2:
            continue
        if len(p) > LEAF and (cut := _split(p, bits, rng)):
            d = _distance(p, cut[0])
            stack += [p[d <= cut[1]], p[d > cut[1] - bits]]
            continue
        label = _leaf_links(p, bits)
        linked = np.flatnonzero(label != np.arange(len(p)))
        if len(linked):
            out.append(np.stack([p[linked], p[label[linked]]], axis=1))
    return np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), dtype=np.uint64)


def near_pairs(distinct: DataFrame, bits: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Star links (a, b) between the distinct longs in column `fp`."""
    n = distinct.count()
    sample = min(MAX_SAMPLE, max(SAMPLE, PER_SHARD * n // shard_rows))
    share = max(1, n // sample)
    drawn = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0).limit(2 * sample)
    drawn = drawn.select("fp").toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tree = grow(drawn, n / max(1, len(drawn)), shard_rows, bits)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = f["fp"].to_numpy(np.int64)
            for leaf, idx in route(tree, fp.view(np.uint64), bits):
                yield pd.DataFrame({"shard": leaf, "fp": fp[idx]})

    def link(f: pd.DataFrame) -> pd.DataFrame:
        found = local_links(f["fp"].to_numpy(np.int64).view(np.uint64), bits).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return (distinct.select("fp").mapInPandas(deal, "shard long, fp long")
            .groupBy("shard").applyInPandas(link, "a long, b long"))


# ---------------------------------------------------------------- operator

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    shingle: int = 3, bits: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per input row: (id, fp, component_id).

    component_id is the smallest id reachable over fingerprints that differ in
    `bits` bits or fewer, its own included.  Null and empty texts have the
    fingerprint zero and link like any other; null ids never win and keep a null
    component only where the whole component has no id; repeated rows each give
    a row; an empty table gives no rows; other columns are not read.
    """
    prints = stage(fingerprints(docs.select(id_col, text), text, shingle), "simhash")
    members = groups(prints, bits, id_col, shard_rows)
    return prints.join(members, "fp").select(id_col, "fp", "component_id")


def groups(prints: DataFrame, bits: int = 2, id_col: str = "doc_id", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(fp, label, component_id) per distinct fingerprint of `prints` (id, fp):
    label names the group, component_id is its smallest id."""
    distinct = stage(prints.groupBy("fp").agg(F.min(id_col).alias("rep")), "simhash-distinct")
    links = components(near_pairs(distinct, bits, shard_rows), "simhash-links")
    found = (distinct.join(links.select(F.col("node").alias("fp"), "label"), "fp", "left")
             .select("fp", "rep", F.coalesce("label", "fp").alias("label")))
    grouped = found.groupBy("label").agg(F.min("rep").alias("component_id"))
    return stage(found.join(grouped, "label").select("fp", "label", "component_id"), "simhash-groups")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
             bits: int = 2) -> DataFrame:
    """The rows of `docs`, with their own columns, that stay: of each group the
    row with the smallest id (the smallest fingerprint and text, where rows share
    that id; null ids only where a group has no other)."""
    prints = stage(fingerprints(docs, text, shingle, "__fp", keep_text=True), "simhash-docs")
    ids = prints.select(F.col(id_col).alias("id"), F.col("__fp").alias("fp"))
    chosen = (ids.join(groups(ids, bits, "id"), "fp").where("id <=> component_id")
              .groupBy("label").agg(F.min(F.struct("id", "fp")).alias("first"))
              .select(F.col("first.id").alias("__id"), F.col("first.fp").alias("__kept")))
    rows = prints.join(chosen, (prints["__fp"] == F.col("__kept")) & prints[id_col].eqNullSafe(F.col("__id")))
    one = Window.partitionBy("__kept", "__id").orderBy(text)
    return rows.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*docs.columns)
