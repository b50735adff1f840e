"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; everything else the model sees is
unlabelled web text (labels of quality 0 are never read).  With the class prior p it
minimises the non-negative unbiased risk

    p * R_pos(+)  +  max(0, R_unl(-) - p * R_pos(-))

by mini-batches; where the second part falls below zero, the step climbs out of
it instead, so that a flexible model cannot push the risk below what is possible.

The prior is estimated from the same two samples.  A network that tells positives
from unlabelled text ranks both; above any threshold, the share of the unlabelled
rows is at least p times that of the positives, and about p times where next to no
negative lies.  The least ratio, with an allowance for the sample sizes, is taken on
rows that the network was not fitted on, less its relative error 1 / sqrt(positives):
a prior too high makes "all positive" the cheapest answer, one too low does little.

All rows are the unlabelled sample, of the prior and of the risk.  The driver only starts
both on a few: Spark counts the rows in at most CELLS cells (the sides of fixed random
planes), and some rows of each cell (the same number, DRAWN in all, CELL_ROWS at most),
drawn by a hash, share the weight of all its rows; the mean of a cell stands in where none
was drawn (copies share a hash).  The networks that the mini-batches over these give then
take PASSES steps along the slope of the risk over every row, each one pass in Spark, of
which the one with the least risk stays; the shares above the thresholds of the prior are
counts of all rows too.  Sums are of whole numbers, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import docstats
from .common import stage, text_batches

POSITIVES = 12_000                          # bound of the sample of labelled rows
PLANES = 14
CELLS, CELL_ROWS = 1 << PLANES, 32          # of unlabelled rows: cells, and rows that speak for a cell at most
DRAWN = 24_000                              # rows drawn in all, about (2 for each cell at least)
THRESHOLD = 0.3
HIDDEN, STEPS, BATCH, RATE, DECAY, SEED = 24, 2_800, 512, 0.01, 1e-4, 11
PRIOR_STEPS, CONFIDENCE = 800, 0.1          # of the estimate of the prior
PASSES, PASS_RATE = 30, 0.004               # steps over all rows, and their first rate (it falls to 0)
UNIT = 1 << 24                              # sums of a pass are of whole numbers of 1 / UNIT
FIXED, MOST = 1 << 20, 1e4                  # statistics are summed in units of 1 / FIXED, and up to MOST each
CLIP = 4.0                                  # standardised features are kept within this


@dataclass
class Network:
    """One tanh layer over standardised features; `score` is P(quality 1)."""
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def prepare(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -CLIP, CLIP)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh(self.prepare(x) @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def pu_risk(za: np.ndarray, zb: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk at the outputs of positives and of unlabelled rows, and
    the slope to step along in each output (see the module)."""
    pa_, pb = 1 / (1 + np.exp(-np.clip(za, -30, 30))), 1 / (1 + np.exp(-np.clip(zb, -30, 30)))
    # logistic loss of calling a row negative: log(1 + e^z); its slope in z is p
    minus = np.logaddexp(0, zb).mean() - prior * np.logaddexp(0, za).mean()
    slope_neg = np.concatenate([-prior * pa_ / len(za), pb / len(zb)])
    slope_pos = np.concatenate([prior * (pa_ - 1) / len(za), np.zeros(len(zb))])
    risk = prior * np.logaddexp(0, -za).mean() + max(0.0, minus)
    return risk, slope_pos + slope_neg if minus >= 0 else -slope_neg


def telling_apart(za: np.ndarray, zb: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """Logistic risk of telling positives from unlabelled rows, and its slope."""
    pa_, pb = 1 / (1 + np.exp(-np.clip(za, -30, 30))), 1 / (1 + np.exp(-np.clip(zb, -30, 30)))
    return (np.logaddexp(0, -za).mean() + np.logaddexp(0, zb).mean(),
            np.concatenate([(pa_ - 1) / len(za), pb / len(zb)]))


def softplus_sums(net: Network, x: np.ndarray, sign: int = 1) -> np.ndarray:
    """The sum of log(1 + e^(sign z)) over rows (statistics), z being the network's
    output, and its slope in w1, b1, w2 and b2, in one flat array."""
    x = net.prepare(x)
    hidden = np.tanh(x @ net.w1 + net.b1)
    z = hidden @ net.w2 + net.b2
    slope = sign / (1 + np.exp(-np.clip(sign * z, -30, 30)))
    back = np.outer(slope, net.w2) * (1 - hidden**2)
    return np.concatenate([[np.logaddexp(0, sign * z).sum()], (x.T @ back).ravel(), back.sum(axis=0),
                           hidden.T @ slope, [slope.sum()]])


def sums_of_all(rows: DataFrame, nets: list[Network], sides: list[int | None]) -> list[tuple[int, np.ndarray]]:
    """(rows, `softplus_sums`) of each network over all `rows` (`features` and `side`) of
    its side, or of both: one pass for all networks, whatever the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = [0] * len(nets), [0] * len(nets)
        for x, side in _features(batches):
            for k, net in enumerate(nets):
                own = x if sides[k] is None else x[side == sides[k]]
                n[k] += len(own)
                sums[k] += np.rint(softplus_sums(net, own) * UNIT).astype(np.int64)
        made = [(k, n[k], sums[k]) for k in range(len(nets)) if n[k]]
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int32()), pa.array([m[1] for m in made], pa.int64()),
                                          pa.array([m[2] for m in made], pa.list_(pa.int64()))], names=["net", "n", "sums"])

    found = rows.mapInArrow(run, "net int, n long, sums array<long>").collect()              # a row for each task and network
    return [(sum(r.n for r in found if r.net == k),
             np.sum([np.array(r.sums, np.int64) for r in found if r.net == k], axis=0, dtype=np.int64) / UNIT)
            for k in range(len(nets))]


def descend(nets: list[Network], positives: list[np.ndarray], rows: DataFrame, sides: list[int | None],
            prior: float | None = None) -> list[Network]:
    """The networks of the least risk over all `rows` of their side on PASSES steps from
    `nets`: the non-negative risk, or without `prior` that of telling the two apart."""
    best = [(np.inf, net) for net in nets]
    flat = [np.concatenate([net.w1.ravel(), net.b1, net.w2, [net.b2]]) for net in nets]
    first, second = [np.zeros_like(t) for t in flat], [np.zeros_like(t) for t in flat]
    for step in range(1, PASSES + 2):
        for k, (n, sums) in enumerate(sums_of_all(rows, nets, sides)):
            if not n or not len(positives[k]):
                continue
            net, width, below = nets[k], nets[k].w1.size, sums / n
            plus, minus = (softplus_sums(net, positives[k], sign) / len(positives[k]) for sign in (-1, 1))
            if prior is None:
                risk, slope = plus[0] + below[0], plus + below
            else:
                rest = below - prior * minus
                risk, slope = prior * plus[0] + max(0.0, rest[0]), prior * plus + rest if rest[0] >= 0 else -rest
            if risk < best[k][0]:
                best[k] = risk, net
            decay = flat[k] * DECAY
            decay[width:width + HIDDEN] = decay[-1] = 0                  # b1, b2
            first[k] = 0.9 * first[k] + 0.1 * (slope[1:] + decay)
            second[k] = 0.999 * second[k] + 0.001 * (slope[1:] + decay)**2
            flat[k] = flat[k] - PASS_RATE * (1 - (step - 1) / PASSES) * (first[k] / (1 - 0.9**step)) / (
                np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            t = flat[k]
            nets = [*nets[:k], Network(net.mean, net.scale, t[:width].reshape(net.w1.shape), t[width:width + HIDDEN],
                                       t[width + HIDDEN:-1], float(t[-1])), *nets[k + 1:]]
    return [net for _, net in best]


def counts_above(rows: DataFrame, nets: list[Network], sides: list[int], at: list[np.ndarray]) -> list[tuple[int, np.ndarray]]:
    """For each network, the number of all `rows` of its side, and of those whose score
    reaches each of the rising thresholds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = [np.zeros(len(a) + 1, np.int64) for a in at]
        for x, side in _features(batches):
            for k, net in enumerate(nets):
                reached = np.searchsorted(at[k], net.score(x[side == sides[k]]), "right")
                bins[k] += np.bincount(reached, minlength=len(at[k]) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(nets)), pa.int32()), pa.array(bins, pa.list_(pa.int64()))],
                                         names=["net", "bins"])

    found = rows.mapInArrow(run, "net int, bins array<long>").collect()
    out = []
    for k in range(len(nets)):
        bins = np.sum([np.array(r.bins, np.int64) for r in found if r.net == k], axis=0)
        out.append((int(bins.sum()), bins[::-1].cumsum()[::-1][1:]))
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(statistics, up to MOST each, and sides) of each batch."""
    for b in batches:
        if b.num_rows:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            yield np.clip(x, -MOST, MOST), b.column("side").to_numpy(zero_copy_only=False)


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, weights: np.ndarray | None = None,
          steps: int = STEPS, risk=pu_risk) -> Network:
    """Fit on positives and on unlabelled rows or cells (`weights`: their row counts);
    without rows of either kind the score is the prior."""
    width = max(positive.shape[1], unlabelled.shape[1])
    rng = np.random.default_rng(SEED)
    flat = Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1),
                   float(np.log(prior / (1 - prior))))
    if not len(positive) or not len(unlabelled):
        return flat
    share = np.full(len(unlabelled), 1 / len(unlabelled)) if weights is None else weights / weights.sum()
    mean = share @ unlabelled
    scale = np.sqrt(share @ (unlabelled - mean) ** 2)
    net = Network(mean, np.where(scale > 1e-9, scale, 1.0),
                  rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), flat.b2)
    pos, unl, reach = net.prepare(positive), net.prepare(unlabelled), np.cumsum(share)
    theta = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        a = pos[rng.integers(0, len(pos), min(BATCH, len(pos)))]
        b = unl[np.minimum(np.searchsorted(reach, rng.random(BATCH)), len(unl) - 1)]
        x = np.concatenate([a, b])
        hidden = np.tanh(x @ theta[0] + theta[1])
        z = hidden @ theta[2] + theta[3][0]
        _, slope = risk(z[:len(a)], z[len(a):], prior)
        back = np.outer(slope, theta[2]) * (1 - hidden**2)
        grads = [x.T @ back + DECAY * theta[0], back.sum(axis=0),
                 hidden.T @ slope + DECAY * theta[2], np.array([slope.sum()])]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            theta[i] = theta[i] - RATE * (first[i] / (1 - 0.9**step)) / (
                np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = theta[0], theta[1], theta[2], float(theta[3][0])
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, weights: np.ndarray | None = None,
                   side: np.ndarray | None = None, rows: DataFrame | None = None) -> float:
    """The share of positives among the unlabelled rows, from both samples alone;
    0.5 where either has next to no rows.  `rows` (`features` and `side`): all rows,
    which the networks are fitted on and whose shares count, each half apart; then
    `side` has the halves of `unlabelled`, where the networks start."""
    if len(positive) < 4 or len(unlabelled) < 4:
        return 0.5
    weights = np.ones(len(unlabelled)) if weights is None else weights
    halves = np.random.default_rng(SEED)
    side_p, side_u = halves.permutation(len(positive)) % 2, halves.permutation(len(unlabelled)) % 2
    if side is not None:
        side_u = side
    positives = [positive[side_p != fold] for fold in (0, 1)]
    nets = [train(positives[fold], unlabelled[side_u != fold], 0.5, weights[side_u != fold], PRIOR_STEPS, telling_apart)
            for fold in (0, 1)]
    if rows is not None:
        nets = descend(nets, positives, rows, [1, 0])
    scores = [nets[fold].score(positive[side_p == fold]) for fold in (0, 1)]
    at = [np.unique(np.quantile(sp, np.linspace(0, 1, 201)[:-1])) for sp in scores]
    counted = [None, None] if rows is None else counts_above(rows, nets, [0, 1], at)
    ratios = []
    for fold, sp in enumerate(scores):
        w = weights[side_u == fold]
        share_p = 1 - np.searchsorted(np.sort(sp), at[fold], "left") / len(sp)
        if counted[fold]:
            share_u = counted[fold][1] / counted[fold][0]
        else:
            su = nets[fold].score(unlabelled[side_u == fold])
            order = np.argsort(su)
            above = np.append(np.cumsum(w[order][::-1])[::-1], 0.0)
            share_u = above[np.searchsorted(su[order], at[fold], "left")] / w.sum()
        allowance = np.sqrt(np.log(4 / CONFIDENCE) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt((w.sum() ** 2) / (w**2).sum()))
        best = np.argmin((share_u + allowance) / share_p)
        ratios.append(share_u[best] / share_p[best] * (1 - 1 / np.sqrt(len(sp))))
    held = [counted[k][0] if counted[k] else weights[side_u == k].sum() for k in (0, 1)]
    return float(np.clip(np.average(ratios, weights=held), 0.01, 0.99))


def _over_batches(rows: DataFrame, schema: str, fn, *columns: str) -> DataFrame:
    """What fn makes of each batch's features (rows x statistics, up to MOST each) and columns."""
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                made = fn(np.clip(x, -MOST, MOST), *(b.column(c).to_numpy(zero_copy_only=False) for c in columns))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=names)

    return rows.mapInArrow(run, schema)


def unlabelled(rows: DataFrame, id_col: str = "doc_id") -> tuple[np.ndarray, np.ndarray]:
    """(statistics, weights) that stand for all `rows` (id and `features`) where the fit
    starts; the weights add up to the number of rows."""
    return drawn_rows(rows, id_col)[:2]


def drawn_rows(rows: DataFrame, id_col: str = "doc_id") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`unlabelled`, and the hash of each row (of its cell, for a mean).  Three passes over
    the features: moments, counts of the cells, the draw."""
    width, wide = len(docstats.FEATURES), "decimal(38,0)"
    rows = rows.select("features", F.xxhash64(id_col, "features").alias("draw"))

    def moments(x):
        whole = np.rint(x * FIXED).astype(np.int64)
        coarse = np.rint(x * 1024).astype(np.int64)                   # squares of these stay within a long
        return np.arange(width, dtype=np.int32), np.full(width, len(x), np.int64), whole.sum(0), (coarse**2).sum(0)

    sums = {r.at: r for r in _over_batches(rows.select("features"), "at int, n long, s long, q long", moments).groupBy("at").agg(
        *(F.sum(F.col(c).cast(wide)).alias(c) for c in ("n", "s", "q"))).collect()}
    if not sums:
        return np.empty((0, width)), np.empty(0), np.empty(0, np.int64)
    n = float(sums[0].n)
    mean = np.array([float(sums[k].s) / FIXED / n for k in range(width)])
    scale = np.sqrt(np.maximum(np.array([float(sums[k].q) / 1024**2 / n for k in range(width)]) - mean**2, 0))
    scale = np.where(scale > 1e-6, scale, 1.0)
    planes = np.random.default_rng(SEED).normal(size=(width, PLANES))

    def cell_of(x):
        return (np.clip((x - mean) / scale, -CLIP, CLIP) @ planes > 0) @ (1 << np.arange(PLANES))

    def counted(x):
        cell, where, n = np.unique(cell_of(x), return_inverse=True, return_counts=True)
        whole = np.zeros((len(cell), width), np.int64)
        np.add.at(whole, where, np.rint(x * FIXED).astype(np.int64))
        return (cell.astype(np.int32), n.astype(np.int64), *whole.T)

    named = [f"s{k}" for k in range(width)]
    found = _over_batches(rows.select("features"), ", ".join(["cell int", "n long", *(f"{c} long" for c in named)]), counted)
    found = sorted(found.groupBy("cell").agg(*(F.sum(F.col(c).cast(wide)).alias(c) for c in ["n", *named])).collect(),
                   key=lambda r: r.cell)                                      # CELLS rows at most
    held = np.zeros(CELLS)
    held[[r.cell for r in found]] = [float(r.n) for r in found]
    each = max(2, min(CELL_ROWS, DRAWN // len(found)))
    means = {r.cell: [float(r[c]) / FIXED / float(r.n) for c in named] for r in found}

    def drawn(x, draw):
        cell = cell_of(x)
        luck = (draw.astype(np.uint64) >> np.uint64(11)).astype(float) / (1 << 53)
        on = np.flatnonzero(luck * held[cell] < each)
        _, first, copies = np.unique(draw[on], return_index=True, return_counts=True)    # copies leave as one
        on = on[first]
        return cell[on].astype(np.int32), draw[on], copies.astype(np.int64), pa.array(list(x[on]), pa.list_(pa.float64()))

    drawn_ = _over_batches(rows, "cell int, draw long, n long, x array<double>", drawn, "draw")
    picked = drawn_.groupBy("cell", "draw").agg(F.sum("n").alias("n"), F.min("x").alias("x")).collect()    # about DRAWN
    picked = sorted(picked, key=lambda r: (r.cell, r.draw))
    kept = np.zeros(CELLS)
    np.add.at(kept, [r.cell for r in picked], [r.n for r in picked])
    alone = [k for k in sorted(means) if not kept[k]]
    x = np.array([r.x for r in picked] + [means[k] for k in alone]).reshape(-1, width)
    n = np.array([r.n * held[r.cell] / kept[r.cell] for r in picked] + [held[k] for k in alone])
    spread = np.random.default_rng(SEED).integers(-1 << 63, 1 << 63, CELLS, np.int64)
    return x, n, np.array([r.draw for r in picked] + [spread[k] for k in alone], np.int64)


def fit(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Network:
    """The network of `rows` (id and `features`).  Positives: at most about POSITIVES
    rows labelled 1 that are not held out.  Unlabelled: all rows, whatever their labels,
    in every step of `descend`; the drawn ones only start it."""
    sample = docstats.labelled_sample(rows, labels, "quality", POSITIVES, id_col, lambda rows: rows)
    x, y = docstats.collect_sample(sample, POSITIVES, id_col)
    positive = x[y == 1] if len(y) else np.empty((0, len(docstats.FEATURES)))
    web, n, draw = drawn_rows(rows, id_col)
    cut = int(np.median(draw)) if len(draw) else 0
    every = rows.select("features", (F.xxhash64(id_col, "features") >= F.lit(cut)).cast("int").alias("side"))
    prior = estimate_prior(positive, web, n, (draw >= cut).astype(int), every)
    net = train(positive, web, prior, n)
    return descend([net], [positive], every, [None], prior)[0] if len(positive) and len(web) else net


def score_features(net: Network, x: np.ndarray) -> np.ndarray:
    return net.score(x) if len(x) else np.empty(0)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, score (0 to 1), predicted (score >= 0.3).

    Null and empty texts are scored from all-zero statistics; repeated rows each
    give a row; an empty table gives none; without positives the score is the
    prior; ties in the threshold count as 1; other columns are not read.
    """
    stats = stage(docstats.with_stats(docs, text, base=(), id_col=id_col,
                                      stats=_features_only), "pu-stats")
    net = fit(stats, labels, id_col)
    schema = stats.select(id_col).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            s = score_features(net, x)
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=schema.names)

    return stats.select(id_col, "features").mapInArrow(run, schema)


def _features_only(text):
    return (), docstats.document_stats(text)[1]


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` predicted 1 (score at or above the threshold, which null and
    empty texts reach or miss like any other), with their own columns, whatever their
    names; repeated rows share their fate; an empty table gives none."""
    stats = stage(docstats.with_stats(docs.select(id_col, text), text, base=(), id_col=id_col, stats=_features_only), "pu-keep")
    net = fit(stats, labels, id_col)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([docstats.document_stats(t.as_py())[1] for t in b.column(at)]).reshape(b.num_rows, -1)
            yield b.filter(pa.array(score_features(net, x) >= THRESHOLD))

    return text_batches(docs).mapInArrow(run, docs.schema)
