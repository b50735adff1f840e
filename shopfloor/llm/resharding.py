"""Resharding by minimum-cost flow.

From the byte sizes of the old shards and the capacities of the new ones a flow
network says how many bytes go from which shard to which at the least cost
(bytes that change shard).  Blocks, the hash buckets of a shard, realise the
flows; where a flow ends within a block, that block is split by a finer hash.
Only files that hold a moved block are rewritten, the others stay where they are.

What reaches the driver is bounded by parameters: the sizes of shards * blocks,
and of the finer buckets of at most one split block per flow.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, stage

BLOCKS, FINE = 256, 256        # blocks of a shard; finer buckets of a split block
FILES = 16                     # files of a shard, each of BLOCKS / FILES blocks
CELL_ROWS = 5000               # rows of one numbering cell, on average


# ---------------------------------------------------------------- flow

def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """{(from, to): amount} that ships every supply at the least total cost.

    `cost(i, j)` is what one unit from i to j costs.  Successive shortest paths
    with potentials; the capacities must hold the whole supply."""
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards cannot hold the old ones")
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    graph: list[list[list]] = [[] for _ in range(n + m + 2)]      # [to, room, cost, index of the reverse arc]

    def arc(a: int, b: int, room: int, price: int) -> None:
        graph[a].append([b, room, price, len(graph[b])])
        graph[b].append([a, 0, -price, len(graph[a]) - 1])

    for i, s in enumerate(supply):
        arc(source, i, s, 0)
        for j in range(m):
            arc(i, n + j, s, cost(i, j))
    for j, c in enumerate(capacity):
        arc(n + j, sink, c, 0)
    potential = [0] * len(graph)                                  # costs are not negative at first
    left = sum(supply)
    while left:
        best, came = {source: 0}, {}
        heap, done = [(0, source)], set()
        while heap:
            d, a = heapq.heappop(heap)
            if a in done:
                continue
            done.add(a)
            for k, (b, room, price, _) in enumerate(graph[a]):
                reach = d + price + potential[a] - potential[b]
                if room and reach < best.get(b, 1 << 62):
                    best[b], came[b] = reach, (a, k)
                    heapq.heappush(heap, (reach, b))
        for v in range(len(graph)):
            potential[v] += best.get(v, max(best.values()))
        path, v = [], sink
        while v != source:
            a, k = came[v]
            path.append(graph[a][k])
            v = a
        amount = min([left, *(e[1] for e in path)])
        for e in path:
            e[1] -= amount
            graph[e[0]][e[3]][1] += amount
        left -= amount
    return {(i, b - n): graph[b][r][1] for i in range(n) for b, _, _, r in graph[i]
            if n <= b < n + m and graph[b][r][1]}


def even(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


# ---------------------------------------------------------------- plan

@dataclass
class Plan:
    """Where blocks go: whole ones by (shard, block), split ones by bucket too."""
    flows: dict[tuple[int, int], int]
    blocks: dict[tuple[int, int], int] = field(default_factory=dict)
    buckets: dict[tuple[int, int, int], int] = field(default_factory=dict)

    @property
    def touched(self) -> set[tuple[int, int]]:
        return set(self.blocks) | {k[:2] for k in self.buckets}


def _fill(need: dict[int, int], items: list[tuple[int, object]]) -> tuple[dict, list]:
    """Give items (size, name) to targets without exceeding any need: the item
    goes to the target with the most room.  Returns (name -> target, rest)."""
    given, rest = {}, []
    for size, name in items:
        j = max(need, key=lambda t: (need[t], -t), default=None)
        if j is not None and 0 < size <= need[j]:
            given[name] = j
            need[j] -= size
        else:
            rest.append((size, name))
    return given, rest


def plan(rows: DataFrame, old_shards: int, capacities: list[int] | None = None, shards: int = 24,
         size: str = "size") -> Plan:
    """Transfers for `rows` (old_shard, block, bucket, size) to new shards; even
    capacities where none are given."""
    held = {(r.old_shard, r.block): r.bytes for r in
            rows.groupBy("old_shard", "block").agg(F.sum(size).alias("bytes")).collect()}
    supply = [0] * old_shards
    for (s, _), b in held.items():
        supply[s] += b
    out = Plan(min_cost_flow(supply, capacities or even(sum(supply), shards), lambda i, j: int(i != j)))
    need = {i: {j: f for (a, j), f in out.flows.items() if a == i and j != i} for i in range(old_shards)}
    split = []
    for i in range(old_shards):
        # whole blocks in file order, so that few files are touched
        blocks = sorted((k, b) for k, b in held.items() if k[0] == i)
        given, rest = _fill(need[i], [(b, k) for k, b in blocks] if need[i] else [])
        out.blocks.update(given)
        rest = sorted(rest)
        for j in sorted(need[i]):
            # the smallest block left that holds the rest of this flow
            k = next((x for x, (b, _) in enumerate(rest) if b >= need[i][j]), None)
            if need[i][j] and k is not None:
                split.append((rest.pop(k)[1], j, need[i][j]))
    if split:
        of = rows.sparkSession.createDataFrame([(*k,) for k, _, _ in split], "old_shard int, block int")
        fine: dict[tuple[int, int], list] = {}
        for r in (rows.join(F.broadcast(of), ["old_shard", "block"]).groupBy("old_shard", "block", "bucket")
                  .agg(F.sum(size).alias("bytes")).collect()):
            fine.setdefault((r.old_shard, r.block), []).append((r.bytes, r.bucket))
        for k, j, amount in split:
            given, rest = _fill({j: amount}, sorted(fine[k], reverse=True))
            left = amount - sum(b for b, x in fine[k] if x in given)
            if rest and abs(rest[-1][0] - left) < left:              # one more brings it nearer
                given[rest[-1][1]] = j
            out.buckets.update({(*k, x): j for x in given})
    return out


def _bucket(parts: int, seed: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(parts)).cast("int")


def lay_out(docs: DataFrame, old_shards: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with size, text_crc32 and a place (old_shard, block, bucket, file) that
    follows from id, text and `tie`, the row's number in the scan: equal rows spread
    over all places too, so no block of them is heavier than a flow can split."""
    d = docs.withColumn("size", (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")) \
            .withColumn("text_crc32", F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long")) \
            .withColumn("tie", F.monotonically_increasing_id())
    d = d.withColumn("old_shard", _bucket(old_shards, 1, id_col, "text_crc32", "tie")) \
         .withColumn("block", _bucket(BLOCKS, 2, id_col, "text_crc32", "tie")) \
         .withColumn("bucket", _bucket(FINE, 3, id_col, "text_crc32", "tie"))
    return d.withColumn("file", F.floor(F.col("block") / (BLOCKS // FILES)).cast("int"))


def write_old(laid: DataFrame, path: str) -> DataFrame:
    """The existing dataset, read back: one folder per old shard and file, whose
    rows meet in few tasks; AQE splits those too large for one."""
    laid.hint("rebalance", "old_shard", "file").write.partitionBy("old_shard", "file").parquet(path)
    return laid.sparkSession.read.schema(laid.schema).parquet(path)


def rewrite(old: DataFrame, moves: Plan) -> DataFrame:
    """Rewrite the files of the dataset `old` that hold a moved block, and read
    the new dataset: rewritten files and untouched ones, with `shard`.

    Files are chosen by partition, so untouched ones are not opened for it."""
    spark = old.sparkSession
    touched = sorted({(s, b // (BLOCKS // FILES)) for s, b in moves.touched})
    if not touched:
        return old.withColumn("shard", F.col("old_shard"))
    # folder names: a bounded list (shards * files) that prunes partitions at planning
    here = F.concat_ws("/", F.col("old_shard").cast("string"), F.col("file").cast("string")) \
            .isin([f"{s}/{f}" for s, f in touched])
    block = spark.createDataFrame([(*k, j) for k, j in moves.blocks.items()] or [(-1, -1, -1)],
                                  "old_shard int, block int, whole int")
    bucket = spark.createDataFrame([(*k, j) for k, j in moves.buckets.items()] or [(-1, -1, -1, -1)],
                                   "old_shard int, block int, bucket int, part int")
    # both tables are bounded by shards * BLOCKS and flows * FINE rows
    moved = (old.where(here).join(F.broadcast(block), ["old_shard", "block"], "left")
             .join(F.broadcast(bucket), ["old_shard", "block", "bucket"], "left")
             .withColumn("shard", F.coalesce("whole", "part", "old_shard")).drop("whole", "part"))
    new = fresh_path(spark, "reshard-new")
    moved.write.partitionBy("shard").parquet(new)
    written = spark.read.schema(moved.schema).parquet(new)
    return written.unionByName(old.where(~here).withColumn("shard", F.col("old_shard")))


def number(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`rows` (id, text_crc32, size, shard, tie) with `slot`, gapless from 0 within
    each shard.  Shards are numbered in cells of bounded size: a cell's rows
    are ranked, and the cells' counts give where each begins."""
    shards = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    n = rows.count()
    rows = rows.withColumn("cell", _bucket(max(1, n // (24 * CELL_ROWS)), 4, id_col, "text_crc32", "tie"))
    begins = rows.groupBy("shard", "cell").agg(F.count("*").alias("n")) \
                 .select("shard", "cell", F.coalesce(F.sum("n").over(shards), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("shard", "cell").orderBy(F.col(id_col).asc_nulls_first(), "text_crc32", "size", "tie")
    slot = (F.col("begin") + F.col("rank") - 1).cast("long").alias("slot")
    return (rows.withColumn("rank", F.row_number().over(inside)).join(begins, ["shard", "cell"])
            .select(*[c for c in rows.columns if c not in ("cell", "tie")], slot))


def reshard(docs: DataFrame, old_shards: int = 20, shards: int = 24, id_col: str = "doc_id",
            text: str = "text") -> DataFrame:
    """(id, size, text_crc32, old_shard, shard, slot) of every row of `docs`
    after it was written in `old_shards` shards and resharded to `shards` of
    near equal bytes.

    Size: UTF-8 bytes plus 8; null texts have none, and checksum 0.  Null ids
    are placed like any other value.  Repeated rows are spread like different ones,
    and which of them a shard has is a matter of their order in the scan; an empty
    table gives no rows; columns that clash with the working ones are not read.
    """
    spark = docs.sparkSession
    old = write_old(lay_out(docs.select(id_col, text), old_shards, id_col, text), fresh_path(spark, "reshard-old"))
    moves = plan(old, old_shards, shards=shards)
    rows = rewrite(old, moves).select(id_col, "size", "text_crc32", "old_shard", "shard", "tie")
    return number(stage(rows, "reshard-rows"), id_col)
