"""Chat formatting by minimum-cost role repair.

A legal conversation is a path of the automaton

    start -> system | user;  system -> user;  user -> assistant;  assistant -> user

that ends in assistant.  Each message either opens a turn of its own role, is
relabelled to another (RELABEL), joins the turn before it (MERGE, plus RELABEL
where the roles differ), or follows empty turns that are inserted to make it
legal (INSERT each; also at the end).  Dynamic programming over the automaton's
states finds the cheapest repair, which is then rendered.

Messages are numbered within their conversation (ranges of the sorted table, each
numbered on its own, plus what the ranges before it hold) and cut into segments
of at most SEGMENT messages, whatever their turn numbers; repeated rows are one
row with a count until a segment is rendered.  A segment's effect is a 4 x 4
table of least costs between states; FAN tables at a time are combined in order,
over as many rounds as it takes, which gives each segment the states it starts
and ends in, and the segments are then traced and rendered on their own.  So a
conversation of any length never meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_batches

ROLES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT = 10, 35, 20
FAR = 1 << 40
SEGMENT = 512          # messages of one segment, at most
HEAVY = 1 << 15        # text bytes from which a message counts as several
HEAD = 256             # characters of a text that order messages before its hash does
FAN = 512              # tables combined at once
OPEN, CLOSE, JOIN = "<|im_start|>", "<|im_end|>\n", "\n\n"


def _insertions() -> dict[int, dict[int, tuple[int, ...]]]:
    """Shortest chains of empty turns: from state -> to state -> the turns."""
    out = {q: {q: ()} for q in range(4)}
    for q, found in out.items():
        queue = [q]
        for a in queue:
            for b in LEGAL[a]:
                if b not in found:
                    found[b] = (*found[a], b)
                    queue.append(b)
    return out


CHAINS = _insertions()


def _moves() -> list[tuple[int, int, str, tuple[int, ...]]]:
    """(from, to, action, inserted turns) of one message, whatever its role."""
    moves = []
    for q in range(4):
        if q != START:
            moves.append((q, q, "merge", ()))
        for via, chain in CHAINS[q].items():
            moves += [(q, to, "turn", chain) for to in LEGAL[via]]
    return moves


MOVES = _moves()


def _price(move, role: int | None) -> int:
    _, to, action, chain = move
    return MERGE * (action == "merge") + RELABEL * (to != role) + INSERT * len(chain)


def role_number(role: str | None) -> int | None:
    """Number of a role name, upper or lower case, spaces around it ignored;
    None for null and unknown names, which must be relabelled."""
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES[1:] else None


def forward(roles: list[int | None], costs: list[int]) -> list[list[tuple[int, int]]]:
    """Per message and state: (least cost, index of the move that reaches it)."""
    steps = []
    for role in roles:
        after = [(FAR, -1)] * 4
        for k, move in enumerate(MOVES):
            c = costs[move[0]] + _price(move, role)
            if c < after[move[1]][0]:
                after[move[1]] = (c, k)
        steps.append(after)
        costs = [c for c, _ in after]
    return steps


def table(roles: list[int | None]) -> list[int]:
    """Least costs from state to state over a segment, row by row."""
    out = []
    for q in range(4):
        costs = [FAR] * 4
        costs[q] = 0
        steps = forward(roles, costs)
        out += [min(c, FAR) for c, _ in steps[-1]] if steps else costs
    return out


def trace(roles: list[int | None], start: int, end: int) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """The cheapest moves of a segment between two states."""
    costs = [FAR] * 4
    costs[start] = 0
    steps, state, path = forward(roles, costs), end, []
    for step in reversed(steps):
        move = MOVES[step[state][1]]
        path.append(move)
        state = move[0]
    return path[::-1]


def chain(tables: list[list[int]]) -> tuple[int, list[tuple[int, int]]]:
    """Total cost and (start, end) state of each segment of one conversation.

    Closing adds the empty turns that lead to assistant, INSERT each."""
    costs, back = [0, FAR, FAR, FAR], []
    for t in tables:
        best = [min((costs[a] + t[4 * a + b], a) for a in range(4)) for b in range(4)]
        back.append([a for _, a in best])
        costs = [min(c, FAR) for c, _ in best]
    total, state = min((costs[q] + INSERT * len(CHAINS[q][ASSISTANT]), q) for q in range(4))
    ends = []
    for step in reversed(back):
        ends.append((step[state], state))
        state = step[state]
    return total, ends[::-1]


def product(tables: list[list[int]]) -> list[int]:
    """Least costs from state to state over segments in order."""
    out = tables[0]
    for t in tables[1:]:
        out = [min(min(out[4 * q + a] + t[4 * a + b] for a in range(4)), FAR) for q in range(4) for b in range(4)]
    return out


def between(tables: list[list[int]], start: int, end: int) -> list[tuple[int, int]]:
    """(start, end) state of each segment on the cheapest way between two states."""
    costs, back = [FAR] * 4, []
    costs[start] = 0
    for t in tables:
        best = [min((costs[a] + t[4 * a + b], a) for a in range(4)) for b in range(4)]
        back.append([a for _, a in best])
        costs = [min(c, FAR) for c, _ in best]
    ends = []
    for step in reversed(back):
        ends.append((step[end], end))
        end = step[end]
    return ends[::-1]


def _safe(text: str | None) -> str:
    """The text with the template's own markers broken, so that none is forged."""
    return (text or "").replace("<|im_", "<| im_")


def render(messages: list[tuple[str | None, str | None]], start: int, end: int,
           last: bool) -> tuple[str, int, int, int, int]:
    """(text, turns, merges, relabels, insertions) of one segment; the turn that
    is open at its end is closed by the next segment, or here if it is the last."""
    roles = [role_number(r) for r, _ in messages]
    out, at, turns, merges, relabels, inserted = [], start, 0, 0, 0, 0

    def begin(state: int) -> None:
        nonlocal at, turns
        if at != START:
            out.append(CLOSE)
        out.append(f"{OPEN}{ROLES[state]}\n")
        at, turns = state, turns + 1

    for (_, text), role, (_, to, action, empty) in zip(messages, roles, trace(roles, start, end)):
        relabels += to != role
        if action == "merge":
            merges += 1
            out.append(JOIN + _safe(text))
            continue
        for e in empty:
            begin(e)
            inserted += 1
        begin(to)
        out.append(_safe(text))
    if last:
        for e in CHAINS[at][ASSISTANT]:
            begin(e)
            inserted += 1
        out.append(CLOSE)
    return "".join(out), turns, merges, relabels, inserted


_LONG, _INT = pa.int64(), pa.int32()
_TYPES = {"conv_id": _LONG, "seg": _LONG, "costs": pa.list_(_LONG), "parts": _LONG, "part": _INT, "first": _INT, "end": _INT,
          "last": pa.bool_(), "cost": _LONG, "n_messages": _INT, "turns": _INT, "merges": _INT, "relabels": _INT,
          "insertions": _INT, "rendered": pa.string()}
_DDL = {_LONG: "long", _INT: "int", pa.bool_(): "boolean", pa.string(): "string", pa.list_(_LONG): "array<long>"}


def _rows(df: DataFrame, columns: str, fn) -> DataFrame:
    """mapInArrow over Python rows; `fn(row)` yields tuples of `columns`."""
    names = columns.split()
    types = [_TYPES[c] for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                made = list(zip(*(out for row in b.slice(lo, 256).to_pylist() for out in fn(row))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made or [()] * len(names), types)],
                                                 names=names)

    return df.mapInArrow(run, ", ".join(f"{c} {_DDL[t]}" for c, t in zip(names, types)))


def numbered(m: DataFrame) -> DataFrame:
    """Distinct rows of `m` (conv_id, turn, role, text) with their `copies`, the
    `weight` of each and the place `at`, in units of weight, where the first of
    them begins in its conversation."""
    rows = m.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("weight", F.greatest(F.lit(1), F.ceil(F.octet_length("text") / HEAVY)).cast("long"))
    # ranges are chosen from a sample of the keys, so whole texts are kept out of them
    keys = [F.substring("text", 1, HEAD).alias("head"), F.xxhash64("text").alias("tie")]
    order = ["conv_id", "turn", "role", "head", "tie"]
    rows = rows.select("*", *keys).repartitionByRange(*order).sortWithinPartitions(*order, "text") \
               .select("conv_id", "role", "text", "copies", "weight", F.spark_partition_id().alias("cell"))
    schema = rows.select("*").schema.add("at", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begin = None, 0
        for b in batches:
            at = []
            for c, n, w in zip(*(b.column(x).to_pylist() for x in ("conv_id", "copies", "weight"))):
                if c != conv:
                    conv, begin = c, 0
                at.append(begin)
                begin += n * w
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, _LONG)], names=schema.names)

    rows = stage(text_batches(rows).mapInArrow(run, schema), "chat-rows")
    before = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    begins = rows.groupBy("conv_id", "cell").agg(F.max(F.expr("at + copies * weight")).alias("units")) \
                 .select(F.col("conv_id").alias("c"), F.col("cell").alias("k"), F.sum("units").over(before).alias("begin"))
    # a range goes on with one conversation at most, so these are fewer than the ranges
    begins = F.broadcast(begins.where("begin > 0"))
    return rows.join(begins, F.expr("conv_id <=> c and cell = k"), "left").select(
        "conv_id", "role", "text", "copies", "weight", (F.col("at") + F.coalesce("begin", F.lit(0))).alias("at"))


def cut(rows: DataFrame, segment: int) -> DataFrame:
    """(conv_id, seg, messages) of numbered rows: a segment's messages begin
    within its `segment` units; equal ones are one entry that counts them (n)."""
    end = F.col("at") + (F.col("copies") - 1) * F.col("weight")
    rows = rows.withColumn("seg", F.explode(F.sequence(F.floor(F.col("at") / segment), F.floor(end / segment))))
    # copies that begin before a unit: 0 for units up to the first
    ahead = lambda unit: F.least(F.col("copies"), F.greatest(
        F.lit(0), F.ceil((unit - F.col("at")) / F.col("weight"))))
    rows = rows.withColumn("n", (ahead((F.col("seg") + 1) * segment) - ahead(F.col("seg") * segment)).cast("int"))
    return rows.where("n > 0").groupBy("conv_id", "seg").agg(
        F.array_sort(F.collect_list(F.struct("at", "role", "text", "n"))).alias("messages"))


def _groups(tables: DataFrame, up) -> DataFrame:
    return tables.groupBy("conv_id", up.alias("seg")).agg(
        F.array_sort(F.collect_list(F.struct("seg", "costs", "parts"))).alias("tables"))


def ways(tables: DataFrame) -> DataFrame:
    """(conv_id, seg, part, first, end, last, cost) of segments from their tables
    (conv_id, seg, costs, parts); `parts` is how many segments a table spans."""

    def combined(row: dict) -> Iterator[tuple]:
        yield (row["conv_id"], row["seg"], product([t["costs"] for t in row["tables"]]),
               sum(t["parts"] for t in row["tables"]))

    def states(row: dict) -> Iterator[tuple]:
        within, part = row["tables"], row.get("part", 0)
        if "first" in row:
            total, last, ends = row["cost"], row["last"], between([t["costs"] for t in within], row["first"], row["end"])
        else:
            (total, ends), last = chain([t["costs"] for t in within]), True
        for i, (t, (a, b)) in enumerate(zip(within, ends)):
            yield row["conv_id"], t["seg"], part, a, b, last and i == len(within) - 1, total
            part += t["parts"]

    columns, up = "conv_id seg part first end last cost", F.floor(F.col("seg") / FAN)
    levels = [stage(tables, "chat-tables")]
    while (levels[-1].agg(F.max("seg").alias("top")).first()["top"] or 0) >= FAN:
        levels.append(stage(_rows(_groups(levels[-1], up), "conv_id seg costs parts", combined), "chat-tables"))
    ends = _rows(_groups(levels.pop(), F.lit(0)), columns, states)
    while levels:
        above = ends.withColumnRenamed("conv_id", "c").withColumnRenamed("seg", "s")
        ends = _rows(_groups(levels.pop(), up).join(above, F.expr("conv_id <=> c and seg = s")).drop("c", "s"),
                     columns, states)
    return ends


def format_chats(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """Repaired, rendered conversations: (conv_id, part, n_messages, cost, turns,
    merges, relabels, insertions, rendered).

    One row per segment; `part` counts from 0 and a conversation's parts joined
    in order are its text (conversations of up to `segment` messages have one
    part; a message counts once for each HEAVY bytes begun).  `cost` is the whole
    conversation's.  Messages are ordered by turn, then role and text (texts that
    agree in HEAD characters by their hash); those without a turn come first.
    Null ids form one conversation; null texts are empty; null and unknown roles
    are relabelled; repeated rows are messages of their own; an empty table gives
    no rows; other columns are not read.
    """
    m = messages.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    segments = stage(cut(numbered(m), segment), "chat")

    def costs(row: dict) -> Iterator[tuple]:
        roles = [role_number(r) for r, n in zip(row["role"], row["n"]) for _ in range(n)]
        yield row["conv_id"], row["seg"], table(roles), 1

    def rendered(row: dict) -> Iterator[tuple]:
        said = [(x["role"], x["text"]) for x in row["messages"] for _ in range(x["n"])]
        out = render(said, row["first"], row["end"], row["last"])
        yield row["conv_id"], row["part"], len(said), row["cost"], *out[1:], out[0]

    tables = _rows(segments.select("conv_id", "seg", F.col("messages.role").alias("role"), F.col("messages.n").alias("n")),
                   "conv_id seg costs parts", costs)
    ends = ways(tables).withColumnRenamed("conv_id", "c").withColumnRenamed("seg", "s")
    joined = segments.join(ends, F.expr("conv_id <=> c and seg = s")).drop("c", "s")
    return _rows(joined, "conv_id part n_messages cost turns merges relabels insertions rendered", rendered)
