"""Conversation structure repair: the cheapest edits that give a legal turn order,
and of those the least audit, by prefix-doubling path ranking.

A conversation is legal if its role initials are an optional `s` and then `ua`
pairs, or nothing.  Four states read it: nothing yet, after s, after u, after a.
Edits and letters: Delete 2, Insert an empty user or assistant 5, Keep 0, Rerole
to user or assistant 1; a truncated message that stays costs 5 more; a blank or
repeated one must go.  A conversation's audit is its letters in order.

Rows are sorted once over the whole table (by ranges, so no conversation meets in
one task), numbered, and cut into segments of at most 4,096 messages.

1. Each segment's 4 x 4 table of costs from state to state.
2. Along each conversation's segments (one small row each, streamed), last first:
   what remains to be paid behind every segment, by state.
3. In each segment: nodes are (message, state).  The cost DP leaves the optimal
   arcs.  Ranks of the nodes by their next 1, 2, 4, ... letters come from the
   ranks and pointers of half that length.  An entry node's path is read through
   the doubled pointers, once for each rank.  Arcs that leave a node have
   different letters (a letter fixes the next state), so the letters before the
   segment's end decide.
4. Along the segments, first first: the state in which each is entered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stage, text_batches

SEGMENT_BITS = 12                     # messages of a segment: 2 ** this at most
CELLS = 1 << 16                       # messages of segments that are solved together
FAR = 1 << 40
BLANKS = " \t\n\x0b\f\r"

# The automaton, the costs, the letters in ASCII order.
NEXT = np.array([2, 2, 3, 2])                                              # state after a rerole or an insert
KEEP = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1] * 4])   # by initial s, u, a, other
DONE = np.array([0, 10, 5, 0])                                             # to pay at the end, by state
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
LEGAL = {(0, 1), (1, 2), (2, 1)}                                           # su, ua, au
PAD = 12

#: By code (initial + 4 * fault, fault 0 none, 1 truncated, 2 must go; 12 no message) and state.
KEEP_TO = np.vstack([np.tile(np.maximum(KEEP, 0), (3, 1)), [0] * 4])
KEEP_COST = np.vstack([np.where(KEEP < 0, FAR, 0), np.where(KEEP < 0, FAR, TRUNCATED), np.full((5, 4), FAR)])
REROLE_COST = np.repeat([REROLE, REROLE + TRUNCATED, FAR, FAR], [4, 4, 4, 1])
DELETE_COST = np.repeat([DELETE, FAR], [12, 1])


def costs(codes: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """(segments, messages + 1, states): the least cost from each node on, if
    `behind` (segments, states) is to be paid after the last message."""
    n, size = codes.shape
    v = np.empty((n, size + 1, 4), np.int64)
    v[:, size] = behind
    for i in range(size - 1, -1, -1):
        code, after = codes[:, i], v[:, i + 1]
        best = np.minimum(after + DELETE_COST[code, None],
                          np.take_along_axis(after, KEEP_TO[code], 1) + KEEP_COST[code])
        np.minimum(best, after[:, NEXT] + REROLE_COST[code, None], out=best)
        for _ in range(2):
            np.minimum(best, best[:, NEXT] + INSERT, out=best)
        v[:, i] = np.where((code == PAD)[:, None], after, np.minimum(best, FAR))
    return v


def tables(codes: np.ndarray) -> np.ndarray:
    """(segments, 16): the cost from entry state q to exit state r at 4 * q + r."""
    n = len(codes)
    ends = np.where(np.eye(4, dtype=bool), 0, FAR)
    v = costs(np.repeat(codes, 4, 0), np.tile(ends, (n, 1)))[:, 0].reshape(n, 4, 4)
    return v.transpose(0, 2, 1).reshape(n, 16)


def paths(codes: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, list[list[bytes]], np.ndarray]:
    """By segment and entry state: the cost, the least audit and the exit state."""
    n, size = codes.shape
    v = costs(codes, behind)
    node = np.arange(n * (size + 1) * 4).reshape(n, size + 1, 4)
    real = (codes != PAD)[:, :, None]
    here, after, state = v[:, :-1], v[:, 1:], np.arange(4)
    keep_to = KEEP_TO[codes]
    ways = [  # letter, cost along this arc, node it leads to
        (1, after + DELETE_COST[codes][:, :, None], node[:, 1:]),
        (2, here[:, :, NEXT] + INSERT, node[:, :-1][:, :, NEXT]),
        (3, np.take_along_axis(after, keep_to, 2) + KEEP_COST[codes], np.take_along_axis(node[:, 1:], keep_to, 2)),
        (4, after[:, :, NEXT] + REROLE_COST[codes][:, :, None], node[:, 1:][:, :, NEXT])]
    letter, to = np.zeros_like(node), node.copy()
    to[:, :-1] = np.where(real, to[:, :-1], node[:, 1:])                    # behind the last message: to the end
    for k, cost, target in reversed(ways):                                 # the least letter last
        on = real & (cost == here)
        letter[:, :-1][on], to[:, :-1][on] = k, np.broadcast_to(target, on.shape)[on]
    letter, to = letter.ravel(), to.ravel()
    rank, length, doubled = letter, (letter > 0).astype(np.int64), [to]
    while (doubled[-1] // 4 % (size + 1) < size).any():                    # 1, 2, 4, ... letters are ranked
        jump = doubled[-1]
        rank = np.unique(rank * (len(rank) + 5) + rank[jump], return_inverse=True)[1]
        length = length + length[jump]
        doubled.append(jump[jump])
    entry = node[:, 0].ravel()
    _, first, which = np.unique(rank[entry], return_index=True, return_inverse=True)
    start = entry[first]
    steps = np.arange(length[start].max(initial=0))
    at = np.repeat(start[:, None], len(steps), 1)
    for k, jump in enumerate(doubled):
        at = np.where(steps >> k & 1, jump[at], at)
    read = LETTERS[letter[at]]
    audits = [read[k, :x].tobytes() for k, x in enumerate(length[start])]
    found = [audits[x] for x in which]
    return v[:, 0], [found[4 * k:4 * k + 4] for k in range(n)], (doubled[-1][entry] % 4).reshape(n, 4)


def solved(rows: list[np.ndarray], make: Callable[[np.ndarray, np.ndarray], list]) -> list:
    """make(codes, positions) over segments of about the same length at a time, in the order of `rows`."""
    out, sizes = [None] * len(rows), np.array([len(r) for r in rows])
    order = np.argsort(sizes, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * sizes[order[hi]] <= CELLS:
            hi += 1
        some = order[lo:hi]
        codes = np.full((len(some), int(sizes[some].max())), PAD)
        for k, x in enumerate(some):
            codes[k, :sizes[x]] = rows[x] & 15
        for x, made in zip(some, make(codes, some)):
            out[x] = made
        lo = hi
    return out


def _mapped(df: DataFrame, schema: str, fn) -> DataFrame:
    """`df`'s rows (lists by column name) through fn, which gives the output's columns."""
    kinds = T.StructType.fromDDL(schema)
    for f in kinds.fields:
        if f.name == "conv_id":
            f.dataType = df.schema["conv_id"].dataType
    names = kinds.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kinds)
        for b in batches:
            if b.num_rows:
                made = fn({c: b.column(c) for c in b.schema.names})
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, arrow.field(n).type)
                                                  for n, x in zip(names, made)], schema=arrow)

    return df.mapInArrow(run, kinds)


def _along(df: DataFrame, columns: list[str], newest: bool, schema: str, start, step) -> DataFrame:
    """Rows of each conversation in order, streamed: step(state, row) gives the
    next state and the output of the row, and start() a conversation's first state."""
    order = F.col("seg").desc() if newest else F.col("seg").asc()
    df = df.select("conv_id", "seg", *columns).repartition("conv_id").sortWithinPartitions("conv_id", order)
    kinds = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, last, state = to_arrow_schema(kinds), (), None
        for b in batches:
            made = []
            for row in zip(*(b.column(c).to_pylist() for c in ["conv_id", "seg", *columns])):
                if (row[0],) != last:
                    last, state = (row[0],), start()
                state, out = step(state, row[2:])
                made.append((row[1], *out))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made), arrow)] if made else
                                             [pa.array([], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kinds)


def _codes(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """The class of a role's initial, whether a text is blank, whether it is truncated."""
    initial, seen = F.substring(role, 1, 1), F.rtrim(text, F.lit(BLANKS))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return kind, seen == "", ~F.substring(seen, -1, 1).isin(".", "!", "?")


def number(df: DataFrame) -> DataFrame:
    """`df` (conv_id, turn, role, text) staged with `g`, which counts up along
    conversation, turn (nulls first) and content hash; g tells rows apart.  Rows
    alike in all three are equal rows and lie in any order.  Also `key` (the hash),
    `kind`, `blank`, `cut` of the text and `repeat` (role and text seen earlier)."""
    kind, blank, cut = _codes(F.col("role"), F.col("text"))
    rows = df.select("conv_id", "turn", "role", "text",
                     F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")).alias("key"), kind.alias("kind"),
                     blank.alias("blank"), cut.alias("cut"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "key", "tie")]
    return stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
                 .withColumn("g", F.monotonically_increasing_id()), "numbered")


def faults(numbered: DataFrame) -> DataFrame:
    """(conv_id, turn, g, kind, fault): each row's first fault among blank,
    duplicate, truncated, else ''."""
    again = (numbered.groupBy("conv_id", "key").agg(F.min("g").alias("first"), F.count("*").alias("n"))
             .where("n > 1").select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first"))
    slim = numbered.select("conv_id", "turn", "key", "g", "kind", "blank", "cut")
    joined = slim.join(again, slim["conv_id"].eqNullSafe(again["c"]) & (slim["key"] == again["k"]), "left")
    fault = (F.when(F.col("blank"), "blank").when(F.col("g") > F.col("first"), "duplicate")
             .when(F.col("cut"), "truncated").otherwise(""))
    return joined.select("conv_id", "turn", "g", "kind", fault.alias("fault"))


def plan(faulty: DataFrame) -> DataFrame:
    """Staged, one row for each segment: conv_id, seg (its first g), rows (16 * g +
    code, in order), state in which it is entered, audit, tail (letters after the
    conversation's last message), cost (in the first segment, else 0), illegal."""
    code = F.col("kind") + F.when(F.col("fault") == "truncated", 4).when(F.col("fault") == "", 0).otherwise(8)
    segments = stage(
        faulty.groupBy("conv_id", F.shiftright("g", SEGMENT_BITS).alias("block"))
        .agg(F.min("g").alias("seg"), F.array_sort(F.collect_list(F.shiftleft("g", 4) + code)).alias("rows"))
        .drop("block"), "segments")

    def tabled(x):
        return x["conv_id"], x["seg"], solved([np.array(r) for r in x["rows"].to_pylist()],
                                              lambda codes, _: tables(codes).tolist())

    def back(behind, row):
        table = np.array(row[0]).reshape(4, 4)
        return np.minimum((table + behind).min(1), FAR), (behind.tolist(),)

    tables_ = _mapped(segments, "conv_id int, seg long, table array<long>", tabled)
    behind = _along(tables_, ["table"], True, "seg long, behind array<long>", lambda: DONE, back)

    def pathed(x):
        rows, ends = [np.array(r) for r in x["rows"].to_pylist()], np.array(x["behind"].to_pylist())
        made = solved(rows, lambda codes, some: list(zip(*paths(codes, ends[some]))))
        kinds = [(r & 15) % 4 for r in rows]
        inner = [sum((a, b) not in LEGAL for a, b in zip(k.tolist(), k[1:].tolist())) for k in kinds]
        return (x["conv_id"], x["seg"], x["rows"], [m[0].tolist() for m in made], [[a.decode() for a in m[1]] for m in made],
                [m[2].tolist() for m in made], inner, [[int(k[0]), int(k[-1])] for k in kinds])

    solved_ = stage(_mapped(segments.join(behind, "seg"),
                            "conv_id int, seg long, rows array<long>, costs array<long>, audits array<string>, "
                            "exits array<int>, inner long, kinds array<int>", pathed), "paths")

    def forth(state, row):
        at, before = state
        cost, exits, inner, (first, last) = row
        illegal = inner + (before is not None and (before, first) not in LEGAL)
        return (exits[at], last), (at, cost[at] if before is None else 0, illegal, exits[at])

    entered = _along(solved_, ["costs", "exits", "inner", "kinds"], False,
                     "seg long, state int, cost long, illegal long, leaves int", lambda: (0, None), forth)
    ends = solved_.groupBy("conv_id").agg(F.max("seg").alias("seg")).select("seg", F.lit(True).alias("ends"))
    tail = F.when(F.col("ends"), F.when(F.col("leaves") == 1, "II").when(F.col("leaves") == 2, "I")).otherwise("")
    return stage(solved_.join(entered, "seg").join(ends, "seg", "left").select(
        "conv_id", "seg", "rows", "state", F.element_at("audits", F.col("state") + 1).alias("audit"),
        F.coalesce(tail, F.lit("")).alias("tail"), "cost", "illegal"), "plan")


def edits(planned: DataFrame) -> DataFrame:
    """One row for each letter of the audits: conv_id, seg and t (together their
    order), edit, g of the message (null for an insert), role (of an insert or a
    rerole, else null)."""
    def spelled(x):
        out = [[], [], [], [], [], []]
        for conv, seg, rows, state, letters in zip(*(x[c].to_pylist() for c in ("conv_id", "seg", "rows", "state", "letters"))):
            i = 0
            for t, letter in enumerate(letters):
                role, g = None, None
                if letter in "IR":
                    state = int(NEXT[state])
                    role = "user" if state == 2 else "assistant"
                elif letter == "K":
                    state = int(KEEP[(rows[i] & 15) % 4][state])
                if letter != "I":
                    g, i = rows[i] >> 4, i + 1
                for column, value in zip(out, (conv, seg, t, letter, g, role)):
                    column.append(value)
        return out

    return _mapped(planned.select("conv_id", "seg", "rows", "state", F.concat("audit", "tail").alias("letters")),
                   "conv_id int, seg long, t int, edit string, g long, role string", spelled)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired messages (conv_id, seg, t, edit, role, text; seg and t give
    their order) and a row for each conversation with any row: gaps, blank,
    duplicate, truncated, illegal, cost (longs) and audit.

    A null role or text counts as one space, a null conv_id is a conversation of
    its own, a null turn comes first.  Rows of one turn follow each other in the
    order of a content hash; equal rows are duplicates of the first.  An empty
    table gives empty results.  Other columns than the four are left out.
    """
    rows = conversations.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
                                                     for c in ("role", "text")))
    numbered = number(rows)
    faulty = stage(faults(numbered), "faults")
    planned = plan(faulty)
    made = edits(planned).where("edit <> 'D'")
    texts = numbered.select("g", F.col("role").alias("own"), "text")
    messages = made.where("g IS NOT NULL").join(texts, "g").select(
        "conv_id", "seg", "t", "edit", F.coalesce("role", "own").alias("role"), "text").unionByName(
        made.where("g IS NULL").select("conv_id", "seg", "t", "edit", "role", F.lit("").alias("text")))
    wide = "decimal(38,0)"
    gaps = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count_distinct("turn")
    counts = faulty.groupBy("conv_id").agg(
        F.coalesce(gaps.try_cast("long"), F.lit(0)).alias("gaps"),
        *(F.count_if(F.col("fault") == c).alias(c) for c in ("blank", "duplicate", "truncated")))
    letters = F.array_sort(F.collect_list(F.struct("seg", F.concat("audit", "tail").alias("audit"))))
    audits = planned.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
                                            F.array_join(letters["audit"], "").alias("audit"))
    return messages, merged([counts, audits])


def merged(parts: list[DataFrame]) -> DataFrame:
    """Tables with at most one row for each conv_id (null is one) side by side."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in out.columns if c != "conv_id"))


def digests(messages: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): hash of the messages as `role:text`, joined by
    newlines.  A conversation's messages are streamed through one hash, since such
    a hash has no parallel form; nothing is held but the hash's state."""
    rows = text_batches(messages.select("conv_id", "seg", "t", F.concat_ws(":", "role", "text").alias("line"))
                        .repartition("conv_id").sortWithinPartitions("conv_id", "seg", "t"))
    schema = rows.select("conv_id").schema.add("repaired_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, last, state = to_arrow_schema(schema), (), None
        for b in batches:
            done = []
            for conv, line in zip(b.column("conv_id").to_pylist(), b.column("line").to_pylist()):
                if (conv,) == last:
                    state.update(b"\n")
                else:
                    if last:
                        done.append((last[0], state.hexdigest()))
                    last, state = (conv,), hashlib.sha256()
                state.update(line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), arrow)], schema=arrow)
        if last:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((last[0], state.hexdigest()), arrow)],
                                             schema=arrow)

    return rows.mapInArrow(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Faults planted by crc32("conv_id:turn") % 20: 0 drops the row, 1 empties its
    text, 2 takes out . ! ?, 3 repeats it, 4 makes its role user.  Nulls in what is
    read (conv_id and turn in the key; role and text) count as one space."""
    def plain(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
