import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from llm_helpers import SF0001

from shopfloor.llm import queries, turn_repair

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}
DDL = "conv_id long, turn long, role string, text string"


def brute(rows, insert=5):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired messages: a
    cheapest-first search whose queue is ordered by cost and audit."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0,
                                       hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        shown = text.strip(" \t\n\x0b\f\r")
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen
                      else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        legal = [x for x in "ua" if x in NEXT[state]]
        for x in legal:
            heapq.heappush(queue, (cost + insert, audit + "I", i, x, out + ((NAMES[x], ""),)))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, state, out))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                if role and role[0] in NEXT[state]:
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, role[0], out + ((role, text),)))
                for x in legal:
                    heapq.heappush(queue, (cost + extra + 1, audit + "R", i + 1, x, out + ((NAMES[x], text),)))
    turns, initials = [t for t, _, _ in rows if t is not None], [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
            faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, list(out))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def by_conversation(rows):
    found = {}
    for conv, *rest in rows:
        found.setdefault(conv, []).append(tuple(rest))
    return found


def repaired(df):
    messages, audits = turn_repair.repair(df)
    said = {}
    for r in sorted(messages.collect(), key=lambda r: (r.seg, r.t)):
        said.setdefault(r.conv_id, []).append((r.role, r.text))
    return {r.conv_id: (*(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")),
                        said.get(r.conv_id, [])) for r in audits.collect()}


def test_query_against_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    want = {c: (0, 0, 0, 0, 0, 0, "", []) for c in by_conversation(rows)}
    want |= {c: brute(x) for c, x in by_conversation(damaged(rows)).items()}
    got = {r[0]: tuple(r)[1:] for r in queries.op13_turn_repair(spark, SF0001).collect()}
    assert got == {c: (*w[:7], hashlib.sha256("\n".join(f"{r}:{t}" for r, t in w[7]).encode()).hexdigest())
                   for c, w in want.items()}


def odd_rows():
    rng = random.Random(5)
    rows = [(None if conv == 0 else conv, rng.choice([None, 0, 1, 2, 3, 4, 9]),
             rng.choice([None, "user", "user", "assistant", "assistant", "system", "tool", "", "u\n"]),
             rng.choice([None, "", "\t ", "ok.", "Cut", "Yes!", "?", "long " * 3_000 + ".", f"{rng.random()}."]))
            for conv in range(12) for _ in range(rng.randint(1, 9))]
    rows += rows[:9]                                                                          # repeated rows
    return rows + [(99, 2**62, "user", "a."), (99, -2**62, "assistant", "b.")]                # a gap beyond a long


@pytest.mark.parametrize("bits", [12, 1, 0])
def test_odd_rows_in_segments_of_any_size(spark, frame, monkeypatch, bits):
    monkeypatch.setattr(turn_repair, "SEGMENT_BITS", bits)
    rows = odd_rows()
    df = frame([(*r, 1, "x") for r in rows], DDL + ", cost int, seg string")
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = {c: brute(x) for c, x in by_conversation(plain).items()}
    want[99] = (0, *want[99][1:]) if want[99][0] > 2**63 - 1 else want[99]
    assert repaired(df) == want


def test_hot_conversation_over_many_segments(spark, frame, monkeypatch):
    monkeypatch.setattr(turn_repair, "SEGMENT_BITS", 3)
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["", "cut", "same.", f"{t}."])) for t in range(400)]
    assert repaired(frame(rows, DDL, 6))[7] == brute([r[1:] for r in rows])


def test_damage(spark, frame):
    rows = [(c, t, "system" if t == 0 else None if t == 1 else "assistant", None if t == 2 else f"{c}. {t}! x?")
            for c in [*range(12), None] for t in [*range(6), None]]
    got = sorted(map(tuple, turn_repair.damage(frame(rows, DDL)).collect()), key=str)
    assert got == sorted(damaged(rows), key=str)


def test_empty_table_and_nothing_left(spark, frame):
    messages, audits = turn_repair.repair(frame([], DDL))
    assert messages.count() == 0 and audits.count() == 0
    assert repaired(frame([(1, 0, "user", ""), (1, 1, "user", " ")], DDL)) == {1: (0, 2, 0, 0, 1, 4, "DD", [])}


def test_inserts_where_they_are_cheap(monkeypatch):
    """With the stated costs no cheapest repair inserts; with cheaper ones they are placed right."""
    monkeypatch.setattr(turn_repair, "INSERT", 1)
    rng = random.Random(2)
    for _ in range(200):
        kinds = [rng.choice("suax") for _ in range(rng.randint(1, 7))]
        rows = [(k, x + "_", f"{k}.") for k, x in enumerate(kinds)]
        codes = np.array([["suax".index(k) for k in kinds]])
        cost, audits, exits = turn_repair.paths(codes, np.array([[0, 2, 1, 0]]))
        want = brute(rows, insert=1)
        tail = {1: "II", 2: "I"}.get(int(exits[0, 0]), "")
        assert (cost[0, 0], audits[0][0].decode() + tail) == (want[5], want[6])
