"""Alignment of two tokenizers over the same texts, and corpus-wide token pairs.

Tokenizer A is a byte-level BPE vocabulary that reads a space and the text,
tokenizer B a piece model that adds the space itself.  Both give the same bytes,
so each token has an end offset; offsets where both end cut the text into groups.

Diagonal run skipping: in a one-to-one stretch token i of A ends with token
i + shift of B.  From such a pair, slices of both end arrays at that shift are
compared while their width doubles; the slice that differs is halved down to the
first difference.  The whole stretch is jumped over.  An irregular group is then
resolved by stepping whichever side ends first, which sets the shift anew.

Counting pairs over the corpus: occurrences are counted with map-side partial
sums.  The counts are looked up again per occurrence: pairs with at least a
2^-20 share of all occurrences (so at most 2^20 pairs, whatever the corpus) are
broadcast, the others are joined by a shuffle, where none is a hot key.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .common import stage, text_batches

HEAVY = 1 << 20           # pairs that are broadcast, at most
TEXT_BYTES = 1 << 15      # of units that are encoded as one text
BATCH_CHARS = 1 << 20     # of texts that are aligned at once (one text at least)
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices in `ends_a` and in `ends_b` of the tokens that end together.  Both
    arrays of ends increase strictly and have the same last value."""
    a, b, runs, i, j, n = ends_a.tolist(), ends_b.tolist(), [], 0, 0, len(ends_a)
    raw_a, raw_b = ends_a.astype("<u8").tobytes(), ends_b.astype("<u8").tobytes()    # slices compare fast
    while i < n:
        x, y = a[i], b[j]
        while x != y:                                      # an irregular group: step the side that ends first
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        at, there, width = 8 * i + 8, 8 * j + 8, 8         # a[i] and b[j] end together: probe at this shift
        while (probe := raw_a[at:at + width]) == raw_b[there:there + width] and probe:
            at += len(probe)
            there += len(probe)
            width *= 2
        while width > 8:                                   # the first difference lies in the slice of this width
            width //= 2
            if (probe := raw_a[at:at + width]) == raw_b[there:there + width]:
                at += len(probe)
                there += len(probe)
        runs.append((i, j, at // 8 - i))
        i, j = at // 8, there // 8
    first_a, first_b, sizes = np.array(runs, np.int64).reshape(-1, 3).T
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(first_a, sizes) + within, np.repeat(first_b, sizes) + within


def offsets(sizes) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def slices(bounds: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Positions in the slices bounds[k]:bounds[k + 1] of all k in `which`, in that order."""
    sizes = np.diff(bounds)[which]
    return np.arange(sizes.sum()) + np.repeat(bounds[which] - (np.cumsum(sizes) - sizes), sizes)


class TokenizerPair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, vocabulary: str, model: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        spec = bpe.vocabulary(vocabulary)
        special = set(spec.special.values())
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
            s: i for i, s in enumerate(spec.strings) if s and i not in special})
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.strings = spec.strings, [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(p))
                                      else p.replace("▁", " ").encode() for p in pieces]
        self.sizes = [np.array([len(x) for x in side], np.int64) for side in self.strings]
        #: the characters of each id and of what follows it (the next token of its side,
        #: the other side, the next group), filled up with zeros
        words = [f"{i}{mark}" for i in range(max(map(len, self.strings))) for mark in ",|;"]
        width = max(map(len, words))
        self.words = np.array(words, f"S{width}").view(np.uint8).reshape(-1, width)
        self.word_sizes = np.array([len(w) for w in words], np.int64)

    def ids(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a text that starts with a space; None if the bytes of a side differ from it."""
        both, data = (self.a.encode_ordinary(text), self.b.encode(text[1:], num_threads=1)), text.encode()
        if any(b"".join([known[x] for x in side]) != data for known, side in zip(self.strings, both)):
            return None
        return both

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Which texts have tokens, their ids by A and by B one after the other,
        and where each text's ids begin.  Texts may not be empty.

        Each different unit of the texts is encoded once, thousands of them as one
        text: no token crosses the places where units are cut (see below)."""
        spaced = [b" " + t.encode() for t in texts]
        data, starts = b"".join(spaced), offsets([len(t) for t in spaced])[:-1]
        raw = np.frombuffer(data, np.uint8)
        # A space between visible ASCII and no white space: A's word pattern holds a
        # space only in front, no piece of B holds one behind another character.
        cut = np.flatnonzero((raw[1:-1] == 32) & (raw[:-2] > 32) & (raw[:-2] < 127) & (raw[2:] > 32)) + 1
        bounds = np.union1d(cut, starts)
        # What ends a text otherwise is read alone: its white space would meet the next unit.
        last = np.append(bounds, len(raw))[1:] - 1
        alone = (raw[last] <= 32) | (raw[last] >= 127)
        coded = pa.Array.from_buffers(pa.binary(), len(bounds), [None, pa.py_buffer(np.append(bounds, len(raw)).astype(np.int32)),
                                                                 pa.py_buffer(data)]).dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int64)
        units = coded.dictionary.cast(pa.string()).to_pylist()
        apart = np.zeros(len(units), bool)
        apart[which[alone]] = True
        ids, counts, bad = ([], []), (np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)), np.zeros(len(units), bool)
        order = np.concatenate((np.flatnonzero(~apart), np.flatnonzero(apart)))
        sizes = pc.binary_length(coded.dictionary).to_numpy().astype(np.int64)[order]
        steps = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // TEXT_BYTES)) + 1).tolist()]
        steps = sorted({x for x in steps if x < (~apart).sum()} | set(range(int((~apart).sum()), len(units)))) + [len(units)]
        for lo, hi in zip(steps, steps[1:]):
            found = self.ids("".join([units[k] for k in order[lo:hi].tolist()]))
            if found is not None:
                for side in (0, 1):
                    ids[side].append(np.array(found[side], np.int64))
                    ends = np.searchsorted(np.cumsum(self.sizes[side][ids[side][-1]]), np.cumsum(sizes[lo:hi])) + 1
                    counts[side][order[lo:hi]] = np.diff(ends, prepend=0)
                continue
            for k in order[lo:hi]:                         # some unit here has other bytes
                found = self.ids(units[k])
                bad[k] = found is None
                for side in (0, 1):
                    ids[side].append(np.array(found[side] if found else [], np.int64))
                    counts[side][k] = len(ids[side][-1])
        first = np.searchsorted(bounds, starts)
        good = ~np.logical_or.reduceat(bad[which], first)
        wanted = np.repeat(good, np.diff(np.append(first, len(which))))
        place = np.empty(len(units), np.int64)
        place[order] = np.arange(len(units))
        out, begins = [], []
        for side in (0, 1):
            at = offsets(counts[side][order])
            out.append(np.concatenate(ids[side])[slices(at, place[which[wanted]])])
            begins.append(offsets(np.add.reduceat(counts[side][which], first)[good]))
        return good, out, begins

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, bytes, np.ndarray]:
        """Which texts have tokens and, of those: where their ids begin on each
        side; the linked ids of each group (its last tokens) as a << 32 | b and
        where each text's begin; all groups as characters and where each text's
        begin.  The arrays of ends of all texts are walked as one, since texts end
        together on both sides."""
        good, (a, b), begins = self.encode(texts)
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        last_a, last_b = common_ends(ends_a, ends_b)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        # A's tokens follow all groups before theirs, B's also the A tokens of theirs
        spoken = np.empty(len(a) + len(b), np.int64)
        spoken[np.arange(len(a)) + np.append(0, last_b + 1)[np.cumsum(mark_a) - mark_a]] = 3 * a + mark_a
        spoken[np.arange(len(b)) + (last_a + 1)[(np.cumsum(mark_b) - mark_b) // 2]] = 3 * b + mark_b
        chars = self.words[spoken].ravel()
        size_at = offsets(self.word_sizes[spoken])[begins[0] + begins[1]]
        return (good, begins, a[last_a] << 32 | b[last_b], np.searchsorted(last_a, begins[0]), chars[chars != 0].tobytes(), size_at)


@functools.lru_cache(maxsize=2)
def tokenizers(vocabulary: str, model: str) -> TokenizerPair:
    return TokenizerPair(vocabulary, model)


OUT = {"n_a": "long", "n_b": "long", "n_groups": "long", "groups_sha256": "string", "links": T.ArrayType(T.LongType())}


def align(df: DataFrame, vocabulary: str, model: str, text: str = "text", keep: list[str] | None = None,
          groups: str | None = None) -> DataFrame:
    """`df`'s columns `keep` (default: all but `text`) with the counts n_a, n_b,
    n_groups, groups_sha256 (of the group string; '' without tokens) and `links`
    (array of a << 32 | b, one for each group: only its last tokens end together,
    as no token is empty).  `groups` names a column for the group string itself.

    Null and empty texts, and texts whose bytes one of the tokenizers changes,
    have no tokens: zeros, an empty array.  Each row gives one row, repeated ones
    too; an empty table stays empty; columns named like an output are replaced.
    """
    out = OUT | ({groups: "string"} if groups else {})
    keep = [c for c in (df.columns if keep is None else keep) if c not in out and (keep is not None or c != text)]
    schema = df.select(*keep).schema
    for name, kind in out.items():
        schema = schema.add(name, kind)

    def of(pair: TokenizerPair, part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(text).to_pylist()
        n, has = len(texts), [k for k, t in enumerate(texts) if t]
        counts, digests, strings, lists = np.zeros((3, n), np.int64), [""] * n, [""] * n, [np.zeros(0, np.int64)] * n
        if has:
            good, begins, linked, at, chars, size_at = pair.align([texts[k] for k in has])
            for x, k in enumerate(k for k, ok in zip(has, good) if ok):
                string = chars[size_at[x]:size_at[x + 1] - 1]
                lists[k] = linked[at[x]:at[x + 1]]
                counts[:, k] = begins[0][x + 1] - begins[0][x], begins[1][x + 1] - begins[1][x], len(lists[k])
                digests[k], strings[k] = hashlib.sha256(string).hexdigest(), string.decode() if groups else ""
        made = [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(pa.array(offsets([len(x) for x in lists]), pa.int32()),
                                         pa.array(np.concatenate(lists), pa.int64()))]
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made, *([pa.array(strings, pa.string())] if groups else [])],
                                          names=[*keep, *out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(vocabulary, model)
        for batch in batches:
            sizes = np.cumsum([len(x.as_py() or "") for x in batch.column(text)])
            cuts = [0, *(np.flatnonzero(np.diff(sizes // BATCH_CHARS)) + 1).tolist(), batch.num_rows]   # bounds what is held at once
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    yield of(pair, batch.slice(lo, hi - lo))

    return text_batches(df).select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(link, n, best) of every linked id pair: how many links hold it, and
    whether no other pair of its B id is held by more."""
    counts = stage(aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n")),
                   "pair-counts")
    b = F.col("link").bitwiseAND((1 << 32) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return stage(counts.withColumn("b", b).join(most, "b").select("link", "n", (F.col("n") == F.col("most")).alias("best")),
                 "pairs")


def rate_links(aligned: DataFrame, mark: str) -> DataFrame:
    """(mark, n_best, count_sum) of each row that has links.  `mark` tells the
    rows apart.  n_best: links whose pair is a most frequent one of its B id;
    count_sum: the sum of their pairs' counts."""
    pairs = pair_counts(aligned)
    total = F.broadcast(pairs.agg(F.sum("n").alias("total")))               # one row
    shares = pairs.crossJoin(total).withColumn("heavy", F.col("n") * HEAVY >= F.col("total")).drop("total")
    heavy = F.broadcast(shares.where("heavy").drop("heavy"))                # at most HEAVY rows: each has that share
    light = shares.where("NOT heavy").drop("heavy")
    found = aligned.select(mark, F.explode("links").alias("link")).join(heavy, "link", "left")
    sums = [F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("n").alias("count_sum")]
    near = found.where(F.col("n").isNotNull()).groupBy(mark).agg(*sums)
    rest = found.where(F.col("n").isNull()).select(mark, "link").join(light, "link").groupBy(mark).agg(*sums)
    return near.unionByName(rest).groupBy(mark).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
