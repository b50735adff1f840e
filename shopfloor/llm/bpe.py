"""Byte-level BPE encoding and decoding with a public vocabulary file.

Encoding splits a text at special tokens and by the vocabulary's word pattern,
then merges the bytes of each word: a heap holds the merge ranks of adjacent
symbols, the symbols form a doubly linked list, and heap entries whose symbols
have changed since are skipped.  Words repeat, so each task keeps a bounded
word -> ids table.  Decoding concatenates the vocabulary's strings.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import text_batches


# The word pattern of the byte-level vocabulary (letters first,
# which no other branch can start with, and possessive runs: same words, faster).
WORDS = r" ?\p{L}++|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
CACHE_WORDS = 150_000     # bound of each of the two word tables; the older is dropped when the newer is full
CACHE_CHARS = 32          # longer words are not kept


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file:
    visible Latin-1 stands for itself, the rest for U+0100 onwards in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class ByteBPE:
    """One vocabulary; ids are kept as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        chars = byte_chars()
        of_char = {c: b for b, c in enumerate(chars)}
        self.first = [vocab[c] for c in chars]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.strings[i] = bytes(of_char[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.merges = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.find = regex.compile(WORDS).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one word."""
        ids = [self.first[b] for b in data]
        n, merges = len(ids), self.merges
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            m = merges.get((ids[i], ids[i + 1]))
            if m:
                heap.append((m[0], i, m[1], ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, new, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue                                   # stale: a neighbour was merged away
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = merges.get((new, ids[k]))
                if m:
                    heapq.heappush(heap, (m[0], i, m[1], new, ids[k]))
            h = before[i]
            if h >= 0:
                m = merges.get((ids[h], new))
                if m:
                    heapq.heappush(heap, (m[0], h, m[1], ids[h], new))
        return [x for x in ids if x >= 0]

    def word(self, w: str) -> bytes:
        out = self.known.get(w) or self.older.get(w) or np.array(self.merge(w.encode()), dtype="<u4").tobytes()
        if len(w) <= CACHE_CHARS:
            if len(self.known) >= CACHE_WORDS:
                self.older, self.known = self.known, {}
            self.known[w] = out
        return out

    def plain(self, text: str) -> bytes:
        known, word = self.known, self.word
        return b"".join([known.get(w) or word(w) for w in self.find(text)])

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; null: none.
        The string of a special token becomes that token."""
        if not text:
            return b""
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        return b"".join(np.array([self.special[p]], dtype="<u4").tobytes() if p in self.special else self.plain(p)
                        for p in self.cut.split(text))

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings of the ids, special tokens included.  Ids outside
        the vocabulary give nothing; bytes that are no UTF-8 become U+FFFD."""
        strings = self.strings
        numbers = np.frombuffer(ids, dtype="<u4")
        if len(numbers) and numbers.max() >= len(strings):
            numbers = numbers[numbers < len(strings)]
        return b"".join([strings[i] for i in numbers.tolist()]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> ByteBPE:
    return ByteBPE(path)


def _mapped(df: DataFrame, source: str, out: dict[str, str], path: str, fn) -> DataFrame:
    """`df` with new columns from `fn(vocabulary, value)`; same-named ones are replaced."""
    keep = [c for c in df.columns if c not in out]
    schema = df.select(*keep).schema
    for name, kind in out.items():
        schema = schema.add(name, kind)
    types = [pa.int64() if k == "long" else pa.binary() if k == "binary" else pa.string() for k in out.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            for lo in range(0, b.num_rows, 256):           # bounds what one output batch holds
                part = b.slice(lo, 256)
                made = list(zip(*(fn(bpe, x.as_py()) for x in part.column(source))))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), *(pa.array(m, t) for m, t in zip(made, types))],
                    names=[*keep, *out])

    return text_batches(df).select(*dict.fromkeys([*keep, source])).mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids",
           count: str = "n_tokens") -> DataFrame:
    """`df` with `ids` (binary: little-endian unsigned 32-bit integers) and `count`.

    Null and empty texts have no ids (empty binary, 0).  Every row gives one
    row, repeated ones too; an empty table stays empty; columns already named
    `ids` or `count` are replaced, all others are carried along.  `path` must be
    readable where the tasks run (the vocabulary is installed there).
    """
    def one(bpe: ByteBPE, value):
        out = bpe.encode(value)
        return out, len(out) // 4

    return _mapped(df, text, {ids: "binary", count: "long"}, path, one)


def decode(df: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """`df` with `out`, the text that the ids stand for; null ids: the empty text."""
    return _mapped(df, ids, {out: "string"}, path, lambda bpe, value: (bpe.decode(value or b""),))
