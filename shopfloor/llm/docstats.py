"""Statistics of whole texts, shared by the quality operators."""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import text_batches

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# Frequent function words of the corpus' languages.
FUNCTION_WORDS = frozenset("""
the of and to in a is that it for was on with as be by this are or an at not from
der die das und in zu den mit von ist im für auf dem nicht ein eine als auch es
le la les de des et en un une du est que pour dans qui sur par au plus pas
el los las del y que en un una es por con para se su al lo como más
""".encode().split())

UPPER = string.ascii_uppercase.encode()
DIGITS = string.digits.encode()
PUNCTUATION = string.punctuation.encode()
SENTENCE_END = re.compile(rb"[.!?](?=[ \t\r\n]|$)")

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "mean_word", "symbol_rate", "repeat_share", "dup_line_share", "distinct_share",
            "top_word_share", "upper_rate", "digit_rate", "punct_rate", "exclaim_rate", "bar_share",
            "sentence_rate", "log_line_words", "function_share", "single_share", "high_byte_rate",
            "log_longest_word", "log_longest_repeat")


def repeat_words(words: Sequence[bytes], distinct: Sequence[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    number = dict(zip(distinct, range(len(distinct))))
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=n)
    k = len(distinct)
    key = ids[:-2] * k + ids[1:-1]
    if k > 2_000_000:                                  # keeps the combined key within 63 bits
        key = np.unique(key, return_inverse=True)[1]
    _, inverse, counts = np.unique(key * k + ids[2:], return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    mark = np.zeros(n, dtype=bool)
    for shift in range(3):
        mark[shift:n - 2 + shift] |= hit
    return int(mark.sum())


def _without(data: bytes, drop: bytes) -> int:
    return len(data) - len(data.translate(None, drop))


def document_stats(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """(BASE counts, FEATURES) of a text; null counts as empty: all zero."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return (0, 0, _count_symbols(data), 0, 0), [0.0] * len(FEATURES)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeat_words(words, list(counts))
    n_symbols = _count_symbols(data)
    word_bytes = len(data) - _without(data, SPACES)
    word_chars = len(text) - (len(data) - word_bytes)
    top_word, top = counts.most_common(1)[0]
    features = [
        math.log1p(n), word_chars / n, n_symbols / word_chars, n_repeat / n, n_dup / len(lines),
        len(counts) / n, top / n, _without(data, UPPER) / word_chars, _without(data, DIGITS) / word_chars,
        _without(data, PUNCTUATION) / word_chars, data.count(b"!") / word_chars, counts.get(b"|", 0) / n,
        len(SENTENCE_END.findall(data)) / n, math.log1p(n / len(lines)),
        sum(c for w, c in counts.items() if w in FUNCTION_WORDS) / n,
        sum(c for w, c in counts.items() if len(w) == 1) / n, (word_bytes - word_chars) / word_chars,
        math.log1p(max(map(len, counts))), math.log1p(top if len(top_word) > 3 else 0)]
    return (n, word_chars, n_symbols, n_dup, n_repeat), features


def _count_symbols(data: bytes) -> int:
    return _without(data, SYMBOLS)


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def with_stats(docs: DataFrame, text: str = "text", out: str = "features",
               stats: Callable = document_stats, base: Sequence[str] = BASE,
               id_col: str | None = None) -> DataFrame:
    """`docs` with the `base` counts (long) and `out` (array of double); the text
    goes along only where `id_col` is None.  Same-named columns are replaced."""
    made = {*base, out}
    keep = [c for c in ([id_col] if id_col else docs.columns) if c not in made]
    schema = docs.select(*keep).schema
    for c in base:
        schema = schema.add(c, "long")
    schema = schema.add(out, ArrayType(DoubleType()))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [stats(t.as_py()) for t in b.column(text)]
            counts = list(zip(*(r[0] for r in rows))) if rows else [()] * len(base)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([r[1] for r in rows], pa.list_(pa.float64()))], names=names)

    return text_batches(docs).select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


# ---------------------------------------------------------------- labelled rows

def held_out(id_col: str = "doc_id"):
    """Rows that no model may learn labels from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def label_sample(labels: DataFrame, label: str, limit: int, id_col: str = "doc_id") -> DataFrame:
    """(id, label) of the rows that may be learned from, not held out, about
    `limit` at most: beyond that a share by hash of the id.  Ids labelled more
    than once take the larger label; null labels and ids are left out."""
    known = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(id_col).agg(F.max(label).cast("int").alias("label")))
    n = known.count()
    if n > limit:
        known = known.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(1_000_000)) < int(1e6 * limit / n))
    return known


def labelled_sample(rows: DataFrame, labels: DataFrame, label: str, limit: int, id_col: str = "doc_id",
                    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """`features` and `label` of a `label_sample`, one row per id.  `prepare`
    makes the features of the sampled rows, where `rows` has none yet."""
    known = label_sample(labels, label, limit, id_col)
    return prepare(rows.join(F.broadcast(known.select(id_col)), id_col, "left_semi")).select(id_col, "features") \
        .join(F.broadcast(known), id_col).groupBy(id_col).agg(
            F.min("features").alias("features"), F.first("label").alias("label"))


def collect_sample(sample: DataFrame, limit: int, id_col: str = "doc_id") -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of a bounded sample, in id order."""
    rows = sample.orderBy(F.xxhash64(id_col), id_col).limit(2 * limit).collect()
    x = np.array([r.features for r in rows], dtype=float) if rows else np.empty((0, 0))
    return x, np.array([r.label for r in rows], dtype=int)
