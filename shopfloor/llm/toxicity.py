"""Toxicity: gradient-boosted trees over dense features of whole texts (lexicon
densities, second-person proximity, capitals, punctuation, obfuscation rates),
calibrated by isotonic regression.

Two lexicons give densities: a stated list of insults, and words learned from
labelled rows because toxic documents hold them far more often.  The learned
words come from one half of the labelled rows, trees and calibration from the
other, so the trees see how reliable the learned words are on rows that did not
choose them.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import docstats, gbt
from .common import stage

SAMPLE = 20_000          # labelled rows that are learned from (bound; a hash share of the ids beyond it)
CALIBRATION = 4          # every fourth learned row calibrates instead of growing trees
THRESHOLD = 0.5
LEARNED = 2_000          # learned words that are kept, the most telling first
MIN_TOXIC, MIN_RATIO = 3, 8.0    # toxic documents that hold a learned word; how much oftener than others do
NEAR = 6                 # words between an insult and a second-person word that count as near

# Insults and slurs on character, by strength and language.
STRONG = frozenset("""
idiot idiots idiotic moron morons moronic imbecile scum scumbag scumbags worthless disgusting pathetic trash
bastard bastards bitch bitches asshole assholes dickhead fuck fucker fuckers fucking motherfucker shit shitty bullshit
cunt whore slut retard retarded filth filthy vermin parasite subhuman degenerate despicable
arschloch abschaum schwachkopf vollidiot idioten hurensohn missgeburt scheisse scheiße wichser dreckskerl widerlich erbärmlich wertlos
connard connasse salaud ordure abruti crétin imbécile débile pourriture enculé putain merde minable dégueulasse
idiota imbécil estúpido estúpida basura escoria gilipollas cabrón mierda puta asqueroso asquerosa despreciable patético patética
""".split())
MILD = frozenset("""
stupid dumb loser losers clown clowns fool fools foolish jerk jerks creep creeps freak freaks liar liars coward cowards
ugly useless hate hated disgrace garbage rubbish nonsense ridiculous hopeless lazy ignorant lunatic psycho weirdo
dumm dummkopf blöd blödmann trottel versager lügner feigling clownerie nutzlos hässlich
stupide nul bouffon clowns perdant menteur lâche ridicule inutile idiote
tonto tonta perdedor perdedora payaso payasa mentiroso cobarde inútil ridículo
""".split())
SECOND_PERSON = frozenset("you your yours yourself youre you're u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti tuyo usted ustedes".split())
# Characters that stand in for letters.
LEET = str.maketrans("013457@$!|", "oieastasil")

INSIDE = re.compile(r"(?<=\w)[*._\-~^'’·]+(?=\w)")
RUNS = re.compile(r"(\w)\1{2,}")
MIXED = re.compile(r"[^\W\d_][0-9@$!*|]+[^\W\d_]")
EDGE = ".,;:!?\"'()[]{}<>#%&*$|~^+-_=/\\“”„«»…’¡¿"
STOPS = ".,;:?\"'()[]<>#%&"      # edge characters that never stand for a letter

LEARNED_HIT, MILD_HIT, STRONG_HIT = 1, 2, 3
FEATURES = ("strong_rate", "mild_rate", "learned_rate", "log_hits", "log_learned", "distinct_hits", "hidden_rate",
            "near_rate", "second_rate", "upper_rate", "shout_share", "exclaim_rate", "question_rate", "punct_rate",
            "mixed_share", "run_share", "log_words")


def plain(word: str) -> str:
    """A word with stand-in characters, inner separators and letter runs undone."""
    return RUNS.sub(r"\1", INSIDE.sub("", word.translate(LEET)))


@functools.lru_cache(maxsize=4)
def levels(learned: frozenset[str]) -> dict[str, int]:
    return dict.fromkeys(learned, LEARNED_HIT) | dict.fromkeys(MILD, MILD_HIT) | dict.fromkeys(STRONG, STRONG_HIT)


def toxicity_stats(text: str | None, learned: frozenset[str] = frozenset()) -> tuple[tuple[()], list[float]]:
    """FEATURES of a text; null, empty and white space: all zero."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return (), [0.0] * len(FEATURES)
    level = levels(learned)
    any_runs = RUNS.search(text) is not None
    found = [0, 0, 0, 0]
    hidden = distinct = second = shout = mixed = runs = 0
    hits, persons = set(), set()
    for raw, c in Counter(words).items():
        w = raw.strip(EDGE).lower()
        kind = level.get(w, 0)
        if w in SECOND_PERSON:
            persons.add(raw)
            second += c
        if raw.isupper() and len(w) > 1:
            shout += c
        if not kind and (any_runs or not w.isalpha() or "$" in raw or "!" in raw or "|" in raw):
            if MIXED.search(raw):
                mixed += c
            if any_runs and RUNS.search(w):
                runs += c
            # an edge character may stand for a letter: $tupid
            kind = level.get(plain(w), 0) or level.get(plain(raw.strip(STOPS).lower()), 0)
            hidden += c * (kind > 0)
        if kind:
            hits.add(raw)
            distinct += 1
            found[kind] += c
    near = 0
    if hits and persons:
        last_hit = last_person = -NEAR - 1
        for i, w in enumerate(words):
            if w in hits:
                last_hit = i
                near += i - last_person <= NEAR
            elif w in persons:
                last_person = i
                near += i - last_hit <= NEAR
    data = text.encode()
    size = len(data)
    rate = lambda chars: (size - len(data.translate(None, chars))) / size
    return (), [found[STRONG_HIT] / n, found[MILD_HIT] / n, found[LEARNED_HIT] / n,
                math.log1p(found[STRONG_HIT] + found[MILD_HIT]), math.log1p(found[LEARNED_HIT]), float(distinct),
                hidden / n, near / n, second / n, rate(docstats.UPPER), shout / n, data.count(b"!") / size,
                data.count(b"?") / size, rate(docstats.PUNCTUATION), mixed / n, runs / n, math.log1p(n)]


# ---------------------------------------------------------------- learned words

def _lexicon_half(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.lit(2)) == 0


def learn_words(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
                text: str = "text") -> frozenset[str]:
    """Words that toxic documents of the lexicon half hold at least MIN_RATIO
    times as often as others.  The labelled ids are a bounded sample, so they
    are broadcast and the texts are not shuffled."""
    known = docstats.label_sample(labels, "toxic", sample, id_col).where(_lexicon_half(id_col))
    known = stage(known, "toxicity-labels")
    sizes = known.agg(F.sum("label").alias("toxic"), F.count("*").alias("all")).first()
    toxic, clean = sizes["toxic"] or 0, (sizes["all"] or 0) - (sizes["toxic"] or 0)
    if not toxic or not clean:
        return frozenset()
    bare = lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    own = F.array_distinct(F.transform(F.split(F.lower(text), r"\s+"), bare))      # each word once a document
    words = (docs.select(id_col, text).join(F.broadcast(known), id_col)
             .select("label", F.explode(own).alias("word")).where(F.length("word") > 2))
    ratio = (F.col("t") / toxic) / ((F.col("c") + 0.5) / clean)
    top = (words.groupBy("word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
           .where((F.col("t") >= MIN_TOXIC) & (ratio >= MIN_RATIO))
           .orderBy((ratio * F.col("t")).desc(), "word").limit(LEARNED).select("word"))
    return frozenset(r.word for r in top.collect()) - STRONG - MILD


# ---------------------------------------------------------------- calibration

@dataclass
class Isotonic:
    """Monotone map from raw score to probability, linear between the blocks."""
    x: np.ndarray
    y: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.x, self.y) if len(self.x) else raw


def isotonic(raw: np.ndarray, label: np.ndarray) -> Isotonic:
    """Pool adjacent violators.  Each block is laid at its mean raw score, with
    (ones + 1/2) / (rows + 1) so that no block claims certainty."""
    if not len(raw):
        return Isotonic(np.empty(0), np.empty(0))
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []                # sum of raw, ones, rows
    for r, y in zip(raw[order], label[order]):
        blocks.append([r, y, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    y = np.maximum.accumulate((b[:, 1] + 0.5) / (b[:, 2] + 1))
    return Isotonic(b[:, 0] / b[:, 2], y)


@dataclass
class Model:
    forest: gbt.Forest
    calibrate: Isotonic

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrate(self.forest.score(x)) if len(x) else np.empty(0)


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id") -> Model:
    """Trees on three quarters of the half that chose no words, calibration on the rest of it."""
    rows = docstats.labelled_sample(stats, labels, "toxic", sample, id_col).where(~_lexicon_half(id_col))
    x, y = docstats.collect_sample(rows, sample, id_col)
    held = np.arange(len(y)) % CALIBRATION == 0
    forest = gbt.train(x[~held], y[~held], pseudo=(0.5, 1.0))      # knowing nothing, not toxic
    return Model(forest, isotonic(forest.score(x[held]) if held.any() else np.empty(0), y[held]))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, score (0 to 1), predicted (score >= 0.5).

    Null and empty texts are scored from all-zero features; repeated rows each
    give a row; an empty table gives none; without labels of both kinds the
    score is the smoothed base rate (1/3 where nothing is labelled); other columns are not read.
    """
    learned = learn_words(docs, labels, id_col=id_col, text=text)
    stats = stage(docstats.with_stats(docs, text, base=(), id_col=id_col,
                                      stats=functools.partial(toxicity_stats, learned=learned)), "toxicity")
    model = fit(stats, labels, id_col=id_col)
    schema = stats.select(id_col).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            s = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=schema.names)

    return stats.select(id_col, "features").mapInArrow(run, schema)
