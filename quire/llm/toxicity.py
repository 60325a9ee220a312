"""Toxicity: boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of lexicon words at three strengths and their strongest weight,
hits near second-person words, shares of capitals, of exclaiming or asking words and of obfuscated
spellings (digits or signs amid letters, read as the letters they stand for), and its length. The
lexicon is a short fixed list plus words and word beginnings learned from labelled texts by their
smoothed log-odds.

The model is fitted on the driver on a bounded sample: about ``SAMPLE`` labelled ids, those whose
hash is in the share that gives so many, among those that may be learned from and whose text is no
longer than ``LONGEST`` characters. Lexicon and trees are cross-fitted on two halves, so
the trees see features of texts that the lexicon did not, and the calibration sees scores of texts
that the trees did not. Scoring is one pass over all texts without a shuffle.

Defined cases: null and empty texts have all features 0 and get the model's score for that; an id
labelled more than once is toxic if one of its labels is; an id with several texts is learned from
its least one, and each of its rows is scored by its own text; a null id is never held out nor
learned from; without any usable label every score is 0; very long texts are scored whole; an empty
table gives an empty result. Other columns pass through ``score``, whose new column must not exist.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import trees
from .arrow import arrow_map, slices
from .common import below_share

SAMPLE = 8000
LONGEST = 1 << 18
REJECT = 0.7
NEAR = 5
PREFIXES = (4, 5, 6, 7, 8)
LEVELS = (1.5, 2.5, 3.5)
#: Tokens whose codes a worker keeps, and the longest that is kept: about 40 MB at most.
MEMO = 250_000
MEMO_CHARS = 64

# Insults and second-person words to start from.
INSULTS = frozenset(
    "idiot idiots stupid moron morons loser losers scum trash pathetic worthless disgusting clown dumb imbecile "
    "dummkopf trottel abschaum idiota imbécil estúpido estúpida basura connard débile ordure".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos tú ti usted ustedes tus su".split()
)
READS_AS = str.maketrans("013457@$!|", "oieastasil")

STRONG, MEDIUM, WEAK, SECOND, CAPS, LOUD, ODD, LISTED = (1 << i for i in range(8))


def core_of(token: str) -> tuple[str, bool]:
    """A token in lower case without the signs around it, read through obfuscation; whether it was obfuscated."""
    core = token.lower().strip(".,;:!?\"'()[]{}<>«»„“”…-_*#%&")
    if not core or core.isalpha():
        return core, False
    plain = core.translate(READS_AS)
    letters = "".join(c for c in plain if c.isalpha())
    if 2 * len(letters) <= len(core) or core.isdigit() or sum(c.isalpha() for c in core) < 2 or any(c in core for c in "/.,:@="):
        return core, False
    return letters, True


def units(core: str) -> list[str]:
    return [core, *(core[:k] + "*" for k in PREFIXES if len(core) >= k)]


def learn_lexicon(texts: list[str], y: np.ndarray) -> dict[str, float]:
    """Weights (log-odds, smoothed) of words and beginnings that mark label 1."""

    def found(text: str) -> set[str]:
        return {u for core in {core_of(t)[0] for t in set(text.split())} if len(core) > 1 for u in units(core)}

    bad, good = Counter(), Counter()
    for t, v in zip(texts, y, strict=True):
        if v:
            bad.update(found(t))
    bad = Counter({u: n for u, n in bad.items() if n >= 3})
    for t, v in zip(texts, y, strict=True):
        if not v:
            good.update(found(t) & bad.keys())
    n_bad, n_good = float(y.sum()), float(len(y) - y.sum())
    out = {}
    for u, n in bad.items():
        weight = math.log((n + 0.5) / (n_bad + 1)) - math.log((good[u] + 0.5) / (n_good + 1))
        if weight >= LEVELS[0]:
            out[u] = weight
    return out


class Features:
    """Texts to feature rows; codes of tokens are memoised."""

    N = 13

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.weights: list[float] = [0.0]
        self.codes: dict[str, int] = {}

    def code(self, token: str) -> int:
        found = self.codes.get(token)
        if found is None:
            found = self.fresh(token)
            if len(token) <= MEMO_CHARS and len(self.codes) < MEMO:
                self.codes[token] = found
        return found

    def fresh(self, token: str) -> int:
        core, odd = core_of(token)
        weight = max((self.lexicon.get(u, 0.0) for u in units(core)), default=0.0)
        bits = (STRONG if weight >= LEVELS[2] else MEDIUM if weight >= LEVELS[1] else WEAK if weight >= LEVELS[0] else 0)
        bits |= (core in SECOND_PERSON) * SECOND | (len(token) > 2 and token.isupper()) * CAPS
        bits |= ("!" in token or "?" in token) * LOUD | odd * ODD | (core in INSULTS) * LISTED
        return bits | min(int(weight * 16), 255) << 8

    def row(self, text: str | None) -> list[float]:
        tokens = text.split() if text else []
        n = len(tokens)
        if not n:
            return [0.0] * self.N
        codes = np.array([*map(self.code, tokens)], np.int32)
        weight = (codes >> 8) / 16
        hit = (codes & (STRONG | MEDIUM | LISTED)) > 0
        second = (codes & SECOND) > 0
        near = 0
        if hit.any() and second.any():
            at = np.flatnonzero(second)
            marks = np.zeros(n + 1, np.int64)
            np.add.at(marks, np.maximum(at - NEAR, 0), 1)
            np.add.at(marks, np.minimum(at + NEAR + 1, n), -1)
            near = int((marks.cumsum()[:n] > 0)[hit].sum())
        share = lambda bit: float(((codes & bit) > 0).sum()) / n
        top = np.sort(weight)[-3:]
        return [
            math.log1p(n), share(STRONG), share(STRONG | MEDIUM), share(STRONG | MEDIUM | WEAK), math.log1p(int(hit.sum())), float(top[-1]),
            float(top.sum()), float(second.mean()), near / n, share(CAPS), share(LOUD), share(ODD), share(LISTED),
        ]

    def rows(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.row(t) for t in texts]).reshape(-1, self.N)


class Model:
    def __init__(self, lexicon: dict[str, float], boosted, knots):
        self.lexicon, self.boosted, self.knots = lexicon, boosted, knots
        self.features: Features | None = None

    def __getstate__(self):
        return self.__dict__ | {"features": None}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.boosted is None:
            return np.zeros(len(texts))
        if self.features is None:
            self.features = Features(self.lexicon)
        m = trees.margin(self.boosted, self.features.rows(texts))
        return np.interp(m, *self.knots) if len(self.knots[0]) > 1 else 1 / (1 + np.exp(-m))


def fit_texts(ids: list[int], texts: list[str], labels: list[int]) -> Model:
    y = np.array(labels, float)
    if not 0 < y.sum() < len(y):
        return Model({}, None, None)
    half = np.array([zlib.crc32(f"half {i}".encode()) & 1 for i in ids])
    x, oof = np.zeros((len(y), Features.N)), np.zeros(len(y))
    if min(y[half == k].sum() for k in (0, 1)) < 2 or min((1 - y[half == k]).sum() for k in (0, 1)) < 2:
        half = np.argsort(np.argsort(y, kind="stable"), kind="stable") & 1
    for k in (0, 1):
        others = np.flatnonzero(half != k)
        lexicon = learn_lexicon([texts[i] for i in others], y[others])
        x[half == k] = Features(lexicon).rows([t for t, h in zip(texts, half, strict=True) if h == k])
    for k in (0, 1):
        oof[half == k] = trees.margin(trees.boost(x[half != k], y[half != k]), x[half == k])
    return Model(learn_lexicon(texts, y), trees.boost(x, y), trees.isotonic(oof, y))


def remainder(id_col):
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(3))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` labelled ids whose crc32 remainder by 3 is not 1."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 1))
    ids = usable.groupBy("doc_id").agg(F.max("toxic").alias("y"))
    share = float(sample) / max(1, ids.count())
    chosen = ids.where(below_share(F.col("doc_id"), F.lit(share)))
    rows = docs.where(F.length("text") <= LONGEST).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about ``sample`` ids
    rows = rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    rows = sorted(rows, key=lambda r: r.doc_id)
    return fit_texts([r.doc_id for r in rows], [r.text for r in rows], [int(r.y > 0) for r in rows])


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns plus the score."""
    names = docs.columns
    where = names.index(text_col)
    if score_col in names:
        raise ValueError(f"a column {score_col} exists already")

    def run(batches):
        for b in slices(batches):
            s = pa.array(model.scores(b.column(where).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], [*names, score_col])

    return arrow_map(docs, run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def op(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)

    def run(batches):
        for b in slices(batches):
            s = model.scores(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    scored = arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double")
    held = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"))
