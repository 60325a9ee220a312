"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its number alone. The vector of a
three-letter gram binds its letters' vectors, permuted by place (cyclic shifts by 2, 1 and 0), by
multiplication; a text's vector bundles (adds) its grams' vectors, and a language's prototype the
vectors of its training texts. A text is of the language whose prototype has the highest cosine
with it.

Bundling is linear, so a text's inner product with a prototype is the sum over its grams of the
gram's inner product with it; those are kept per gram, and a text costs one gather and one sum.
Prototypes are used without what they have in common (their mean) so that shared grams do not
count. The score is (1 + margin) / 2 of the best over the second cosine relative to their sizes,
which needs no norm of the text, as that divides both.

Prototypes are bundled from a bounded sample: about ``PER_LANGUAGE`` texts of each language, those
whose id's hash is in the share that gives so many, among those that may be learned from and are no
longer than ``LONGEST`` characters. A count per language is all that this needs.

Defined cases: texts that are null or have no letter are ``und`` with score 0; very long texts are
read whole; ties go to the language first by code point; letters beyond the ``LETTERS`` most frequent
ones share hashed numbers; digits and signs part words as spaces do; rows that repeat an id are
predicted by their own texts, and an id and language with several texts are learned from by the
least; a null id is never held out nor learned from; without training texts all are ``und``; an empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import arrow_map, slices
from .common import below_share

DIMENSIONS = 2048
LETTERS = 96
PER_LANGUAGE = 1500
LONGEST = 1 << 18
UNKNOWN = "und"


def letter_vectors(n: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Row i is letter number i's vector; row 0 is the space."""
    return np.stack([np.random.default_rng([20, i]).integers(0, 2, dimensions) * 2 - 1 for i in range(n)]).astype(np.float32)


class Alphabet:
    """Code points to letter numbers: 0 for what is no letter, 1.. for letters."""

    def __init__(self, frequent: list[str]):
        self.frequent = frequent
        self.size = LETTERS + 33  # 32 hashed numbers for all other letters
        self.table: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"table": None}

    def numbers(self, text: str) -> np.ndarray:
        if self.table is None:
            self.table = np.full(0x110000, -1, np.int16)
            self.table[[ord(c) for c in self.frequent]] = np.arange(1, len(self.frequent) + 1)
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        out = self.table[points]
        if out.min(initial=0) < 0:
            for p in np.unique(points[out < 0]).tolist():
                letter = unicodedata.category(chr(p))[0] == "L"
                self.table[p] = LETTERS + 1 + p % 32 if letter else 0
            out = self.table[points]
        return out

    def grams(self, text: str) -> np.ndarray:
        """Gram numbers of a text, a space put at either end; runs of non-letters are one space."""
        x = np.concatenate([[0], self.numbers(text), [0]]).astype(np.int64)
        x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]
        if not x.any():
            return x[:0]
        return (x[:-2] * self.size + x[1:-1]) * self.size + x[2:]


class Model:
    def __init__(self, languages: list[str], alphabet: Alphabet | None, prototypes: np.ndarray | None):
        self.languages, self.alphabet, self.prototypes = languages, alphabet, prototypes
        self.place: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"place": None, "products": None}

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        return gram_vectors(grams, self.alphabet.size)

    def similar(self, grams: np.ndarray) -> np.ndarray:
        """Inner products of grams with the prototypes, kept once computed."""
        if self.place is None:
            self.place = np.full(self.alphabet.size**3, -1, np.int32)
            self.products = np.zeros((0, len(self.languages)), np.float32)
        new = np.unique(grams[self.place[grams] < 0])
        if len(new):
            self.place[new] = len(self.products) + np.arange(len(new))
            parts = [self.vectors(new[i : i + 4096]) @ self.prototypes.T for i in range(0, len(new), 4096)]
            self.products = np.concatenate([self.products, *parts])
        return self.products[self.place[grams]]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for t in texts:
            g = self.alphabet.grams(t) if t and self.languages else ()
            if not len(g):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            cosines = self.similar(g).sum(0, dtype=np.float64)
            order = np.argsort(-cosines, kind="stable")
            best = cosines[order[0]]
            second = cosines[order[1]] if len(order) > 1 else -best
            size = abs(best) + abs(second)
            names.append(self.languages[order[0]])
            scores.append(float((1 + (best - second) / size) / 2) if size else 0.5)
        return names, scores


def gram_vectors(grams: np.ndarray, size: int) -> np.ndarray:
    v = letter_vectors(size) if _VECTORS.get(size) is None else _VECTORS[size]
    _VECTORS[size] = v
    a, b, c = grams // (size * size), grams // size % size, grams % size
    return np.roll(v[a], 2, 1) * np.roll(v[b], 1, 1) * v[c]


_VECTORS: dict[int, np.ndarray] = {}


def fit_texts(texts: list[str], languages: list[str]) -> Model:
    names = sorted(set(languages))
    letters = Counter()
    for t in texts:
        letters.update(t.lower())
    frequent = [c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0])) if unicodedata.category(c)[0] == "L"][:LETTERS]
    if not names or not frequent:
        return Model([], None, None)
    alphabet = Alphabet(frequent)
    sums = np.zeros((len(names), DIMENSIONS))
    for k, name in enumerate(names):
        counts = Counter()
        for t, lang in zip(texts, languages, strict=True):
            if lang == name:
                g, n = np.unique(alphabet.grams(t), return_counts=True)
                counts.update(dict(zip(g.tolist(), n.tolist(), strict=True)))
        grams, n = np.array([*counts.keys()], np.int64), np.array([*counts.values()], np.float64)
        for i in range(0, len(grams), 4096):
            sums[k] += n[i : i + 4096] @ gram_vectors(grams[i : i + 4096], alphabet.size)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    p = unit(sums)
    if len(names) > 1:
        p = unit(p - p.mean(0))
    return Model(names, alphabet, p.astype(np.float32))


def remainder(id_col):
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(3))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` texts of each language whose id's crc32 remainder by 3 is not 1."""
    usable = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & (F.length("text") <= LONGEST) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 1))
    share = usable.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*")).alias("share"))
    rows = usable.join(F.broadcast(share), "lang").where(below_share(F.col("doc_id"), F.col("share")))  # one row a language, as the model has
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    rows = sorted(rows, key=lambda r: (r.doc_id, r.lang))
    return fit_texts([r.text for r in rows], [r.lang for r in rows])


def op(docs: DataFrame) -> DataFrame:
    model = fit(docs)

    def run(batches):
        for b in slices(batches):
            names, scores = model.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, lang_pred string, score double")
    return rows.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
