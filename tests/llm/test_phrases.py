"""Phrase mining against SQL on given data and against counting every phrase on awkward texts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import of_df, of_sql

from quire.llm import phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 5):
                    if i + k <= len(words):
                        f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= 30}
        kept = []
        for p, a in found.items():
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items())
            if not inside:
                cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = ["Alpha", "beta", "gam\x01ma", "de", "de\x01", "É", "é", "x\xa0y", "10", "the", "the", "the", "漢字", "\x00", "a b"]
    texts = [(r.choice(["en", "de", None, "und", ""]), "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", "\n", ". ", ",", "\r", "\x0b", "!? "]) for _ in range(r.randrange(0, 80)))) for _ in range(400)]
    return [*texts, ("en", None), ("en", ""), (None, "."), ("fr", " \t\n"), *[("en", "New York is New York is new york is")] * 40, *[("de", "b a. a b")] * 31]


def test_phrases_equal_brute_force(spark, rows):
    docs = spark.createDataFrame([(i, *x, "s", 1) for i, x in enumerate(rows)], "doc_id long, lang string, text string, phrase string, n int").repartition(3)
    got = phrases.mined(docs)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert sorted(map(tuple, phrases.mined(docs, top=3).collect())) == brute(rows, 3)


def test_phrases_equal_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert of_df(queries.op11_phrases(spark, sf)) == of_sql(phrases.ORACLE, sf)


def test_long_text_and_empty_table(spark):
    text = "one two three " * 200_000 + "w" * 2_000_000 + " " + "four\t\tfive;" * 100
    docs = spark.createDataFrame([(1, "en", text)], "doc_id long, lang string, text string")
    got = {r.phrase: r for r in phrases.mined(docs).collect()}
    assert got["one two three one"].a == 199_999 and got["four five"].a == 100 and got["four five"].n == 600_000 + 1 + 200
    assert phrases.mined(spark.createDataFrame([], "doc_id long, lang string, text string")).count() == 0


def test_prefixes_split_over_batches_sum_up():
    """However the sorted pointers are cut, what is emitted adds up to the frequent phrases."""
    r = random.Random(4)
    pointers = sorted(tuple(r.choice("abc") for _ in range(r.randrange(1, 5))) for _ in range(300))
    want = Counter()
    for p in pointers:
        for k in range(1, len(p) + 1):
            want[p[:k]] += 1
    for cuts in ([], [100], [37, 38, 150, 290]):
        got = Counter()
        for lo, hi in zip([0, *cuts], [*cuts, 300]):
            part = [list(p) for p in pointers[lo:hi]]
            phrases._grow(part, np.ones(len(part), np.int64), 0, len(part), 0, len(part), lambda w, t: got.update({tuple(w): t}))
        assert {p: a for p, a in got.items() if a >= phrases.LEAST} == {p: a for p, a in want.items() if a >= phrases.LEAST}


def test_bitmap_marks_what_is_frequent(spark):
    docs = spark.createDataFrame([("en", "left right. left right")] * 15 + [("en", "rare words")] * 29, "lang string, text string")
    bits = phrases.frequent_bits(docs)
    coder = phrases.Coder()
    codes = coder.codes("left right rare words")
    word, pair = phrases._hashed(coder, "en", codes)
    marked = lambda h: [bool(bits[b >> 3] >> (b & 7) & 1) for b in phrases._bit(h).tolist()]
    assert marked(word)[:4] == [True, True, False, False] and marked(pair)[:3] == [True, False, False]
    assert int(np.unpackbits(bits).sum()) == 3
