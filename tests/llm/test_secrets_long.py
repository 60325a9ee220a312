"""Secret scans: long unbroken words in linear time, the dictionary's cut, candidates against a plain rule."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from quire.llm import secrets

TOKEN = r"[A-Za-z0-9+/_=.\-]"


@pytest.mark.parametrize("word", ["漢字" * 500_000 + "1", "ACGT" * 250_000, "A1" * 500_000, "secret" * 170_000 + "1", "eyJ" * 330_000 + "1", "a/" * 500_000 + "1", "secret" + "!" * 1_000_000 + " x1y2z3a4b5c6d7"])
def test_words_of_a_million_characters(spark, word):
    docs = spark.createDataFrame([(1, "see " + word)], "doc_id long, text string")
    words = spark.createDataFrame([(["see"],)], "dict array<string>")
    secrets.described(secrets.candidates(docs.where("doc_id < 0")), words).count()  # code is compiled
    start = time.time()
    secrets.described(secrets.candidates(docs), words).agg(*[F.sum(f"f_{f}") for f in secrets.FEATURES]).collect()
    assert time.time() - start < 20


def test_candidates_are_the_mixed_runs(spark):
    r = random.Random(6)
    words = ["".join(r.choice(["a", "B", "7", ".", "/", "=", "-", "漢", '"', ":", "abc", "99"]) for _ in range(r.randrange(1, 40))) for _ in range(3000)]

    def rule(w):
        if len(w) < 12:
            return []
        runs = re.findall(TOKEN + "{12,}", w)
        return [x for x in runs if any(len(p) >= 12 and re.search("[0-9]", p) and re.search("[A-Za-z]", p) for p in x.split("."))]

    d = spark.createDataFrame([(w,) for w in words], "w string")
    got = d.select("w", F.transform(secrets.pieces(F.col("w")), lambda x: x["run"]).alias("r")).collect()
    assert [list(x.r or []) for x in got] == [rule(w) for w in words]


def test_signed_tokens_as_the_pattern(spark):
    r = random.Random(8)
    runs = ["".join(r.choice(["eyJ", "a", "B9", ".", "-", "/", "=", "abcdefgh", "eyJabcdefgh."]) for _ in range(r.randrange(1, 12))) for _ in range(4000)]
    got = spark.createDataFrame([(x,) for x in runs], "r string").select("r", secrets.signed(F.col("r")).alias("s")).collect()
    assert [x.s for x in got] == [bool(re.search(secrets.FORMATS["jwt"], x)) for x in runs] and 50 < sum(x.s for x in got) < 3900


def test_dictionary_keeps_its_size(spark):
    letters = "abcdefghijklmnopqrst"
    many = [a + b + c + d for a in letters for b in letters for c in letters for d in "xyz"][:6000]
    docs = spark.createDataFrame([(1, " ".join(many)), (2, "often often often rarely rarely")], "doc_id long, text string")
    got = secrets.dictionary(docs).first()["dict"]
    assert got == sorted(["often", "rarely", *sorted(many)[:4998]])
    assert secrets.dictionary(docs.where("doc_id = 2")).first()["dict"] == ["often", "rarely"]
    assert secrets.dictionary(docs.where("doc_id = 3")).first()["dict"] == []
