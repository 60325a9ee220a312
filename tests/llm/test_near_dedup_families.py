"""Near duplicates by the weighted or the plain similarity, with repeated passages, against brute force over all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest

from quire.llm import near_dedup as nd


def sentence(r, n):
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]


def classes(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return {x.doc_id: x.class_id for x in nd.op(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}


def test_repetition_does_not_hide_equal_sets(spark):
    """Texts of equal shingles, one of which repeats them fifty times."""
    r = random.Random(1)
    bases = [sentence(r, 20) for _ in range(60)]
    got = classes(spark, [" ".join(b * 2) for b in bases] + [" ".join(b * 50) for b in bases])
    assert sum(got[i] == got[i + 60] for i in range(60)) >= 59
    assert len(set(got.values())) >= 60


def test_recall_of_both_similarities(spark):
    """Edited texts with some passages repeated: brute force over all pairs gives the links of each kind."""
    r = random.Random(2)
    texts = []
    for _ in range(120):
        base = sentence(r, r.randrange(60, 160))
        texts.append(base)
        for _ in range(2):
            copy = list(base)
            for _ in range(r.randrange(0, 3)):
                copy[r.randrange(len(copy))] = "changed"
            cut = r.randrange(len(copy) - 20)
            copy += copy[cut : cut + 20] * r.choice([0, 0, 1, 4, 12])
            texts.append(copy)
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = nd.idf_of(nd.frequencies(docs))
    hashes = {x.doc_id: np.array(x.h, np.int64) for x in nd.word_hashes(docs, "doc_id").collect()}
    vectors = {i: nd.vector(h, idf) for i, h in hashes.items()}
    got = {x.doc_id: x.class_id for x in nd.op(docs).collect()}
    found = defaultdict(list)
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            both = np.intersect1d(vectors[i][0], vectors[j][0])
            if not len(both):
                continue
            (sa, wa), (sb, wb) = vectors[i], vectors[j]
            plain = len(both) / (len(sa) + len(sb) - len(both))
            shared = np.minimum(wa[np.searchsorted(sa, both)], wb[np.searchsorted(sb, both)]).sum()
            weighted = shared / (wa.sum() + wb.sum() - shared)
            for kind, value in (("plain", plain), ("weighted", weighted)):
                if value >= 0.8:
                    found[kind].append(got[i] == got[j])
    for kind in ("plain", "weighted"):
        assert len(found[kind]) > 60 and np.mean(found[kind]) >= 0.99, kind


@pytest.mark.parametrize("n", [16, 17, 40])
def test_buckets_of_every_size(spark, n):
    """A passage that many texts begin with; two of them are alike in the rest too, and all of a group of copies."""
    r = random.Random(n)
    common = sentence(r, 40)
    texts = [common + sentence(r, 60) for _ in range(n - 2)]
    pair = common + sentence(r, 60)
    texts += [pair, [*pair[:-1], "end"]]
    got = classes(spark, [" ".join(t) for t in texts])
    assert got[n - 2] == got[n - 1] and len(set(got.values())) == n - 1


def test_plain_samples_agree_as_the_sets_do():
    rng = np.random.default_rng(3)
    hits = []
    for _ in range(200):
        s = rng.integers(0, 1 << 62, 500).astype(np.uint64)
        hits.append((nd.plain_samples(s[:400]) == nd.plain_samples(s[100:])).mean())
    assert abs(np.mean(hits) - 0.6) < 0.03
    assert (nd.plain_samples(s) == nd.plain_samples(s[::-1])).all()
