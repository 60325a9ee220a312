"""Packing: every id in one piece, gapless windows, little padding, ids of the library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from quire.llm import packing

PATH = P.path("byte_bpe_50k.json")


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [e.ids + [1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def cost(n, capacity=2048):
    return n if n & (n - 1) == 0 else capacity


@pytest.mark.parametrize(("sizes", "k"), [([5], 1), ([5, 4], 3), ([8, 7, 6, 5, 4], 2), (list(range(1, 60)), 7), ([1] * 40, 8)])
def test_difference_is_a_partition(sizes, k):
    windows = packing.difference(sizes, k)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes))) and len(windows) == k
    sums = sorted(sum(sizes[i] for i in w) for w in windows)
    assert sums[-1] - sums[0] <= max(sizes)


def test_difference_of_the_textbook():
    assert sorted(sorted([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference([8, 7, 6, 5, 4], 2)) == [[4, 5, 7], [6, 8]]


def test_window_count_rises_when_capacity_is_exceeded():
    p = packing.Packer(capacity=10, windows=4)
    for doc in range(3):
        p.add(doc, np.arange(6, dtype="<u4").tobytes())  # three pieces of six never fit two windows of ten
    p.group = [(d, s, i, n) for d, s, i, n in p.group]
    p.close()
    used = defaultdict(int)
    for _, _, ids, _, sequence, _ in p.rows:
        used[sequence] += len(ids) // 4
    assert sum(used.values()) == 18 and max(used.values()) <= 10


def test_pieces_hold_every_id_once(spark):
    r = random.Random(1)
    texts = [None, "", " ", "a<|endoftext|>b", "word " * 9000, "x" * 5000, "漢字 かな\n\nb"] + [" ".join(r.choice(["alpha", "beta", "ga,mma", "d\te"]) for _ in range(r.randrange(1, 900))) for _ in range(300)]
    rows = [(i if i != 9 else None, t, i, "extra") for i, t in enumerate(texts)] + [(20, texts[20], 1, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, sequence_id string").repartition(2)
    got = packing.packed(docs, PATH).collect()
    want = dict(zip([x[0] for x in rows], library([x[1] for x in rows])))
    windows, pieces = defaultdict(list), defaultdict(list)
    for p in got:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0 and p.doc_tokens == len(want[p.doc_id])
        assert want[p.doc_id][p.start : p.start + p.length] == ids
        windows[p.sequence_id].append((p.offset, p.length))
        pieces[p.doc_id].append((p.start, p.length))
    for doc, parts in pieces.items():
        times = 2 if doc == 20 else 1
        assert sum(n for _, n in parts) == times * len(want[doc])
        if times == 1:
            assert sorted(s for s, _ in parts) == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
    for parts in windows.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 2048
    total = sum(p.length for p in got)
    assert sum(cost(sum(n for _, n in w)) for w in windows.values()) <= 1.02 * total


def test_op_gives_checksums(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    got = {x.doc_id: x for x in packing.op(docs, PATH).where(F.col("start") == 0).collect()}
    assert got[2].ids_crc32 == zlib.crc32(np.array([1], "<u4").tobytes())
    whole = packing.op(docs, PATH).where("doc_id = 1").collect()
    assert sum(x.length for x in whole) == len(library(["some text"])[0])
    assert packing.op(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
