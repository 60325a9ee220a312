"""Cross-tokenizer alignment against a brute-force version that looks at every two tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest

from quire.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "\n", "\n\n", " a", "a ", "a  b", "a\n b", "a \nb", "a\n\nb\n", "\ta\t b", "x\r\ny;\r\n z", "a<|endoftext|>b <s></s> <unk>", "é　b 　c", "▁a b", "a ▁",
    "'s don't  I'll", "   lead", "trail   ", "a\n\n\nb", "a\x1cb c", "漢字 かな 12", "a" * 300 + " b", "a\x00b", "\U0001f600 x \U0001f468‍\U0001f469", "<0x41> b", "same words here", "same words here",
]


def ids_of():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=B)
    pair = alignment.Pair(A, B)
    return (lambda x: t.encode(" " + x, add_special_tokens=False).ids), s.encode, pair.a.bytes_of, pair.b.bytes_of


def brute(rows):
    """The query's rows, in any order."""
    enc_a, enc_b, bytes_a, bytes_b = ids_of()
    docs, count = [], Counter()
    for doc, text in rows:
        a, b = (enc_a(text), enc_b(text)) if text else ([], [])
        full = (" " + text).encode() if text else b""
        if not text or b"".join(bytes_a[i] for i in a) != full or b"".join(bytes_b[i] for i in b) != full:
            docs.append((doc, [], [], [], ""))
            continue

        def ranges(ids, table):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at += len(table[i])
            return out

        ra, rb = ranges(a, bytes_a), ranges(b, bytes_b)
        links = [(x[2], y[2]) for x in ra for y in rb if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in ra} & {y[1] for y in rb})
        groups, last = [], 0
        for c in cuts:
            own = [",".join(str(t[2]) for t in r if last < t[1] <= c) for r in (ra, rb)]
            groups.append("|".join(own))
            last = c
        count.update(set(links))
        docs.append((doc, a, b, links, groups))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc, a, b, links, groups in docs:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((doc, len(a), len(b), len(groups), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), sha))
    return sorted(out, key=repr)


def made(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(["the", "a", " ", "\n", "\t", "é", "1", ".", "'s", "　", "in g", " word", ";"]) for _ in range(r.randrange(1, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    return [*((i if i % 7 else None, t) for i, t in enumerate(ODD + made(150, 3)))]


@pytest.mark.parametrize("most_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_alignment_equals_brute_force(spark, rows, most_pairs):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, pairs string").repartition(3)
    got = alignment.aligned(docs, A, B, most_pairs)
    assert got.columns == alignment.RESULT
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_long_text_is_swept_in_blocks(spark, monkeypatch):
    r = random.Random(5)
    text = " ".join("".join(r.choice("abcdeé\nf") for _ in range(r.randrange(1, 9))) for _ in range(60_000)) + "x" * 150_000
    rows = [(1, text), (2, "short one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x for x in alignment.aligned(docs, A, B).collect()}
    enc_a, enc_b, bytes_a, bytes_b = ids_of()
    a, b = enc_a(text), enc_b(text)
    m = alignment.Machine(alignment.pair(A, B).sizes)
    import numpy as np

    m.begin(1)
    m.feed([(np.cumsum([len(t[i]) for i in ids]), np.array(ids)) for ids, t in ((a, bytes_a), (b, bytes_b))])
    assert (got[1].n_a, got[1].n_b, got[1].n_groups, got[1].n_links) == tuple(m.counts) and got[1].n_a == len(a)
    assert got[1].groups_sha256 == m.digest.hexdigest()


def test_empty_table(spark):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
