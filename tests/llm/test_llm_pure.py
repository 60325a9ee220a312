"""The parts that need no Spark: merges, Elias-Fano, images, trees, hypervectors, sampling."""

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import bpe, language_id, media, near_dedup, token_files, toxicity, trees

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = "ab  \n\t\x1c\x85​　'stll.,!?09é中ñ\U0001f600\r\x0b́x<|endoftext|>᠎İΣσ"


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=40), st.text(ODD, max_size=60)))
def test_bpe_equals_library(encoder, library, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = encoder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


def test_bpe_long_piece(encoder, library):
    text = "ab" * 30_000 + "x" * 30_000
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10_000), max_size=300))
def test_elias_fano(values):
    values.sort()
    most = values[-1] if values else 0
    ef = token_files.EliasFano.of(np.array(values, np.int64), most)
    assert ef.values().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values


def test_shard_round_trip():
    ids = np.arange(7, dtype=np.uint32) * 9000
    blob = token_files.write_shard([None, 3, 3], np.array([1, 1, 7]), ids, 2)
    docs, ef, back = token_files.read_shard(blob)
    assert docs == [None, 3, 3] and ef.values().tolist() == [1, 1, 7] and back.tolist() == ids.tolist()
    with pytest.raises(ValueError):
        token_files.read_shard(blob[:-9] + b"\0" + blob[-8:])


def test_word_ids_equal_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own, lib, rnd = token_files.Ids(path), Tokenizer.from_file(path), random.Random(3)
    parts = [*ODD, "Word,", "end.", "It's", "<|endoftext|>", "Å"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(500)]
    for t, got in zip(texts, own.batch(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("shape", [(1, 1, 3), (7, 11, 3), (3, 64, 3)])
def test_image_formats(shape):
    x = np.random.default_rng(1).integers(0, 256, shape).astype(np.uint8)
    assert (media.decode(media.encode_bmp(x)) == x).all() and (media.decode(media.encode_netpbm(x)) == x).all()
    g = x[:, :, 0]
    assert (media.decode(media.encode_netpbm(g)) == g).all()
    plain = b"P2 # a comment\n%d %d 255\n" % (g.shape[1], g.shape[0]) + b" ".join(b"%d" % v for v in g.ravel())
    assert (media.decode(plain) == g).all()
    for bad in (b"P6\n2 2\n255\n", b"GIF89a", b"BM", b"P5 x"):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_area_resize_is_exact():
    g = np.random.default_rng(2).integers(0, 256, (5, 7))
    fine = np.kron(g, np.ones((6, 4), int))  # 30 x 28
    want = np.kron(fine, np.ones((8, 9), int)).reshape(8, 30, 9, 28).mean((1, 3))
    assert np.allclose(media.area_resize(fine, 8, 9), want)


def test_trees_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((trees.margin(trees.boost(x, y), x) > 0) == y).mean() > 0.98
    p = np.mean([trees.predict(t, x) for t in trees.forest(x, y)], 0)
    assert ((p > 0.5) == y).mean() > 0.9
    knots = trees.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert knots[1] == sorted(knots[1]) and knots[1] == [0.0, 0.5, 1.0]


def test_languages():
    words = {"aa": "sol mar rio luz", "bb": "krag thun vorst bild", "cc": "ñandú égal être"}
    r = random.Random(1)
    texts = [(" ".join(r.choice(w.split()) for _ in range(30)), k) for k, w in words.items() for _ in range(20)]
    m = language_id.fit_texts([t for t, _ in texts], [k for _, k in texts])
    names, scores = m.predict(["sol luz rio", "vorst krag", "être égal", None, "", "12 .,", "ñandú " * 20_000])
    assert names == ["aa", "bb", "cc", "und", "und", "und", "cc"] and all(0 <= s <= 1 for s in scores)
    # by linearity the kept products equal the bundled vector's
    g = m.alphabet.grams("sol mar")
    assert np.allclose(m.similar(g).sum(0), language_id.gram_vectors(g, m.alphabet.size).sum(0) @ m.prototypes.T, rtol=1e-4, atol=1e-2)


def test_toxicity_model():
    r = random.Random(2)
    base = "the of river stone cloud mountain paper water light house".split()
    texts, y = [], []
    for i in range(300):
        t = [r.choice(base) for _ in range(r.randrange(20, 60))]
        if i % 5 == 0:
            t.insert(r.randrange(len(t)), r.choice(["vilewort", "vileworm", "id10t"]))
        texts.append(" ".join(t))
        y.append(int(i % 5 == 0))
    m = toxicity.fit_texts(list(range(300)), texts, y)
    s = m.scores(["the river vileworst stone paper", "the river stone paper light", "", None, "you are an 1d1ot water"])
    assert s[0] >= 0.7 > s[1] and s[4] >= 0.7 and s[2] == s[3] and (0 <= s).all() and (s <= 1).all()
    assert toxicity.fit_texts([], [], []).scores(["x"]).tolist() == [0.0]
    assert toxicity.core_of("!!ST*PID??")[0] == "st*pid" or toxicity.core_of("1d10t")[0] == "idiot"


def test_shingles_and_samples():
    h = np.arange(3, dtype=np.int64)
    assert len(near_dedup.shingles(h)) == 1 and len(near_dedup.shingles(np.arange(9))) == 5 and not len(near_dedup.shingles(h[:0]))
    rng = np.random.default_rng(5)
    idf = np.ones(near_dedup.BINS, np.float32)
    hits, runs = 0, 150
    for _ in range(runs):  # sets with a Jaccard similarity of 0.6 share a sample in about 60 % of cases
        s = np.sort(rng.integers(0, 1 << 62, 400).astype(np.uint64))
        a, b = s[:320], s[80:]
        ka, kb = (near_dedup.band_keys(near_dedup.samples(x, np.ones(len(x), np.float32))) for x in (a, b))
        hits += (ka == kb).mean()
    assert abs(hits / runs - 0.6**near_dedup.ROWS) < 0.05
    v = near_dedup.vector(np.arange(50), idf)
    assert near_dedup.similarity(v, v) == 1.0 and near_dedup.similarity(v, near_dedup.vector(np.arange(100, 150), idf)) == 0.0


def test_media_payload():
    raw = "héllo".encode()
    px = media.decode(media.encode_netpbm(np.frombuffer(raw.ljust(192, b" "), np.uint8).reshape(-1, 64, 3)))
    assert hashlib.sha256(px.tobytes()).digest() == hashlib.sha256(raw.ljust(192, b" ")).digest()


def test_language_by_hand():
    """Predictions and scores equal those from the vectors themselves, bound and bundled gram by gram."""
    texts = ["the cat and the dog", "a bird in the tree, the sun", "der hund und die katze", "ein vogel im baum, die sonne", "el gato y el perro", "un ave en el árbol"]
    langs = ["en", "en", "de", "de", "es", "es"]
    m = language_id.fit_texts(texts, langs)
    v = language_id.letter_vectors(m.alphabet.size).astype(float)

    def bundle(text):
        numbers = [0]
        for c in text.lower():
            n = m.alphabet.frequent.index(c) + 1 if c in m.alphabet.frequent else 0
            if n or numbers[-1]:
                numbers.append(n)
        if numbers[-1]:
            numbers.append(0)
        out = np.zeros(language_id.DIMENSIONS)
        for a, b, c in zip(numbers, numbers[1:], numbers[2:]):
            out += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
        return out

    unit = lambda x: x / np.linalg.norm(x)
    own = [unit(sum(bundle(t) for t, k in zip(texts, langs, strict=True) if k == name)) for name in sorted({*langs})]
    own = [unit(p - np.mean(own, axis=0)) for p in own]
    asked = [*texts, "the katze", "x", "hund el"]
    names, scores = m.predict(asked)
    for t, name, score in zip(asked, names, scores, strict=True):
        cosines = sorted(((float(unit(bundle(t)) @ p), k) for p, k in zip(own, sorted({*langs}), strict=True)), key=lambda x: -x[0]) if any(c in m.alphabet.frequent for c in t) else []
        if cosines and cosines[0][0] - cosines[1][0] > 1e-5:
            (best, k), (second, _) = cosines[:2]
            assert name == k and score == pytest.approx((1 + (best - second) / (abs(best) + abs(second))) / 2, abs=1e-4)
    assert names[:6] == langs and m.predict([None, "", "123 !"]) == (["und"] * 3, [0.0] * 3)


def test_toxicity_features_by_hand():
    lexicon = {"vile": 4.0, "mean": 2.6, "rude": 1.6}
    row = dict(zip("n strong medium weak hits top top3 second near caps loud odd listed".split(), toxicity.Features(lexicon).row("You are VILE! so mean and rude, v1le idiot?"), strict=True))
    want = {"n": math.log1p(9), "strong": 2 / 9, "medium": 3 / 9, "weak": 4 / 9, "hits": math.log1p(4), "top": 4.0, "second": 1 / 9, "near": 2 / 9, "caps": 1 / 9, "loud": 2 / 9, "odd": 1 / 9, "listed": 1 / 9}
    assert {k: row[k] for k in want} == pytest.approx(want) and row["top3"] == pytest.approx(4 + 4 + 2.5625)
    assert toxicity.Features(lexicon).row(None) == toxicity.Features(lexicon).row("  ") == [0.0] * 13


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=400), st.integers(0, 10**6), st.data())
def test_select_many(gaps, more, data):
    values = np.cumsum(gaps) + more
    ef = token_files.EliasFano.of(values, int(values[-1]))
    at = np.array(sorted(data.draw(st.lists(st.integers(0, len(values) - 1), max_size=50))), np.int64)
    assert ef.select_many(at).tolist() == [ef.select(i) for i in at.tolist()] == values[at].tolist()
    assert ef.select_many(np.arange(len(values))).tolist() == ef.values().tolist() == values.tolist()
