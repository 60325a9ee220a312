"""Phrase collocation mining by contiguous pattern growth.

1. A first scan counts, by 64-bit hashes and summed within tasks, the words of each language and the
   pairs of neighbouring words. Those that occur ``LEAST`` times or more are marked in a bitmap of a
   fixed size (``BITS``), which is broadcast; it may mark too much, never too little.
2. A second scan projects an occurrence pointer for each place in a text: the word there and up to
   three more, cut where the next pair of words is not marked, as no longer phrase can be frequent.
   Equal pointers of a task are one row with a count; equal rows of all tasks are summed.
3. The projected rows are sorted over ranges, so that all that begin with a prefix lie together, and
   each task grows the prefixes that it holds: the pointers of a frequent prefix are a slice of the
   sorted rows, which is cut into the slices of its extensions, to the right and depth first. A prefix
   with very many continuations is split between neighbouring ranges (and batches): what touches an
   end is not pruned, and its parts are summed afterwards.
4. Cuts, scores and containment are joins of the frequent phrases, whose rows are unique by phrase.

Frequencies of hashes only decide what is projected; all numbers returned are counted exactly by the
phrases themselves. Products are decimals, so they may pass 64 bits.

Defined cases: a null text is empty; an empty one has no words; a null language is ``und``; very
long texts are read in blocks and keep one number for each word; rows that repeat an id count each; ties are
ordered by phrase; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import arrow_map, slices
from .common import stored

LEAST = 30
LONGEST = 4
CONTAINED = 80
TOP = 2000
BITS = 1 << 27
#: Words that a task holds before it sums them up, and distinct words before it starts anew.
HELD = 1_000_000
WORDS = 250_000
#: Bytes of a text that are split at a time.
SPAN = 1 << 20
SALTS = 64
#: What ends a piece, as bytes.
ENDS = b".,;:!?\n\x0b\x0c\r"
TO_PIECES = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")
END = 0


class Coder(dict):
    """Words of lower-cased texts to numbers from 1 on, with their hashes; END stands between pieces."""

    def __init__(self):
        super().__init__({b"\n": END})
        self.words, self.hashes = [b""], [0]

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return code

    def codes(self, text: str) -> np.ndarray:
        """The words of a text in order, an END after each piece."""
        raw = text.encode().lower().translate(TO_PIECES)
        out, at = [], 0
        while at < len(raw):
            end = at + SPAN
            if end < len(raw):  # cut at a word's end
                stops = [x for x in (raw.find(b" ", end), raw.find(b"\n", end)) if x >= 0]
                end = min(stops, default=len(raw))
            tokens = raw[at:end].replace(b"\n", b" \n ").split(b" ")
            out.append(np.fromiter(map(self.__getitem__, filter(None, tokens)), np.int32))
            at = end
        return np.concatenate([*out, [END]]).astype(np.int32)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Coder, dict[str, np.ndarray]]]:
    """The coded words of each language, about HELD at a time."""
    coder, held, size = Coder(), {}, 0
    for b in slices(batches, 256):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if text:
                codes = coder.codes(text)
                held.setdefault(lang, []).append(codes)
                size += len(codes)
        if size >= HELD or len(coder) >= WORDS:
            yield coder, {k: np.concatenate(v) for k, v in held.items()}
            coder, held, size = Coder(), {}, 0
    if held:
        yield coder, {k: np.concatenate(v) for k, v in held.items()}


def _hashed(coder: Coder, lang: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of the pairs (word, next word) of a language; those of END mean nothing."""
    own = np.array(coder.hashes, np.uint64) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), 11))
    with np.errstate(over="ignore"):
        own = own * np.uint64(0x9E3779B97F4A7C15)
        own ^= own >> np.uint64(32)
        word = own[codes]
        pair = (word[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + word[1:]) * np.uint64(0x9FB21C651E98DF25)
        pair ^= pair >> np.uint64(31)
    return word, pair


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - (BITS.bit_length() - 1))).astype(np.int64)


def frequent_bits(docs: DataFrame) -> np.ndarray:
    """Bitmap of the words and pairs that may occur LEAST times or more in a language: BITS bits."""

    def run(batches):
        for coder, langs in _blocks(batches):
            for lang, codes in langs.items():
                word, pair = _hashed(coder, lang, codes)
                inner = codes != END
                keys, n = np.unique(np.concatenate([word[inner], pair[inner[:-1] & inner[1:]]]), return_counts=True)
                for i in range(0, len(keys), 1 << 20):
                    part = slice(i, i + (1 << 20))
                    yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(n[part])], ["h", "n"])
            coder = langs = None  # not held while the next block is gathered

    counts = arrow_map(docs, run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
    bit = F.shiftrightunsigned("h", 64 - (BITS.bit_length() - 1)) + 1
    marked = counts.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in marked.toLocalIterator():  # at most BITS / 2^15 rows of 4096 bytes
        at = (r["block"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def projected(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(lang, pointer, n): the words from each place on, each with a space after it, as far as they may be frequent; and each language's words as the pointer ''."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def marked(h: np.ndarray) -> np.ndarray:
        bit = _bit(h)
        return (shared.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)

    def pointers(coder: Coder, lang: str, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        word, pair = _hashed(coder, lang, codes)
        inner = codes != END
        one = inner & marked(word)
        count = len(codes)
        after = np.append(codes, np.full(LONGEST, END, np.int32))
        grows = np.append(inner[:-1] & inner[1:] & marked(pair), np.zeros(LONGEST, bool))
        columns, more = [np.where(one, codes, END)], one
        for k in range(1, LONGEST):
            more = more & grows[k - 1 : k - 1 + count]
            columns.append(np.where(more, after[k : k + count], END))
        rows = np.stack(columns, 1)[one].astype(np.int64)
        high, low = rows[:, 0] << 32 | rows[:, 1], rows[:, 2] << 32 | rows[:, 3]
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))[: len(high)])
        n = np.diff(first, append=len(high))
        texts = coder.words
        for i in range(0, len(first), 1 << 17):
            found = rows[order[first[i : i + (1 << 17)]]].tolist()
            named = [b"".join(texts[c] + b" " for c in row if c).decode() for row in found]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(named)), pa.array(named), pa.array(n[i : i + (1 << 17)])], ["lang", "pointer", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([""]), pa.array([int(inner.sum())])], ["lang", "pointer", "n"])

    def run(batches):
        for coder, langs in _blocks(batches):
            for lang, codes in langs.items():
                yield from pointers(coder, lang, codes)
            coder = langs = codes = None

    rows = arrow_map(docs, run, "lang string, pointer string, n long")
    return stored(rows.groupBy("lang", "pointer").agg(F.sum("n").alias("n")))


def _grow(words: list[list[str]], n: np.ndarray, lo: int, hi: int, depth: int, top: int, emit) -> None:
    """Emits the prefixes of ``depth`` + 1 words among the sorted pointers ``lo`` to ``hi``, which share their first ``depth`` words, and grows them.

    ``top`` is the number of pointers held: a slice at either end may go on elsewhere and is kept whatever its count.
    """
    while lo < hi:
        row = words[lo]
        if len(row) <= depth:  # a pointer that ends with the prefix itself
            lo += 1
            continue
        end, word = lo + 1, row[depth]
        while end < hi and len(words[end]) > depth and words[end][depth] == word:
            end += 1
        total = int(n[lo:end].sum())
        if total >= LEAST or lo == 0 or end == top:
            emit(row[: depth + 1], total)
            if depth + 1 < LONGEST:
                _grow(words, n, lo, end, depth + 1, top, emit)
        lo = end


def grown(rows: DataFrame) -> DataFrame:
    """(lang, phrase, size, f) of every frequent phrase, from projected rows."""
    ranges = rows.repartitionByRange("lang", "pointer").sortWithinPartitions("lang", "pointer")

    def run(batches):
        for b in batches:
            langs = b.column(0).to_pylist()
            words = [p.split(" ")[:-1] for p in b.column(1).to_pylist()]
            n = b.column(2).to_numpy()
            cuts = [i for i in range(1, len(langs)) if langs[i] != langs[i - 1]]
            for lo, hi in zip([0, *cuts], [*cuts, len(langs)]):
                if lo < hi:
                    phrases, sizes, counts = [], [], []

                    def emit(words, total):
                        phrases.append(" ".join(words))
                        sizes.append(len(words))
                        counts.append(total)

                    _grow(words[lo:hi], n[lo:hi], 0, hi - lo, 0, hi - lo, emit)
                    yield pa.RecordBatch.from_arrays([pa.array([langs[lo]] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())], ["lang", "phrase", "size", "f"])

    parts = arrow_map(ranges, run, "lang string, phrase string, size int, f long")
    return stored(parts.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= LEAST))


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, size, a, l, r, score): each with its lowest-scoring cut."""
    p = phrases.select("lang", "phrase", "size", "f")
    words = F.split("phrase", " ")
    part = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    cuts = p.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = stored(cuts.select("*", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")))
    known = p.select("lang", F.col("phrase").alias("of"), "f")
    # sorted joins of stored tables, alone in their stages: a word that begins or ends very many phrases can be split
    left = stored(cuts.hint("merge").join(known.select("lang", F.col("of").alias("head"), F.col("f").alias("l")), ["lang", "head"]))
    both = stored(left.hint("merge").join(known.select("lang", F.col("of").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    score = F.expr("cast(2000000 * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as long)")
    best = both.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return best.select("lang", "phrase", "size", "a", "m.l", "m.r", "m.score")


def uncontained(candidates: DataFrame) -> DataFrame:
    """Candidates that no longer one holds nearly as often."""
    words = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")))
    )
    held = candidates.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    most = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    inside = F.expr(f"100 * cast(longer as decimal(20, 0)) >= {CONTAINED} * cast(a as decimal(20, 0))")
    return candidates.join(most, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~inside).drop("longer")


def mined(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best collocations."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    rows = projected(docs, frequent_bits(docs))
    found = stored(uncontained(stored(scored(grown(rows.where("pointer <> ''"))))))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    total = rows.where("pointer = ''").select("lang", "n")
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op(docs: DataFrame) -> DataFrame:
    return mined(docs)


ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null),
worded as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as ws from pieces),
places as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from worded),
grams as (select lang, array_to_string(ws[i : i + size - 1], ' ') as phrase, size from places, (select unnest([1, 2, 3, 4]) as size) where i + size - 1 <= len(ws)),
totals as (select lang, count(*) as n from places group by lang),
f as (select lang, phrase, size, count(*) as f from grams group by lang, phrase, size having count(*) >= 30),
cuts as (
  select lang, phrase, size, f as a, unnest(range(1, size)) as k, string_split(phrase, ' ') as ws from f where size > 1),
parted as (
  select c.lang, c.phrase, c.size, c.a, c.k, x.f as l, y.f as r, (2000000::hugeint * c.a) // (x.f + y.f)::hugeint as score
  from cuts c join f x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1 : c.k], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.ws[c.k + 1 : c.size], ' ')),
scored as (select * from parted qualify row_number() over (partition by lang, phrase order by score, k) = 1),
spread as (select lang, string_split(phrase, ' ') as ws, size, a, unnest(range(2, size)) as m from scored where size > 2),
inner_ as (select lang, ws, m, a, unnest(range(1, size - m + 2)) as i from spread),
most as (select lang, array_to_string(ws[i : i + m - 1], ' ') as phrase, max(a) as longer from inner_ group by 1, 2),
kept as (
  select s.* from scored s left join most m on m.lang = s.lang and m.phrase = s.phrase
  where m.longer is null or not 100::hugeint * m.longer >= 80::hugeint * s.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select r.lang, r.rank::bigint as rank, r.phrase, r.a::bigint as a, r.l::bigint as l, r.r::bigint as r, t.n::bigint as n, r.score::bigint as score
from ranked r join totals t on t.lang = r.lang where r.rank <= 2000
"""
