"""Token-id output with Elias-Fano encoded document boundaries.

File format (all little-endian), one blob per shard:

    magic "EFT1" | u8 bytes per id (2 or 4) | u8 low bits l | u16 zero | u64 documents n | u64 ids u
    | u64 null ids | n x i64 document ids | low parts, ceil(n * l / 8) bytes
    | upper bits, ceil((n + (u >> l) + 1) / 8) bytes | u64 select samples, every 64th one
    | u x id | u32 crc of all before

The n end offsets (number of ids up to and including each document) are a monotone sequence with
maximum u. Each keeps its l = floor(log2(u / n)) low bits verbatim; the rest is a unary bit string
in which the i-th one stands at position (end_i >> l) + i. That is about 2 + log2(u / n) bits per
document instead of 64. ``select`` starts at the nearest sample and counts ones.

Shards are bounded in ids (a single longer document is a shard of its own) and are written as rows
of a Parquet table in the shared storage, so that Spark's commit protocol and any file system do.
Rows are range-sorted by document id; a shard row carries its range's number and the ids of that
range before it. The ids before each range need one row per range only, a number fixed by
spark.sql.shuffle.partitions, which is what the read broadcasts. The read gets each document's
offsets by select, many at a time.

Defined cases: a null or empty text is the end id alone; a very long text is a shard of its own;
null ids come first; rows that repeat an id follow one another (ordered by their text's hash); other
columns are ignored; an empty table gives no shard and no row.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import arrow_map, slices
from .common import stored

SHARD_IDS = 1 << 18
SAMPLE = 64
#: Words whose ids a worker keeps, and the longest that is kept: about 300 MB at most.
MEMO = 1_500_000
MEMO_CHARS = 64
#: Words that the library is asked for at a time.
JOINED = 1000
#: Controls that Python splits at and the tokenizer does not.
ODD = "\x1c\x1d\x1e\x1f"
HEAD = struct.Struct("<4sBBHQQQ")


class EliasFano:
    """A monotone sequence of non-negative integers below or at ``most``."""

    def __init__(self, n: int, most: int, low_bits: int, low: np.ndarray, upper: np.ndarray, samples: np.ndarray):
        self.n, self.most, self.low_bits, self.low, self.upper, self.samples = n, most, low_bits, low, upper, samples

    @staticmethod
    def low_width(n: int, most: int) -> int:
        return max(0, (most // n).bit_length() - 1) if n else 0

    @classmethod
    def of(cls, values: np.ndarray, most: int) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        l = cls.low_width(n, most)
        bits = (values[:, None] >> np.arange(l)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> l) + np.arange(n)
        flags = np.zeros(n + (most >> l) + 1, np.uint8)
        flags[ones] = 1
        return cls(n, most, l, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype("<u8"))

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(1) if self.low_bits else 0
        return ((ones - np.arange(self.n)) << self.low_bits) + low

    def select(self, i: int) -> int:
        """The i-th value, by its sample and a short scan."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at >> 3
        word = int(self.upper[byte]) >> (at & 7) << (at & 7)
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self.upper[byte])
        for _ in range(left):
            word &= word - 1
        one = (byte << 3) + (word & -word).bit_length() - 1
        start = i * self.low_bits
        first, last = start >> 3, (start + self.low_bits + 7) >> 3
        low = int.from_bytes(self.low[first:last].tobytes(), "little") >> (start & 7) & ((1 << self.low_bits) - 1)
        return ((one - i) << self.low_bits) + low

    def select_many(self, at: np.ndarray) -> np.ndarray:
        """The values at several places, in ascending order: of the unary bits only the groups that hold them are read, each from its sample to the next."""
        at = np.asarray(at, np.int64)
        group, ones = at // SAMPLE, np.empty(len(at), np.int64)
        for g in np.unique(group).tolist():
            first, end = int(self.samples[g]), len(self.upper)
            if g + 1 < len(self.samples):
                end = (int(self.samples[g + 1]) >> 3) + 1
            bits = np.flatnonzero(np.unpackbits(self.upper[first >> 3 : end], bitorder="little")) + (first & ~7)
            a, b = np.searchsorted(group, [g, g + 1])
            ones[a:b] = bits[np.searchsorted(bits, first) + at[a:b] % SAMPLE]
        start = at * self.low_bits
        padded = np.concatenate([self.low, np.zeros(8, np.uint8)])
        low = padded[(start >> 3)[:, None] + np.arange(8)].view("<u8").ravel().astype(np.uint64) >> (start & 7).astype(np.uint64)
        return ((ones - at) << self.low_bits) + (low & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)


def write_shard(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    n, u = len(doc_ids), len(ids)
    nulls = sum(d is None for d in doc_ids)
    ef = EliasFano.of(ends, u)
    parts = [
        HEAD.pack(b"EFT1", width, ef.low_bits, 0, n, u, nulls),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        ef.low.tobytes(),
        ef.upper.tobytes(),
        ef.samples.tobytes(),
        ids.astype(f"<u{width}").tobytes(),
    ]
    body = b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


def read_shard(blob: bytes) -> tuple[list[int | None], EliasFano, np.ndarray]:
    """Document ids, end offsets and ids of a shard; a damaged one raises ValueError."""
    magic, width, l, _, n, u, nulls = HEAD.unpack_from(blob)
    if magic != b"EFT1" or struct.unpack("<I", blob[-4:])[0] != zlib.crc32(memoryview(blob)[:-4]):
        raise ValueError("not a whole token shard")
    at = HEAD.size

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(blob, dtype, count, at)
        at += out.nbytes
        return out

    docs: list[int | None] = take("<i8", n).tolist()
    docs[:nulls] = [None] * nulls
    low, upper = take("u1", -(-n * l // 8)), take("u1", -(-(n + (u >> l) + 1) // 8))
    ef = EliasFano(n, u, l, low, upper, take("<u8", -(-n // SAMPLE)))
    return docs, ef, take(f"<u{width}", u)


class Ids:
    """Texts to ids with the tokenizers library.

    The tokenizer drops white space and no token spans it, so the library is asked once for each
    distinct word; texts with the few controls that only Python takes for spaces go to it whole.
    It also lowers case and always parts letters from a closing comma or full stop, so a word of
    letters is asked for without those. Words of Latin letters are asked for many at a time, as a
    text: each ends with a token that the vocabulary marks as a word's end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.memo: dict[str, bytes] = {}

    def ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ask_words(self, words: list[str]) -> list[bytes]:
        """The same of words of letters; should their ends not come out one for each word, they are asked for singly."""
        out = []
        for i in range(0, len(words), JOINED):
            part = words[i : i + JOINED]
            raw = self.ask([" ".join(part)])[0]
            cuts = (4 * np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 4).tolist()
            whole = len(cuts) == len(part) and cuts[-1] == len(raw)
            out += [raw[a:b] for a, b in zip([0, *cuts], cuts)] if whole else self.ask(part)
        return out

    def learn(self, words: set[str]) -> set[str]:
        """Puts words into the memo; returns what is too long to stay there."""
        memo, bare = self.memo, {}
        for w in words:
            core = w[:-1] if w[-1] in ",." and _plain(w[:-1]) else w
            bare[w] = core.lower() if core.isascii() else core, w[len(core) :]
        unknown = {x for pair in bare.values() for x in pair if x and x not in memo}
        latin = [x for x in unknown if _plain(x) and (x.isascii() or max(x) < "\u0250")]
        other = list(unknown.difference(latin))
        memo.update(zip(latin, self.ask_words(latin), strict=True))
        memo.update(zip(other, self.ask(other), strict=True))
        memo.update((w, memo[core] + (memo[tail] if tail else b"")) for w, (core, tail) in bare.items())
        return {x for w in words if len(w) > MEMO_CHARS for x in (w, *bare[w])}

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.memo) > MEMO:
            self.memo = {}
        memo = self.memo
        parts = [None if t is not None and any(c in t for c in ODD) else (t or "").split() for t in texts]
        words = set().union(*(p for p in parts if p))
        long = self.learn(words.difference(memo))
        out = [self.ask([t])[0] if p is None else b"".join(map(memo.__getitem__, p)) for t, p in zip(texts, parts, strict=True)]
        for w in long:
            memo.pop(w, None)
        return out


def _plain(word: str) -> bool:
    """Letters only, and still letters only once normalised and lowered."""
    return word.isalpha() and (word.isascii() or (is_normalized("NFC", word) and word.lower().isalpha()))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Ids:
    return Ids(path)


def write(docs: DataFrame, tokenizer_path: str, end_id: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode and write; returns the table of shards (part, base, n_ids, blob) as stored."""

    def run(batches):
        part, base = TaskContext.get().partitionId(), 0
        t = tokenizer(tokenizer_path)
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def shard():
            nonlocal base, held, size
            ids = np.frombuffer(b"".join(x for _, x in held), "<u4")
            ends = np.cumsum([len(x) // 4 for _, x in held])
            blob = write_shard([d for d, _ in held], ends, ids, t.width)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([base], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([blob], pa.binary())],
                ["part", "base", "n_ids", "blob"],
            )
            base += len(ids)
            held, size = [], 0
            return row

        end = struct.pack("<I", end_id)
        for b in slices(batches, 256):
            for d, x in zip(b.column(0).to_pylist(), t.batch(b.column(1).to_pylist()), strict=True):
                x += end
                if held and size + len(x) // 4 > shard_ids:
                    yield shard()
                held.append((d, x))
                size += len(x) // 4
        if held:
            yield shard()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return stored(arrow_map(rows, run, "part int, base long, n_ids long, blob binary"))


def read(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document."""
    ranges = shards.groupBy("part").agg(F.sum("n_ids").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("ids_before"))
    placed = shards.join(F.broadcast(ranges), "part").select((F.col("ids_before") + F.col("base")).alias("first"), "blob")

    def run(batches):
        for b in slices(batches, 1):
            first, blob = b.column(0)[0].as_py(), b.column(1)[0].as_py()
            docs, ef, ids = read_shard(blob)
            ends = ef.select_many(np.arange(ef.n))
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            wide = memoryview(ids.astype("<u4").tobytes())
            crcs = [zlib.crc32(wide[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(starts + first), pa.array(ends - starts), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return arrow_map(placed, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    return read(write(docs, tokenizer_path, end_id))
