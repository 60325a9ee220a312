"""Cross-tokenizer alignment by an event sweep.

1. Every text is encoded by two tokenizers: A, byte-level, over a space and the text, and B, with
   pieces of characters, over the text, before which it puts a space itself. Each token's end, as a byte
   offset, is an event of its side. The events of both sides leave as one table: a row holds the
   events of one side that end within ``BLOCK`` bytes of a text, as lengths and ids, compressed.
2. The rows are repartitioned by document and sorted within partitions by offset.
3. A state machine reads them in that order. Where A and B end together, a group ends. Between two
   successive events of either side lies exactly one pair of tokens that overlap, so every event is a
   link: an end of A links it with the token of B that reaches over it or ends there, an end of B
   that is none of A likewise. The machine holds the events after the last common end only.
4. Each document's distinct linked id pairs are stored with their numbers of links. Pairs are counted
   over documents, partly summed before the shuffle; each id of A has its highest count.
5. The counts, one for each pair of ids ever linked, are broadcast up to ``BROADCAST_PAIRS``; beyond
   that the documents' pairs are joined with them. Both ways give the same rows.

Both tokenizers are asked once for each distinct chunk of text that a worker meets (``chunks``).

Defined cases: a null or empty text, and one whose tokens' bytes are not a space and the text, has no
tokens (zeros and an empty digest) and counts for no pair; special tokens' spelling is ordinary text;
a very long text is several rows of events of one document; rows that repeat an id, or have none,
are documents of their own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import arrow_map, slices
from .bpe import SPACE
from .chunks import ByteLevel, Chunks, dealt, joint, placed
from .common import stored

BLOCK = 1 << 16
BROADCAST_PAIRS = 1 << 22
#: Pairs that a counting task sums up at a time.
COUNTED = 1 << 21
EVENTS = "part int, row long, doc_id long, offset long, side int, start long, n int, wide boolean, events binary"
SWEPT = "part int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, links binary"
NO_TOKENS = ""


class Pieces:
    """A model of the sentencepiece library whose pieces do not reach from a character into a following space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        written = [self.model.id_to_piece(i) for i in range(n)]
        if any(re.search("[^▁][▁]", p) or "\n" in p for p in written):
            raise ValueError("pieces of this model cross chunks of text")
        one_byte = re.compile("<0x([0-9A-F]{2})>")
        self.bytes_of = [bytes([int(m[1], 16)]) if self.model.is_byte(i) and (m := one_byte.fullmatch(p)) else p.replace("▁", " ").encode() for i, p in enumerate(written)]
        self.lengths = np.array(list(map(len, self.bytes_of)), np.int64)
        self.lead = self.model.encode("\n")  # the space put before a text and a line end, which joins nothing

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of chunks that follow some text: each is asked for after a line end."""
        k = len(self.lead)
        out = self.model.encode(["\n" + t for t in texts], num_threads=1)
        if any(ids[:k] != self.lead for ids in out):
            raise ValueError("pieces of this model cross chunks of text")
        return [np.array(ids[k:], "<u4") for ids in out]

    def ask(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        good, rest = joint(chunks)
        parts = []
        if good:
            texts = [chunks[i] for i in good]
            ids = self.whole(["".join(texts)])[0]
            counts = dealt(ids, self.lengths, texts)
            if counts is None:  # a chunk with a character that B writes otherwise
                good, rest = [], list(range(len(chunks)))
            else:
                parts.append((ids, counts))
        if rest:
            got = self.whole([chunks[i] for i in rest])
            parts.append((np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got))))
        return placed(good + rest, parts, len(chunks))


class Pair:
    """Two tokenizers and the memo of what they make of chunks."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a, plain_specials=True), Pieces(path_b)
        self.sizes = len(self.a.lengths), len(self.b.lengths)
        self.chunks = Chunks(self.ask)

    def ask(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A, ids of B, and whether both spell each chunk."""
        out, same = [], np.ones(len(chunks), bool)
        for side in (self.a, self.b):
            ids, counts = side.ask(chunks)
            spelled = b"".join(map(side.bytes_of.__getitem__, ids.tolist()))
            ends = np.cumsum(side.lengths[ids]) if len(ids) else np.zeros(0, np.int64)
            last = np.cumsum(counts)
            ends = np.concatenate([[0], ends])[last].tolist()
            start = 0
            for i, (c, end) in enumerate(zip(chunks, ends, strict=True)):
                same[i] &= spelled[start:end] == c.encode()
                start = end
            out.append((ids, counts))
        return [*out, (same, np.ones(len(chunks), np.int64))]

    def events(self, texts: list[str | None]):
        """(ids, lengths) of both sides for each text; None for one without tokens."""
        codes = self.chunks.batch([" " + t if t else "" for t in texts])
        for text, c in zip(texts, codes, strict=True):
            if not len(c):
                yield None
                continue
            a, b = self.chunks.gather(0, c), self.chunks.gather(1, c)
            if not self.chunks.gather(2, c).all():
                full = (" " + text).encode()
                if any(b"".join(map(s.bytes_of.__getitem__, ids.tolist())) != full for s, ids in ((self.a, a), (self.b, b))):
                    yield None
                    continue
            yield (a, self.a.lengths[a]), (b, self.b.lengths[b])


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _packed(ids: np.ndarray, lengths: np.ndarray, z: zstandard.ZstdCompressor) -> tuple[int, bool, bytes]:
    """Number of events, whether they are wide, and the events: lengths, then the ids' low and high parts."""
    wide = bool(len(ids)) and (int(lengths.max()) > 255 or int(ids.max()) > 65535)
    if wide:
        raw = lengths.astype("<u4").tobytes() + ids.astype("<u4").tobytes()
    else:
        raw = lengths.astype(np.uint8).tobytes() + ids.astype("<u2").tobytes()
    return len(ids), wide, z.compress(raw)


def _unpacked(n: int, wide: bool, events: bytes, z: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray]:
    raw = z.decompress(events)
    width = 4 if wide else 1
    lengths = np.frombuffer(raw, f"<u{width}", n)
    return np.frombuffer(raw, "<u4" if wide else "<u2", n, n * width).astype(np.int64), lengths.astype(np.int64)


def events(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The end events of both sides. (part, row) names a document: the task that read it and its place there."""

    def run(batches):
        t, z = pair(path_a, path_b), zstandard.ZstdCompressor(level=1)
        part, row, names = TaskContext.get().partitionId(), 0, [f.split()[0] for f in EVENTS.split(", ")]
        held: list[tuple] = []
        for b in slices(batches, 128):
            for doc, sides in zip(b.column(0).to_pylist(), t.events(b.column(1).to_pylist()), strict=True):
                if sides is None:
                    held.append((part, row, doc, 0, 0, 0, *_packed(np.empty(0, np.int64), np.empty(0, np.int64), z)))
                for side, (ids, lengths) in enumerate(sides or ()):
                    ends = np.cumsum(lengths)
                    blocks = (ends - 1) // BLOCK
                    cuts = np.flatnonzero(np.diff(blocks, prepend=-1))
                    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)]):
                        held.append((part, row, doc, int(blocks[lo]) * BLOCK, side, int(ends[lo] - lengths[lo]), *_packed(ids[lo:hi], lengths[lo:hi], z)))
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*held), _types(EVENTS))] if held else [pa.array([], f) for f in _types(EVENTS)], names)
            held = []

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, EVENTS)


def _types(schema: str) -> list[pa.DataType]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return [kinds[f.split()[1]] for f in schema.split(", ")]


@lru_cache(maxsize=1)
def _signs(n: int) -> list[bytes]:
    """Each id in decimal with a comma, with a bar and with a semicolon after it."""
    return [b"%d%c" % (i, sign) for sign in b",|;" for i in range(n)]


class Machine:
    """Sweeps the events of one document after another; open events of the current one are all that it holds, beside its pairs."""

    def __init__(self, sizes: tuple[int, int]):
        self.size_b, self.n = sizes[1], max(sizes)
        self.begin(None)

    def begin(self, key) -> None:
        self.key, self.counts = key, [0, 0, 0, 0]
        self.open = [(np.empty(0, np.int64), np.empty(0, np.int64))] * 2
        self.digest, self.first = hashlib.sha256(), True
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def feed(self, sides: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """(ends, ids) of both sides up to an offset; sweeps to the last common end."""
        (ea, ia), (eb, ib) = ((np.concatenate([o[0], s[0]]), np.concatenate([o[1], s[1]])) if len(o[0]) else s for o, s in zip(self.open, sides, strict=True))
        over = np.searchsorted(eb, ea)  # the token of B that reaches over each end of A, or ends there
        both = over < len(eb)
        both[both] = eb[over[both]] == ea[both]
        last_a = np.flatnonzero(both)
        if not len(last_a):
            self.open = [(ea, ia), (eb, ib)]
            return
        last_b = over[last_a]
        na, nb = int(last_a[-1]) + 1, int(last_b[-1]) + 1
        self.open = [(ea[na:], ia[na:]), (eb[nb:], ib[nb:])]
        ea, ia, eb, ib, both, over = ea[:na], ia[:na], eb[:nb], ib[:nb], both[:na], over[:na]
        ends_b = np.zeros(nb, bool)
        ends_b[last_b] = True
        # links: one for each event
        alone = np.flatnonzero(~ends_b)
        links = np.concatenate([ia * self.size_b + ib[over], ia[np.searchsorted(ea, eb[alone])] * self.size_b + ib[alone]])
        self.found.append(np.unique(links, return_counts=True))
        for i, k in enumerate((na, nb, len(last_a), len(links))):
            self.counts[i] += k
        # groups: the tokens of A, then those of B
        group_a = np.cumsum(both) - both
        group_b = np.cumsum(ends_b) - ends_b
        order = np.empty(na + nb, np.int64)
        order[np.arange(na) + np.concatenate([[0], last_b[:-1] + 1])[group_a]] = ia + self.n * both
        order[np.arange(nb) + (last_a + 1)[group_b]] = ib + 2 * self.n * ends_b
        if not self.first:
            self.digest.update(b";")
        self.first = False
        self.digest.update(b"".join(map(_signs(self.n).__getitem__, order.tolist()))[:-1])

    def end(self) -> tuple:
        """The document's numbers, digest, distinct pairs and their links."""
        pairs, links = self.found[0] if len(self.found) == 1 else _summed(self.found)
        return (*self.counts, self.digest.hexdigest() if self.counts[0] else NO_TOKENS, np.diff(pairs, prepend=0).astype("<u4").tobytes(), links.astype("<u4").tobytes())


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of several parts, each key once."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, at, np.concatenate([n for _, n in parts]))
    return keys, sums


def _pairs(pairs: bytes, links: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(pairs, "<u4").astype(np.int64)), np.frombuffer(links, "<u4").astype(np.int64)


def swept(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document from its events."""
    dealt_rows = rows.repartition("part", "row").sortWithinPartitions("part", "row", "offset", "side")

    def run(batches):
        sizes = pair(path_a, path_b).sizes
        if sizes[0] * sizes[1] > 1 << 32:
            raise ValueError("the pairs of ids do not fit 32 bits")
        m, z, names = Machine(sizes), zstandard.ZstdDecompressor(), [f.split()[0] for f in SWEPT.split(", ")]
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        offset, sides, out = None, [none, none], []

        def flush():
            m.feed(sides)

        for b in batches:
            for part, row, doc, at, side, start, n, wide, content in zip(*(c.to_pylist() for c in b.columns), strict=True):
                key = (part, row, doc)
                if m.key != key or offset != at:
                    if m.key is not None:
                        flush()
                    if m.key != key:
                        if m.key is not None:
                            out.append((*m.key, *m.end()))
                        m.begin(key)
                    offset, sides = at, [none, none]
                ids, lengths = _unpacked(n, wide, content, z)
                sides[side] = start + np.cumsum(lengths), ids
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*out), _types(SWEPT))], names)
                out = []
        if m.key is not None:
            flush()
            out.append((*m.key, *m.end()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*out), _types(SWEPT))], names)

    return arrow_map(dealt_rows, run, SWEPT)


def counted(docs: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): in how many documents each id pair is linked, and whether that is its A id's highest."""

    def run(batches):
        def rows(keys, sums):
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])

        total, held = (np.empty(0, np.int64), np.empty(0, np.int64)), []
        size = 0
        for b in batches:
            for pairs, links in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys, _ = _pairs(pairs, links)
                held.append((keys, np.ones(len(keys), np.int64)))
                size += len(keys)
            if size >= COUNTED:
                total = _summed([total, *held])
                held, size = [], 0
                if len(total[0]) >= COUNTED:
                    yield rows(*total)
                    total = np.empty(0, np.int64), np.empty(0, np.int64)
        yield rows(*_summed([total, *held]))

    n = stored(arrow_map(docs.select("pairs", "links"), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    a = F.floor(F.col("pair") / size_b).alias("a")
    most = n.groupBy(a).agg(F.max("n").alias("most"))
    return stored(n.select("pair", "n", a).hint("merge").join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _by_broadcast(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """Documents with their sums, from counts that every task holds."""
    t = counts.orderBy("pair").toArrow()
    table = docs.sparkSession.sparkContext.broadcast(tuple(np.ascontiguousarray(t[c].to_numpy()) for c in ("pair", "n", "best")))
    names = docs.columns

    def run(batches):
        keys, n, best = table.value
        for b in batches:
            sums = []
            for pairs, links in zip(b.column(names.index("pairs")).to_pylist(), b.column(names.index("links")).to_pylist(), strict=True):
                p, k = _pairs(pairs, links)
                at = np.searchsorted(keys, p)
                sums.append((int(k[best[at]].sum()), int((k * n[at]).sum())))
            columns = {c: b.column(names.index(c)) for c in names} | {"n_best": pa.array([x for x, _ in sums], pa.int64()), "count_sum": pa.array([x for _, x in sums], pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in RESULT], RESULT)

    return arrow_map(docs, run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _by_join(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by joining each document's pairs with their counts."""

    def run(batches):
        for b in batches:
            for part, row, pairs, links in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                p, k = _pairs(pairs, links)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), part), pa.int32()), pa.array(np.full(len(p), row)), pa.array(p), pa.array(k)], ["part", "row", "pair", "k"])

    links = stored(arrow_map(docs.select("part", "row", "pairs", "links"), run, "part int, row long, pair long, k long"))
    met = stored(links.hint("merge").join(counts, "pair").select("part", "row", "k", "n", "best"))
    sums = met.groupBy("part", "row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"), F.sum(F.col("k") * F.col("n")).alias("count_sum"))
    return docs.join(sums, ["part", "row"], "left").na.fill(0, ["n_best", "count_sum"]).select(*RESULT)


def aligned(docs: DataFrame, path_a: str, path_b: str, most_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Alignment of every document: numbers of tokens, groups and links, how usual its links are, and the groups' digest."""
    rows = stored(swept(events(docs, path_a, path_b), path_a, path_b))
    counts = counted(rows, pair(path_a, path_b).sizes[1])
    return _by_broadcast(rows, counts) if counts.count() <= most_pairs else _by_join(rows, counts)


def op(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    return aligned(docs, path_a, path_b)
