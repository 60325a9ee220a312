"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document's ids and its end id are cut into windows of ``capacity`` ids as often as they fill one;
what is left of it, fewer than that, joins a group of about ``WINDOWS`` windows. A group is
partitioned by multiway differencing: each piece starts as a partition of its own, with one filled
window and the others empty; the two partitions of the widest imbalance are merged, the fullest
windows of one with the emptiest of the other, until one partition is left, whose windows are nearly
equal. If a window exceeds the capacity, the group is partitioned anew into one window more.

Cuts make this tight: about a thirtieth of a group's ids (``capacity`` of them at least) is cut into
pieces of ``FINE`` ids, which even out the windows, and a group is closed a few ids for each window
below its windows' capacity. A task's last group has what is over its full windows cut into sequences
whose sizes are powers of two, which need no padding.

Each task packs its own rows: nothing is shuffled, no key can be hot, and a task holds one group,
so memory does not grow with the input. Ids are those of the tokenizers library, by way of a
memo of chunks (``chunks``); a text that spells an added token goes to the library whole.

Defined cases: a null or empty text is the end id alone; a very long one fills windows by itself and
its rest is one piece; rows that repeat an id are packed each on its own; a null id is passed on; other
columns are ignored; an empty table gives an empty result. ``sequence_id`` joins the task's number
and a counter, so it is unique but not dense; it is the same on a rerun over equally dealt rows.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import arrow_map, slices
from .chunks import ByteLevel, Chunks

CAPACITY = 2048
WINDOWS = 128
FINE = 16
#: Ids for each window by which a group stays below its capacity.
SLACK = 8
#: Bits of a sequence id that count within a task.
COUNTER = 40
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of the pieces of each of ``k`` windows, by largest differencing; sums of windows differ little."""
    follows = np.full(len(sizes), -1)
    heap = []
    for i, size in enumerate(sizes):
        sums, head = np.zeros(k, np.int64), np.full(k, -1)
        sums[-1], head[-1] = size, i
        heap.append((-size if k > 1 else 0, i, sums, head, head))
    heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, sums, head, tail = heappop(heap)
        _, _, other, first, last = heappop(heap)
        other, first, last = other[::-1], first[::-1], last[::-1]  # emptiest windows to the fullest
        sums = sums + other
        both = (head >= 0) & (first >= 0)
        follows[tail[both]] = first[both]
        head, tail = np.where(head >= 0, head, first), np.where(last >= 0, last, tail)
        order = np.argsort(sums, kind="stable")
        sums = sums[order] - sums[order[0]]  # only imbalances matter
        heappush(heap, (-int(sums[-1]), count, sums, head[order], tail[order]))
        count += 1
    out = []
    for i in heap[0][3].tolist() if heap else []:
        window = []
        while i >= 0:
            window.append(i)
            i = int(follows[i])
        out.append(window)
    return out


class Packer:
    """Packs what one task reads; ``rows`` are the pieces that are placed: (doc_id, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int = CAPACITY, first_sequence: int = 0, windows: int = WINDOWS):
        self.capacity, self.sequence = capacity, first_sequence
        self.full = windows * (capacity - min(SLACK, capacity - 1))
        self.group: list[tuple[int | None, int, bytes, int]] = []
        self.size = 0
        self.rows: list[tuple] = []

    def place(self, window: list[tuple[int | None, int, bytes, int]]) -> None:
        offset = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, ids, total, self.sequence, offset))
            offset += len(ids) // 4
        self.sequence += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        """The ids of one document, four bytes each."""
        n, at = len(ids) // 4, 0
        while n - at >= self.capacity:
            self.place([(doc, at, ids[4 * at : 4 * (at + self.capacity)], n)])
            at += self.capacity
        while at < n:
            end = min(n, at + self.full - self.size)
            self.group.append((doc, at, ids[4 * at : 4 * end], n))
            self.size += end - at
            at = end
            if self.size == self.full:
                self.close()

    def take(self, n: int) -> list[tuple[int | None, int, bytes, int]]:
        """Cuts the last ``n`` ids off the group."""
        out = []
        self.size -= n
        while n:
            doc, start, ids, total = self.group.pop()
            k = min(n, len(ids) // 4)
            if k < len(ids) // 4:
                self.group.append((doc, start, ids[: len(ids) - 4 * k], total))
            out.append((doc, start + len(ids) // 4 - k, ids[len(ids) - 4 * k :], total))
            n -= k
        return out[::-1]

    def close(self, last: bool = False) -> None:
        """Places the group's pieces."""
        if last:
            whole = self.size // self.capacity
            over = max(0, self.size - whole * (self.capacity - min(SLACK, self.capacity - 1)))
            while over:
                part = min(self.capacity, 1 << (over.bit_length() - 1))
                self.place(self.take(part))
                over -= part
        if self.group:
            k = -(-self.size // self.capacity)
            fine = self.take(min(self.size, max(self.size // 32, self.capacity)))
            self.group += [(doc, start + i, ids[4 * i : 4 * (i + FINE)], total) for doc, start, ids, total in fine for i in range(0, len(ids) // 4, FINE)]
            sizes = [len(ids) // 4 for _, _, ids, _ in self.group]
            windows = difference(sizes, k)
            while max(sum(sizes[i] for i in w) for w in windows) > self.capacity:
                k += 1
                windows = difference(sizes, k)
            for w in windows:
                self.place(self._joined(w))
        self.group, self.size = [], 0

    def _joined(self, window: list[int]) -> list[tuple[int | None, int, bytes, int]]:
        """The pieces of a window, those that follow one another in one document as one."""
        out = []
        for i in sorted(window):
            doc, start, ids, total = self.group[i]
            if out and i - 1 == last and out[-1][0] == doc and out[-1][1] + len(out[-1][2]) // 4 == start and start:
                out[-1] = (doc, out[-1][1], out[-1][2] + ids, total)
            else:
                out.append((doc, start, ids, total))
            last = i
        return out


class Library:
    """A byte-level tokenizer file, by way of the memo of chunks."""

    def __init__(self, path: str):
        self.tokenizer = ByteLevel(path)
        self.chunks = Chunks(lambda texts: [self.tokenizer.ask(texts)])

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        special = {i for i, t in enumerate(texts) if t and any(a in t for a in self.tokenizer.added)}
        codes = self.chunks.batch(["" if i in special else t or "" for i, t in enumerate(texts)])
        return [self.tokenizer.whole([texts[i]])[0].tobytes() if i in special else self.chunks.gather(0, c).astype("<u4").tobytes() for i, c in enumerate(codes)]


@lru_cache(maxsize=2)
def library(path: str) -> Library:
    return Library(path)


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset; with ``ids_crc32`` in place of ids if these are not wanted."""

    def run(batches):
        t = library(tokenizer_path)
        end = struct.pack("<I", end_id)
        p = Packer(capacity, TaskContext.get().partitionId() << COUNTER)

        def placed():
            doc, start, ids, total, sequence, offset = zip(*p.rows, strict=True)
            p.rows = []
            content = pa.array(ids, pa.binary()) if with_ids else pa.array([zlib.crc32(x) for x in ids], pa.int64())
            columns = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), content]
            columns += [pa.array(x, pa.int64()) for x in (total, sequence, offset)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids" if with_ids else "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for b in slices(batches, 256):
            for doc, ids in zip(b.column(0).to_pylist(), t.batch(b.column(1).to_pylist()), strict=True):
                p.add(doc, ids + end)
                if len(p.rows) >= 4096:
                    yield placed()
        p.close(last=True)
        if p.rows:
            yield placed()

    schema = SCHEMA if with_ids else SCHEMA.replace("ids binary", "ids_crc32 long")
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def op(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    return packed(docs, tokenizer_path, end_id, with_ids=False)
