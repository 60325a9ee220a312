"""Byte-level BPE encoding and decoding with given merge ranks.

A text is split by the tokenizer's pattern; each piece is merged on its own. Merging keeps the
parts of a piece as a linked list over byte positions and the mergeable pairs in a rank queue:
one bucket of positions per merge rank and a two-level bitmap of the non-empty buckets, whose
lowest set bit (find-first-set on each level) is the next rank to merge. A merge changes two
neighbouring pairs; their old entries stay in the buckets and are skipped as stale when met. So a
piece of n bytes takes O(n) queue steps and a piece of megabytes costs no more per byte than a
short one.

Pieces repeat a lot, so their ids are kept in a bounded memo per worker. The memo works on
whitespace-delimited chunks: no piece of the pattern continues from a non-space into a space, so
chunks can be encoded one by one. A line's first word goes with the line end before it, as that is
a piece of its own unless more than two of them, or one at the end of the text, come together.

Defined cases: a null text counts as empty; an empty text has no ids; very long texts are encoded
whole; rows that repeat an id are encoded one by one; special tokens are never made, their spelling
is ordinary text; an empty table gives an empty result. Other columns pass through ``encode`` and
``decode``, whose new columns must not exist.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import arrow_map, slices

#: White space as the tokenizer library's regex engine has it (Unicode White_Space).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Entries of each memo in a worker, and the longest text that is kept: about 220 MB at most.
MEMO = 450_000
MEMO_CHARS = 48


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO):
        self.ranks, self.most = ranks, memo
        self.n = max(ranks.values()) + 1
        self.vocab = [b""] * self.n
        for token, rank in ranks.items():
            self.vocab[rank] = token
        self.words = [0] * ((self.n >> 8) + 1)
        spaces = pattern.replace("[^\\s", f"[^{SPACE}").replace("\\s", f"[{SPACE}]").replace("\\S", f"[^{SPACE}]")
        self.pieces = regex.compile(spaces).findall
        self.chunks = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.uneven = re.compile(f" [{SPACE}]|[{SPACE}] |\\n\\n(?:[{SPACE}]|\\Z)|[{SPACE}]\\n\\n").search
        self.spaced = _Memo(self, " ")
        self.plain = _Memo(self, "")
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece. The queue is written out here, as its steps are the whole cost.

        ``words[w]`` has a bit for each rank 256 * w + bit whose bucket holds positions, ``top`` a
        bit for each non-zero word; both are empty again when a piece is done. Buckets are heaps,
        as equal pairs merge from left to right.
        """
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 1))  # a part is named by its start; end[start] is the next part's start
        prev = list(range(-1, n))
        pair = [-1] * n  # rank of the pair that starts here, -1 for none
        words, buckets, top = self.words, {}, 0
        for i in range(n - 1):
            rank = rank_of(piece[i : i + 2])
            if rank is not None:
                pair[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    w = rank >> 8
                    words[w] |= 1 << (rank & 255)
                    top |= 1 << w
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            rank = (w << 8) + (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[w] = word = word & (word - 1)
                if not word:
                    top &= top - 1
            if pair[i] != rank:
                continue  # stale
            j = end[i]
            k = end[i] = end[j]
            pair[j] = pair[i] = -1
            prev[k] = i
            p = prev[i]
            for at, new in ((i, rank_of(piece[i : end[k]]) if k < n else None), (p, rank_of(piece[p:k]) if p >= 0 else None)):
                if new is not None:
                    pair[at] = new
                    if new in buckets:
                        heappush(buckets[new], at)
                    else:
                        buckets[new] = [at]
                        w = new >> 8
                        words[w] |= 1 << (new & 255)
                        top |= 1 << w
                elif at >= 0:
                    pair[at] = -1
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def piece(self, text: str) -> bytes:
        """Ids of one piece by way of the memo of pieces."""
        found = self.known.get(text)
        if found is None:
            ids = self.merge(text.encode())
            found = pack(f"<{len(ids)}I", *ids)
            if len(text) <= MEMO_CHARS and len(self.known) < self.most:
                self.known[text] = found
        return found

    def chunk(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.pieces(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.uneven(text):
            return b"".join(map(self.plain.__getitem__, self.chunks(text)))
        first, *rest = text.replace("\n", " \n").split(" ")
        return (self.plain[first] if first else b"") + b"".join(map(self.spaced.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Memo(dict):
    """Chunk -> ids; ``lead`` is put before each chunk."""

    def __init__(self, encoder: Encoder, lead: str):
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, text: str) -> bytes:
        e = self.encoder
        lead = "" if text[:1] == "\n" else self.lead
        ids = b"".join(map(e.chunk, e.chunks(lead + text)))
        if len(text) <= MEMO_CHARS and len(self) < e.most:
            self[text] = ids
        return ids


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, memo: int = MEMO) -> Encoder:
    with open(path, "rb") as f:
        rows = (line.split() for line in f if line.strip())
        return Encoder({base64.b64decode(a): int(b) for a, b in rows}, pattern, memo)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", whole_col: str | None = None, memo: int = MEMO) -> DataFrame:
    """All columns plus ``ids_col``: the ids as binary (little-endian unsigned 32-bit).

    ``whole_col`` names one more column: whether decoding the ids gives the text back. ``memo``
    bounds the entries of each memo of a worker, for jobs that need its memory for other things.
    """
    names = docs.columns
    where = names.index(text_col)
    new = [ids_col, *([whole_col] if whole_col else [])]
    if set(new) & set(names):
        raise ValueError(f"a column of {new} exists already")

    def run(batches):
        e = encoder(path, pattern, memo)
        for b in slices(batches):
            texts = b.column(where).to_pylist()
            ids = [e.encode(t) for t in texts]
            more = [pa.array(ids, pa.binary())]
            if whole_col:
                more.append(pa.array([e.decode(i) == (t or "").encode() for t, i in zip(texts, ids, strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*names, *new])

    added = [T.StructField(ids_col, T.BinaryType()), *([T.StructField(whole_col, T.BooleanType())] if whole_col else [])]
    return arrow_map(docs, run, T.StructType([*docs.schema.fields, *added]))


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """All columns plus ``bytes_col``: the bytes that the ids stand for."""
    names = rows.columns
    where = names.index(ids_col)
    if bytes_col in names:
        raise ValueError(f"a column {bytes_col} exists already")

    def run(batches):
        e = encoder(path, pattern)
        for b in slices(batches):
            out = pa.array([None if i is None else e.decode(i) for i in b.column(where).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, out], [*names, bytes_col])

    return arrow_map(rows, run, T.StructType([*rows.schema.fields, T.StructField(bytes_col, T.BinaryType())]))


def op(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of encoding and decoding: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        e = encoder(path, pattern)
        for b in slices(batches):
            counts, ids_sha, text_sha = [], [], []
            for t in b.column(1).to_pylist():
                ids = e.encode(t)
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(e.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
