"""Media columns: Netpbm and BMP images, area-resized, as NPY tiles with difference hashes.

``decode`` reads plain and raw PBM, PGM and PPM and uncompressed 24-bit BMP into numpy arrays.
``area_resize`` averages each target cell over its exact source area: the integral image of a
piecewise constant image is bilinear between its nodes, so reading it at fractional corners gives
exact area sums. ``difference_hash`` compares neighbouring cells of a 9 x 8 grey reduction;
``tile`` writes a reduction as NPY.

``store_texts`` keeps any text losslessly as an image: its UTF-8 bytes, padded with spaces to rows
of 64 RGB pixels, as BMP if the rows are odd in number and as PPM if they are even. The images are
written to the shared storage as a binary column; from the bytes read back come features and the
NPY tiles, which are written there too.

Defined cases: a null text counts as empty (one row of padding); equal texts give equal values;
very long texts are one tall image; a broken image has null features and says in ``error`` what is
wrong; a null image likewise; rows that repeat an id are images of their own; an empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import arrow_map, slices
from .common import stored

ROW = 192  # bytes in a row of 64 RGB pixels
TILE = 16


def encode_netpbm(pixels: np.ndarray) -> bytes:
    """Raw PGM (two axes) or PPM (three) of 8-bit samples."""
    kind = b"P5" if pixels.ndim == 2 else b"P6"
    return b"%s\n%d %d\n255\n" % (kind, pixels.shape[1], pixels.shape[0]) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def encode_bmp(pixels: np.ndarray) -> bytes:
    """Uncompressed 24-bit BMP, bottom row first."""
    h, w, _ = pixels.shape
    rows = np.zeros((h, -(-3 * w // 4) * 4), np.uint8)
    rows[:, : 3 * w] = pixels[::-1, :, ::-1].reshape(h, 3 * w)
    head = struct.pack("<2sIHHI", b"BM", 54 + rows.nbytes, 0, 0, 54)
    return head + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, rows.nbytes, 2835, 2835, 0, 0) + rows.tobytes()


def _decode_bmp(data: bytes) -> np.ndarray:
    if len(data) < 54:
        raise ValueError("BMP: cut off")
    offset, size, w, h, _, depth, packed = struct.unpack_from("<10xIIiiHHI", data)
    if max(w, abs(h)) >= 1 << 30:
        raise ValueError("BMP: broken header")
    if size < 40 or depth != 24 or packed != 0 or w <= 0 or h == 0:
        raise ValueError("BMP: only uncompressed 24-bit images")
    stride = -(-3 * w // 4) * 4
    if len(data) < offset + stride * abs(h):
        raise ValueError("BMP: cut off")
    rows = np.frombuffer(data, np.uint8, stride * abs(h), offset).reshape(abs(h), stride)[:, : 3 * w].reshape(abs(h), w, 3)[:, :, ::-1]
    return rows[::-1] if h > 0 else rows


_TOKEN = re.compile(rb"(?:\s|#[^\n\r]*)*(\d+)")


def _decode_netpbm(data: bytes) -> np.ndarray:
    kind = data[1] - 48
    at, head = 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        m = _TOKEN.match(data, at)
        if not m:
            raise ValueError("Netpbm: broken header")
        head.append(int(m[1]))
        at = m.end()
    w, h, top = (*head, 1)[:3]
    deep = 3 if kind in (3, 6) else 1
    if not w or not h or not 0 < top < 65536:
        raise ValueError("Netpbm: broken header")
    n = w * h * deep
    if (-(-w // 8) * h if kind == 4 else n) > len(data) - at:
        raise ValueError("Netpbm: cut off")
    try:
        if kind == 1:
            bits = re.sub(rb"#[^\n\r]*|\s", b"", data[at:])
            px = np.frombuffer(bits, np.uint8, n) & 1
        elif kind in (2, 3):
            px = np.array(re.sub(rb"#[^\n\r]*", b"", data[at:]).split()[:n], np.int64)
        elif kind == 4:
            stride = -(-w // 8)
            px = np.unpackbits(np.frombuffer(data, np.uint8, stride * h, at + 1).reshape(h, stride), axis=1)[:, :w].ravel()
        else:
            px = np.frombuffer(data, np.uint8 if top < 256 else ">u2", n, at + 1)
    except (ValueError, OverflowError) as short:
        raise ValueError("Netpbm: cut off") from short
    if len(px) != n:
        raise ValueError("Netpbm: cut off")
    if kind in (1, 4):
        px = (1 - px) * 255
    elif top != 255:
        px = px.astype(np.int64) * 255 // top
    px = px.astype(np.uint8, copy=False)
    return px.reshape(h, w, 3) if deep == 3 else px.reshape(h, w)


def decode(data: bytes) -> np.ndarray:
    """8-bit samples: height x width, or height x width x 3."""
    if data[:2] == b"BM":
        return _decode_bmp(data)
    if len(data) > 2 and data[:1] == b"P" and data[1:2] in b"123456":
        return _decode_netpbm(data)
    raise ValueError("neither Netpbm nor BMP")


def grey(pixels: np.ndarray) -> np.ndarray:
    if pixels.ndim == 2:
        return pixels.astype(np.int64)
    p = pixels.astype(np.int64)
    return (77 * p[:, :, 0] + 150 * p[:, :, 1] + 29 * p[:, :, 2]) >> 8


def _read_at(sums: np.ndarray, n: int) -> np.ndarray:
    """Rows of an integral image at n + 1 even cuts of its first axis, between rows linearly."""
    size = sums.shape[0] - 1
    cuts = np.arange(n + 1) * size
    lower, part = cuts // n, (cuts % n) / n
    upper = np.minimum(lower + 1, size)
    return sums[lower] + (sums[upper] - sums[lower]) * part.reshape(-1, *[1] * (sums.ndim - 1))


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over height x width cells of a grey image."""
    h, w = image.shape
    sums = np.zeros((h + 1, w + 1))
    sums[1:, 1:] = image.cumsum(0, dtype=np.int64).cumsum(1)
    cells = _read_at(_read_at(sums, height).T, width).T
    return np.diff(np.diff(cells, axis=0), axis=1) * (height * width / (h * w))


def difference_hash(image: np.ndarray) -> str:
    """64 bits as hex: whether each of 8 x 9 cells' means is below its right neighbour's."""
    cells = np.round(area_resize(image, 8, 9), 6)
    return np.packbits(cells[:, 1:] > cells[:, :-1]).tobytes().hex()


def tile(image: np.ndarray, side: int = TILE) -> bytes:
    """NPY bytes of a side x side reduction."""
    out = io.BytesIO()
    np.save(out, np.rint(area_resize(image, side, side)).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the stored image (``media``) of every text."""

    def run(batches):
        for b in slices(batches):
            sizes, media = [], []
            for t in b.column(1).to_pylist():
                raw = t or b""
                padded = raw.ljust(max(1, -(-len(raw) // ROW)) * ROW, b" ")
                sizes.append(len(raw))
                pixels = np.frombuffer(padded, np.uint8).reshape(-1, ROW // 3, 3)
                media.append(encode_bmp(pixels) if len(pixels) % 2 else encode_netpbm(pixels))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"))
    return stored(arrow_map(rows, run, "doc_id long, n_bytes long, media binary"))


FEATURES = {
    "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(),
    "tile": pa.binary(), "error": pa.string(),
}


def describe(data: bytes | None) -> tuple:
    """The values of FEATURES of one stored image."""
    stored_form = (None, None) if data is None else (len(data), hashlib.sha256(data).hexdigest())
    try:
        pixels = decode(data or b"")
    except ValueError as broken:
        return None, None, None, *stored_form, None, None, str(broken)
    payload, g = pixels.tobytes(), grey(pixels)
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), *stored_form, difference_hash(g), tile(g), None


def features(media: DataFrame) -> DataFrame:
    """doc_id and n_bytes of every row of (doc_id, n_bytes, media), with the columns of FEATURES."""

    def run(batches):
        for b in slices(batches):
            rows = [*map(describe, b.column(2).to_pylist())]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(FEATURES.values())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], ["doc_id", "n_bytes", *FEATURES])

    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return arrow_map(media.select("doc_id", "n_bytes", "media"), run, "doc_id long, n_bytes long, " + ", ".join(f"{n} {kinds[t]}" for n, t in FEATURES.items()))


def op(docs: DataFrame) -> DataFrame:
    """Digests of the stored images and of the stored tiles."""
    tiles = stored(features(store_texts(docs)))
    return tiles.withColumn("tile_sha256", F.sha2("tile", 256)).drop("tile")
