"""Image sizes from file headers: PNG, GIF, JPEG, WebP."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.shipping import ship

HEAD = 256 * 1024


def dimensions(data: bytes) -> tuple[int, int] | None:
    """(width, height), or None if the header is of no known kind or cut off."""
    d = data[:HEAD]
    if d[1:4] == b"PNG" and len(d) >= 24:
        return struct.unpack(">II", d[16:24])
    if d[:6] in (b"GIF87a", b"GIF89a") and len(d) >= 10:
        return struct.unpack("<HH", d[6:10])
    if d[:2] == b"\xff\xd8":
        return _jpeg(d)
    if d[:4] == b"RIFF" and d[8:12] == b"WEBP" and len(d) >= 30:
        return _webp(d)
    return None


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def _sizes(heads: pd.Series) -> pd.DataFrame:
    found = [dimensions(bytes(h)) if h is not None else None for h in heads]
    return pd.DataFrame({k: pd.array([None if f is None else f[i] for f in found], dtype="Int32") for i, k in enumerate(("width", "height"))})


def with_dimensions(files: DataFrame, content: Column) -> DataFrame:
    """Adds width and height of each image, null where the header tells none; no more than the head of a file reaches Python."""
    ship(files.sparkSession)
    return files.withColumn("__s", _sizes(F.substring(content, 1, HEAD))).withColumns({"width": F.col("__s.width"), "height": F.col("__s.height")}).drop("__s")


def _jpeg(d: bytes) -> tuple[int, int] | None:
    frames = {*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC}
    at = 2
    while at + 9 < len(d):
        if d[at] != 0xFF:
            at += 1
        elif d[at + 1] in (0xD8, 0xD9):
            at += 2
        else:
            size = int.from_bytes(d[at + 2 : at + 4])
            if size < 2 or at + 2 + size > len(d):
                return None
            if d[at + 1] in frames:
                height, width = struct.unpack(">HH", d[at + 5 : at + 9])
                return width, height
            at += 2 + size
    return None


def _webp(d: bytes) -> tuple[int, int] | None:
    kind = d[12:16]
    if kind == b"VP8X":
        return 1 + int.from_bytes(d[24:27], "little"), 1 + int.from_bytes(d[27:30], "little")
    if kind == b"VP8L" and d[20] == 0x2F:
        bits = int.from_bytes(d[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    if kind == b"VP8 " and d[23:26] == b"\x9d\x01\x2a":
        w, h = struct.unpack("<HH", d[26:30])
        return w & 0x3FFF, h & 0x3FFF
    return None
