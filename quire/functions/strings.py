"""String helpers whose semantics differ between hosts (trimming, code units)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that is trimmed at both ends (Unicode spaces, line ends and BOM).
SPACE_CLASS = "\\t\\n\\x0b\\f\\r \\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff"
SPACES = "\t\n\x0b\f\r \xa0                　﻿"


def js_trim(text: str) -> str:
    return text.strip(SPACES)


def is_blank(text: str | None) -> bool:
    return not text or not js_trim(text)


def trim_all(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+\\z", "")


def utf16_length(c: Column) -> Column:
    """Length in UTF-16 code units."""
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def utf16_prefix(c: Column, units: int) -> Column:
    """The first ``units`` UTF-16 code units; a pair that would be cut in half is left out.

    The prefix of ``units`` code points is enough to look at, and has at most twice the units. A
    character beyond the basic plane counts twice: the running count is folded once per text that
    has any, and all others are cut directly.
    """
    head = F.substring(c, 1, units)
    over = utf16_length(head) > units
    chars = F.split(head, "")
    kind = "struct<n:int,k:int>"
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("k")).cast(kind)

    def step(acc: Column, ch: Column) -> Column:
        width = F.when(F.octet_length(ch) == 4, 2).otherwise(1)
        fits = acc["n"] + width <= units
        return F.struct((acc["n"] + width).alias("n"), F.when(fits, acc["k"] + 1).otherwise(acc["k"]).alias("k")).cast(kind)

    return F.when(over, F.substr(head, F.lit(1), F.aggregate(chars, start, step)["k"])).otherwise(head)


def leaf(path: Column) -> Column:
    """What follows the last slash or backslash."""
    return F.regexp_extract(path, r"([^/\\]*)\z", 1)


def extension(name: Column) -> Column:
    """Lower-case extension with its dot; a leading dot alone makes none."""
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]*)\z", 1))
