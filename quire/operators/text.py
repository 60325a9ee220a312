"""Line operators over a text column (keyed by ``doc_id``).

Every function takes a DataFrame with ``doc_id`` and ``text`` and stays in built-in expressions.
Lines are split at ``\\r?\\n`` with trailing empties kept; line numbers start at 1. Null texts have
no lines and give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import SPACE_CLASS, is_blank, js_trim, trim_all, utf16_prefix
from ..limits import LIMITS, QueryError


def lines_of(text: Column) -> Column:
    return F.split(text, "\r?\n", -1)


def lines(docs: DataFrame) -> DataFrame:
    """One row per line: doc_id, line_no, line."""
    return docs.select("doc_id", F.posexplode(lines_of(F.col("text"))).alias("p", "line")).select(
        "doc_id", (F.col("p") + 1).alias("line_no"), "line"
    )


def clamp(limit: int | None, most: int = LIMITS.search_items, default: int = 20) -> int:
    return max(1, min(most, default if limit is None else limit))


def needle_of(query: str) -> str:
    key = js_trim(query).lower()
    if is_blank(key):
        raise QueryError("BAD_REQUEST", "empty search text")
    return key


def search(docs: DataFrame, query: str, limit: int | None = None) -> DataFrame:
    """First ``limit`` (clamped to 1..50) lines per document that contain the needle.

    A needle without line breaks can only match inside one line, so whole documents are
    filtered before the explode. A blank needle is an error.
    """
    key = needle_of(query)
    if "\n" not in key and "\r" not in key:
        docs = docs.where(F.lower("text").contains(key))
    hits = lines(docs).where(F.lower("line").contains(key))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no"))
    return hits.withColumn("hit", rank).where(F.col("hit") <= clamp(limit))


def positive(value: int | None, default: int) -> int:
    n = default if value is None else value
    if isinstance(n, bool) or not isinstance(n, int) or n < 1:
        raise QueryError("BAD_REQUEST", "line numbers are positive integers")
    return n


def text_range(docs: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Lines start..end of each document, at most 400; past the last line it is an error of that document."""
    first = positive(start, 1)
    wanted = positive(end, first + LIMITS.text_lines - 1)
    if wanted < first:
        raise QueryError("BAD_REQUEST", "the end lies before the start")
    ls = lines_of(F.col("text"))
    total = F.size(ls)
    last = F.least(F.lit(min(wanted, first + LIMITS.text_lines - 1)), total)
    inside = total >= first
    return docs.where(F.col("text").isNotNull()).select(
        "doc_id",
        F.when(inside, F.array_join(F.slice(ls, first, F.greatest(last - first + 1, F.lit(0))), "\n")).alias("text"),
        F.lit(first).alias("line_start"),
        F.when(inside, last).alias("line_end"),
        total.alias("total_lines"),
        F.when(inside, last < total).alias("truncated"),
        F.when(inside & (last < total), last + 1).alias("next_line_start"),
        F.when(~inside, F.lit("BAD_REQUEST")).alias("error"),
    )


def outline(docs: DataFrame) -> DataFrame:
    """Headings of each document; documents without any get windows of 200 lines. Fenced code is not skipped."""
    pattern = f"^(#{{1,6}})[{SPACE_CLASS}]+([^\\n\\r\\u2028\\u2029]+)\\z"
    found = lines(docs.where(F.col("text").contains("#"))).where(F.col("line").rlike(pattern))
    headings = found.select(
        "doc_id",
        F.col("line_no").alias("line"),
        F.concat(F.lit("lines:"), "line_no", F.lit("-"), "line_no").alias("id"),
        trim_all(F.regexp_extract("line", pattern, 2)).alias("title"),
        F.length(F.regexp_extract("line", pattern, 1)).alias("level"),
    )
    rest = docs.where(F.col("text").isNotNull()).join(headings.select("doc_id").distinct(), "doc_id", "left_anti")
    total, step = F.size(lines_of(F.col("text"))), LIMITS.outline_window
    windows = rest.select("doc_id", total.alias("n")).select("doc_id", "n", F.explode(F.sequence(F.lit(1), F.col("n"), F.lit(step))).alias("line"))
    end = F.least("n", F.col("line") + (step - 1))
    windows = windows.select(
        "doc_id", "line", F.concat(F.lit("lines:"), "line", F.lit("-"), end).alias("id"),
        F.concat(F.lit("第 "), "line", F.lit("-"), end, F.lit(" 行")).alias("title"), F.lit(1).alias("level"),
    )
    return headings.unionByName(windows)


_BLOCK = re.compile(r"lines:([1-9][0-9]*)-([1-9][0-9]*)")


def block_bounds(block_id: str) -> tuple[int, int]:
    m = _BLOCK.fullmatch(block_id)
    if not m or int(m[2]) < int(m[1]):
        raise QueryError("BAD_REQUEST", f"no text block {block_id}")
    return int(m[1]), int(m[2])


def blocks(docs: DataFrame, ids: Sequence[str], budget: int = LIMITS.block_lines) -> DataFrame:
    """Line blocks in request order, repeats allowed; all of a request share a budget of 2000 lines.

    What a block gets depends on what those before it took, so the request is folded once per document.
    """
    asked = [(i, *block_bounds(i)) for i in ids]
    if not asked:
        return docs.limit(0).select("doc_id", F.lit(0).alias("ord"), F.lit("").alias("id"), "text", F.lit(0).alias("line_start"), F.lit(0).alias("line_end"))
    request = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, a, b in asked])
    kind = "struct<left:int,got:array<struct<id:string,a:int,e:int>>>"

    def take(acc: Column, x: Column) -> Column:
        e = F.least(x["b"], x["a"] + acc["left"] - 1, F.col("n"))
        row = F.struct(x["id"].alias("id"), x["a"].alias("a"), e.alias("e"))
        return F.struct((acc["left"] - F.greatest(F.lit(0), e - x["a"] + 1)).alias("left"), F.concat(acc["got"], F.array(row)).alias("got")).cast(kind)

    start = F.struct(F.lit(budget).alias("left"), F.array().cast("array<struct<id:string,a:int,e:int>>").alias("got")).cast(kind)
    d = docs.where(F.col("text").isNotNull()).select("doc_id", lines_of(F.col("text")).alias("ls")).withColumn("n", F.size("ls"))
    d = d.select("doc_id", "ls", F.posexplode(F.aggregate(request, start, take)["got"]).alias("p", "x"))
    part = F.array_join(F.slice("ls", F.col("x.a"), F.greatest(F.col("x.e") - F.col("x.a") + 1, F.lit(0))), "\n")
    return d.select("doc_id", (F.col("p") + 1).alias("ord"), F.col("x.id").alias("id"), part.alias("text"), F.col("x.a").alias("line_start"), F.col("x.e").alias("line_end"))


def preview(docs: DataFrame, chars: int = LIMITS.preview_chars) -> DataFrame:
    """The first 4000 UTF-16 units of each text, never half a surrogate pair."""
    return docs.where(F.col("text").isNotNull()).select("doc_id", utf16_prefix(F.col("text"), chars).alias("preview"))


def primary_read(docs: DataFrame, query: str | None = None, start: int | None = None, end: int | None = None, limit: int | None = None) -> DataFrame:
    """A text's default read: a search if a query is given, else a line range."""
    return search(docs, query, limit) if query is not None else text_range(docs, start, end)


def admission(files: DataFrame, most: int = LIMITS.file_bytes) -> DataFrame:
    """Text of each file (``content``) or the reason against it: size, emptiness, NUL, encoding. A BOM is dropped."""
    bare = F.when(F.expr("startswith(content, X'EFBBBF')"), F.expr("substring(content, 4)")).otherwise(F.col("content"))
    valid = F.expr("is_valid_utf8(cast(content as string))")
    reason = (
        F.when(F.octet_length("content") > most, "FILE_TOO_LARGE")
        .when(F.octet_length("content") == 0, "BAD_REQUEST")
        .when(F.expr("contains(content, X'00')"), "TEXT_ENCODING_UNSUPPORTED")
        .when(~valid, "TEXT_ENCODING_UNSUPPORTED")
    )
    return files.withColumn("reason", reason).withColumn("text", F.when(F.col("reason").isNull(), F.decode(bare, "UTF-8")))
