"""Spreadsheet cells: addresses, ranges, row blocks, headers, formulas.

A cell table has doc_id, sheet, row_no, col_no, value (all values are text) and, where known, cell,
formula and saved_value.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..limits import LIMITS, QueryError

_A1 = re.compile(r"([A-Z]{1,3})([1-9][0-9]*)")


@lru_cache(1 << 14)
def parse_a1(address: str) -> tuple[int, int]:
    """(row, column) of an A1 address, in any case."""
    m = _A1.fullmatch(address.upper())
    if not m:
        raise QueryError("PARSER_OUTPUT_INVALID", f"no cell {address}")
    column = 0
    for c in m[1]:
        column = column * 26 + ord(c) - 64
    return int(m[2]), column


def parse_range(text: str) -> tuple[int, int, int, int]:
    """(first row, first column, last row, last column); a missing end is the start, corners may be swapped."""
    start, _, rest = text.partition(":")
    r1, c1 = parse_a1(start)
    r2, c2 = parse_a1(rest.partition(":")[0]) if ":" in text else (r1, c1)
    return min(r1, r2), min(c1, c2), max(r1, r2), max(c1, c2)


def column_name(n: int) -> str:
    out = ""
    while n > 0:
        n, k = divmod(n - 1, 26)
        out = chr(65 + k) + out
    return out


def column_letters(n: Column) -> Column:
    """Letters of a column number of any size; null for numbers below 1. (Addresses themselves have three letters at most.)"""
    digit = lambda x: F.chr(F.lit(65) + F.pmod(x, F.lit(26)))
    letters, first, power = [], 1, 1  # numbers from ``first`` on have one letter more
    for _ in range(7):
        letters.insert(0, F.when(n >= first, digit(F.floor((n - first) / power))).otherwise(""))
        power *= 26
        first += power
    return F.when(n >= 1, F.concat(*letters))


def a1(row: Column, col: Column) -> Column:
    return F.concat(column_letters(col), row.cast("string"))


def row_of(address: Column) -> Column:
    return F.regexp_extract(F.upper(address), "^[A-Z]{1,3}([1-9][0-9]*)$", 1).try_cast("int")


def column_of(address: Column) -> Column:
    """Column number of an address column, null if it is none (more than three letters are none)."""
    letters = F.regexp_extract(F.upper(address), "^([A-Z]{1,3})[1-9][0-9]*$", 1)
    at = lambda i: F.ascii(F.substring(letters, i, 1)) - 64
    n = F.length(letters)
    return F.when(n == 1, at(1)).when(n == 2, at(1) * 26 + at(2)).when(n == 3, at(1) * 676 + at(2) * 26 + at(3))


def within(df: DataFrame, sheet: str, where: str) -> DataFrame:
    r1, c1, r2, c2 = parse_range(where)
    return df.where((F.col("sheet") == sheet) & F.col("row_no").between(r1, r2) & F.col("col_no").between(c1, c2))


def spreadsheet_range(cells: DataFrame, formulas: DataFrame | None, sheet: str, where: str, limit: int = LIMITS.query_items) -> DataFrame:
    """Cells of the range, then formulas of it, the first 2000 in total per document."""
    names = ("doc_id", "sheet", "row_no", "col_no")
    items = cells.select(F.lit("cells").alias("family"), *names, "value", F.lit(None).cast("string").alias("formula"))
    if formulas is not None:
        items = items.unionByName(formulas.select(F.lit("formulas").alias("family"), *names, F.lit(None).cast("string").alias("value"), "formula"))
    return items_range(items, sheet, where, limit)


def items_range(items: DataFrame, sheet: str, where: str, limit: int = LIMITS.query_items) -> DataFrame:
    """The same of one table of items, families cells and formulas, which is read once."""
    is_cell = F.col("family") == "cells"
    picked = within(items, sheet, where).select(
        "doc_id", F.when(is_cell, 5).otherwise(6).alias("family_ord"), "sheet", "row_no", "col_no", F.when(is_cell, F.col("value")).alias("value"), F.when(~is_cell, F.col("formula")).alias("formula")
    )
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("family_ord", "row_no", "col_no"))
    return picked.withColumn("ord", rank).where(F.col("ord") <= limit).withColumn("cell", a1(F.col("row_no"), F.col("col_no")))


def unpivot(rows: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Rows (doc_id, sheet, row_no, fields) to cells; empty ones stay out unless asked for."""
    cells = rows.select("doc_id", "sheet", "row_no", F.posexplode("fields").alias("p", "value")).select("doc_id", "sheet", "row_no", (F.col("p") + 1).alias("col_no"), "value")
    return cells if keep_empty else cells.where(F.col("value") != "")


def used_range(cells: DataFrame) -> DataFrame:
    g = cells.groupBy("doc_id", "sheet").agg(F.max("row_no").alias("rows"), F.max("col_no").alias("cols"))
    return g.withColumn("range", F.concat(F.lit("A1:"), a1(F.col("rows"), F.col("cols"))))


def dense_rows(cells: DataFrame) -> DataFrame:
    """One row per present sheet row: its fields up to the sheet's widest column, missing ones empty. Of two values of one cell the greater counts."""
    width = cells.groupBy("doc_id", "sheet").agg(F.max("col_no").alias("w"))
    row = F.sort_array(F.collect_list(F.struct("col_no", "value")))
    rows = cells.groupBy("doc_id", "sheet", "row_no").agg(row.alias("s"))
    last = F.filter("s", lambda x, i: F.coalesce(F.get(F.col("s"), i + 1)["col_no"] != x["col_no"], F.lit(True)))
    rows = rows.select("doc_id", "sheet", "row_no", F.map_from_entries(last).alias("m"))
    fields = F.transform(F.sequence(F.lit(1), F.col("w")), lambda c: F.coalesce(F.element_at(F.col("m"), c), F.lit("")))
    return rows.join(width, ["doc_id", "sheet"]).select("doc_id", "sheet", "row_no", fields.alias("fields"))


def row_blocks(rows: DataFrame, size: int = LIMITS.rows_per_block) -> DataFrame:
    """Tables of 500 present rows each: headers (the sheet's first row), rows (header included), first and last row number.

    A sheet's rows are numbered in one window per sheet; a block never holds more than ``size`` rows.
    """
    order = Window.partitionBy("doc_id", "sheet").orderBy("row_no")
    d = rows.withColumn("n", F.row_number().over(order)).withColumn("headers", F.first("fields").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    d = d.withColumn("block", F.floor((F.col("n") - 1) / size).cast("int"))
    g = d.groupBy("doc_id", "sheet", "block").agg(
        F.min_by("headers", "row_no").alias("headers"), F.sort_array(F.collect_list(F.struct("row_no", "fields"))).alias("s"),
        F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row"),
    )
    return g.select("doc_id", "sheet", "block", header_fallback(F.col("headers")).alias("headers"), F.transform("s", lambda x: x["fields"]).alias("rows"), "first_row", "last_row")


def header_fallback(headers: Column, width: Column | None = None) -> Column:
    """Missing header cells take their column's letters; an empty header stays empty."""
    n = F.size(headers) if width is None else width
    return F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda c: F.coalesce(F.get(headers, c - 1), column_letters(c)))


def formula_status(formula: Column, saved: Column, shared: Column) -> Column:
    """What is known of a formula cell's value. Nothing is ever recalculated."""
    bare = F.when(saved.isNotNull(), "SAVED_VALUE_ONLY").otherwise("UNSUPPORTED_FORMULA")
    return F.when(shared | formula.isNull(), bare).when(saved.isNull(), "FORMULA_ONLY").otherwise("SAVED_CACHE")


def resolve_shared(cells: DataFrame, strings: DataFrame) -> DataFrame:
    """Replaces indices of type-s cells by the shared strings of their document; unknown ones become empty."""
    s = strings.select(F.col("doc_id").alias("__d"), F.col("idx").alias("__i"), F.col("string").alias("__s"))
    is_shared = F.col("type") == "s"
    on = (F.col("doc_id") == F.col("__d")) & is_shared & (F.col("value").try_cast("int") == F.col("__i"))
    out = cells.join(s, on, "left")
    return out.withColumn("value", F.when(is_shared, F.coalesce("__s", F.lit(""))).otherwise(F.col("value"))).drop("__d", "__i", "__s")


def number_format(cells: DataFrame, xfs: DataFrame, formats: DataFrame) -> DataFrame:
    """Number format of each cell's style: the custom code, or builtin:<id>."""
    d = cells.join(xfs, ["doc_id", "style"], "left").join(formats, ["doc_id", "format_id"], "left")
    return d.withColumn("number_format", F.coalesce("code", F.when(F.col("format_id").isNotNull(), F.concat(F.lit("builtin:"), "format_id"))))
