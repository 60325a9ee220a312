"""The six-operation document query algebra over one long item table.

An item table has doc_id, family, ord and the nullable fields of all families (see ITEM). Families
are answered in the order outline, blocks, tables, formulas, cells, sheets, images, and inside a
family by ord. Every answer is a bounded prefix per document in that order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..limits import LIMITS
from .text import clamp, needle_of

# Order of the families in answers.
FAMILIES = ("outline", "blocks", "tables", "formulas", "cells", "sheets", "images")

ITEM = {
    "doc_id": "bigint", "family": "string", "ord": "int", "id": "string", "type": "string", "title": "string", "level": "int", "text": "string",
    "parent_id": "string", "headers": "array<string>", "rows": "array<array<string>>", "sheet": "string", "cell": "string", "value": "string",
    "formula": "string", "saved_value": "string", "status": "string", "name": "string", "alt_text": "string", "path": "string", "slide": "int",
}


def as_items(df: DataFrame, family: str) -> DataFrame:
    """A family's table with all item columns; those it lacks are null."""
    have = set(df.columns)
    cols = [F.lit(family).alias("family") if c == "family" else F.col(c).cast(t).alias(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in ITEM.items()]
    return df.select(*cols)


def family_ord() -> Column:
    return F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")).cast("int")


def first_per_doc(df: DataFrame, limit: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(family_ord(), "ord"))
    return df.withColumn("n", rank).where(F.col("n") <= limit)


def item_text(df: DataFrame | None = None) -> Column:
    """What a search looks at: the first that applies of text, title, table body, cell, formula, name, alt text.

    A table with a title is found by its title only.
    """
    is_f = F.col("family")
    body = F.concat_ws("\n", F.array_join("headers", "\t"), F.array_join(F.transform("rows", lambda r: F.array_join(r, "\t")), "\n"))
    at = F.concat("sheet", F.lit("!"), "cell", F.lit(" "))
    return (
        F.when(is_f == "blocks", F.coalesce("text", F.lit("")))
        .when(F.col("title").isNotNull(), F.col("title"))
        .when(is_f == "tables", body)
        .when(is_f == "cells", F.concat(at, F.coalesce("value", F.lit(""))))
        .when(is_f == "formulas", F.concat(at, F.coalesce("formula", F.lit("")), F.lit(" "), F.coalesce("saved_value", F.lit(""))))
        .when(is_f == "sheets", F.coalesce("name", F.lit("")))
        .otherwise(F.coalesce("alt_text", F.lit("")))
    )


def outline(items: DataFrame) -> DataFrame:
    return first_per_doc(items.where(F.col("family").isin("outline", "sheets")), LIMITS.query_items)


def search(items: DataFrame, query: str, limit: int = 20) -> DataFrame:
    hits = items.where(F.col("family").isin(*FAMILIES) & F.lower(item_text()).contains(needle_of(query)))
    return first_per_doc(hits, clamp(limit))


def blocks(items: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Items with one of the ids, in document order; repeated and unknown ids do nothing; cells and sheets have none."""
    return first_per_doc(items.where(F.col("id").isin(*dict.fromkeys(ids)) & ~F.col("family").isin("cells", "sheets")), LIMITS.query_items)


def slide(items: DataFrame, number: int, include_notes: bool = True) -> DataFrame:
    """Items of a slide; without notes only those of type note are left out."""
    hits = items.where(F.col("slide") == number)
    if not include_notes:
        hits = hits.where(~F.coalesce(F.col("type") == "note", F.lit(False)))
    return first_per_doc(hits, LIMITS.query_items)


def path(items: DataFrame, prefix: str) -> DataFrame:
    """Items whose path starts with the prefix as a string; an empty prefix takes all that have a path."""
    return first_per_doc(items.where(F.col("path").startswith(prefix)), LIMITS.query_items)


def heading_parents(blocks: DataFrame) -> DataFrame:
    """parent_id of each block: the latest heading before it; headings have none."""
    before = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    is_heading = F.col("type") == "heading"
    last = F.last(F.when(is_heading, F.col("id")), ignorenulls=True).over(before)
    return blocks.withColumn("parent_id", F.when(~F.coalesce(is_heading, F.lit(False)), last))


def heading_level(style: Column, kind: Column | None = None) -> Column:
    """Level of a heading style, or 1 for a slide title; null for no heading."""
    level = F.nullif(F.regexp_extract(style, r"(?i)heading\s*([1-9])", 1), F.lit("")).cast("int")
    return level if kind is None else F.coalesce(level, F.when(kind == "title", 1))


def slide_of(path_col: Column) -> Column:
    return F.nullif(F.regexp_extract(path_col, r"^/slide\[([0-9]+)\]", 1), F.lit("")).cast("int")


def slide_outline(items: DataFrame) -> DataFrame:
    """Outline of decks without titles: one item per slide, its first text or ``Slide n``."""
    titled = items.where(F.col("family") == "outline").select("doc_id").distinct()
    rest = items.where(F.col("slide").isNotNull()).join(titled, "doc_id", "left_anti")
    g = rest.groupBy("doc_id", "slide").agg(F.min_by("text", F.when(F.col("text") != "", F.col("ord"))).alias("t"))
    return g.select("doc_id", "slide", F.coalesce("t", F.concat(F.lit("Slide "), "slide")).alias("title"))


def table_parts(rows: Column) -> tuple[Column, Column]:
    """Headers and rows of a document table: unlike in sheets the first row is not repeated."""
    return F.get(rows, 0), F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))


def preview(outline_items: DataFrame, counts: DataFrame, limit: int = LIMITS.preview_chars) -> DataFrame:
    """Preview text per document.

    ``counts``: doc_id, kind, coverage, n_blocks, n_tables, n_formulas and warnings (array of
    messages). At most 12 outline lines and 3 warnings, 4000 characters in all.
    """
    ranked = outline_items.withColumn("k", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))).where("k <= 12")
    line = F.concat(F.repeat(F.lit("  "), F.greatest(F.col("level") - 1, F.lit(0))), "title", F.coalesce(F.concat(F.lit(" · "), "location"), F.lit("")))
    heads = ranked.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", line.alias("l")))), lambda x: x["l"]), "\n").alias("heads"))
    d = counts.join(heads, "doc_id", "left")
    sums = F.concat_ws(" · ", F.concat("n_blocks", F.lit(" blocks")), F.concat("n_tables", F.lit(" tables")), F.concat("n_formulas", F.lit(" formulas")))
    warned = F.nullif(F.array_join(F.transform(F.slice("warnings", 1, 3), lambda w: F.concat(F.lit("Warning: "), w)), "\n"), F.lit(""))
    return d.select("doc_id", F.substring(F.concat_ws("\n", F.concat("kind", F.lit(" · "), "coverage"), "heads", sums, warned), 1, limit).alias("preview"))
