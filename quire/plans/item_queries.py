"""Queries of the item algebra: conversations as decks (a turn is a slide), documents, pages and nations as other families."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import items
from ..sources.tables import table


def _blocks(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "heading").when(F.col("role") == "system", "note").otherwise("paragraph")
    return c.select(
        F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("ord"), F.concat(F.lit("block-"), F.col("turn").cast("string")).alias("id"), kind.alias("type"),
        "text", F.col("turn").cast("int").alias("slide"), F.concat(F.lit("/slide["), F.col("turn").cast("string"), F.lit("]")).alias("path"),
    )


def _items(spark, sf_dir):
    b = _blocks(spark, sf_dir)
    heads = b.where("type = 'heading'").select("doc_id", "ord", "id", F.substring("text", 1, 40).alias("title"), F.lit(1).alias("level"), "slide", "path")
    n = table(spark, sf_dir, "nation")
    grid = n.select(F.col("n_regionkey").cast("bigint").alias("doc_id"), F.col("n_nationkey").alias("ord"), F.lit("nation").alias("sheet"), F.concat(F.lit("A"), F.col("n_nationkey") + 1).alias("cell"), F.col("n_name").alias("value"))
    sheets = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("doc_id"), F.lit(0).alias("ord"), F.col("r_name").alias("name"))
    parts = [items.as_items(d, f) for d, f in ((heads, "outline"), (b, "blocks"), (grid, "cells"), (sheets, "sheets"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SHOWN = ("doc_id", "family", "ord", "id", "type", "title", "text", "value", "name", "n")


def items_outline(spark, sf_dir):
    return items.outline(_items(spark, sf_dir)).select(*_SHOWN)


def items_search(spark, sf_dir):
    return items.search(_items(spark, sf_dir), " An", 20).select(*_SHOWN)


def items_blocks(spark, sf_dir):
    return items.blocks(_items(spark, sf_dir), ["block-2", "block-0", "block-2", "none"]).select(*_SHOWN)


def items_slide(spark, sf_dir):
    return items.slide(_items(spark, sf_dir), 1, include_notes=False).select(*_SHOWN)


def items_path(spark, sf_dir):
    return items.path(_items(spark, sf_dir), "/slide[1").select(*_SHOWN)


def heading_parent(spark, sf_dir):
    return items.heading_parents(_blocks(spark, sf_dir)).select("doc_id", "ord", "type", "parent_id")


def slide_outline(spark, sf_dir):
    b = _blocks(spark, sf_dir).where("doc_id is not null")
    deck = b.where("doc_id % 2 <> 0").groupBy("doc_id").agg(F.min("ord").alias("ord"))
    titles = deck.select("doc_id", "ord", F.concat(F.lit("Deck "), F.col("doc_id").cast("string")).alias("title"), F.lit(1).alias("level"))
    return items.slide_outline(items.as_items(titles, "outline").unionByName(items.as_items(b, "blocks")))


_B = """SELECT conv_id AS doc_id, CAST(turn AS INTEGER) AS ord, 'block-' || turn AS id,
       CASE role WHEN 'user' THEN 'heading' WHEN 'system' THEN 'note' ELSE 'paragraph' END AS type, text, CAST(turn AS INTEGER) AS slide, '/slide[' || turn || ']' AS path FROM conversations"""
_I = f"""WITH b AS ({_B}), i AS (
SELECT doc_id, 'outline' AS family, 1 AS fo, ord, id, CAST(NULL AS VARCHAR) AS type, substr(text, 1, 40) AS title, CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS name, slide, path, substr(text, 1, 40) AS seen FROM b WHERE type = 'heading'
UNION ALL SELECT doc_id, 'blocks', 2, ord, id, type, NULL, text, NULL, NULL, slide, path, coalesce(text, '') FROM b
UNION ALL SELECT n_regionkey, 'cells', 5, n_nationkey, NULL, NULL, NULL, NULL, n_name, NULL, NULL, NULL, 'nation!A' || (n_nationkey + 1) || ' ' || n_name FROM nation
UNION ALL SELECT r_regionkey, 'sheets', 6, 0, NULL, NULL, NULL, NULL, NULL, r_name, NULL, NULL, r_name FROM region)"""


def _answer(where: str, limit: int = 2000) -> str:
    return f"""{_I} SELECT doc_id, family, ord, id, type, title, text, value, name, n FROM
(SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY fo, ord) AS INTEGER) AS n FROM i WHERE {where}) WHERE n <= {limit}"""


QUERIES = {f.__name__: f for f in (items_outline, items_search, items_blocks, items_slide, items_path, heading_parent, slide_outline)}
ORACLES = {
    "items_outline": _answer("family IN ('outline', 'sheets')"),
    "items_search": _answer("contains(lower(seen), 'an')", 20),
    "items_blocks": _answer("id IN ('block-2', 'block-0', 'none')"),
    "items_slide": _answer("slide = 1 AND (type IS NULL OR type <> 'note')"),
    "items_path": _answer("starts_with(path, '/slide[1')"),
    "heading_parent": f"""
SELECT doc_id, ord, type, CASE WHEN type <> 'heading' THEN last_value(CASE WHEN type = 'heading' THEN id END IGNORE NULLS)
       OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS parent_id FROM ({_B})""",
    "slide_outline": f"SELECT doc_id, slide, coalesce(arg_min(text, ord) FILTER (WHERE text <> ''), 'Slide ' || slide) AS title FROM ({_B}) WHERE doc_id % 2 = 0 GROUP BY doc_id, slide",
}
