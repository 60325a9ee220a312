"""Queries over tables read as sheets: one workbook per order month, nations as a sheet."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cells
from ..sources.tables import table


def _rows(spark, sf_dir):
    """Orders as sheet rows: one sheet per priority, row numbers by key, an empty field for status P."""
    o = table(spark, sf_dir, "orders")
    fields = F.array(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")))
    return o.select(F.lit(1).alias("doc_id"), F.col("o_orderpriority").alias("sheet"), F.col("o_orderkey").cast("int").alias("row_no"), fields.alias("fields"))


def csv_cells(spark, sf_dir):
    c = cells.unpivot(_rows(spark, sf_dir))
    return c.withColumn("cell", cells.a1(F.col("row_no"), F.col("col_no")))


def sheet_range(spark, sf_dir):
    return cells.spreadsheet_range(cells.unpivot(_rows(spark, sf_dir)), None, "1-URGENT", "c400:A20")


def sheet_used_range(spark, sf_dir):
    return cells.used_range(cells.unpivot(_rows(spark, sf_dir)))


def sheet_row_blocks(spark, sf_dir):
    b = cells.row_blocks(_rows(spark, sf_dir))
    return b.select("doc_id", "sheet", "block", "headers", "first_row", "last_row", F.size("rows").alias("n_rows"), F.element_at("rows", -1).alias("last_fields"))


def sheet_dense_rows(spark, sf_dir):
    return cells.dense_rows(cells.unpivot(_rows(spark, sf_dir)))


def sheet_header_fallback(spark, sf_dir):
    n = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_name")).alias("h"))
    return n.select("n_regionkey", cells.header_fallback(F.slice("h", 1, 3), F.lit(30)).alias("headers"))


def sheet_column_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    back = cells.column_of(F.concat(cells.column_letters(F.col("p_partkey")), F.lit("7")))
    return p.select("p_partkey", cells.column_letters(F.col("p_partkey")).alias("letters"), back.cast("bigint").alias("back"))


def shared_string_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    strings = p.where("p_partkey % 3 <> 0").select(F.lit(1).alias("doc_id"), F.col("p_partkey").cast("int").alias("idx"), F.col("p_name").alias("string"))
    grid = p.select(F.lit(1).alias("doc_id"), F.col("p_partkey").alias("row_no"), F.when(F.col("p_size") % 2 == 0, "s").otherwise("n").alias("type"), F.col("p_partkey").cast("string").alias("value"))
    return cells.resolve_shared(grid, strings).select("row_no", "type", "value")


def number_formats(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.lit(1).alias("doc_id"), "p_partkey", F.col("p_size").alias("style"))
    xfs = p.select("doc_id", "style", (F.col("style") % 20).alias("format_id")).where("style % 4 <> 0").distinct()
    codes = xfs.where("format_id > 10").select("doc_id", "format_id", F.concat(F.lit("0.0"), "format_id").alias("code")).distinct()
    return cells.number_format(p, xfs, codes).select("p_partkey", "number_format")


def formula_status(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    formula = F.when(F.col("l_orderkey") % 3 != 0, F.concat(F.lit("=A"), "l_linenumber"))
    saved = F.when(F.col("l_partkey") % 2 == 0, F.col("l_quantity").cast("int").cast("string"))
    status = cells.formula_status(formula, saved, F.col("l_suppkey") % 5 == 0)
    return li.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


_ROWS = """SELECT 1 AS doc_id, o_orderpriority AS sheet, CAST(o_orderkey AS INTEGER) AS row_no,
       [CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END] AS fields FROM orders"""
_CELLS = f"SELECT doc_id, sheet, row_no, col_no, value FROM (SELECT doc_id, sheet, row_no, unnest(fields) AS value, CAST(generate_subscripts(fields, 1) AS INTEGER) AS col_no FROM ({_ROWS})) WHERE value <> ''"
_LETTERS = """CASE WHEN {n} > 702 THEN chr(CAST(65 + ({n} - 703) // 676 AS INTEGER)) ELSE '' END ||
       CASE WHEN {n} > 26 THEN chr(CAST(65 + (({n} - 27) // 26) % 26 AS INTEGER)) ELSE '' END || chr(CAST(65 + ({n} - 1) % 26 AS INTEGER))"""

QUERIES = {
    f.__name__: f
    for f in (csv_cells, sheet_range, sheet_used_range, sheet_row_blocks, sheet_dense_rows, sheet_header_fallback, sheet_column_names, shared_string_join, number_formats, formula_status)
}
ORACLES = {
    "csv_cells": f"SELECT *, chr(64 + col_no) || row_no AS cell FROM ({_CELLS})",
    "sheet_range": f"""
SELECT doc_id, 5 AS family_ord, sheet, row_no, col_no, value, CAST(NULL AS VARCHAR) AS formula, ord, chr(64 + col_no) || row_no AS cell
FROM (SELECT *, CAST(row_number() OVER (ORDER BY row_no, col_no) AS INTEGER) AS ord FROM ({_CELLS})
      WHERE sheet = '1-URGENT' AND row_no BETWEEN 20 AND 400 AND col_no BETWEEN 1 AND 3) WHERE ord <= 2000""",
    "sheet_used_range": f"SELECT doc_id, sheet, max(row_no) AS rows, max(col_no) AS cols, 'A1:' || chr(64 + max(col_no)) || max(row_no) AS range FROM ({_CELLS}) GROUP BY 1, 2",
    "sheet_row_blocks": f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY row_no) AS n, first(fields) OVER (PARTITION BY sheet ORDER BY row_no) AS headers FROM ({_ROWS}))
SELECT doc_id, sheet, CAST((n - 1) // 500 AS INTEGER) AS block, any_value(headers) AS headers, min(row_no) AS first_row, max(row_no) AS last_row,
       CAST(count(*) AS INTEGER) AS n_rows, arg_max(fields, row_no) AS last_fields FROM r GROUP BY doc_id, sheet, (n - 1) // 500""",
    "sheet_dense_rows": f"""
WITH c AS ({_CELLS}), w AS (SELECT doc_id, sheet, max(col_no) AS w FROM c GROUP BY ALL),
g AS (SELECT doc_id, sheet, row_no, w, unnest(range(1, w + 1)) AS col_no FROM (SELECT DISTINCT doc_id, sheet, row_no FROM c) JOIN w USING (doc_id, sheet))
SELECT doc_id, sheet, row_no, list(coalesce(value, '') ORDER BY col_no) AS fields FROM g LEFT JOIN c USING (doc_id, sheet, row_no, col_no) GROUP BY ALL""",
    "sheet_header_fallback": f"""
WITH n AS (SELECT n_regionkey, list(n_name ORDER BY n_name)[1:3] AS h FROM nation GROUP BY 1),
c AS (SELECT n_regionkey, h, unnest(range(1, 31)) AS i FROM n)
SELECT n_regionkey, list(coalesce(h[i], {_LETTERS.format(n='i')}) ORDER BY i) AS headers FROM c GROUP BY 1""",
    "sheet_column_names": f"""
SELECT p_partkey, CASE WHEN p_partkey >= 1 THEN CASE WHEN p_partkey > 18278 THEN chr(CAST(65 + (p_partkey - 18279) // 17576 AS INTEGER)) ELSE '' END ||
       CASE WHEN p_partkey > 702 THEN chr(CAST(65 + ((p_partkey - 703) // 676) % 26 AS INTEGER)) ELSE '' END || {_LETTERS.split("||", 1)[1].format(n="p_partkey")} END AS letters,
       CASE WHEN p_partkey BETWEEN 1 AND 18278 THEN p_partkey END AS back FROM part""",
    "shared_string_join": """
SELECT p_partkey AS row_no, CASE WHEN p_size % 2 = 0 THEN 's' ELSE 'n' END AS type,
       CASE WHEN p_size % 2 <> 0 THEN CAST(p_partkey AS VARCHAR) WHEN p_partkey % 3 <> 0 THEN p_name ELSE '' END AS value FROM part""",
    "number_formats": """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 20 > 10 THEN '0.0' || (p_size % 20) ELSE 'builtin:' || (p_size % 20) END AS number_format FROM part""",
    "formula_status": """
WITH l AS (SELECT l_orderkey % 3 <> 0 AS f, l_partkey % 2 = 0 AS s, l_suppkey % 5 = 0 AS sh FROM lineitem)
SELECT CASE WHEN sh OR NOT f THEN CASE WHEN s THEN 'SAVED_VALUE_ONLY' ELSE 'UNSUPPORTED_FORMULA' END
            WHEN NOT s THEN 'FORMULA_ONLY' ELSE 'SAVED_CACHE' END AS status, count(*) AS n FROM l GROUP BY 1""",
}
