"""Queries over the lines of ``documents``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import folder
from ..operators import text
from ..sources.search_index import SearchIndex
from ..sources.tables import table

BLOCK_IDS = ("lines:2-3", "lines:1-1", "lines:2-3")


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text", "source")


def text_search(spark, sf_dir):
    return text.search(_docs(spark, sf_dir), "with", 20)


def text_search_indexed(spark, sf_dir):
    """Searches by trigram index: a common word, a rare string, two characters (which read all), one that is nowhere."""
    index = SearchIndex.build(_docs(spark, sf_dir), folder(spark), groups=64)
    found = [index.search(n, 3).withColumn("needle", F.lit(n)) for n in ("With", "ab", "Password", "zzqqzz")]
    return reduce(DataFrame.unionByName, found).select("needle", "doc_id", "line_no", "line", "hit")


def text_lines(spark, sf_dir):
    return text.lines(_docs(spark, sf_dir))


def text_range(spark, sf_dir):
    return text.text_range(_docs(spark, sf_dir), 3, 6)


def text_blocks(spark, sf_dir):
    return text.blocks(_docs(spark, sf_dir), BLOCK_IDS)


def text_blocks_budget(spark, sf_dir):
    """The shared line budget, scaled to five lines."""
    return text.blocks(_docs(spark, sf_dir), ("lines:1-3", "lines:2-9", "lines:4-4"), budget=5)


def text_preview(spark, sf_dir):
    return text.preview(_docs(spark, sf_dir))


def text_outline_windows(spark, sf_dir):
    return text.outline(_docs(spark, sf_dir).withColumn("text", F.replace("text", F.lit(" "), F.lit("\n"))))


def text_outline_headings(spark, sf_dir):
    """Every document's first line made a heading, every third one's second line too."""
    marked = F.concat(F.lit("## "), F.replace("text", F.lit("\n"), F.when(F.col("doc_id") % 3 == 0, F.lit("\n#\t")).otherwise(F.lit("\n"))))
    return text.outline(_docs(spark, sf_dir).withColumn("text", marked))


_SPLIT = "regexp_split_to_array(text, '\\r?\\n')"
_LINES = f"SELECT doc_id, unnest({_SPLIT}) AS line, CAST(generate_subscripts({_SPLIT}, 1) AS INTEGER) AS line_no FROM documents WHERE text IS NOT NULL"

QUERIES = {f.__name__: f for f in (text_search, text_search_indexed, text_lines, text_range, text_blocks, text_blocks_budget, text_preview, text_outline_windows, text_outline_headings)}
ORACLES = {
    "text_search": f"""
WITH l AS ({_LINES}),
h AS (SELECT doc_id, line_no, line, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS INTEGER) AS hit
      FROM l WHERE contains(lower(line), 'with'))
SELECT doc_id, line_no, line, hit FROM h WHERE hit <= 20""",
    "text_search_indexed": f"""
WITH l AS ({_LINES}), q(needle) AS (VALUES ('With'), ('ab'), ('Password'), ('zzqqzz')),
h AS (SELECT needle, doc_id, line_no, line, CAST(row_number() OVER (PARTITION BY needle, doc_id ORDER BY line_no) AS INTEGER) AS hit
      FROM l JOIN q ON contains(lower(line), lower(needle)))
SELECT needle, doc_id, line_no, line, hit FROM h WHERE hit <= 3""",
    "text_lines": _LINES,
    "text_range": f"""
WITH d AS (SELECT doc_id, {_SPLIT} AS ls, CAST(len({_SPLIT}) AS INTEGER) AS n FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN n >= 3 THEN array_to_string(ls[3:least(6, n)], chr(10)) END AS text, 3 AS line_start,
       CASE WHEN n >= 3 THEN least(6, n) END AS line_end, n AS total_lines,
       CASE WHEN n >= 3 THEN 6 < n END AS truncated, CASE WHEN n > 6 THEN 7 END AS next_line_start,
       CASE WHEN n < 3 THEN 'BAD_REQUEST' END AS error
FROM d""",
    "text_blocks": f"""
WITH d AS (SELECT doc_id, {_SPLIT} AS ls, CAST(len({_SPLIT}) AS INTEGER) AS n FROM documents WHERE text IS NOT NULL),
q(ord, id, a, b) AS (VALUES (1, 'lines:2-3', 2, 3), (2, 'lines:1-1', 1, 1), (3, 'lines:2-3', 2, 3))
SELECT doc_id, ord, id, CASE WHEN n < a THEN '' ELSE array_to_string(ls[a:least(b, n)], chr(10)) END AS text, a AS line_start, least(b, n) AS line_end
FROM d, q""",
    "text_blocks_budget": f"""
WITH d AS (SELECT doc_id, {_SPLIT} AS ls, CAST(len({_SPLIT}) AS INTEGER) AS n FROM documents WHERE text IS NOT NULL),
e1 AS (SELECT *, least(3, n) AS e1, 5 - greatest(0, least(3, n)) AS b1 FROM d),
e2 AS (SELECT *, least(9, 1 + b1, n) AS e2, b1 - greatest(0, least(9, 1 + b1, n) - 1) AS b2 FROM e1),
e3 AS (SELECT *, least(4, 3 + b2, n) AS e3 FROM e2),
r AS (SELECT doc_id, ls, 1 AS ord, 'lines:1-3' AS id, 1 AS a, e1 AS e FROM e3 UNION ALL
      SELECT doc_id, ls, 2, 'lines:2-9', 2, e2 FROM e3 UNION ALL SELECT doc_id, ls, 3, 'lines:4-4', 4, e3 FROM e3)
SELECT doc_id, ord, id, CASE WHEN e < a THEN '' ELSE array_to_string(ls[a:e], chr(10)) END AS text, a AS line_start, e AS line_end FROM r""",
    "text_preview": "SELECT doc_id, substr(text, 1, 4000) AS preview FROM documents WHERE text IS NOT NULL",
    "text_outline_windows": """
WITH d AS (SELECT doc_id, len(regexp_split_to_array(replace(text, ' ', chr(10)), '\\r?\\n')) AS n FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, n, unnest(range(1, n + 1, 200)) AS line FROM d)
SELECT doc_id, CAST(line AS INTEGER) AS line, 'lines:' || line || '-' || least(n, line + 199) AS id,
       '第 ' || line || '-' || least(n, line + 199) || ' 行' AS title, 1 AS level FROM w""",
    "text_outline_headings": f"""
WITH documents AS (SELECT doc_id, '## ' || replace(text, chr(10), CASE WHEN doc_id % 3 = 0 THEN chr(10) || '#' || chr(9) ELSE chr(10) END) AS text FROM main.documents),
l AS ({_LINES}),
h AS (SELECT doc_id, line_no AS line, 'lines:' || line_no || '-' || line_no AS id, trim(regexp_extract(line, '^(#{{1,6}})\\s+(.+)$', 2)) AS title,
             CAST(length(regexp_extract(line, '^(#{{1,6}})\\s+(.+)$', 1)) AS INTEGER) AS level
      FROM l WHERE regexp_matches(line, '^(#{{1,6}})\\s+(.+)$')),
d AS (SELECT doc_id, CAST(len({_SPLIT}) AS INTEGER) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM h)),
w AS (SELECT doc_id, n, unnest(range(1, n + 1, 200)) AS line FROM d)
SELECT doc_id, line, id, title, level FROM h UNION ALL
SELECT doc_id, CAST(line AS INTEGER), 'lines:' || line || '-' || least(n, line + 199), '第 ' || line || '-' || least(n, line + 199) || ' 行', 1 FROM w""",
}
