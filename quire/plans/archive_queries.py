"""Queries over archives and folders: each document source is an archive, each page URL a path."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import archive
from ..sources.tables import table

_KINDS = (".md", ".bin", "/README", ".py", ".png", "/.env", ".TXT")


def _entries(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("doc_id") % len(_KINDS) + 1).cast("int"))
    return d.select(
        F.col("source").alias("archive_id"), F.col("doc_id").cast("int").alias("ord"), F.concat(F.lit("docs/"), F.col("lang"), F.lit("/"), "doc_id", kind).alias("path"),
        F.octet_length("text").cast("bigint").alias("bytes"), F.lit(False).alias("directory"), "text",
    )


def _folder(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    path = F.regexp_replace("url", r"^https?://|[?#].*$|/$", "")
    return p.select(F.col("page_id").cast("int").alias("ord"), F.lit("site").alias("archive_id"), path.alias("path"), F.octet_length("html").cast("bigint").alias("bytes"), F.lit(False).alias("directory"))


def is_text(spark, sf_dir):
    return _entries(spark, sf_dir).select("ord", "path", archive.is_text(F.col("path")).alias("is_text"))


def archive_outline(spark, sf_dir):
    return archive.outline(_entries(spark, sf_dir), 10).select("archive_id", "ord", "path", "bytes", "n", "entries", "total_bytes", "truncated")


def archive_admitted(spark, sf_dir):
    return archive.admitted(_entries(spark, sf_dir))


def archive_search(spark, sf_dir):
    return archive.search(_entries(spark, sf_dir), "with", 20)


def archive_entry(spark, sf_dir):
    e = _entries(spark, sf_dir)
    return archive.read_entry(e.withColumn("path", F.regexp_replace("path", "^docs/[a-z]+/", "docs/")), "docs/7.md", 2, 5)


def archive_coverage(spark, sf_dir):
    return archive.coverage(_entries(spark, sf_dir))


def archive_manifest_check(spark, sf_dir):
    e = _entries(spark, sf_dir)
    d = e.groupBy("archive_id").agg(F.count("*").alias("files"), F.sum("bytes").alias("source_bytes"))
    declared = d.select("archive_id", F.when(F.col("archive_id").endswith("3"), F.col("files") + 1).otherwise(F.col("files")).alias("files"), F.lit(0).alias("directories"), "source_bytes")
    return archive.manifest_check(e, declared)


def path_safety(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    raw = F.element_at(
        F.array(F.col("url"), F.concat(F.lit("../"), "url"), F.concat(F.lit("/"), "url"), F.regexp_replace("url", "^https?://", ""), F.lit("C:/x"), F.regexp_replace("url", "^https?://|/$", ""), F.lit("a\\b\\")),
        (F.col("page_id") % 7 + 1).cast("int"),
    )
    return archive.safe_paths(p.select(F.lit("site").alias("archive_id"), "page_id", raw.alias("path")), unicode=False).select("page_id", "safe_path", "duplicate")


def path_unicode(spark, sf_dir):
    """Paths with decomposed letters, which another entry has composed."""
    p = table(spark, sf_dir, "pages")
    raw = F.concat(F.lit("caf"), F.when(F.col("page_id") % 2 == 0, "e\u0301").otherwise("é"), F.lit("/"), F.floor(F.col("page_id") / 4).cast("string"))
    return archive.safe_paths(p.select(F.lit("site").alias("archive_id"), "page_id", raw.alias("path"))).select("page_id", "safe_path", "duplicate")


def parent_dirs(spark, sf_dir):
    return archive.parents(_folder(spark, sf_dir))


def folder_conflicts(spark, sf_dir):
    f = _folder(spark, sf_dir)
    more = archive.parents(f).where(F.length("parent") % 5 == 0).select(F.lit(0).alias("ord"), "archive_id", F.col("parent").alias("path"), F.lit(1).cast("bigint").alias("bytes"), F.lit(False).alias("directory"))
    dirs = f.where("ord % 9 = 0").withColumn("directory", F.lit(True)).withColumn("path", F.concat("path", F.lit("/")))
    return archive.conflicts(f.unionByName(more).unionByName(dirs))


def folder_group_root(spark, sf_dir):
    return archive.group_by_root(_folder(spark, sf_dir))


def classify_file(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    kinds = (".docx", ".XLSX", ".zip", ".py", ".doc", ".tar.gz", "", "/.env", ".json", ".htm")
    name = F.concat(F.lit("up/"), "page_id", F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("page_id") % len(kinds) + 1).cast("int")))
    return archive.classify(p.select("page_id", name.alias("name"))).select("page_id", "kind", "media_type", "error")


_KIND_SQL = "['.md', '.bin', '/README', '.py', '.png', '/.env', '.TXT'][CAST(doc_id % 7 + 1 AS INTEGER)]"
_E = f"SELECT source AS archive_id, CAST(doc_id AS INTEGER) AS ord, 'docs/' || lang || '/' || doc_id || {_KIND_SQL} AS path, strlen(text) AS bytes, doc_id % 7 NOT IN (1, 4) AS is_text, text, doc_id FROM documents"
_F = "SELECT CAST(page_id AS INTEGER) AS ord, regexp_replace(url, '^https?://|[?#].*$|/$', '', 'g') AS path, strlen(html) AS bytes FROM pages"
_PARENTS = f"""SELECT DISTINCT 'site' AS archive_id, array_to_string(s[1:i], '/') AS parent FROM
(SELECT s, unnest(range(1, len(s))) AS i FROM (SELECT string_split(path, '/') AS s FROM ({_F})))"""
_ADMIT = f"""e AS ({_E}),
c AS (SELECT *, row_number() OVER (PARTITION BY archive_id ORDER BY ord) AS k, count(*) OVER (PARTITION BY archive_id) AS searchable FROM e WHERE is_text AND bytes <= 8388608),
f(archive_id, k, left_, taken, got) AS (
  SELECT DISTINCT archive_id, CAST(0 AS BIGINT), CAST(33554432 AS BIGINT), 0, false FROM c
  UNION ALL
  SELECT c.archive_id, c.k, CASE WHEN taken < 500 AND bytes <= left_ THEN left_ - bytes ELSE left_ END,
         CASE WHEN taken < 500 AND bytes <= left_ THEN taken + 1 ELSE taken END, taken < 500 AND bytes <= left_
  FROM f JOIN c ON c.archive_id = f.archive_id AND c.k = f.k + 1),
a AS (SELECT c.*, CAST(count(*) OVER (PARTITION BY c.archive_id) AS INTEGER) AS searched FROM c JOIN f ON c.archive_id = f.archive_id AND c.k = f.k WHERE f.got)"""

QUERIES = {
    f.__name__: f
    for f in (
        is_text, archive_outline, archive_admitted, archive_search, archive_entry, archive_coverage, archive_manifest_check, path_safety, path_unicode, parent_dirs,
        folder_conflicts, folder_group_root, classify_file,
    )
}
ORACLES = {
    "is_text": f"SELECT ord, path, is_text FROM ({_E})",
    "archive_outline": f"""
SELECT archive_id, ord, path, bytes, n, entries, total_bytes, entries > 10 AS truncated FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY archive_id ORDER BY ord) AS INTEGER) AS n, count(*) OVER (PARTITION BY archive_id) AS entries,
         CAST(sum(bytes) OVER (PARTITION BY archive_id) AS BIGINT) AS total_bytes FROM ({_E})) WHERE n <= 10""",
    "archive_admitted": f"WITH RECURSIVE {_ADMIT} SELECT archive_id, CAST(searchable AS INTEGER) AS searchable, searched, ord FROM a",
    "archive_search": f"""WITH RECURSIVE {_ADMIT},
l AS (SELECT archive_id, ord, path, searched, CAST(searchable AS INTEGER) AS searchable, unnest(regexp_split_to_array(text, '\\r?\\n')) AS line,
             CAST(generate_subscripts(regexp_split_to_array(text, '\\r?\\n'), 1) AS INTEGER) AS line_no FROM a),
h AS (SELECT *, CAST(row_number() OVER (PARTITION BY archive_id ORDER BY ord, line_no) AS INTEGER) AS hit FROM l WHERE contains(lower(line), 'with'))
SELECT archive_id, path, line_no, line, hit, searched, searchable, CASE WHEN searched = searchable THEN 'COMPLETE' ELSE 'PARTIAL' END AS coverage FROM h WHERE hit <= 20""",
    "archive_entry": f"""
WITH d AS (SELECT archive_id, 'docs/7.md' AS path, regexp_split_to_array(text, '\\r?\\n') AS ls FROM ({_E}) WHERE doc_id = 7)
SELECT archive_id, path, array_to_string(ls[2:least(5, len(ls))], chr(10)) AS text, 2 AS line_start, CAST(least(5, len(ls)) AS INTEGER) AS line_end,
       CAST(len(ls) AS INTEGER) AS total_lines, len(ls) > 5 AS truncated, CAST(NULL AS VARCHAR) AS error FROM d""",
    "archive_coverage": f"""
SELECT archive_id, count(*) AS files, count(*) FILTER (WHERE is_text) AS text_files, count(*) FILTER (WHERE NOT is_text) AS binary_files,
       CAST(sum(bytes) AS BIGINT) AS bytes, (list(path ORDER BY ord))[1:30] AS paths, CASE WHEN bool_and(is_text) THEN 'COMPLETE' ELSE 'PARTIAL' END AS coverage
FROM ({_E}) GROUP BY archive_id""",
    "archive_manifest_check": "SELECT source AS archive_id, source NOT LIKE '%3' AS ok, CASE WHEN source LIKE '%3' THEN 'ARCHIVE_CORRUPT' END AS error FROM documents GROUP BY source",
    "path_safety": r"""
WITH r AS (SELECT page_id, CASE page_id % 7 WHEN 0 THEN url WHEN 1 THEN '../' || url WHEN 2 THEN '/' || url WHEN 3 THEN regexp_replace(url, '^https?://', '')
             WHEN 4 THEN 'C:/x' WHEN 5 THEN regexp_replace(url, '^https?://|/$', '', 'g') ELSE 'a\b\' END AS raw FROM pages),
s AS (SELECT page_id, replace(raw, '\', '/') AS p FROM r),
t AS (SELECT page_id, CASE WHEN starts_with(p, '/') OR regexp_matches(p, '^[A-Za-z]:/') OR
        len(list_filter(string_split(regexp_replace(p, '/$', ''), '/'), lambda x: x IN ('', '.', '..'))) > 0 THEN NULL ELSE p END AS safe_path FROM s)
SELECT page_id, safe_path, safe_path IS NOT NULL AND count(*) OVER (PARTITION BY safe_path) > 1 AS duplicate FROM t""",
    "path_unicode": """
WITH p AS (SELECT page_id, 'café/' || (page_id // 4) AS safe_path FROM pages)
SELECT page_id, safe_path, count(*) OVER (PARTITION BY safe_path) > 1 AS duplicate FROM p""",
    "parent_dirs": _PARENTS,
    "folder_conflicts": f"""
WITH f AS ({_F}), p AS ({_PARENTS}),
a AS (SELECT path, false AS directory FROM f UNION ALL SELECT parent, false FROM p WHERE length(parent) % 5 = 0 UNION ALL SELECT path, true FROM f WHERE ord % 9 = 0),
files AS (SELECT DISTINCT path FROM a WHERE NOT directory),
above AS (SELECT DISTINCT array_to_string(s[1:i], '/') AS path FROM (SELECT s, unnest(range(1, len(s))) AS i FROM (SELECT string_split(path, '/') AS s FROM files)))
SELECT 'site' AS archive_id, path, 'duplicate' AS conflict FROM (SELECT path, directory FROM a GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'site', path, 'file_above_file' FROM files WHERE path IN (SELECT path FROM above)
UNION ALL SELECT 'site', path, 'file_and_directory' FROM files WHERE path IN (SELECT path FROM a WHERE directory)""",
    "folder_group_root": f"""
WITH f AS (SELECT *, string_split(path, '/') AS s FROM ({_F})),
d AS (SELECT DISTINCT s[1] AS root, array_to_string(s[1:i], '/') AS parent FROM (SELECT s, unnest(range(2, len(s))) AS i FROM f))
SELECT s[1] AS root, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, coalesce(any_value(k.n), 0) AS directories FROM f LEFT JOIN (SELECT root, count(*) AS n FROM d GROUP BY root) k ON k.root = f.s[1] GROUP BY s[1]""",
    "classify_file": """
SELECT page_id,
  CASE page_id % 10 WHEN 0 THEN 'document' WHEN 1 THEN 'document' WHEN 2 THEN 'archive' WHEN 3 THEN 'text' WHEN 8 THEN 'text' WHEN 9 THEN 'text' END AS kind,
  CASE page_id % 10 WHEN 0 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
    WHEN 1 THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' WHEN 2 THEN 'application/zip' WHEN 3 THEN 'text/plain'
    WHEN 8 THEN 'application/json' WHEN 9 THEN 'text/plain' END AS media_type,
  CASE page_id % 10 WHEN 4 THEN 'LEGACY_OFFICE_UNSUPPORTED' WHEN 5 THEN 'UNSUPPORTED_FILE_TYPE' WHEN 6 THEN 'UNSUPPORTED_FILE_TYPE' WHEN 7 THEN 'UNSUPPORTED_FILE_TYPE' END AS error
FROM pages""",
}
