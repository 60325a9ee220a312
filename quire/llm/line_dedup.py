"""Line dedup by site-relative frequency.

Pages are grouped by host. For each line, the share of its host's pages that contain it is pages
with the line / pages of the host; lines above the boilerplate ratio are dropped from that host's
pages. Everything that is shuffled for the counts is a 16-byte digest of a line, partly summed
before the shuffle, so a line that a third of all pages carry costs one row per task.

A line is boilerplate only if it is on more than ``ratio`` of its host's pages, so a host has at
most (lines per page) / ratio of them. The boilerplate table is materialised and counted: within
``BROADCAST_ROWS`` (a few MB) it is broadcast as one array per host; beyond that the distinct digests
of each host's texts are joined with it by (host, digest), the table side copied to ``SALTS`` buckets
against hot lines, and a text gets the digests it has to lose. Both ways give the same rows.

Defined cases: a null text stays null and has no lines; a null host is a host of its own; blank
lines are never boilerplate and stay; lines are compared without the white space around them; a
line counts once per page however often it stands there; very long texts are read whole; a null id
is passed on; rows that repeat an id, or a text, are pages of their own; a page whose lines all go
keeps an empty text; an empty table gives an empty result. Other columns pass through, whatever their
names, but for those of the two new ones, which raise ValueError.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, spaced, stored

RATIO = 0.1
MIN_PAGES = 5
BROADCAST_ROWS = 100_000
SALTS = 16


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; null if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _digest(line: Column) -> Column:
    """Digest of a line, null for a blank one."""
    bare = F.trim(spaced(line))
    return F.when(bare != "", F.md5(bare))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _digests(text: Column) -> Column:
    """Distinct digests of a text's lines."""
    return F.array_distinct(F.filter(F.transform(_lines(F.coalesce(text, F.lit(""))), _digest), lambda d: d.isNotNull()))


def boilerplate(pages: DataFrame, text_col: str, host: Column, ratio: float, min_pages: int) -> DataFrame:
    """(host, digest) of the lines above the ratio; hosts are keyed so that null is one of them."""
    keyed = pages.select(host.alias("h"), F.col(text_col).alias("t"))
    lines = keyed.select("h", F.explode(_digests(F.col("t"))).alias("d")).groupBy("h", "d").agg(F.count("*").alias("n"))
    sizes = keyed.groupBy("h").agg(F.count("*").alias("pages"))
    frequent = lines.where(F.col("n") >= min_pages).join(sizes, "h")
    return frequent.where(F.col("n") > F.lit(ratio) * F.col("pages")).select("h", "d")


def clean(
    pages: DataFrame,
    text_col: str = "text",
    host_col: str | Column = "source",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All columns with the text cleaned, plus ``n_lines`` and ``n_dropped``."""
    if clash := {"n_lines", "n_dropped"} & {*pages.columns}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    raw = F.col(host_col) if isinstance(host_col, str) else host_col
    host = F.when(raw.isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), raw))
    drop = stored(boilerplate(pages, text_col, host, ratio, min_pages))
    h, name, gone, kept = fresh(pages, "h", "name", "gone", "kept")
    keyed = pages.withColumn(h, host)
    if drop.count() <= broadcast_rows:
        per_host = drop.groupBy(F.col("h").alias(h)).agg(F.sort_array(F.collect_set("d")).alias(gone))
        joined = keyed.join(F.broadcast(per_host), h, "left")
    else:
        keyed = keyed.withColumn(name, F.md5(text_col))
        salt = F.pmod(F.xxhash64(name, "d"), F.lit(SALTS))
        lines = keyed.select(h, name, F.explode(_digests(F.col(text_col))).alias("d")).distinct().withColumn("salt", salt)
        copies = drop.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        hits = lines.join(copies.withColumnRenamed("h", h), [h, "d", "salt"]).groupBy(h, name).agg(F.sort_array(F.collect_set("d")).alias(gone))
        joined = keyed.join(hits, [h, name], "left")
    lines = _lines(F.col(text_col))
    found = F.array_intersect(_digests(F.col(text_col)), F.coalesce(gone, F.array().cast("array<string>")))
    rest = let(found, lambda g: F.filter(lines, lambda x: ~F.coalesce(F.array_contains(g, _digest(x)), F.lit(False))))
    out = joined.withColumn(kept, F.when(F.col(gone).isNull() | F.col(text_col).isNull(), lines).otherwise(rest))
    n, k = (F.greatest(F.coalesce(F.size(c), F.lit(0)).cast("long"), F.lit(0)) for c in (lines, F.col(kept)))
    columns = [F.array_join(kept, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in pages.columns]
    return out.select(*columns, n.alias("n_lines"), (n - k).alias("n_dropped"))


def op(docs: DataFrame) -> DataFrame:
    return clean(docs.select("doc_id", "text", "source")).select("doc_id", "source", "text", "n_lines", "n_dropped")


ORACLE = """
WITH p AS (SELECT doc_id, source, text, row_number() OVER () AS r FROM documents),
l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM p WHERE text IS NOT NULL),
b AS (SELECT r, source, i, line, trim(translate(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ')) AS bare FROM l),
n AS (SELECT source, bare, count(DISTINCT r) AS n FROM b WHERE bare <> '' GROUP BY source, bare),
s AS (SELECT source, count(*) AS pages FROM p GROUP BY source),
g AS (SELECT n.source, n.bare FROM n JOIN s ON n.source IS NOT DISTINCT FROM s.source WHERE n >= 5 AND n > 0.1::DOUBLE * pages),
k AS (SELECT b.*, g.bare IS NOT NULL AS gone FROM b LEFT JOIN g ON b.source IS NOT DISTINCT FROM g.source AND b.bare = g.bare),
a AS (SELECT r, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text,
             count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped FROM k GROUP BY r)
SELECT p.doc_id, p.source, a.text, coalesce(a.n_lines, 0) AS n_lines, coalesce(a.n_dropped, 0) AS n_dropped
FROM p LEFT JOIN a ON p.r = a.r"""
