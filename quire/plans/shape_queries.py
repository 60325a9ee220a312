"""Queries over the shapes of files: media families, old formats, image heads, titles, folder roots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import archive
from ..sources import images
from ..sources.files import Corpus
from ..sources.tables import table
from . import source_queries as made


def media_families(spark, sf_dir):
    """Names of ten kinds, every third with the first bytes of an old office file."""
    p = table(spark, sf_dir, "pages")
    kinds = (".docx", ".xlsx", ".pptx", ".csv", ".doc", ".XLS", ".ppt.txt", ".zip", ".md", "")
    name = F.concat(F.lit("f"), "page_id", F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("page_id") % len(kinds) + 1).cast("int")))
    content = F.when(F.col("page_id") % 3 == 0, F.expr("X'D0CF11E0A1B11AE100'")).otherwise(F.expr("X'504B0304'"))
    c = archive.classify(p.select("page_id", name.alias("name"), content.alias("content")))
    return c.select("page_id", archive.media_family(F.col("media_type")).alias("family"), archive.is_legacy(F.col("name"), F.col("content")).alias("legacy"))


def image_dimensions(spark, sf_dir):
    """Heads of PNG, GIF and WebP files, and of none."""
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 3000 + 1).alias("w"), (F.col("p_size") * 7 + 1).alias("h"))
    big = lambda c: F.lpad(F.hex(c), 8, "0")
    low = lambda c: F.concat(F.lpad(F.hex(c % 256), 2, "0"), F.lpad(F.hex(F.floor(c / 256)), 2, "0"))
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), big(F.col("w")), big(F.col("h")))
    gif = F.concat(F.lit("474946383961"), low(F.col("w")), low(F.col("h")))
    webp = F.concat(F.lit("52494646000000005745425056503858" + "00" * 8), low(F.col("w") - 1), F.lit("00"), low(F.col("h") - 1), F.lit("00"))
    head = F.element_at(F.array(png, gif, webp, F.lit("00")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return images.with_dimensions(p, F.unhex(head)).select("p_partkey", "width", "height")


def document_titles(spark, sf_dir):
    """Documents with a title, a blank one and none."""
    d = made._turns(spark, sf_dir)
    title = F.when(F.col("c") % 3 == 0, made.cat(" Talk & ", F.col("c"), " ")).when(F.col("c") % 3 == 1, "  ").otherwise("")
    parts = {
        "[Content_Types].xml": "<Types/>", "word/document.xml": f"<document {made.W}><body/></document>",
        "docProps/core.xml": made.cat("<cp xmlns:dc='urn:dc'><dc:title>", made.xml(title), "</dc:title></cp>"),
    }
    c = Corpus.over(made.zipped(d, made.cat("talk-", F.col("c"), ".docx"), parts))
    return c.items.where("family = 'document'").select("doc_id", "title", F.col("name").alias("kind"))


def text_file_coverage(spark, sf_dir):
    """Documents as text files, every fifth with a byte that is no text."""
    d = table(spark, sf_dir, "documents").where("doc_id is not null and text <> ''")
    content = F.when(F.col("doc_id") % 5 == 0, F.concat(F.col("text").cast("binary"), F.expr("X'FF'"))).otherwise(F.col("text").cast("binary"))
    return Corpus.over(made.files_of(d, made.cat(F.col("doc_id"), ".txt"), content)).text_coverage()


def folder_root(spark, sf_dir):
    """Paths of one site's folder without the folder; the folder itself is dropped and foreign paths are errors."""
    p = table(spark, sf_dir, "pages")
    path = F.concat(F.when(F.col("page_id") % 4 == 3, "other/").otherwise("site/"), F.when(F.col("page_id") % 4 == 1, "").otherwise(F.concat("page_id", F.lit(".html"))))
    return archive.strip_root(p.select("page_id", path.alias("path")), "site").select("page_id", "path", "error")


QUERIES = {f.__name__: f for f in (media_families, image_dimensions, document_titles, text_file_coverage, folder_root)}
ORACLES = {
    "media_families": """
SELECT page_id, CASE page_id % 10 WHEN 0 THEN 'docx' WHEN 1 THEN 'xlsx' WHEN 2 THEN 'pptx' WHEN 3 THEN 'csv' END AS family, page_id % 10 IN (4, 5) OR page_id % 3 = 0 AS legacy FROM pages""",
    "image_dimensions": """
SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN CAST(p_partkey % 3000 + 1 AS INTEGER) END AS width, CASE WHEN p_partkey % 4 < 3 THEN CAST(p_size * 7 + 1 AS INTEGER) END AS height FROM part""",
    "document_titles": """
SELECT DISTINCT 'talk-' || conv_id || '.docx' AS doc_id, CASE WHEN conv_id % 3 = 0 THEN 'Talk & ' || conv_id END AS title, 'document' AS kind FROM conversations WHERE conv_id IS NOT NULL""",
    "text_file_coverage": """
SELECT doc_id || '.txt' AS doc_id, 'text' AS kind, CASE WHEN doc_id % 5 <> 0 THEN 'COMPLETE' END AS coverage, CASE WHEN doc_id % 5 <> 0 THEN ['utf-8 text'] END AS included,
       CASE WHEN doc_id % 5 = 0 THEN 'TEXT_ENCODING_UNSUPPORTED' END AS error FROM documents WHERE doc_id IS NOT NULL AND text <> ''""",
    "folder_root": """
SELECT page_id, CASE page_id % 4 WHEN 3 THEN 'other/' || page_id || '.html' ELSE page_id || '.html' END AS path, CASE WHEN page_id % 4 = 3 THEN 'BAD_REQUEST' END AS error
FROM pages WHERE page_id % 4 <> 1""",
}
