"""Files to item tables: one Python crossing per file, then DataFrame operators.

``Corpus`` is the entry point for users: it reads a folder or files with Spark's binaryFile source
and answers the six document queries, text and archive queries as DataFrames.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.shipping import ship
from ..functions.strings import extension, leaf
from ..limits import LIMITS, QueryError
from ..operators import archive, cells, items, text
from . import parsers
from .csv_split import SplitCsv
from .store import Table

SCHEMA = (
    "doc_id string, family string, ord int, id string, type string, title string, level int, text string, parent_id string, headers array<string>, "
    "rows array<array<string>>, sheet string, cell string, row_no int, col_no int, value string, formula string, saved_value string, status string, "
    "name string, alt_text string, path string, slide int, merged array<struct<row:int,col:int,row_span:int,col_span:int>>"
)
FIELDS = [
    "doc_id", "family", "ord", "id", "type", "title", "level", "text", "parent_id", "headers", "rows", "sheet", "cell", "row_no", "col_no", "value", "formula", "saved_value",
    "status", "name", "alt_text", "path", "slide", "merged",
]


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (path), name, bytes, sha256, content of every file below a path."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.select(
        F.col("path").alias("doc_id"), leaf(F.col("path")).alias("name"), F.col("length").alias("bytes"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("sha256"), "content"
    )


#: Rows that leave a task at a time; a table's rows count one each, texts and contents one per KiB.
ROWS = 5000


def _batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of any number of files as Arrow batches of the columns asked for."""
    held: list[dict] = []
    weight = 0
    heavy = [n for n in ("rows", "text", "content") if n in schema.names]
    for r in rows:
        held.append(r)
        weight += 1
        for n in heavy:
            if (x := r.get(n)) is not None:
                weight += len(x) if n == "rows" else len(x) >> 10
        if weight >= ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def arrow_stream(d: DataFrame, rows_of: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], out: T.StructType | str) -> DataFrame:
    """Rows (dicts) that Python gives for a partition's batches; they leave in bounded batches."""
    ship(d.sparkSession)
    out = T._parse_datatype_string(out) if isinstance(out, str) else out
    schema = to_arrow_schema(out)
    return d.mapInArrow(lambda batches: _batches(rows_of(batches), schema), out)


def arrow_rows(files: DataFrame, rows_of: Callable[..., Iterable[dict]], out: T.StructType | str) -> DataFrame:
    """The same where each row of ``files`` has rows of its own, taken one by one."""
    return arrow_stream(files, lambda batches: (r for b in batches for row in zip(*b.columns, strict=True) for r in rows_of(*(x.as_py() for x in row))), out)


def _scan(files: DataFrame, parse, families: Iterable[str] | None, fields: Iterable[str] | None) -> DataFrame:
    """One crossing to Python over (doc_id, kind, content, ...): ``parse`` gives a file's rows; only the families and fields asked for leave it."""
    wanted = None if families is None else frozenset(families)
    names = FIELDS if fields is None else [f for f in FIELDS if f in set(fields) | {"doc_id", "family"}]
    out = T.StructType([f for f in T._parse_datatype_string(SCHEMA).fields if f.name in names])

    def rows_of(doc, *file):
        for r in parse(*file):
            if wanted is None or r["family"] in wanted:
                r["doc_id"] = doc
                yield r

    return arrow_rows(files, rows_of, out)


def _kinds(files: DataFrame, known: Iterable[str]) -> DataFrame:
    kind = F.substring(extension(F.col("name")), 2, 10)
    return files.select("doc_id", kind.alias("kind"), "content").where(F.col("kind").isin(*known))


def parse_documents(files: DataFrame, index_from: int | None = None, families: Iterable[str] | None = None, fields: Iterable[str] | None = None, seconds: float = LIMITS.parse_seconds) -> DataFrame:
    """Item rows of the document files (csv, xlsx, docx, pptx by name); a file that cannot be read is one row of family ``error``.

    Spreadsheets from ``index_from`` bytes on give their sheets only; ``read_ranges`` answers for their
    cells. ``families`` and ``fields`` name the rows and columns wanted, if not all of them are. A file
    that takes longer than ``seconds`` is such an error row too (its task goes on).
    """
    wanted = None if families is None else frozenset(families)
    return _scan(_kinds(files, parsers.PARSERS), lambda kind, data: parsers.parse(kind, data, index_from, seconds, wanted), wanted, fields)


def read_ranges(files: DataFrame, sheet: str, where: str, fields: Iterable[str] | None = None) -> DataFrame:
    """Items of a range of each spreadsheet file, read from the file itself: cells, each formula after its cell, 2000 at most."""
    return _scan(_kinds(files, parsers.RANGES), lambda kind, data: parsers.read_range(kind, data, sheet, where), None, fields)


def fingerprint(index_from: int | None = None) -> str:
    """Twelve hex digits that change with the parsers' version and their limits."""
    return hashlib.sha256(repr((parsers.VERSION, LIMITS, index_from)).encode()).hexdigest()[:12]


def parse_cached(files: DataFrame, folder: str, index_from: int | None = None) -> DataFrame:
    """Items as ``parse_documents`` gives them, by way of a table in ``folder``: equal bytes of a kind are parsed once per fingerprint.

    Of the table only the prefixes of these files' digests are read. Openers that run at once may parse
    the same bytes; one commit of a key counts (``store.Table``), so its items are there once.
    """
    cache = Table(files.sparkSession, f"{folder.rstrip('/')}/parser={fingerprint(index_from)}", SCHEMA, "doc_id")
    keyed = files.withColumn("key", F.concat("sha256", F.lit("."), F.substring(extension(F.col("name")), 2, 10)))
    keys = keyed.select(F.col("key").alias("doc_id"))
    prefixes = cache.prefixes(keys)
    new = keyed.join(cache.winners(prefixes).select(F.col("doc_id").alias("key")), "key", "left_anti")
    fresh = new.dropDuplicates(["key"]).select(F.col("key").alias("doc_id"), "name", "content")
    if not fresh.isEmpty():
        cache.write(parse_documents(fresh, index_from), fresh.select("doc_id"))
    stored = cache.rows(prefixes, keys).withColumnRenamed("doc_id", "key")
    return keyed.select("doc_id", "key").join(stored, "key").select(*FIELDS)


ENTRY_SCHEMA = "archive_id string, ord int, path string, bytes long, compressed_bytes long, method int, directory boolean, text string, error string"


def list_archives(files: DataFrame) -> DataFrame:
    """Entries of the zip files: archive_id, ord, path, bytes, compressed_bytes, method, directory, text, error.

    An archive is opened and checked once. Text entries within the limit are decoded; a damaged or
    undecodable one has no text and says so in ``error``. An archive that cannot be read is one row
    without a path.
    """
    names = [f.split()[0] for f in ENTRY_SCHEMA.split(", ")]

    def entries(doc, data):
        try:
            pack = parsers.Archive(data)
            rows = pack.entries()
        except QueryError as bad:
            yield [doc, 0, None, 0, 0, 0, False, None, bad.code]
            return
        except Exception:  # as in ``parsers.guarded``
            yield [doc, 0, None, 0, 0, 0, False, None, "ARCHIVE_CORRUPT"]
            return
        for i, (info, r) in enumerate(zip(pack.infos, rows, strict=True)):
            text = error = None
            if not r["directory"] and r["bytes"] <= LIMITS.entry_text_bytes and archive.names_text(r["path"]):
                try:
                    text = parsers.decoded_text(pack.read(info))
                    error = None if text is not None else "TEXT_ENCODING_UNSUPPORTED"
                except QueryError as bad:
                    error = bad.code
            yield [doc, i, *r.values(), text, error]

    return arrow_rows(files.select("doc_id", "content"), lambda doc, data: (dict(zip(names, row, strict=True)) for row in entries(doc, data)), ENTRY_SCHEMA)


def _entry_path(path: str) -> str:
    wanted = parsers.archive_path(path)
    if wanted.endswith("/"):
        raise QueryError("ARCHIVE_ENTRY_UNSUPPORTED")
    return wanted


def _entry(data: bytes, wanted: str) -> tuple[bytes | None, str | None]:
    """An archive's entry, or the error why there is none."""
    try:
        pack = parsers.Archive(data)
        return pack.read(pack.find(wanted)), None
    except QueryError as bad:
        return None, bad.code
    except Exception:  # as in ``parsers.guarded``
        return None, "ARCHIVE_CORRUPT"


def entry_bytes(files: DataFrame, path: str) -> DataFrame:
    """The entry of one path in each zip file: doc_id (the archive), path, content, or the error why there is none."""
    wanted = _entry_path(path)

    def one(doc, data):
        content, error = _entry(data, wanted)
        return [{"doc_id": doc, "path": wanted, "content": content, "error": error}]

    return arrow_rows(files.select("doc_id", "content"), one, "doc_id string, path string, content binary, error string")


def entry_documents(files: DataFrame, path: str, families: Iterable[str] | None = None, fields: Iterable[str] | None = None) -> DataFrame:
    """Items of the document at one path in each zip file, or a row of family ``error``. ``locator`` puts each item's place under the path.

    An archive is opened once, and its entry parsed where it is unpacked. ``families`` and ``fields`` as in ``parse_documents``.
    """
    wanted = _entry_path(path)
    named = archive.classify(files.select("doc_id", "content", F.lit(path.replace("\\", "/").rpartition("/")[2]).alias("name")))
    refused = F.when(F.coalesce(F.col("kind") != "document", F.lit(True)), F.coalesce("error", F.lit("ARCHIVE_ENTRY_UNSUPPORTED")))
    named = named.select("doc_id", F.substring(extension(F.col("name")), 2, 10).alias("kind"), "content", refused.alias("refused"))

    def parse(kind, data, refused):
        content, error = _entry(data, wanted)
        if error or refused:
            return [{"family": "error", "ord": 0, "status": error or refused}]
        return parsers.parse(kind, content)

    placed = None if fields is None else {*fields, "path", "slide", "sheet", "cell"}
    out = _scan(named, parse, families, placed)
    place = F.struct(F.when(F.col("sheet").isNotNull(), "spreadsheet").otherwise("office").alias("kind"), F.col("path").alias("path"), F.col("slide").alias("slide"), F.col("sheet").alias("sheet"), F.col("cell").alias("cell"))
    return archive.folderize(out.withColumn("locator", place), wanted)


class Corpus:
    """Files below a path, queried as DataFrames.

    ``cache``: a folder for parsed documents, so that equal files are parsed once. ``index_from``:
    spreadsheets of so many bytes on are not unpacked into cells; ``range`` then reads them on demand.
    """

    def __init__(self, spark: SparkSession, path: str, cache: str | None = None, index_from: int | None = None):
        self.path_below = path
        self._open(read_files(spark, path), cache, index_from)

    @classmethod
    def over(cls, files: DataFrame, cache: str | None = None, index_from: int | None = None) -> Corpus:
        """A corpus of a table of files (doc_id, name, bytes, sha256, content)."""
        corpus = cls.__new__(cls)
        corpus._open(files, cache, index_from)
        return corpus

    def _open(self, files: DataFrame, cache: str | None, index_from: int | None) -> None:
        self.files = files
        self.classified = archive.classify(self.files)
        self.index_from = index_from
        documents = self.classified.where("kind = 'document'")
        self.documents, self.cached = documents, cache is not None
        self.items = parse_documents(documents, index_from) if cache is None else parse_cached(documents, cache, index_from)
        self.texts = text.admission(self.classified.where("kind = 'text'"))
        self.archives = self.classified.where("kind = 'archive'")
        self.entries = list_archives(self.archives)

    def of(self, *families: str, fields: Iterable[str] | None = None) -> DataFrame:
        """The items of some families. Files that are not cached are scanned for these alone, and of a cache no others are read."""
        if self.cached:
            return self.items.where(F.col("family").isin(*families))
        return parse_documents(self.documents, self.index_from, families, fields)

    def views(self) -> None:
        """Registers the tables for SQL as corpus_items, corpus_texts and corpus_entries."""
        self.items.createOrReplaceTempView("corpus_items")
        self.texts.createOrReplaceTempView("corpus_texts")
        self.entries.createOrReplaceTempView("corpus_entries")

    def outline(self) -> DataFrame:
        return items.outline(self.items)

    def search(self, query: str, limit: int = 20) -> DataFrame:
        return items.search(self.items, query, limit)

    def blocks(self, ids: list[str]) -> DataFrame:
        return items.blocks(self.items, ids)

    def range(self, sheet: str, where: str) -> DataFrame:
        """Cells, then formulas. Files that were only indexed are read again up to the range's last row."""
        found = self.of("cells", "formulas", fields=("sheet", "row_no", "col_no", "value", "formula"))
        whole = cells.items_range(found, sheet, where)
        if self.index_from is None:
            return whole
        large = self.classified.where(F.col("kind") == "document").where(F.col("bytes") >= self.index_from)
        read = read_ranges(large, sheet, where).where("family in ('cells', 'formulas')")
        order = F.when(F.col("family") == "cells", 5).otherwise(6)
        of_cell = F.when(F.col("family") == "cells", F.col("value"))
        formula = F.when(F.col("family") == "formulas", F.col("formula"))
        return whole.unionByName(read.select("doc_id", order.alias("family_ord"), "sheet", "row_no", "col_no", of_cell.alias("value"), formula.alias("formula"), (F.col("ord") + 1).alias("ord"), "cell"))

    def csv(self, pattern: str = "*.csv") -> SplitCsv:
        """The CSV files below the path (not of a table of files), each read by as many tasks as it has ranges, without a limit of size."""
        return SplitCsv(self.files.sparkSession, self.path_below, pattern)

    def slide(self, number: int, include_notes: bool = True) -> DataFrame:
        return items.slide(self.items, number, include_notes)

    def path(self, prefix: str) -> DataFrame:
        return items.path(self.items, prefix)

    def coverage(self) -> DataFrame:
        """One row per document: kind, coverage, warnings, or its error; texts and archives likewise."""
        d = self.of("document", "error", fields=("name", "status", "text"))
        failed = F.col("family") == "error"
        return d.select("doc_id", F.when(~failed, F.col("name")).alias("kind"), F.when(~failed, F.col("status")).alias("coverage"), F.when(~failed, F.col("text")).alias("warnings"), F.when(failed, F.col("status")).alias("error"))

    def text_coverage(self) -> DataFrame:
        """The same of text files, which are read whole or not at all."""
        ok = F.col("reason").isNull()
        return self.texts.select("doc_id", F.lit("text").alias("kind"), F.when(ok, "COMPLETE").alias("coverage"), F.when(ok, F.array(F.lit("utf-8 text"))).alias("included"), F.col("reason").alias("error"))

    def preview(self) -> DataFrame:
        """Preview text of each document."""
        location = F.coalesce(F.concat_ws("!", "sheet", "cell"), "path")
        counted = self.of("document", "outline", "sheets", "blocks", "tables", "formulas", fields=("ord", "title", "level", "text", "sheet", "cell", "name", "status", "path"))
        heads = items.outline(counted).where("family = 'outline'").withColumn("location", F.nullif(location, F.lit("")))
        count = lambda f: F.count_if(F.col("family") == f)
        is_doc = F.col("family") == "document"
        counts = counted.groupBy("doc_id").agg(
            F.max(F.when(is_doc, F.col("name"))).alias("kind"), F.max(F.when(is_doc, F.col("status"))).alias("coverage"),
            count("blocks").alias("n_blocks"), count("tables").alias("n_tables"), count("formulas").alias("n_formulas"),
            F.split(F.max(F.when(is_doc & (F.col("status") == "PARTIAL"), F.col("text"))), "\n").alias("warnings"),
        )
        return items.preview(heads, counts.where("kind is not null"))

    def first_cells(self) -> DataFrame:
        """A1:H10 of each spreadsheet's first sheet, which an outline shows beside the sheets."""
        first = self.of("sheets", fields=("name", "ord")).groupBy("doc_id").agg(F.min_by("name", "ord").alias("first"))
        own = self.of("cells", "formulas").join(first, "doc_id").where(F.col("sheet") == F.col("first")).where("row_no <= 10 and col_no <= 8")
        return items.first_per_doc(own.drop("first"), LIMITS.query_items)

    def read(self, query: str | None = None, limit: int = 20, start: int | None = None, end: int | None = None) -> dict[str, DataFrame]:
        """The default read of everything below the path, by kind of file: a search if there is a query, else lines of texts and outlines of the others."""
        if query is not None and query.strip():
            return {"document": self.search(query, limit), "text": self.text_search(query, limit), "archive": self.archive_search(query, limit)}
        return {"document": self.outline(), "text": self.text_range(start, end), "archive": archive.outline(self.entries)}

    def text_range(self, start: int | None = None, end: int | None = None) -> DataFrame:
        return text.text_range(self.texts, start, end)

    def text_search(self, query: str, limit: int = 20) -> DataFrame:
        return text.search(self.texts, query, limit)

    def archive_search(self, query: str, limit: int = 20) -> DataFrame:
        return archive.search(self.entries, query, limit)

    def read_entry(self, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
        """Lines of the entry of each archive; an archive without it is a row with the error."""
        return archive.read_entry(self.entries, parsers.archive_path(path), start, end, archives=self.archives.select(F.col("doc_id").alias("archive_id")))

    def entry_bytes(self, path: str) -> DataFrame:
        return entry_bytes(self.archives, path)

    def entry_items(self, path: str, *families: str, fields: Iterable[str] | None = None) -> DataFrame:
        """All items, or those of some families, of the document at a path inside each archive, for the functions of ``operators.items`` and ``operators.cells``."""
        return entry_documents(self.archives, path, families or None, fields)
