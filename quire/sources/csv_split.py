"""CSV files of any size, read in splits: many tasks per file, the rows as of one reader from its start.

Spark's text source deals files into byte ranges and gives each range's lines. Where a line starts, a
CSV reader is in one of two states, inside a quoted field or outside. A first pass learns for every
range where each state leads and how many rows end on the way, for each delimiter that the file may
have. Composing these along a file gives the state and the row number that each range starts with.
A second pass then reads every range on its own. Rows that lie across ranges leave in pieces, which
are joined by their row number; there is at most one such piece at either end of a range.

What is gathered per file is a row per range (128 MB by default); ranges within the first 16 KB add
those bytes, from which the delimiter is chosen.

Defined cases, as for files read whole: UTF-8 or GB18030, both strict, for the whole file; a quote
opens only in an empty field; CR, LF and CRLF end rows; a blank line is one empty field; a quote that
is never closed makes the whole file corrupt. Files without a byte are unknown to Spark's sources and
have no row at all. The text source drops a BOM, also one before GB18030. If the second pass finds other
ranges than the first, those that start where one did are read right and any other is an error, never
rows with wrong numbers. Where executors come and go, fix ``spark.sql.files.minPartitionNum``, from
which Spark cuts ranges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import cut
from ..functions.shipping import ship
from ..operators import cells

DELIMITERS = ",\t;"
HEAD = 16384
#: Ranges whose plan is broadcast (under 200 bytes each); beyond that lines and plan are sorted and merged.
PLANNED = 1 << 17
#: Rows and bytes that leave a task at a time.
ROWS, BYTES = 5000, 1 << 24


class Reader:
    """Rows from lines that follow one another, from outside or inside a quoted field on."""

    def __init__(self, delimiter: str, quoted: bool = False):
        self.delimiter, self.quoted, self.n = delimiter, quoted, 0
        self.stop = re.compile(f"[{re.escape(delimiter)}\r]")
        self.fields: list[str] = []
        self.part: list[str] = []

    def feed(self, line: str) -> Iterator[list[str]]:
        """The rows that end in a line, which is given without its LF."""
        at, closed = 0, self.quoted
        if not self.quoted and '"' not in line and "\r" not in line[:-1]:
            self.n += 1
            yield line.removesuffix("\r").split(self.delimiter)
            return
        while True:
            if not self.quoted and not closed and line[at : at + 1] == '"':
                self.quoted, at = True, at + 1
            if self.quoted:
                end = line.find('"', at)
                if end < 0:
                    self.part += (line[at:], "\n")
                    return
                self.part.append(line[at:end])
                at = end + 1
                if line[at : at + 1] == '"':
                    self.part.append('"')
                    at += 1
                    continue
                self.quoted, closed = False, True
            m = self.stop.search(line, at)
            self.part.append(line[at : m.start() if m else len(line)])
            self.fields.append("".join(self.part))
            self.part, closed = [], False
            if m is not None:
                at = m.end()
            if m is None or m[0] == "\r":
                row, self.fields = self.fields, []
                self.n += 1
                yield row
                if m is None or at == len(line):
                    return

    def skip(self, line: str) -> None:
        """As ``feed``, of which only the state and the number of rows are kept."""
        for _ in self.feed(line):
            pass
        self.fields.clear()
        self.part.clear()

    def open(self) -> list[str]:
        """The fields so far of a row that has not ended."""
        return [*self.fields, "".join(self.part)]


def lines_below(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """doc_id (path), block (where the range starts) and line (bytes without the LF) of the files, in a task in their order."""
    source = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
    if pattern is not None:
        source = source.option("pathGlobFilter", pattern)
    return source.text(path).select(F.col("_metadata.file_path").alias("doc_id"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Each batch cut where its file or range changes."""
    for b in batches:
        if not b.num_rows:
            continue
        doc, block = pc.dictionary_encode(b.column(0)).indices.to_numpy(), b.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(doc) != 0) | (np.diff(block) != 0)) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            yield (b.column(0)[i].as_py(), int(block[i])), b.slice(i, j - i)


def _decodes(line: bytes, encoding: str) -> bool:
    try:
        line.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


class _Range:
    """What the first pass learns of one range."""

    def __init__(self, block: int):
        self.readers = [Reader(d, q) for d in DELIMITERS for q in (False, True)]
        self.head, self.wanted = bytearray(), HEAD if block < HEAD else 0
        self.utf8 = self.gb18030 = True

    def add(self, lines: pa.Array) -> None:
        special = pc.fill_null(pc.match_substring_regex(lines, '(?s)[^\\x00-\\x7f"]|"|\r.'), True).to_numpy(zero_copy_only=False)
        last = 0
        for i in [*np.flatnonzero(special).tolist(), len(lines)]:
            for r in self.readers:  # lines without quotes: a row each outside, text inside
                if not r.quoted:
                    r.n += i - last
            last = i + 1
            if i < len(lines):
                self._one(lines[i].as_py())
        for i in range(len(lines) if len(self.head) < self.wanted else 0):
            self.head += lines[i].as_py() + b"\n"
            if len(self.head) >= self.wanted:
                break

    def _one(self, line: bytes) -> None:
        if not line.isascii():
            self.utf8 = self.utf8 and _decodes(line, "utf-8")
            self.gb18030 = self.gb18030 and _decodes(line, "gb18030")
        text = line.decode("latin-1")  # no byte of a longer character is a quote, a delimiter or a line end in either encoding
        for r in self.readers:
            r.skip(text)

    def row(self, key: tuple) -> tuple:
        steps = [{"quoted": r.quoted, "n": r.n} for r in self.readers]
        return (*key, steps, bytes(self.head[: self.wanted]), self.utf8, self.gb18030)


_LEARNED = "doc_id string, block long, steps array<struct<quoted:boolean,n:long>>, head binary, utf8 boolean, gb18030 boolean"
_ARROW = pa.schema(
    [
        ("doc_id", pa.string()), ("block", pa.int64()), ("steps", pa.list_(pa.struct([("quoted", pa.bool_()), ("n", pa.int64())]))),
        ("head", pa.binary()), ("utf8", pa.bool_()), ("gb18030", pa.bool_()),
    ]
)


def learned(lines: DataFrame) -> DataFrame:
    """The first pass: a row per range."""
    ship(lines.sparkSession)

    def run(batches):
        last, found = None, None
        one = lambda: pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, found.row(last), strict=True))], _ARROW)
        for key, part in _ranges(batches):
            if key != last:
                if found is not None:
                    yield one()
                last, found = key, _Range(key[1])
            found.add(part.column(2))
        if found is not None:
            yield one()

    return lines.mapInArrow(run, _LEARNED)


def planned(ranges: DataFrame, delimiter: str | None = None) -> DataFrame:
    """One row per file: delimiter, encoding, n_rows, error, and ``starts`` (block, quoted, row_no: rows that ended before)."""
    g = ranges.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("block", "steps", "head"))).alias("s"), F.every("utf8").alias("utf8"), F.every("gb18030").alias("gb18030"))
    head = F.substring(F.aggregate("s", F.lit(b""), lambda acc, x: F.concat(acc, x["head"])), 1, HEAD).cast("string")
    times = [F.octet_length(head) - F.octet_length(F.replace(head, F.lit(d), F.lit(""))) for d in DELIMITERS]
    best = F.when((times[0] >= times[1]) & (times[0] >= times[2]), 0).when(times[1] >= times[2], 1).otherwise(2)
    g = g.withColumn("d", best if delimiter is None else F.lit(DELIMITERS.index(delimiter)))
    kind = "struct<quoted:boolean,n:long,starts:array<struct<block:long,quoted:boolean,row_no:long>>>"

    def step(acc: Column, x: Column) -> Column:
        way = F.element_at(x["steps"], F.col("d") * 2 + acc["quoted"].cast("int") + 1)
        start = F.struct(x["block"].alias("block"), acc["quoted"].alias("quoted"), acc["n"].alias("row_no"))
        return F.struct(way["quoted"].alias("quoted"), (acc["n"] + way["n"]).alias("n"), F.concat(acc["starts"], F.array(start)).alias("starts")).cast(kind)

    none = F.struct(F.lit(False).alias("quoted"), F.lit(0).alias("n"), F.array().alias("starts")).cast(kind)
    g = g.withColumn("a", F.aggregate("s", none, step))
    encoding = F.when(F.col("utf8"), "utf-8").when(F.col("gb18030"), "gb18030")
    error = F.when(encoding.isNull(), "TEXT_ENCODING_UNSUPPORTED").when(F.col("a.quoted"), "DOCUMENT_CORRUPT")
    return g.select(
        "doc_id", F.element_at(F.array(*[F.lit(d) for d in DELIMITERS]), F.col("d") + 1).alias("delimiter"), encoding.alias("encoding"),
        F.col("a.n").alias("n_rows"), error.alias("error"), F.col("a.starts").alias("starts"),
    )


_PIECES = "doc_id string, block long, row_no long, fields array<string>, whole boolean"
_PIECE = pa.schema([("doc_id", pa.string()), ("block", pa.int64()), ("row_no", pa.int64()), ("fields", pa.list_(pa.string())), ("whole", pa.bool_())])


def pieces(lines: DataFrame) -> DataFrame:
    """The second pass over lines with their range's start: whole rows, and the pieces of rows that lie across ranges."""
    ship(lines.sparkSession)

    def rows(batches):
        last, r = None, None
        for key, part in _ranges(batches):
            if key != last:
                if r is not None and r.quoted:
                    yield (*last, base + r.n + 1, r.open(), False)
                quoted, base, delimiter, encoding = (part.column(i)[0].as_py() for i in range(3, 7))
                if base is None:
                    raise RuntimeError(f"{key[0]} was cut otherwise when it was planned: no range starts at {key[1]}")
                last, r, broken = key, Reader(delimiter, quoted), quoted
            for line in part.column(2):
                for fields in r.feed(line.as_py().decode(encoding)):
                    # feed has counted all before this row, and this row
                    yield (*key, base + r.n, fields, not broken)
                    broken = False
        if r is not None and r.quoted:
            yield (*last, base + r.n + 1, r.open(), False)

    def run(batches):
        held, size = [], 0
        for row in rows(batches):
            held.append(row)
            size += sum(map(len, row[3]))
            if len(held) >= ROWS or size >= BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _PIECE, strict=True)], schema=_PIECE)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _PIECE, strict=True)], schema=_PIECE)

    return lines.mapInArrow(run, _PIECES)


def joined(parts: DataFrame) -> DataFrame:
    """Rows (doc_id, row_no, fields): pieces of one row in the order of their ranges, the last field of each goes on with the first of the next."""
    tail = lambda a: F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))
    most = lambda a: F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))
    add = lambda acc, x: F.concat(most(acc), F.array(F.concat(F.element_at(acc, -1), F.element_at(x["fields"], 1))), tail(x["fields"]))
    broken = parts.where(~F.col("whole")).groupBy("doc_id", "row_no").agg(F.sort_array(F.collect_list(F.struct("block", "fields"))).alias("s"))
    mended = broken.select("doc_id", "row_no", F.aggregate(tail(F.col("s")), F.element_at("s", 1)["fields"], add).alias("fields"))
    return parts.where("whole").select("doc_id", "row_no", "fields").unionByName(mended)


class SplitCsv:
    """The CSV files below a path, each read by as many tasks as it has ranges."""

    def __init__(self, spark: SparkSession, path: str, pattern: str | None = None, delimiter: str | None = None):
        self.spark, self.path, self.pattern, self.delimiter = spark, path, pattern, delimiter

    def lines(self) -> DataFrame:
        return lines_below(self.spark, self.path, self.pattern)

    @cached_property
    def plan(self) -> DataFrame:
        """One row per file that has lines, written once."""
        return cut(planned(learned(self.lines()), self.delimiter))

    def files(self) -> DataFrame:
        """One row per file: doc_id, delimiter, encoding, n_rows, error."""
        return self.plan.drop("starts")

    def rows(self) -> DataFrame:
        """doc_id, row_no (from 1) and fields of every row of the files that can be read."""
        start = self.plan.select("doc_id", "delimiter", "encoding", "error", F.explode("starts").alias("x"))
        start = cut(start.select("doc_id", F.col("x.block").alias("block"), "x.quoted", "x.row_no", "delimiter", "encoding", "error"))
        lines = self.lines()
        if start.count() <= PLANNED:
            found = lines.join(F.broadcast(start), ["doc_id", "block"], "left")
        else:
            found = lines.withColumn("at", F.monotonically_increasing_id()).join(start.hint("merge"), ["doc_id", "block"], "left")
            found = found.sortWithinPartitions("doc_id", "block", "at")
        return joined(pieces(found.where("error is null").select("doc_id", "block", "line", "quoted", "row_no", "delimiter", "encoding")))

    def cells(self) -> DataFrame:
        """The cells that are not empty: doc_id, sheet, row_no, col_no, value."""
        return cells.unpivot(self.rows().withColumn("sheet", F.lit("CSV")))
