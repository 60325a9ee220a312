"""File scans: what a Python worker holds is bounded, and each file is read once."""

import io
import zipfile

import pyarrow as pa

from quire.plans import source_queries
from quire.sources import files
from quire.sources.files import Corpus

SF = "/root/testdata/sf0.001"


def zipped(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, c in parts.items():
            z.writestr(n, c)
    return out.getvalue()


def corpus(spark, *packs):
    rows = [(f"a{i}", f"a{i}.zip", len(p), "", bytearray(p)) for i, p in enumerate(packs)]
    return Corpus.over(spark.createDataFrame(rows, "doc_id string, name string, bytes long, sha256 string, content binary"))


def scans(df) -> int:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("MapInArrow") + plan.count("MapInPandas") + plan.count("ArrowEvalPython")


def test_archive_search_reads_archives_once(spark):
    c = corpus(spark, zipped({"b.md": "no\nYes it is\r\nyes", "a.bin": "yes", "c.txt": "yes"}), zipped({"x.md": "none"}), b"broken")
    found = c.archive_search("yes", 2)
    assert scans(found) == 1
    assert [tuple(r) for r in found.orderBy("hit").collect()] == [("a0", "b.md", 2, "Yes it is", 1, 2, 2, "COMPLETE"), ("a0", "b.md", 3, "yes", 2, 2, 2, "COMPLETE")]


def test_batches_weigh_what_they_hold():
    schema = pa.schema([("rows", pa.list_(pa.list_(pa.string()))), ("text", pa.string())])
    tables = [{"rows": [["x"]] * 500} for _ in range(40)]
    assert [b.num_rows for b in files._batches(tables, schema)] == [10, 10, 10, 10]
    texts = [{"text": "x" * (1 << 20)} for _ in range(10)]
    assert max(b.num_rows for b in files._batches(texts, schema)) == 5


def test_files_are_packed_one_by_one(spark):
    made = source_queries._zip(spark, SF).files
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan  # it held pandas objects of 10 000 files' parts at once
    assert made.count() == spark.read.parquet(f"{SF}/conversations.parquet").where("conv_id is not null").select("conv_id").distinct().count()


def test_uploads_of_a_table_pass_in_one_stream(spark):
    from quire.streaming.uploads import run_uploads

    rows = [(s, u, e, q, 0, n, 3) for u in ("a", "b") for s in ("x", "y") for e, q, n in (("commit", 2, 0), ("begin", 0, 0), ("chunk", 3, None), ("chunk", 1, 3))]
    out = run_uploads(spark.createDataFrame(rows, "session_id string, upload_id string, event string, seq long, idx int, bytes long, declared long"))
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()  # a frame for each upload
    got = [tuple(r) for r in out.where("session_id = 'x' and upload_id = 'b'").orderBy("seq").select("event", "status", "received", "chunks").collect()]
    assert got == [("begin", "OPEN", 0, 0), ("chunk", "OK", 3, 1), ("commit", "COMMITTED", 3, 1), ("chunk", "BAD_REQUEST", 0, 0)]
    assert out.count() == 16


def test_a_range_and_an_entry_need_one_scan(spark):
    assert scans(source_queries.xlsx_file_range(spark, SF)) == 2  # packing and reading; cells and formulas were two scans
    assert scans(source_queries.zip_file_document(spark, SF)) == 2  # unpacking and parsing were scans of their own


def test_entry_errors_keep_their_codes(spark):
    c = corpus(spark, zipped({"d/a.csv": "x,y", "d/b.bin": "x"}), b"broken", zipped({"other": "x"}))
    codes = lambda path: {r.doc_id: r.status for r in c.entry_items(path).where("family = 'error'").collect()}
    assert codes("d/a.csv") == {"a1": "ARCHIVE_CORRUPT", "a2": "ARCHIVE_ENTRY_NOT_FOUND"}
    assert codes("d/b.bin") == {"a0": "UNSUPPORTED_FILE_TYPE", "a1": "ARCHIVE_CORRUPT", "a2": "ARCHIVE_ENTRY_NOT_FOUND"}
    assert [r.value for r in c.entry_items("d/a.csv", "cells", fields=("value", "ord")).orderBy("ord").collect()] == ["x", "y"]


def test_a_preview_needs_no_cells(spark):
    plan = source_queries.csv_file_preview(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "saved_value" not in plan and "headers" not in plan  # the scan gave every column of every family


def test_column_letters_of_five_letters(spark):
    from pyspark.sql import functions as F

    from quire.operators.cells import column_letters, column_name

    at = [1, 702, 703, 18278, 18279, 475254, 475255, 1_200_000, 12_356_630]
    rows = spark.createDataFrame([(n,) for n in at], "n long").select("n", column_letters(F.col("n")).alias("l")).collect()
    assert {r.n: r.l for r in rows} == {n: column_name(n) for n in at} and column_name(475255) == "AAAAA"
