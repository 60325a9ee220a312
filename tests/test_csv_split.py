"""CSV files cut at every place against the reader that takes a file whole."""

import contextlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.limits import QueryError
from quire.sources import csv_split, parsers
from quire.sources.csv_split import Reader, SplitCsv
from quire.sources.files import Corpus


def whole(data: bytes) -> list[list[str]]:
    return parsers.csv_rows(parsers.csv_text(data)[0], parsers.csv_delimiter(data))


@contextlib.contextmanager
def ranges_of(spark, size: int):
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": size}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


@given(st.text(alphabet='a",\r\n', max_size=40))
@settings(max_examples=500, deadline=None)
def test_reader_equals_the_whole_one(text):
    r, got = Reader(","), []
    lines = text.split("\n")
    for line in lines[:-1] if lines[-1] == "" else lines:
        got += r.feed(line)
    try:
        assert (got, r.quoted, r.n) == (list(parsers.csv_stream(text)), False, len(got))
    except QueryError:
        assert r.quoted


ODD = {
    "quotes.csv": 'id,"a ""b"" c",x\r\n1,"two\r\nlines, and ""more""\n\n",y\n2,mid"quote,"z"tail\n\n3,"",end'.encode(),
    "tabs.csv": "﻿名\t值\n\"é\n;\"\t2\r3\t4\n".encode(),
    "gb.csv": '名;"中\n文"\n1;2\n'.encode("gb18030"),
    "open.csv": b'a,b\n"never closed\nx,y\n',
    "bytes.csv": b"a,\xff\xff\nb,c\n",
    "empty.csv": b"",
    "blank.csv": b"\n",
    "last.csv": b"a,b\r",
}


@pytest.mark.parametrize("size", [2, 7, 1 << 20])
def test_ranges_of_any_size(spark, tmp_path, size):
    for name, data in ODD.items():
        (tmp_path / name).write_bytes(data)
    with ranges_of(spark, size):
        csv = SplitCsv(spark, str(tmp_path))
        files = {r.doc_id.rpartition("/")[2]: r for r in csv.files().collect()}
        got = {}
        for r in csv.rows().collect():
            got.setdefault(r.doc_id.rpartition("/")[2], {})[r.row_no] = r.fields
        if size == 2:
            assert csv.lines().rdd.getNumPartitions() > 20
    assert set(files) == set(ODD) - {"empty.csv"}
    for name, data in ODD.items():
        if not data:
            continue
        try:
            rows = whole(data)
        except QueryError as bad:
            assert (files[name].error, name in got) == (bad.code, False)
            continue
        assert got[name] == dict(enumerate(rows, 1)), name
        assert (files[name].error, files[name].n_rows, files[name].delimiter) == (None, len(rows), parsers.csv_delimiter(data))
        assert files[name].encoding == parsers.csv_text(data)[1]


def test_merged_plan_gives_the_same_rows(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_bytes(ODD["quotes.csv"] * 1)
    with ranges_of(spark, 9):
        csv = SplitCsv(spark, str(tmp_path))
        want = sorted(csv.rows().collect())
        monkeypatch.setattr(csv_split, "PLANNED", 0)
        assert sorted(csv.rows().collect()) == want


def test_unplanned_range_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"a,b\nc,d\ne,f\n")
    csv = SplitCsv(spark, str(tmp_path))
    assert csv.plan.count() == 1
    with ranges_of(spark, 4), pytest.raises(Exception, match="cut otherwise"):
        csv.rows().collect()


def test_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a,,"b\nc"\n,d\n')
    (tmp_path / "b.txt").write_bytes(b"x")
    with ranges_of(spark, 3):
        got = Corpus(spark, str(tmp_path)).csv().cells().select("row_no", "col_no", "value", F.col("sheet")).collect()
    assert sorted(map(tuple, got)) == [(1, 1, "a", "CSV"), (1, 3, "b\nc", "CSV"), (2, 2, "d", "CSV")]
