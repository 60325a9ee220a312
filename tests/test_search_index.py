"""A search by index against one that reads all, and what it reads."""

import re

import pytest

from quire.limits import QueryError
from quire.operators import text
from quire.sources.search_index import SearchIndex

ROWS = [(1, "Alpha beta\nALPHABET soup"), (2, None), (3, ""), (4, "ab"), (5, "naïve 中文字 \U0001f600\U0001f600 ok"), (6, "gamma\r\nrays"), (None, "alpha of none"), (7, "alpha"), (7, "alpha"), (8, "xyz " * 5000 + "needle")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, grp_name string")
    return docs, SearchIndex.build(docs, str(tmp_path_factory.mktemp("index") / "i"), groups=16)


@pytest.mark.parametrize("needle", ["alpha", "ALPHA", "a", "ab", "beta\nalpha", "中文字", "文字 \U0001f600", "\U0001f600\U0001f600 ok", "nothing like it", "needle", "gamma", " rays "])
def test_rows_are_those_of_a_scan(index, needle):
    docs, found = index
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.hit)
    got, want = found.search(needle).select("doc_id", "line_no", "line", "hit").collect(), text.search(docs, needle).select("doc_id", "line_no", "line", "hit").collect()
    assert sorted(got, key=key) == sorted(want, key=key)


def test_only_matching_groups_are_read(index):
    _, found = index
    groups = found.groups("needle")
    assert 0 < len(groups) < 8
    plan = found.candidates("needle")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*grp", plan)
    read = {int(re.search(r"grp=(\d+)", f)[1]) for f in found.candidates("needle").inputFiles() if f}
    assert found.rows().select("grp").distinct().count() > len(groups)
    assert read >= set(groups)
    assert found.groups("zzz") == [] and found.search("zzz").count() == 0 and found.groups("zz") is None


def test_blank_needle_is_an_error(index):
    with pytest.raises(QueryError):
        index[1].search("  ")


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    found = SearchIndex.build(none, str(tmp_path / "i"), groups=4)
    assert found.search("alpha").count() == 0
