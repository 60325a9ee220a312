"""Every registered query of the library against its SQL on the smallest data."""

import pytest
from oracle import of_df, of_sql

from quire.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    assert of_df(registry.QUERIES[name](spark, SF)) == of_sql(registry.ORACLES[name], SF)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_slide_outline_reads_every_deck(spark, monkeypatch):
    from quire.operators import items

    seen, outline = [], items.slide_outline
    monkeypatch.setattr(items, "slide_outline", lambda i: seen.append(i) or outline(i))
    got = {r.doc_id for r in registry.QUERIES["slide_outline"](spark, SF).collect()}
    decks = {r[0] for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().collect()}
    assert {r[0] for r in seen[0].where("family = 'blocks'").select("doc_id").distinct().collect()} == decks
    titled = {r[0] for r in seen[0].where("family = 'outline'").select("doc_id").distinct().collect()}
    assert titled and got == decks - titled
