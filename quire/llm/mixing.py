"""Mixing sources to target weights.

Each row gets a hash-random key (md5 of seed and id), so sorting a source by key shuffles it.
A key's leading hex digits name one of 4096 fixed key ranges; a source is range-sorted as its
ranges in order and the rows in each range by key. Prefix sums of the sizes are distributed: sums
per (source, range), a running sum over at most 4096 ranges of a source, then a running sum in
each range. A source of any size is thereby spread over 4096 tasks' worth of groups, and nothing
but one row per source and range is ever looked at together. The targets are found over one row per
source, which is range-partitioned and summed in the same way.

A source's budget of T units over rows of S units is spent as floor(T / S) whole epochs and one
cut epoch: rows in key order until the remainder is used up, the row at the cut giving only the
part that still fits (``cut`` below its size).

Defined cases: a null or empty text has size 0 and takes 0; a very long text is one row like any
other, cut or taken whole; a null id is an id of its own, a null source a source of its own, last in
order; rows that repeat an id tie on the key, are ordered by size and text, and each has its own
plan; an empty table gives an empty result. Other columns are ignored by ``op`` and pass through
``mix`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, n_words, stored

RANGE_DIGITS = 3  # 16 ** 3 key ranges in a source


def _source_key(source: Column) -> Column:
    """Total order by code point with null last, and never null itself."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), source))


def _running(rows: DataFrame, by: Sequence[str], **sums: str) -> DataFrame:
    """Adds to each row, under each name, the sum of a column over the rows before it in the order ``by``.

    The rows are range-partitioned and summed per partition; only one row per partition is ever
    looked at in one task.
    """
    placed = stored(rows.repartitionByRange(*by).withColumn("__p", F.spark_partition_id()))
    parts = placed.groupBy("__p").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__p", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy("__p").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(F.broadcast(parts), "__p")
    return out.withColumns({n: F.col(f"__{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}).drop("__p", *[f"__{n}" for n in sums])


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Water-filling over one row per source (skey, source_size): adds ``target``.

    Targets are level * weight, at most ``most`` * source_size; the level is the one at which they
    add up to ``share`` of all sizes. Sources sorted by cap / weight are filled up in that order;
    the first whose cap is not below the level reached by the rest fixes the level. Ranks and sums
    are distributed, as hosts may be the sources.
    """
    ranked = _running(sources.withColumn("one", F.lit(1)), ["skey"], rank="one")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    s = ranked.select("skey", "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(most))).alias("cap"))
    s = stored(_running(s.withColumn("full", F.col("cap") / F.col("w")), ["full", "skey"], cap_before="cap", w_before="w"))
    all_of = s.agg((F.sum("source_size") * F.lit(float(share))).alias("total"), F.sum("w").alias("w_all"))
    s = s.join(F.broadcast(all_of)).withColumn("level", (F.col("total") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before")))
    holds = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("full", "skey", "level"))
    fixed = s.agg(F.min(holds).alias("m")).select(F.col("m.level").alias("fixed"))
    target = F.when(F.col("fixed").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("fixed") * F.col("w")))
    return s.join(F.broadcast(fixed)).select("skey", "source_size", target.alias("target"))


_PLAN = ("id", "skey", "size", "key", "tie", "rng")


def _sized(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str, names: Sequence[str] = _PLAN) -> DataFrame:
    """All columns and, under ``names``, a row's id, source key, size, hash-random key, text hash and key range."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    values = (F.col(id_col), _source_key(F.col(source_col)), n_words(F.col(text_col)), key, F.xxhash64(text_col), F.substring(key, 1, RANGE_DIGITS))
    return docs.withColumns(dict(zip(names, values, strict=True)))


def _ranges(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source and key range: skey, rng, the size before the range, source_size, target."""
    ranges = sized.groupBy("skey", "rng").agg(F.sum("size").alias("range_size"))
    per_source = ranges.groupBy("skey").agg(F.sum("range_size").alias("source_size"))
    before = F.sum("range_size").over(Window.partitionBy("skey").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1))
    placed = ranges.select("skey", "rng", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.join(targets(per_source, weights, share, most), "skey")


def _spent(rows: DataFrame, ranges: DataFrame, names: Sequence[str], out: Sequence[str]) -> DataFrame:
    """``rows`` (with the columns ``names`` of _sized) and, under ``out``, before, source_size, target, whole epochs and the cut of the last one."""
    ident, skey, size, key, tie, rng = names
    before, source_size, target, epochs, cut = out
    ranges = ranges.select(F.col("skey").alias(skey), F.col("rng").alias(rng), F.col("before").alias(before), F.col("source_size").alias(source_size), F.col("target").alias(target))
    inside = Window.partitionBy(skey, rng).orderBy(key, size, ident, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.col(before) + F.sum(size).over(inside) - F.col(size)
    budget = F.floor(target).cast("long")
    whole = F.when(F.col(source_size) == 0, F.lit(0)).otherwise(F.floor(budget / F.col(source_size))).cast("long")
    rows = rows.join(ranges, [skey, rng]).withColumn(before, first).withColumn(epochs, whole)
    rest = budget - F.col(epochs) * F.col(source_size)
    return rows.withColumn(cut, F.greatest(F.lit(0), F.least(F.col(size), rest - F.col(before))).cast("long"))


def plan(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per input row: id, source key, size, source_size, target, epochs (whole), cut (units of the last one)."""
    docs = docs.select(F.col(id_col).alias("__i"), F.col(text_col).alias("__t"), F.col(source_col).alias("__s"))
    sized = stored(_sized(docs, seed, "__i", "__t", "__s").select(*_PLAN))  # one pass over the texts; a few bytes a row from here on
    rows = _spent(sized, _ranges(sized, weights, share, most), _PLAN, ("before", "source_size", "target", "epochs", "cut"))
    return rows.select("id", "skey", "size", "source_size", "target", "key", "epochs", "cut")


def op(docs: DataFrame) -> DataFrame:
    p = plan(docs)
    return p.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("cut")).alias("taken"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mixed rows themselves: every row as often as its own plan takes it, in whole rows.

    The row at a source's cut is kept when at least half of it fits. The rows are dealt to their
    source's key ranges once, with all their columns; nothing is joined by id.
    """
    names, out = fresh(docs, *_PLAN), fresh(docs, "before", "source_size", "target", "epochs", "cut")
    (epoch,) = fresh(docs, "epoch")
    how = (seed, id_col, text_col, source_col)
    sized = stored(_sized(docs.select(id_col, text_col, source_col), *how, names).select(*[F.col(n).alias(c) for n, c in zip(names, _PLAN, strict=True)]))
    rows = _spent(_sized(docs, *how, names), _ranges(sized, weights, share, most), names, out)
    size, epochs, cut = F.col(names[2]), F.col(out[3]), F.col(out[4])
    copies = (epochs + F.when((cut > 0) & (2 * cut >= size), 1).otherwise(0)).cast("int")
    times = F.when(copies > 0, F.sequence(F.lit(1), copies))
    return rows.withColumn(epoch, F.explode(times)).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = """
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 'k' || source END AS skey,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY skey),
w AS (SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS w,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY cap / w, skey)),
f AS (SELECT level AS fixed FROM l WHERE level * w <= cap ORDER BY cap / w, skey LIMIT 1),
t AS (SELECT skey, source_size, least(cap, (SELECT fixed FROM f) * w) AS target FROM l),
r AS (SELECT doc_id, d.skey, size, source_size, target,
             CAST(sum(size) OVER (PARTITION BY d.skey ORDER BY k, size, doc_id ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS first,
             CAST(floor(target) AS BIGINT) AS budget,
             CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) // source_size END AS epochs
      FROM d JOIN t ON d.skey = t.skey)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - first)) AS BIGINT) AS taken
FROM r"""
