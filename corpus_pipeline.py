"""Corpus pipeline: documents to token ids in five stages, each calling one operator of quire.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. The order: toxic documents go, boilerplate lines go, one document of each group of
near duplicates stays, sources are mixed to their target weights (a document taken twice is two
rows), and what is left is encoded; the last stage decodes its ids again and says whether that gave
the text back.

Defined cases, in every stage: a row, not an id, is what is kept, changed or repeated, so ids may
repeat and may be null; columns beyond those of documents are dropped, whatever their names; an empty
table gives an empty one. A null text is scored like an empty one, has no lines to lose, is no copy
of anything, takes no part of the mix's budget (size 0, as often as its source's whole epochs) and
encodes to no ids. An empty text is a text like any other; very long ones are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, line_dedup, mixing, near_dedup, toxicity
from quire.llm.common import stored, table

#: Entries of the encoder's memos: its workers served the other stages before and keep what these need.
MEMO = 150_000

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below the rejection level; the model learns from the labelled ids among ``docs``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(*COLUMNS), model, score_col="toxicity_score")
    return scored.where(F.col("toxicity_score") < toxicity.REJECT).select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without their source's boilerplate lines; ``n_chars`` is counted anew where lines went. A null source is one source."""
    cleaned = line_dedup.clean(docs.select(*COLUMNS))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, of its least id; an id with texts of two classes keeps a row in each."""
    return near_dedup.keep_one(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them whole; the row at a source's cut stays if half of it fits."""
    return mixing.mix(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, number of ids, the ids (little-endian unsigned 32-bit) and whether they decode to the text."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(docs.select("doc_id", "source", "text"), ranks, pattern, whole_col="round_trip", memo=MEMO)
    return ids.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: No SQL: trained scores, sampled hashes and merges are beyond it; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
