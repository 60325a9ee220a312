"""Posting lists of letter trigrams over groups of documents, so that a search reads few of them.

Documents are dealt into groups by the hash of their id and stored in a folder per group. For every
trigram of the lower-case texts the index holds the groups in which it occurs; those lists lie in
buckets by the trigram's hash. A search reads the lists of its needle's trigrams, then only the groups
that are in all of them, and verifies there as a search without an index does: its rows are the same.
Needles of one or two characters read all groups.

What reaches the driver is a list of group numbers, at most as many as there are groups. A group
should hold some hundred megabytes; a list has at most one number per group, so the index of n groups
is at most n numbers per distinct trigram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import text
from ..operators.text import needle_of

GRAM = 3
BUCKETS = 64


def grams(value: Column) -> Column:
    """Every three characters in a row, overlaps included (half a surrogate pair adds grams that nothing asks for)."""
    return F.regexp_extract_all(F.lower(value), F.lit("(?s)(?=(...))"), F.lit(1))


def bucket_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


class SearchIndex:
    """An index in a folder: ``rows/grp=<n>`` and ``grams/bucket=<n>``."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType | None = None):
        """``schema``: that of the rows, which otherwise is read from them (an empty index has none to read)."""
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    @classmethod
    def build(cls, docs: DataFrame, folder: str, groups: int = 1024, salt: int = 4) -> SearchIndex:
        """Indexes (doc_id, text, any other columns). Rows of one id are in one group, whose rows are written by up to ``salt`` tasks.

        A null text is stored and has no trigrams; a null id is an id like others.
        """
        spread = F.pmod(F.xxhash64("doc_id", "text"), F.lit(salt))
        dealt = docs.withColumn("grp", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int"))
        index = cls(docs.sparkSession, folder, dealt.schema)
        dealt.repartition("grp", spread).write.partitionBy("grp").parquet(f"{index.folder}/rows")
        pairs = index.rows().select("grp", F.explode(F.array_distinct(grams(F.col("text")))).alias("gram")).distinct()
        lists = pairs.groupBy("gram").agg(F.sort_array(F.collect_list("grp")).alias("groups")).withColumn("bucket", bucket_of(F.col("gram")))
        lists.repartition("bucket").sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{index.folder}/grams")
        return index

    def rows(self) -> DataFrame:
        read = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return read.parquet(f"{self.folder}/rows")

    def groups(self, query: str) -> list[int] | None:
        """The groups that have all trigrams of a needle, or None if it has none."""
        key = needle_of(query)
        asked = sorted({key[i : i + GRAM] for i in range(len(key) - GRAM + 1)})
        if not asked:
            return None
        wanted = self.spark.createDataFrame([(g,) for g in asked], "gram string").select(F.collect_set(bucket_of(F.col("gram")))).first()[0]
        lists = self.spark.read.schema("gram string, groups array<int>, bucket int").parquet(f"{self.folder}/grams").where(F.col("bucket").isin(wanted) & F.col("gram").isin(asked))
        both = lists.select(F.explode("groups").alias("grp")).groupBy("grp").count().where(F.col("count") == len(asked))
        return sorted(r.grp for r in both.collect())

    def candidates(self, query: str) -> DataFrame:
        """The rows of the groups that may hold the needle."""
        found = self.groups(query)
        rows = self.rows()
        return (rows if found is None else rows.where(F.col("grp").isin(found))).drop("grp")

    def search(self, query: str, limit: int | None = None) -> DataFrame:
        """The same rows as ``text.search`` over all documents."""
        return text.search(self.candidates(query), query, limit)
