"""Durable tables of the library: append-only, dealt by key prefix, safe with several writers.

A ``Table`` is a folder of commits. A commit is written to a staging folder and renamed to its name,
``commit=<id>``; of two writers of one id the first rename wins and the other's rows are dropped, so a
batch that is replayed under its id adds nothing. Rows lie in ``prefix=`` folders, by the first
digits of their key; each commit has a small manifest of its keys, renamed after its rows, so a key
that is listed has its rows. Where several commits wrote one key, the commit of the least id is its
winner and the others' rows are never read. Readers name the prefixes that they want, so
what they do not ask for is not scanned.

The rename is atomic where the file system's is (local, HDFS). Nothing is ever overwritten;
``compact`` folds the commits there are into one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import cut


def prefix_of(key: Column, digits: int = 1) -> Column:
    """The partition of a key: the first digits of its digest."""
    return F.substring(F.regexp_replace(key, "^sha256:", ""), 1, digits)


def commit_id() -> str:
    """An id that sorts by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


class Files:
    """The few file system calls of a store, by Hadoop's interface, so that any storage does."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        if not self.fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at))

    def rename(self, source: str, target: str) -> bool:
        """False if the target is there already."""
        to = self.path(target)
        if self.fs.exists(to):
            return False
        self.fs.mkdirs(to.getParent())
        try:
            done = self.fs.rename(self.path(source), to)
        except Exception as lost:  # some file systems raise where another writer was first
            if not self.fs.exists(to):
                raise lost
            done = False
        # a folder renamed onto one that has just appeared lands inside it
        inside = self.path(f"{target}/{source.rpartition('/')[2]}")
        if done and self.fs.exists(inside):
            self.fs.delete(inside, True)
            return False
        return bool(done)

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class Table:
    """Rows by key in a folder. ``schema`` has the key column and is that of the rows.

    ``digits`` of a key make its prefix: one for stores of up to some TB (16 folders a commit), two beyond
    (256 folders, which are listed by a job); it must stay the same for a folder.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str | T.StructType, key: str, digits: int = 1):
        self.spark, self.root, self.key, self.digits = spark, root.rstrip("/"), key, digits
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.files = Files(spark, self.root)

    def commits(self) -> list[str]:
        """Ids of the commits whose manifests are there."""
        return [n.removeprefix("commit=") for n in self.files.names("keys") if n.startswith("commit=")]

    def write(self, rows: DataFrame, keys: DataFrame | None = None, commit: str | None = None, gather: bool = True) -> bool:
        """Adds rows as one commit; False if a commit of that id is there already. ``keys`` lists keys, for those that have no rows.

        ``gather`` deals the rows by prefix, for few files; without it they are written where they lie, and not moved again.
        """
        commit = commit or commit_id()
        if commit in self.commits():
            return False
        stage = f"_staging/{uuid.uuid4().hex}"
        named = rows.select(*self.schema.names).withColumn("prefix", prefix_of(F.col(self.key), self.digits))
        if gather:  # few files for each prefix; adaptive execution splits a prefix that is large
            named = named.hint("rebalance", "prefix")
        named.write.partitionBy("prefix").parquet(f"{self.root}/{stage}/rows")
        mine = self.files.rename(f"{stage}/rows", f"rows/commit={commit}")
        if keys is None or not mine:  # if another writer was first and died before it listed its rows, they are listed for it
            path = f"{self.root}/rows/commit={commit}"
            keys = self.spark.read.schema(self._with("prefix")).option("basePath", path).parquet(path)
        listed = keys.select(self.key, prefix_of(F.col(self.key), self.digits).alias("prefix"))
        listed.repartition("prefix").distinct().write.partitionBy("prefix").parquet(f"{self.root}/{stage}/keys")
        won = self.files.rename(f"{stage}/keys", f"keys/commit={commit}") and mine
        self.files.drop(stage)
        return won

    def _with(self, *names: str) -> T.StructType:
        return T.StructType([*self.schema.fields, *(T.StructField(n, T.StringType()) for n in names)])

    def _read(self, part: str, schema: T.StructType, prefixes: list[str] | None) -> DataFrame:
        paths = [f"{self.root}/{part}/commit={c}" for c in self.commits()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{part}").parquet(*paths)
        return rows if prefixes is None else rows.where(F.col("prefix").isin(prefixes))

    def winners(self, prefixes: list[str] | None = None) -> DataFrame:
        """(key, commit, prefix): each key once, with the commit whose rows count."""
        return self.listed(prefixes).groupBy(self.key, "prefix").agg(F.min("commit").alias("commit"))

    def listed(self, prefixes: list[str] | None = None) -> DataFrame:
        """(key, commit, prefix) of every commit's keys."""
        schema = T.StructType([self.schema[self.key], T.StructField("commit", T.StringType()), T.StructField("prefix", T.StringType())])
        return self._read("keys", schema, prefixes)

    def rows(
        self, prefixes: list[str] | None = None, wanted: DataFrame | None = None, every: bool = False, seen: Callable[[DataFrame], DataFrame] | None = None
    ) -> DataFrame:
        """The rows of every key, or of the ``wanted`` keys, in some or all prefixes; ``every``: those of all commits, for keys that grow.

        ``seen`` gives what is wanted of the rows and keeps key, commit and prefix; it is applied where they are read, so that
        what it drops is not moved.
        """
        found = self._read("rows", self._with("commit", "prefix"), prefixes)
        found = found if seen is None else seen(found)
        chosen = self.listed(prefixes) if every else self.winners(prefixes)
        if wanted is not None:
            chosen = chosen.join(wanted.select(self.key).distinct(), self.key, "left_semi")
        # each commit lists a key once; a semi join would be pushed below what ``seen`` makes
        return found.join(chosen, [self.key, "commit", "prefix"]).select(*[n for n in found.columns if n not in ("commit", "prefix")])

    def prefixes(self, keys: DataFrame) -> list[str]:
        """The prefixes of some keys: at most 16, or 256 of two digits."""
        return sorted(r[0] for r in keys.select(prefix_of(F.col(self.key), self.digits)).distinct().collect() if r[0] is not None)

    def compact(self) -> list[str]:
        """Folds all commits into one that comes before them; returns their ids, for ``sweep`` once no reader lists them any more."""
        old = self.commits()
        if len(old) > 1:
            self.write(self.rows(), self.winners().select(self.key), commit=f"{min(old)[:-1]}!")
        return old if len(old) > 1 else []

    def sweep(self, folded: list[str]) -> None:
        """Removes commits that ``compact`` has folded."""
        for c in folded:
            self.files.drop(f"keys/commit={c}")
            self.files.drop(f"rows/commit={c}")


#: Bits of the filter of digests: one bitmap of 32 768 for each of 32 buckets.
FILTER_BUCKETS = 32


def _bit(sha256: Column) -> Column:
    """A bit of a digest, from 1 on: 20 of its bits after the longest prefix."""
    return F.conv(F.substring(F.regexp_replace(sha256, "^sha256:", ""), 3, 5), 16, 10).cast("long") + 1


def digest_filter(keys: DataFrame) -> DataFrame:
    """A bitmap of some digests, of at most FILTER_BUCKETS rows of 4096 bytes: what is not in it is none of them."""
    bit = _bit(F.col("sha256"))
    return keys.select(bit.alias("bit")).where("bit is not null").groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))


def may_be_in(rows: DataFrame, bitmap: DataFrame) -> DataFrame:
    """The rows whose digest may be one of a filter's; the filter is broadcast, its size is fixed."""
    at = F.bitmap_bit_position(_bit(F.col("sha256")))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(__byte, cast(__at % 8 as int)) & 1") == 1
    marked = rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(_bit(F.col("sha256"))) == F.col("bucket"))
    return marked.withColumns({"__byte": byte, "__at": at}).where(hit).drop("__byte", "__at", "bits", "bucket")


OBJECTS = "sha256 string, bytes long, content binary"
SHAPE = "^sha256:[0-9a-f]{64}\\z"


def checked(objects: DataFrame) -> DataFrame:
    """Adds ``error`` for content whose digest is not its name."""
    ok = F.concat(F.lit("sha256:"), F.sha2("content", 256)) == F.col("sha256")
    return objects.withColumn("error", F.when(~F.coalesce(ok, F.lit(False)), "ATTACHMENT_STORAGE_FAILED"))


class Objects:
    """Content by digest."""

    def __init__(self, spark: SparkSession, root: str, digits: int = 1):
        self.table = Table(spark, f"{root.rstrip('/')}/objects", OBJECTS, "sha256", digits)

    def publish(self, incoming: DataFrame, commit: str | None = None) -> DataFrame:
        """Stores what of (sha256, content) is new, each digest once; returns (sha256, stored, error) of every digest.

        Only the prefixes of what comes in are read, of the manifest. Stored bytes of a digest that
        comes again are read once more and checked: broken ones are an error, as their name would
        answer for other bytes. An incoming object whose bytes are not its digest's is an error too.
        What comes in is read twice, for its digests and for its bytes, and bytes are moved once.
        """
        t = self.table
        incoming = checked(incoming.select("sha256", "content"))
        one = cut(incoming.select("sha256", "error"))
        keys = one.where("error is null").select("sha256").distinct()
        prefixes = t.prefixes(keys)
        again = cut(t.winners(prefixes).join(keys, "sha256", "left_semi").select("sha256"))
        bits = digest_filter(keys)
        stored = t.rows(prefixes, again, seen=lambda d: checked(may_be_in(d, bits)).select("sha256", "error", "commit", "prefix"))
        broken = cut(stored.where("error is not null").select("sha256", "error"))
        answers = keys.join(broken, "sha256", "left").unionByName(one.where("error is not null").select("sha256", "error").distinct())
        met = again.withColumn("met", F.lit(True))
        answers = answers.join(met, "sha256", "left").select("sha256", (F.col("met").isNull() & F.col("error").isNull()).alias("stored"), "error")
        # dealt by digest once: what is stored already goes, then copies go, then the rest is written from there
        new = incoming.where("error is null").repartition("sha256").join(again, "sha256", "left_anti").dropDuplicates(["sha256"])
        t.write(new.withColumn("bytes", F.octet_length("content").cast("long")), commit=commit, gather=False)
        return answers  # its plan reads the commits that were there before

    def read(self, refs: DataFrame, **of: Column) -> DataFrame:
        """(sha256, bytes, content, error) of each reference: one that is no digest, is not there or is broken has an error and no content.

        ``of`` names columns made of the content to have in its place, which then is not moved.
        """
        t, of = self.table, of or {"content": F.col("content")}
        shaped = refs.select("sha256").distinct().withColumn("shaped", F.col("sha256").rlike(SHAPE))
        good = shaped.where("shaped")
        whole = [F.when(F.col("error").isNull(), c).alias(n) for n, c in of.items()]
        found = t.rows(t.prefixes(good), good, seen=lambda d: checked(d).select("sha256", "error", "bytes", *whole, "commit", "prefix"))
        out = shaped.join(found.withColumn("found", F.lit(True)), "sha256", "left")
        error = F.when(~F.coalesce("shaped", F.lit(False)), "ATTACHMENT_INDEX_FAILED").when(F.col("found").isNull(), "ATTACHMENT_STORAGE_FAILED").otherwise(F.col("error"))
        return out.select("sha256", error.alias("error"), "bytes", *of)


def archive_reference(sha256: Column) -> Column:
    """Where an archive of a digest lies below the store."""
    bare = F.regexp_replace(sha256, "^sha256:", "")
    return F.concat(F.substring(bare, 1, 2), F.lit("/"), bare, F.lit(".zip"))


def reference_error(schema: Column, sha256: Column, path: Column, version: str) -> Column:
    """Null for a reference of an archive that is whole: its version, digest and path agree."""
    whole = (schema == version) & sha256.rlike("^[a-f0-9]{64}\\z") & (path == archive_reference(sha256))
    return F.when(~F.coalesce(whole, F.lit(False)), "ATTACHMENT_INDEX_FAILED")
