"""Shared pieces: words, scratch storage, let-bindings for higher-order functions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters outside these (the class [^\x20\x09-\x0D]+).
WHITE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spaced(text: Column, by: str = " ") -> Column:
    """A text with each white character replaced. Six byte searches cost a tenth of one ``translate``, which looks up every character."""
    for c in WHITE if by != " " else WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def words(text: Column) -> Column:
    """Array of the words of a text; null gives an empty array."""
    return F.array_remove(F.split(spaced(F.coalesce(text, F.lit(""))), " "), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an array-valued expression once: inside ``body`` it is not evaluated again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the table does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        n = f"__{n}"
        while n in taken:
            n = f"_{n}"
        out.append(n)
    return out


def below_share(key: Column, share: Column) -> Column:
    """Whether a row's hash by ``key`` lies in the first ``share`` (0 to 1) of all hashes: a sample that any task can take alone."""
    return F.xxhash64(key).cast("double") <= (share - 0.5) * 2.0**64


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors share.

    ``spark.checkpoint.dir`` if the cluster names one; else the warehouse. Only a local master
    (one machine, as in tests) may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        named = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", named)
        return named
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


_ROOTS: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The application's own folder in the shared storage; the driver's JVM removes it when it ends."""
    context = spark.sparkContext
    root = f"{shared_dir(spark)}/quire-{context.applicationId}"
    if _ROOTS.get(context.applicationId) != root:
        path = context._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
        _ROOTS[context.applicationId] = root
    return root


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write to a new folder of the shared storage and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
