"""Folders that the driver and all executors share, for what a query writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: set[str] = set()


def shared(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` if the cluster names one; else the warehouse. Only a local master may fall back to a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        named = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", named)
        return named
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def folder(spark: SparkSession) -> str:
    """A new folder; the driver's JVM removes the application's folders when it ends."""
    context = spark.sparkContext
    root = f"{shared(spark)}/quire-files-{context.applicationId}"
    if root not in _ROOTS:
        path = context._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
        _ROOTS.add(root)
    return f"{root}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once to a new folder: what is built on them plans and runs from there."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
