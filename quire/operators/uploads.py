"""Batch twins of the upload state machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..limits import LIMITS


def strict_base64(text: Column) -> Column:
    """Bytes of canonical base64 that is not empty, else null."""
    # Fixed value: the shape of canonical base64.
    shape = (text != "") & text.rlike(r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?\z")
    raw = F.when(shape, F.unbase64(text))
    return F.when(F.regexp_replace(F.base64(raw), "\r\n", "") == text, raw)


def replay(chunks: DataFrame, chunk_bytes: int = LIMITS.chunk_bytes) -> DataFrame:
    """Outcome of each upload from its chunks (session_id, upload_id, seq, idx, bytes, declared).

    In arrival order a chunk counts if its index is the expected one, it is not too large and the
    total stays within the declared size; any other leaves the state as it was.
    """
    per = chunks.groupBy("session_id", "upload_id").agg(F.max("declared").alias("declared"), F.sort_array(F.collect_list(F.struct("seq", "idx", "bytes"))).alias("cs"))
    kind = "struct<next:int,total:bigint,rejected:int>"

    def step(acc: Column, c: Column) -> Column:
        ok = (c["idx"] == acc["next"]) & (c["bytes"] <= chunk_bytes) & (acc["total"] + c["bytes"] <= F.col("declared"))
        on = F.when(ok, 1).otherwise(0)
        return F.struct((acc["next"] + on).alias("next"), (acc["total"] + on * c["bytes"]).alias("total"), (acc["rejected"] + 1 - on).alias("rejected")).cast(kind)

    start = F.struct(F.lit(0).alias("next"), F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("rejected")).cast(kind)
    s = per.withColumn("s", F.aggregate("cs", start, step))
    return s.select("session_id", "upload_id", F.col("s.next").alias("chunks"), F.col("s.total").alias("received"), F.col("s.rejected").alias("rejected"), (F.col("s.total") == F.col("declared")).alias("complete"))


def idle_expiry(events: DataFrame, idle_seconds: int = LIMITS.idle_seconds) -> DataFrame:
    """Activity runs per key (key, ts): a pause of the idle limit or more expires the upload and starts another."""
    by = Window.partitionBy("key").orderBy("ts", "seq")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = at - F.lag(at).over(by)
    d = events.withColumn("new", F.when(gap >= idle_seconds * 1_000_000, 1).otherwise(0))
    d = d.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return d.groupBy("key", "run").agg(F.count("*").alias("events"), F.min("ts").alias("opened"), F.max("ts").alias("last_activity"))
