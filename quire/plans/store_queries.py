"""Queries of what is stored: the upload machine, committed uploads, objects by digest, the session log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scratch import folder
from ..operators import catalog, session_log
from ..sources.store import Objects
from ..sources.tables import table
from ..streaming.commit import UploadSink
from ..streaming.uploads import accepted_uploads, run_uploads


def _events(d, *events):
    """One row per event (session_id, upload_id, seq and the fields given) of each document; 16 documents a session."""
    rows = F.array(*[F.struct(F.lit(i).alias("k"), *[c.alias(n) for n, c in e.items()]) for i, e in enumerate(events)])
    d = d.select(F.floor(F.col("doc_id") / 16).cast("string").alias("session_id"), F.concat(F.lit("u"), "doc_id").alias("upload_id"), (F.col("doc_id") * 10).alias("at"), F.explode(rows).alias("e"))
    return d.select("session_id", "upload_id", (F.col("at") + F.col("e.k")).alias("seq"), "e.*").drop("k")


def upload_machine(spark, sf_dir):
    """Each document as an upload of two chunks; every fourth's second chunk has a wrong number, every sixth is cancelled."""
    d = table(spark, sf_dir, "documents").withColumn("n", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    half, zero = F.floor(F.col("n") / 2).cast("bigint"), F.lit(0).cast("bigint")
    event = lambda name, idx, size, declared: {"event": name, "idx": idx.cast("int"), "bytes": size, "declared": declared}
    last = F.when(F.col("doc_id") % 6 == 5, "cancel").otherwise("commit")
    events = _events(
        d, event(F.lit("begin"), F.lit(0), zero, F.col("n")), event(F.lit("chunk"), F.lit(0), half, zero),
        event(F.lit("chunk"), F.when(F.col("doc_id") % 4 == 1, 2).otherwise(1), F.col("n") - half, zero), event(last, F.lit(0), zero, zero),
    )
    return run_uploads(events).select("session_id", "upload_id", "event", "seq", "status", "received", "chunks")


def uploads_committed(spark, sf_dir):
    """Each document's text uploaded, committed and read back from its object; every tenth's chunk is no canonical base64."""
    d = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    data = F.regexp_replace(F.base64(F.col("text").cast("binary")), "\\s", "")
    data = F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit(" "), data)).otherwise(data)
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    event = lambda name, data, declared, title: {"event": F.lit(name), "idx": F.lit(0), "data": data, "declared": declared, "name": title}
    events = _events(d, event("begin", none, F.octet_length("text").cast("bigint"), F.concat(F.lit("up/doc-"), "doc_id", F.lit(".txt"))), event("chunk", data, zero, none), event("commit", none, zero, none))
    root = folder(spark)
    sink = UploadSink(spark, root, stream="query")
    sink(accepted_uploads(events), 0)
    state = sink.log.state()
    found = sink.objects.read(state, chars=F.length(F.decode("content", "UTF-8"))).select("sha256", F.col("error").alias("broken"), "chars")
    return state.join(found, "sha256").select("session_id", "ord", "version", "name", "kind", "bytes", "sha256", "committed", "pending", "broken", "chars")


def objects_published(spark, sf_dir):
    """The texts of even ids are published, then all: which digests the second call stores."""
    d = table(spark, sf_dir, "documents").withColumn("content", F.coalesce("text", F.lit("")).cast("binary"))
    d = d.withColumn("sha256", catalog.content_id(F.col("content")))
    o = Objects(spark, folder(spark))
    o.publish(d.where("doc_id % 2 = 0"), "a")
    return o.publish(d, "b").select("sha256", "stored", "error")


def _log(spark, sf_dir):
    """Documents as events of their sources' sessions, two writers at every third version, every fifth one a removal."""
    d = table(spark, sf_dir, "documents")
    record = {
        "ord": F.col("doc_id").cast("int"), "name": F.concat("doc_id", F.lit(".txt")), "kind": F.lit("text"), "bytes": F.octet_length("text").cast("bigint"), "sha256": F.lit(None).cast("string"),
        "committed": F.lit(True), "pending": F.lit(False), "binding": F.lit(None).cast("string"),
    }
    own = d.select(
        F.col("source").alias("session_id"), F.col("doc_id").alias("version"), F.lit(0).alias("seq"), F.when(F.col("doc_id") % 5 == 0, "remove").otherwise("put").alias("op"),
        F.concat(F.lit("attachment:"), F.floor(F.col("doc_id") / 3)).alias("attachment_id"), (2 * F.col("doc_id")).alias("commit"), *[c.alias(n) for n, c in record.items()],
    )
    late = own.where("version % 3 = 0").withColumns({"commit": F.col("commit") + 1, "attachment_id": F.lit("attachment:lost"), "op": F.lit("put")})
    return own.unionByName(late)


def session_log_state(spark, sf_dir):
    return session_log.state_of(_log(spark, sf_dir)).select("session_id", "attachment_id", "version", "ord", "name", "bytes")


def session_log_heads(spark, sf_dir):
    return session_log.heads_of(_log(spark, sf_dir))


QUERIES = {f.__name__: f for f in (upload_machine, uploads_committed, objects_published, session_log_state, session_log_heads)}
_EVENTS = """
e AS (SELECT source AS session_id, doc_id AS version, CASE WHEN doc_id % 5 = 0 THEN 'remove' ELSE 'put' END AS op, 'attachment:' || (doc_id // 3) AS attachment_id, doc_id, strlen(text) AS bytes FROM documents WHERE doc_id IS NOT NULL)"""
ORACLES = {
    "upload_machine": """
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS n, coalesce(strlen(text), 0) // 2 AS h, doc_id % 4 <> 1 AS whole, doc_id % 6 = 5 AS dropped FROM documents),
e AS (SELECT *, unnest([0, 1, 2, 3]) AS k FROM d)
SELECT CAST(doc_id // 16 AS VARCHAR) AS session_id, 'u' || doc_id AS upload_id, CASE WHEN k = 0 THEN 'begin' WHEN k < 3 THEN 'chunk' WHEN dropped THEN 'cancel' ELSE 'commit' END AS event, doc_id * 10 + k AS seq,
  CASE WHEN n = 0 THEN 'BAD_REQUEST' WHEN k = 0 THEN 'OPEN' WHEN k = 1 OR k = 2 AND whole THEN 'OK' WHEN k = 2 THEN 'BAD_REQUEST' WHEN dropped THEN 'CANCELLED' WHEN whole THEN 'COMMITTED' ELSE 'BAD_REQUEST' END AS status,
  CASE WHEN n = 0 OR k = 0 THEN 0 WHEN k = 1 OR NOT whole THEN h ELSE n END AS received, CAST(CASE WHEN n = 0 OR k = 0 THEN 0 WHEN k = 1 OR NOT whole THEN 1 ELSE 2 END AS INTEGER) AS chunks FROM e""",
    "uploads_committed": """
WITH d AS (SELECT doc_id, doc_id // 16 AS s, text FROM documents WHERE strlen(text) > 0 AND doc_id % 10 <> 3)
SELECT CAST(s AS VARCHAR) AS session_id, CAST(row_number() OVER (PARTITION BY s ORDER BY doc_id) - 1 AS INTEGER) AS ord, CAST(1 AS BIGINT) AS version, 'doc-' || doc_id || '.txt' AS name, 'text' AS kind,
       strlen(text) AS bytes, 'sha256:' || sha256(text) AS sha256, false AS committed, true AS pending, CAST(NULL AS VARCHAR) AS broken, CAST(length(text) AS INTEGER) AS chars FROM d""",
    "objects_published": """
SELECT 'sha256:' || sha256(coalesce(text, '')) AS sha256, NOT bool_or(coalesce(doc_id % 2 = 0, false)) AS stored, CAST(NULL AS VARCHAR) AS error FROM documents GROUP BY 1""",
    "session_log_state": f"""
WITH {_EVENTS}, l AS (SELECT session_id, attachment_id, arg_max(op, version) AS op, max(version) AS version FROM e GROUP BY 1, 2)
SELECT l.session_id, l.attachment_id, l.version, CAST(e.doc_id AS INTEGER) AS ord, e.doc_id || '.txt' AS name, e.bytes FROM l JOIN e ON e.doc_id = l.version AND e.session_id = l.session_id WHERE l.op = 'put'""",
    "session_log_heads": f"WITH {_EVENTS} SELECT session_id, max(version) AS version FROM e GROUP BY 1",
}
