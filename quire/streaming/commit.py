"""Committed uploads: a ``foreachBatch`` sink that keeps accepted chunks, assembles files and publishes them.

For each micro-batch of ``accepted_uploads``:

1. the batch is gathered by upload and written once; of uploads that do not begin and end in it, accepted chunks, and begins
   for their names, are added to the parts table, whose manifest names the others too;
2. what begins and ends in the batch is joined in order as it was gathered; the parts of the other uploads that it
   commits are read back, those prefixes only;
3. each file is admitted: by name, by content (text that is no UTF-8, a package that is none), and by
   what its session holds already (number and bytes, in order of commit);
4. the objects of admitted files are published by digest, and one event a file goes to the session log.

Every step writes under the batch's own id, the query's id and the batch's number, and a step that
finds its id does nothing, so a batch that is run again after a failure adds nothing and goes on where it
stopped. Attachment ids come from the upload's, so they are the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scratch import cut
from ..operators import archive, catalog, text
from ..operators.session_log import FIELDS, SessionLog
from ..sources.store import Objects, Table

PARTS = "upload_key string, session_id string, upload_id string, attempt long, idx int, name string, content binary"
#: States of a session are looked at again this often if another writer is first.
TRIES = 5


def upload_key(df: DataFrame) -> DataFrame:
    """Adds the digest that names an upload's attempt: an id that is begun again is another upload."""
    return df.withColumn("upload_key", F.sha2(F.to_json(F.struct("session_id", "upload_id", "attempt")), 256))


def joined(chunks: Column) -> Column:
    """The bytes of chunks in order."""
    return F.when(F.size(chunks) == 1, chunks[0]["content"]).otherwise(F.unhex(F.array_join(F.transform(chunks, lambda x: F.hex(x["content"])), "")))


def gathered(batch: DataFrame) -> DataFrame:
    """One row per upload of a batch: its name, whether it is ``begun`` and ``at`` what seq it is committed there.

    One that begins and ends in the batch has its whole ``content``, another one its ``parts``: a begin's name, then the chunks.
    An upload has at most a file's limit of bytes, so a group is bounded.
    """
    is_ = lambda status: F.col("status") == status
    per = batch.groupBy("session_id", "upload_id", "attempt").agg(
        F.max(F.when(is_("OPEN"), F.col("name"))).alias("name"), F.bool_or(is_("OPEN")).alias("begun"), F.max(F.when(is_("COMMITTED"), F.col("seq"))).alias("at"),
        F.sort_array(F.collect_list(F.when(is_("OK"), F.struct("idx", "content")))).alias("chunks"),
    )
    whole, kind = F.col("begun") & F.col("at").isNotNull(), "array<struct<idx:int,name:string,content:binary>>"
    begin = F.when(F.col("begun"), F.array(F.struct(F.lit(-1), "name", F.lit(None).cast("binary"))).cast(kind)).otherwise(F.array().cast(kind))
    chunks = F.transform("chunks", lambda x: F.struct(x["idx"], F.lit(None).cast("string"), x["content"])).cast(kind)
    content = F.when(whole, joined(F.col("chunks"))).alias("content")
    return upload_key(per).select("upload_key", "session_id", "upload_id", "attempt", "name", "begun", "at", content, F.when(~whole, F.concat(begin, chunks)).alias("parts"))


def looked_at(files: DataFrame) -> DataFrame:
    """Files with an id, ``bytes``, ``sha256``, display ``name``, ``kind`` and ``error``: what their names and contents say against them."""
    d = files.withColumn("bytes", F.octet_length("content").cast("long")).withColumn("sha256", catalog.content_id(F.col("content")))
    d = archive.classify(d.withColumn("name", archive.display_name(F.col("name"))))
    d = text.admission(d).drop("text")
    packed = F.expr("startswith(content, X'504B')")
    wrong = (F.col("kind") == "archive") & ~packed | F.col("name").rlike(r"(?i)\.(?:docx|xlsx|pptx)$") & ~packed
    reason = F.when(F.col("kind") == "text", F.col("reason"))
    error = F.coalesce("error", F.when(F.col("bytes") == 0, "BAD_REQUEST"), reason, F.when(wrong, F.when(F.col("kind") == "archive", "ARCHIVE_CORRUPT").otherwise("FILE_TYPE_MISMATCH")))
    return d.withColumns({"error": error, "attachment_id": F.concat(F.lit("attachment:"), F.substring("upload_key", 1, 32))}).drop("reason")


class UploadSink:
    """The sink of one stream: ``events.writeStream.foreachBatch(UploadSink(spark, root))`` over ``accepted_uploads``."""

    def __init__(self, spark: SparkSession, root: str, stream: str | None = None):
        root = root.rstrip("/")
        self.stream = stream
        self.parts = Table(spark, f"{root}/parts", PARTS, "upload_key")
        self.ended = Table(spark, f"{root}/ended", "upload_key string, attachment_id string, error string", "upload_key")
        self.objects, self.log = Objects(spark, root), SessionLog(spark, root)

    def __call__(self, batch: DataFrame, number: int) -> None:
        stream = self.stream or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        token = f"{number:012d}-{stream}"
        uploads = cut(looked_at(gathered(batch.where("attempt is not null"))))
        kept = uploads.where("begun or size(parts) > 0").select("upload_key")
        if not kept.isEmpty():
            self.parts.write(uploads.select("upload_key", "session_id", "upload_id", "attempt", F.inline("parts")), kept, token)
        done = uploads.where("at is not null")
        if not done.isEmpty():
            self.commit(done, token)

    def assembled(self, done: DataFrame) -> DataFrame:
        """The files of uploads that are committed, of those begun in other batches by their parts."""
        files, late = done.where("begun").drop("begun", "parts"), done.where("not begun").select("upload_key", "session_id", "upload_id", "attempt", "at")
        if late.isEmpty():
            return files
        rows = self.parts.rows(self.parts.prefixes(late), late, every=True)
        chunks = F.sort_array(F.collect_list(F.when(F.col("idx") >= 0, F.struct("idx", "content"))))
        per = rows.groupBy("upload_key").agg(F.max("name").alias("name"), chunks.alias("chunks")).join(late, "upload_key")
        return files.unionByName(cut(looked_at(per.withColumn("content", joined(F.col("chunks"))).drop("chunks"))))

    def commit(self, done: DataFrame, token: str) -> None:
        """Assembles, admits and publishes gathered uploads."""
        files = self.assembled(done)
        said = self.objects.publish(files.where("error is null").select("sha256", "content"), token)
        broken = cut(said.where("error is not null").select("sha256", F.col("error").alias("broken")))
        named = files.drop("content").join(broken, "sha256", "left")
        good = named.where("error is null and broken is null")
        for _ in range(TRIES):  # another writer of a session may be first
            answers = cut(self.admitted(good))
            fresh = answers.where("admitted").withColumns(
                {"op": F.lit("put"), "seq": F.col("ord"), "committed": F.lit(False), "pending": F.lit(True), "binding": F.lit(None).cast("string")}
            )
            said = self.log.append(fresh.select("session_id", "base", "seq", "op", "attachment_id", *FIELDS), token)
            if said.where("not accepted").isEmpty():
                break
        held = self.log.state(named).select("session_id", "attachment_id", F.lit(True).alias("held"))
        out = named.join(answers.select("upload_key", F.col("error").alias("full")), "upload_key", "left").join(held, ["session_id", "attachment_id"], "left")
        error = F.when(F.col("held").isNull(), F.coalesce("error", "broken", "full", F.lit("ATTACHMENT_INDEX_FAILED")))
        self.ended.write(out.select("upload_key", "attachment_id", error.alias("error")), commit=token)

    def admitted(self, files: DataFrame) -> DataFrame:
        """Files with ``ord``, ``base``, ``admitted`` and ``error``, by what their sessions hold."""
        state = cut(self.log.state(files))
        heads = self.log.heads(files).withColumnRenamed("version", "base")
        most = state.groupBy("session_id").agg(F.max("ord").alias("last"))
        new = files.join(state.select("session_id", "attachment_id"), ["session_id", "attachment_id"], "left_anti").join(heads, "session_id").join(most, "session_id", "left")
        rank = F.row_number().over(Window.partitionBy("session_id").orderBy("at", "upload_key"))
        new = new.withColumn("ord", (F.coalesce("last", F.lit(-1)) + rank).cast("int")).drop("last", "error")
        held = state.select("session_id", "ord", "bytes").withColumn("held", F.lit(True))
        both = held.unionByName(new.select("session_id", "ord", "bytes"), allowMissingColumns=True)
        fits = catalog.admit(both).where("held is null").select("session_id", "ord", "admitted", "error")
        return new.join(fits, ["session_id", "ord"])

    def answers(self) -> DataFrame:
        """(upload_key, attachment_id, error) of every upload that was committed."""
        return self.ended.rows()

    def sweep(self) -> int:
        """Removes the commits of parts whose uploads have all ended; returns how many."""
        ended = self.ended.winners().select("upload_key")
        rows = self.parts.listed()
        left = rows.join(ended, "upload_key", "left_anti").select("commit").distinct()
        old = [r[0] for r in rows.select("commit").distinct().join(left, "commit", "left_anti").collect()]  # one row per batch
        self.parts.sweep(old)
        return len(old)


def read_attachment(sink_root: str, spark: SparkSession, session: str) -> DataFrame:
    """Files (doc_id, name, bytes, sha256, content) of a session's records, for ``Corpus.over``; broken or missing objects are left to ``Objects.read``."""
    wanted = spark.createDataFrame([(session,)], "session_id string")
    state = SessionLog(spark, sink_root).state(wanted)
    content = Objects(spark, sink_root).read(state).where("error is null").select("sha256", "content")
    return state.join(content, "sha256").select(F.col("attachment_id").alias("doc_id"), "name", "bytes", "sha256", "content")
