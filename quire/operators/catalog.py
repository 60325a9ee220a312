"""Session catalog: admission, identity, binding, visibility.

A catalog table has session_id, ord, attachment_id, name, kind, bytes, sha256, committed, pending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..limits import LIMITS

# Engine error codes and the public codes that they become.
ENGINE_CODES = {
    "FILE_TOO_LARGE": "FILE_TOO_LARGE",
    "FILE_TYPE_MISMATCH": "FILE_TYPE_MISMATCH",
    "DOCUMENT_CORRUPT": "DOCUMENT_CORRUPT",
    "DOCUMENT_RESOURCE_LIMIT": "DOCUMENT_RESOURCE_LIMIT",
    "DOCUMENT_PARSE_TIMEOUT": "DOCUMENT_PARSE_TIMEOUT",
    "LEGACY_OFFICE_UNSUPPORTED": "LEGACY_OFFICE_UNSUPPORTED",
    "ENCRYPTED_DOCUMENT_UNSUPPORTED": "ENCRYPTED_DOCUMENT_UNSUPPORTED",
    "TEXT_ENCODING_UNSUPPORTED": "TEXT_ENCODING_UNSUPPORTED",
    "INVALID_TEXT": "TEXT_ENCODING_UNSUPPORTED",
    "PARSER_OUTPUT_INVALID": "PARSER_OUTPUT_INVALID",
    "PARSER_VERSION_MISMATCH": "PARSER_VERSION_MISMATCH",
    "ATTACHMENT_WRITE_FAILED": "ATTACHMENT_STORAGE_FAILED",
    "ATTACHMENT_READ_FAILED": "ATTACHMENT_STORAGE_FAILED",
    "ATTACHMENT_NOT_FOUND": "ATTACHMENT_NOT_FOUND",
    "ATTACHMENT_INDEX_FAILED": "ATTACHMENT_INDEX_FAILED",
}


def public_code(code: Column) -> Column:
    """Public error code of an engine code; unknown ones and null are storage failures."""
    table = F.create_map(*[F.lit(x) for pair in ENGINE_CODES.items() for x in pair])
    return F.coalesce(table[F.coalesce(code, F.lit(""))], F.lit("ATTACHMENT_STORAGE_FAILED"))


def content_id(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def publish(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming objects (sha256, content) that are not stored yet, each once."""
    return incoming.dropDuplicates(["sha256"]).join(stored.select("sha256"), "sha256", "left_anti")


def read_objects(objects: DataFrame) -> DataFrame:
    """Objects whose digest still holds; others carry the error of a broken store."""
    ok = content_id(F.col("content")) == F.col("sha256")
    return objects.withColumn("error", F.when(~ok, "ATTACHMENT_STORAGE_FAILED")).withColumn("content", F.when(ok, F.col("content")))


def is_pending() -> Column:
    return F.coalesce("pending", ~F.col("committed"))


def admit(files: DataFrame, most_files: int = LIMITS.session_files, most_bytes: int = LIMITS.session_bytes, each: int = LIMITS.file_bytes) -> DataFrame:
    """Adds ``admitted`` and ``error`` per file, in session order.

    A rejected file leaves the session as it was and a later one may fit, so a session is one fold
    over the sizes of the files that can fit at all. Its state is the admitted files alone, at most
    ``most_files``; what the others lacked follows from the files admitted before them.
    """
    fit = files.where((F.col("bytes") > 0) & (F.col("bytes") <= each))
    per = fit.groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct(F.col("ord").cast("int").alias("ord"), F.col("bytes").cast("bigint").alias("bytes")))).alias("fs"))
    kind = "struct<total:bigint,got:array<struct<ord:int,bytes:bigint>>>"

    def step(acc: Column, f: Column) -> Column:
        fits = (F.size(acc["got"]) < most_files) & (acc["total"] + f["bytes"] <= most_bytes)
        return F.when(fits, F.struct((acc["total"] + f["bytes"]).alias("total"), F.concat(acc["got"], F.array(f)).alias("got")).cast(kind)).otherwise(acc)

    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<struct<ord:int,bytes:bigint>>").alias("got")).cast(kind)
    got = per.select("session_id", F.aggregate("fs", start, step)["got"].alias("__got"))
    before = F.filter("__got", lambda x: x["ord"] < F.col("ord"))
    error = (
        F.when(F.col("bytes") <= 0, "BAD_REQUEST")
        .when(F.col("bytes") > each, "FILE_TOO_LARGE")
        .when(F.exists("__got", lambda x: x["ord"] == F.col("ord")), F.lit(None))
        .when(F.size(before) >= most_files, "TOO_MANY_ATTACHMENTS")
        .otherwise("ATTACHMENTS_TOO_LARGE")
    )
    return files.join(got, "session_id", "left").withColumn("error", error).withColumn("admitted", F.col("error").isNull()).drop("__got")


def session_key(session: Column) -> Column:
    """Name under which a session's records are stored."""
    return F.sha2(session.cast("binary"), 256)


def active_turn(bindings: DataFrame) -> DataFrame:
    """The attachments of each session's active turn, from events (session_id, seq, event, turn, attachment_id).

    ``activate`` starts a turn with its attachments, ``clear`` ends it; the latest event counts.
    """
    last = bindings.groupBy("session_id").agg(F.max_by(F.struct("event", "turn"), "seq").alias("m"))
    on = last.where("m.event = 'activate'").select("session_id", F.col("m.turn").alias("turn"))
    return bindings.where("event = 'activate'").join(on, ["session_id", "turn"]).select("session_id", "turn", "attachment_id").distinct()


def listed(catalog: DataFrame, session: str) -> DataFrame:
    return catalog.where(F.col("session_id") == session).orderBy("ord")


def available(catalog: DataFrame) -> DataFrame:
    return catalog.where("committed")


def bind_pending(catalog: DataFrame, binding: Column) -> DataFrame:
    """Commits what is pending and binds it; the rest stays as it is."""
    p = is_pending()
    return catalog.withColumns({"binding": F.when(p, binding).otherwise(F.col("binding")), "committed": F.col("committed") | p, "pending": F.lit(False)})


def remove_draft(catalog: DataFrame, session: str, attachment: str) -> DataFrame:
    """Drops a pending draft; one that is committed too only stops being pending."""
    hit = (F.col("session_id") == session) & (F.col("attachment_id") == attachment) & is_pending()
    kept = catalog.where(~hit | F.col("committed"))
    return kept.withColumn("pending", F.when(hit, F.lit(False)).otherwise(F.col("pending")))


def resolve(catalog: DataFrame, session: str, attachment: str) -> DataFrame:
    return catalog.where((F.col("session_id") == session) & (F.col("attachment_id") == attachment) & F.col("committed"))


def missing_references(catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    """References (session_id, attachment_id) that name nothing; a commit needs this to be empty."""
    return wanted.join(catalog, ["session_id", "attachment_id"], "left_anti")


def visible(catalog: DataFrame, active: DataFrame) -> DataFrame:
    """Records a session sees: those of its active turn, else all committed ones; with the scope."""
    on = catalog.where("committed")
    with_turn = active.select("session_id").distinct()
    turn = on.join(active, ["session_id", "attachment_id"], "left_semi").withColumn("scope", F.lit("turn"))
    rest = on.join(with_turn, "session_id", "left_anti").withColumn("scope", F.lit("conversation"))
    return turn.unionByName(rest)


def summary(catalog: DataFrame) -> DataFrame:
    """Message per session: number of attachments and their names in order."""
    names = F.transform(F.sort_array(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"])
    return catalog.groupBy("session_id").agg(F.count("*").alias("n"), names.alias("names")).select(
        "session_id", F.concat(F.col("n").cast("string"), F.lit(" 个附件："), F.array_join("names", "、")).alias("message")
    )


def manifest(catalog: DataFrame, fields: Sequence[str] = ("attachment_id", "name", "kind", "bytes", "sha256")) -> DataFrame:
    """JSON manifest per session."""
    rows = F.transform(F.sort_array(F.collect_list(F.struct("ord", F.struct(*fields).alias("r")))), lambda x: x["r"])
    return catalog.groupBy("session_id").agg(F.to_json(rows).alias("manifest"))


def insert_after_last_user(messages: DataFrame, text: Column) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) with one more right after the last user message."""
    last = messages.where("role = 'user'").groupBy("conv_id").agg(F.max("turn").alias("at"))
    extra = last.select("conv_id", F.col("at").alias("turn"), F.lit(1).alias("sub"), F.lit("runtime").alias("role"), text.alias("text"))
    base = messages.select("conv_id", "turn", F.lit(0).alias("sub"), "role", "text")
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "sub"))
    return base.unionByName(extra).withColumn("turn", rank).drop("sub")
