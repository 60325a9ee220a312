"""The session index as a log of events.

A change of a session is an event with the whole record (``put``) or its end (``remove``), made on top of
the version that its writer has read. A session's records are the last event of each. Two writers
that read the same version both may write; the one whose commit is numbered first is the session's next
version, the other's events are void and its writer is told, so no update is lost silently.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import cut
from ..sources.store import Files, prefix_of
from .catalog import session_key

RECORD = "ord int, name string, kind string, bytes long, sha256 string, committed boolean, pending boolean, binding string"
EVENTS = f"session_id string, session_key string, version long, seq int, op string, attachment_id string, {RECORD}, token string"
FIELDS = [f.split()[0] for f in RECORD.split(", ")]
STALE = "ATTACHMENT_INDEX_FAILED"


def counting(events: DataFrame) -> DataFrame:
    """The events that count, of rows with ``commit``: of each session's version those of its first commit."""
    first = F.min("commit").over(Window.partitionBy("session_id", "version"))
    return events.withColumn("__first", first).where("commit = __first").drop("__first")


def state_of(events: DataFrame) -> DataFrame:
    """The records (session_id, attachment_id, version and the record's fields) that a log's events leave."""
    last = F.max_by(F.struct("op", "version", *FIELDS), F.struct("version", "seq"))
    per = counting(events).groupBy("session_id", "attachment_id").agg(last.alias("m"))
    return per.where("m.op = 'put'").select("session_id", "attachment_id", "m.version", *[f"m.{f}" for f in FIELDS])


def heads_of(events: DataFrame) -> DataFrame:
    """(session_id, version): the version that each session has reached."""
    return counting(events).groupBy("session_id").agg(F.max("version").alias("version"))


class SessionLog:
    """A log in a folder: numbered commits of events, below them ``prefix=`` folders by session key."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/sessions"
        self.files = Files(spark, self.root)
        self.schema = T._parse_datatype_string(f"{EVENTS}, commit long, prefix string")

    def commits(self) -> list[int]:
        return [int(n.removeprefix("commit=")) for n in self.files.names("") if n.startswith("commit=")]

    def events(self, prefixes: list[str] | None = None) -> DataFrame:
        """All events with their commits, of some or all prefixes."""
        paths = [f"{self.root}/commit={c}" for c in self.commits()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", self.root).parquet(*paths)
        return rows if prefixes is None else rows.where(F.col("prefix").isin(prefixes))

    def _prefixes(self, rows: DataFrame) -> list[str]:
        return sorted(r[0] for r in rows.select(prefix_of(session_key(F.col("session_id")))).distinct().collect() if r[0] is not None)

    def state(self, sessions: DataFrame | None = None) -> DataFrame:
        """Records of all sessions, or of those of a table with ``session_id``."""
        if sessions is None:
            return state_of(self.events())
        return state_of(self.events(self._prefixes(sessions)).join(sessions.select("session_id").distinct(), "session_id", "left_semi"))

    def heads(self, sessions: DataFrame) -> DataFrame:
        """(session_id, version) of each of some sessions; 0 for one that has no events."""
        found = heads_of(self.events(self._prefixes(sessions)))
        return sessions.select("session_id").distinct().join(found, "session_id", "left").na.fill(0, ["version"])

    def append(self, changes: DataFrame, token: str | None = None) -> DataFrame:
        """Adds changes (session_id, base, seq, op, attachment_id and the record's fields) as one commit.

        Returns (session_id, version, accepted, error): the sessions whose ``base`` is the version that they
        have reached go on by one version, the others are refused as stale. A ``token`` makes the
        call repeatable: what it has written before is not written again.
        """
        token, changes = token or uuid.uuid4().hex, cut(changes)
        prefixes = self._prefixes(changes)
        if prefixes and self.events(prefixes).where(F.col("token") == token).isEmpty():
            heads = self.heads(changes).withColumnRenamed("version", "__head")
            fresh = changes.join(heads, "session_id").where(F.col("base") == F.col("__head"))
            fresh = fresh.withColumns({"session_key": session_key(F.col("session_id")), "version": F.col("base") + 1, "token": F.lit(token)})
            fresh = fresh.withColumn("prefix", prefix_of(F.col("session_key")))
            stage = f"_staging/{uuid.uuid4().hex}"
            fresh.select(*[f.split()[0] for f in EVENTS.split(", ")], "prefix").write.partitionBy("prefix").parquet(f"{self.root}/{stage}")
            number = max(self.commits(), default=0) + 1
            while not self.files.rename(stage, f"commit={number}"):  # another writer took the number
                number += 1
        own = self.events(prefixes)
        won = counting(own).where(F.col("token") == token).select("session_id", "version").distinct()
        asked = changes.select("session_id").distinct().join(won, "session_id", "left")
        return asked.select("session_id", "version", F.col("version").isNotNull().alias("accepted"), F.when(F.col("version").isNull(), STALE).alias("error"))
