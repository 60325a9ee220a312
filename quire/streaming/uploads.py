"""Upload streams: ordered chunks, idle expiry, completion, a global cap.

Events: session_id, upload_id, event (begin, chunk, commit, cancel, cancel_session), seq, idx, bytes,
declared. A chunk counts if it is the expected one, not too large and within the declared size; any
other is answered BAD_REQUEST and changes nothing. Late chunks are never buffered, so there is no
watermark; an upload idle for the limit expires by processing time.

``run_uploads`` keeps one state per upload, so it spreads over any number of tasks; it knows no cap
and no whole session. ``run_capped_uploads`` keeps all open uploads in one state, as the cap on their
number holds across all keys: at most ``most`` uploads of a few numbers each, whatever the traffic.
Both run the same machine, and over a table that is no stream they answer its events once.
"""

from __future__ import annotations

import json
from collections import namedtuple
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.shipping import ship
from ..limits import LIMITS
from ..operators.uploads import strict_base64
from ..sources.files import arrow_stream

OUT = "session_id string, upload_id string, event string, seq long, status string, received long, chunks int"
#: What an accepted event leaves besides: the seq of its upload's begin, a chunk's place and bytes, the upload's name.
KEPT = ", attempt long, idx int, name string, content binary"

NO_EVENTS = pd.DataFrame(columns=["seq"])


class Machine:
    """Open uploads and the answers to their events. An upload is (declared, received, chunks, last activity in ms, seq of its begin)."""

    def __init__(self, chunk_bytes: int, file_bytes: int, idle_ms: int, most: int | None = None):
        self.chunk_bytes, self.file_bytes, self.idle_ms, self.most = chunk_bytes, file_bytes, idle_ms, most
        self.open: dict[tuple[str, str], list[int]] = {}
        self.answers: list[tuple] = []

    def load(self, text: str) -> None:
        self.open = {(a, b): state for a, b, state in json.loads(text)}

    def drain(self) -> list[tuple]:
        """The answers since the last call."""
        out, self.answers = self.answers, []
        return out

    def dump(self) -> str:
        return json.dumps([[*k, state] for k, state in self.open.items()])

    def expire(self, now: int) -> None:
        for key in [k for k, u in self.open.items() if u[3] <= now - self.idle_ms]:
            _, received, chunks, *_ = self.open.pop(key)
            self.answers.append((*key, "expire", -1, "EXPIRED", received, chunks))

    def event(self, r, now: int) -> None:
        key = (r.session_id, r.upload_id)
        if r.event == "cancel_session":
            for k in [k for k in self.open if k[0] == r.session_id]:
                _, received, chunks, *_ = self.open.pop(k)
                self.answers.append((*k, r.event, r.seq, "CANCELLED", received, chunks))
            return
        u = self.open.get(key)
        if r.event == "begin":
            status = self.begin(key, int(r.declared), now, int(r.seq))
        elif u is None:
            status = "BAD_REQUEST"
        elif r.event == "chunk":
            good = r.idx == u[2] and 0 <= r.bytes <= self.chunk_bytes and u[1] + r.bytes <= u[0]
            if good:
                u[1:4] = [u[1] + int(r.bytes), u[2] + 1, now]
            status = "OK" if good else "BAD_REQUEST"
        elif r.event == "commit":
            status = "COMMITTED" if u[1] == u[0] else "BAD_REQUEST"
        else:
            status = "CANCELLED"
        received, chunks = (0, 0) if u is None or r.event == "begin" else u[1:3]
        if status in ("COMMITTED", "CANCELLED"):
            del self.open[key]
        self.answers.append((*key, r.event, r.seq, status, received, chunks))

    def begin(self, key: tuple[str, str], declared: int, now: int, seq: int) -> str:
        if key in self.open or declared <= 0:
            return "BAD_REQUEST"
        if declared > self.file_bytes:
            return "FILE_TOO_LARGE"
        self.expire(now)
        if self.most is not None and len(self.open) >= self.most:
            return "BAD_REQUEST"
        self.open[key] = [declared, 0, 0, now, seq]
        return "OPEN"


def _run(events: DataFrame, keys: list[str], idle_seconds: int, chunk_bytes: int, file_bytes: int, most: int | None, keep: bool = False) -> DataFrame:
    ship(events.sparkSession)
    schema = OUT + KEPT if keep else OUT

    def machine() -> Machine:
        return Machine(chunk_bytes, file_bytes, idle_seconds * 1000, most)

    def taken(m: Machine, r, now: int) -> list[tuple]:
        """The answers that an event brings, the last one with what it leaves."""
        began = m.open.get((r.session_id, r.upload_id), [None] * 5)[4]
        m.event(r, now)
        rows = m.drain()
        if not keep or not rows:
            return rows
        left, status = (None,) * 4, rows[-1][4]
        if status in ("OPEN", "OK", "COMMITTED"):
            left = (r.seq if status == "OPEN" else began, r.idx if status == "OK" else -1, r.name if status == "OPEN" else None, r.content if status == "OK" else None)
        return [(*a, *(None,) * 4) for a in rows[:-1]] + [(*rows[-1], *left)]

    names = [f.split()[0] for f in schema.split(", ")]

    def answered(m: Machine, events: pd.DataFrame, now: int) -> pd.DataFrame:
        rows = [(*a, *(None,) * 4) if keep else a for a in m.drain()]
        for r in events.sort_values("seq").itertuples():
            rows += taken(m, r, now)
        return pd.DataFrame(rows, columns=names).astype({"attempt": "Int64", "idx": "Int32"} if keep else {})

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        m, now = machine(), state.getCurrentProcessingTimeMs()
        if state.exists:
            m.load(state.get[0])
        m.expire(now)
        out = answered(m, pd.concat(list(frames)) if not state.hasTimedOut else NO_EVENTS, now)
        if m.open:
            state.update((m.dump(),))
            state.setTimeoutDuration(max(1, min(u[3] for u in m.open.values()) + m.idle_ms - now))
        elif state.exists:
            state.remove()
        yield out

    if not events.isStreaming:  # all events there are, at one time: a key's rows lie together, in order, and pass one by one
        used = ["session_id", "upload_id", "event", "seq", "idx", "bytes", "declared", *(("name", "content") if keep else ())]
        together = events.select(*keys, *(n for n in used if n not in keys)).repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_last("seq"))
        fields, n_keys = together.columns, len(keys)

        def rows_of(batches: Iterator) -> Iterator[dict]:
            event, key, m = namedtuple("event", fields), None, None
            for b in batches:
                for row in zip(*b.columns, strict=True):
                    r = event(*(x.as_py() for x in row))
                    if m is None or r[:n_keys] != key:
                        key, m = r[:n_keys], machine()
                    for a in taken(m, r._replace(bytes=-1) if r.bytes is None else r, 0):
                        yield dict(zip(names, a, strict=True))

        return arrow_stream(together, rows_of, schema)
    return events.groupBy(*keys).applyInPandasWithState(step, schema, "uploads string", "append", GroupStateTimeout.ProcessingTimeTimeout)


def run_uploads(events: DataFrame, idle_seconds: int = LIMITS.idle_seconds, chunk_bytes: int = LIMITS.chunk_bytes, file_bytes: int = LIMITS.file_bytes) -> DataFrame:
    """Answers to the events of an upload stream, each upload on its own."""
    return _run(events, ["session_id", "upload_id"], idle_seconds, chunk_bytes, file_bytes, None)


def accepted_uploads(events: DataFrame, idle_seconds: int = LIMITS.idle_seconds, chunk_bytes: int = LIMITS.chunk_bytes, file_bytes: int = LIMITS.file_bytes) -> DataFrame:
    """The answers with what accepted events leave: events carry ``name`` and ``data``, a chunk's base64 text, instead of its size.

    A chunk that is no canonical base64, or empty, is refused. ``streaming.commit`` stores what is accepted.
    """
    content = strict_base64(F.col("data"))
    sized = events.withColumn("content", content).withColumn("bytes", F.when(F.col("event") == "chunk", F.coalesce(F.octet_length("content"), F.lit(-1))).otherwise(0).cast("long"))
    return _run(sized.drop("data"), ["session_id", "upload_id"], idle_seconds, chunk_bytes, file_bytes, None, keep=True)


def run_capped_uploads(events: DataFrame, most: int = LIMITS.uploads, idle_seconds: int = LIMITS.idle_seconds, chunk_bytes: int = LIMITS.chunk_bytes, file_bytes: int = LIMITS.file_bytes) -> DataFrame:
    """The same with at most ``most`` uploads open at once over all sessions, and whole sessions cancelled by ``cancel_session``."""
    return _run(events.withColumn("scope", F.lit("all")), ["scope"], idle_seconds, chunk_bytes, file_bytes, most)
