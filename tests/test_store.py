"""Durable tables: commits, several writers, pruning, objects, the session log and committed uploads."""

import base64
import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from quire.operators import session_log
from quire.operators.session_log import SessionLog
from quire.sources import files, store
from quire.sources.files import Corpus
from quire.sources.store import Objects, Table


def sha(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def objects(spark, *contents: bytes):
    return spark.createDataFrame([(sha(c), bytearray(c)) for c in contents], "sha256 string, content binary")


def scanned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_commits(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "k string, v int", "k", digits=2)
    assert t.rows().count() == 0 and t.commits() == []
    rows = lambda v, *ks: spark.createDataFrame([(k, v) for k in ks], "k string, v int")
    assert t.write(rows(1, "ab1", "ab2", "cd1", "cd1"), commit="1")
    assert not t.write(rows(9, "zz"), commit="1")  # a replay adds nothing
    assert t.write(rows(2, "ab1", "ef1"), commit="2")
    want = [("ab1", 1), ("ab2", 1), ("cd1", 1), ("cd1", 1), ("ef1", 2)]
    read = lambda: sorted(map(tuple, t.rows().collect()))
    assert read() == want and sorted(map(tuple, t.rows(["ab"]).collect())) == want[:2]
    assert sorted(map(tuple, t.rows(wanted=rows(0, "ef1", "no")).collect())) == [("ef1", 2)]
    old = t.compact()
    assert old == ["1", "2"] and read() == want
    t.sweep(old)
    assert len(t.commits()) == 1 and read() == want


def test_table_reads_wanted_prefixes_only(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "k string, v int", "k", digits=2)
    t.write(spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(1).alias("v")))
    plan = scanned(t.rows(["0a", "ff"]))
    assert "PartitionFilters" in plan and "0a" in plan
    scan = plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert "prefix" in scan and "ff" in scan


def test_two_writers_of_one_commit(spark, tmp_path):
    """A writer that died after its rows and before its manifest: the next of that id lists them."""
    t = Table(spark, str(tmp_path / "t"), "k string, v int", "k", digits=2)
    rows = spark.createDataFrame([("ab1", 1)], "k string, v int")
    t.write(rows, commit="7")
    t.files.drop("keys/commit=7")
    assert t.rows().count() == 0
    assert not t.write(spark.createDataFrame([("cd1", 2)], "k string, v int"), commit="7")
    assert [tuple(r) for r in t.rows().collect()] == [("ab1", 1)]


def test_objects(spark, tmp_path):
    o = Objects(spark, str(tmp_path))
    first = {r.sha256: (r.stored, r.error) for r in o.publish(objects(spark, b"one", b"two", b"two", b"")).collect()}
    assert first == {sha(b"one"): (True, None), sha(b"two"): (True, None), sha(b""): (True, None)}
    lie = spark.createDataFrame([(sha(b"x"), bytearray(b"y"))], "sha256 string, content binary")
    again = {r.sha256: (r.stored, r.error) for r in o.publish(objects(spark, b"two", b"three").union(lie)).collect()}
    assert again == {sha(b"two"): (False, None), sha(b"three"): (True, None), sha(b"x"): (False, "ATTACHMENT_STORAGE_FAILED")}
    refs = spark.createDataFrame([(sha(b"one"),), (sha(b"three"),), (sha(b"none"),), ("../x",), (None,)], "sha256 string")
    got = {r.sha256: (r.content and bytes(r.content), r.error) for r in o.read(refs).collect()}
    assert got == {sha(b"one"): (b"one", None), sha(b"three"): (b"three", None), sha(b"none"): (None, "ATTACHMENT_STORAGE_FAILED"), "../x": (None, "ATTACHMENT_INDEX_FAILED"), None: (None, "ATTACHMENT_INDEX_FAILED")}


def test_broken_object_is_found_when_it_is_met_again(spark, tmp_path):
    o = Objects(spark, str(tmp_path))
    o.table.write(spark.createDataFrame([(sha(b"one"), 3, bytearray(b"0ne"))], store.OBJECTS))
    assert [(r.stored, r.error) for r in o.publish(objects(spark, b"one")).collect()] == [(False, "ATTACHMENT_STORAGE_FAILED")]
    assert [(r.content, r.error) for r in o.read(objects(spark, b"one")).collect()] == [(None, "ATTACHMENT_STORAGE_FAILED")]


def test_digest_filter(spark):
    rows = spark.range(3000).select(F.concat(F.lit("sha256:"), F.sha2(F.col("id").cast("string"), 256)).alias("sha256"), "id")
    kept = store.may_be_in(rows, store.digest_filter(rows.where("id % 100 = 0")))
    assert kept.where("id % 100 = 0").count() == 30 and kept.count() < 60 and kept.columns == ["sha256", "id"]
    assert store.digest_filter(rows).count() <= store.FILTER_BUCKETS


def test_archive_references(spark):
    good = "ab" * 32
    rows = [("v1", good, f"ab/{good}.zip"), ("v2", good, f"ab/{good}.zip"), ("v1", good, f"../{good}.zip"), ("v1", "AB" * 32, "x"), (None, None, None)]
    d = spark.createDataFrame(rows, "v string, sha256 string, path string")
    got = [r.e for r in d.select(store.reference_error(F.col("v"), F.col("sha256"), F.col("path"), "v1").alias("e")).collect()]
    assert got == [None, *["ATTACHMENT_INDEX_FAILED"] * 4]


CHANGE = f"session_id string, base long, seq int, op string, attachment_id string, {session_log.RECORD}"


def change(spark, *rows):
    """(session, base, seq, op, attachment, bytes)"""
    return spark.createDataFrame([(s, b, q, op, a, q, f"{a}.txt", "text", n, None, False, True, None) for s, b, q, op, a, n in rows], CHANGE)


def test_session_log_interleaved_writers(spark, tmp_path):
    log, other = SessionLog(spark, str(tmp_path)), SessionLog(spark, str(tmp_path))
    said = lambda df: sorted((r.session_id, r.version, r.accepted) for r in df.collect())
    assert said(log.append(change(spark, ("a", 0, 0, "put", "x", 1), ("a", 0, 1, "put", "y", 2), ("b", 0, 0, "put", "z", 3)))) == [("a", 1, True), ("b", 1, True)]
    # both read version 1 of a and write: the second is told, and its other session goes on
    assert said(log.append(change(spark, ("a", 1, 0, "put", "x", 10)))) == [("a", 2, True)]
    assert said(other.append(change(spark, ("a", 1, 0, "put", "x", 99), ("c", 0, 0, "put", "w", 4)))) == [("a", None, False), ("c", 1, True)]
    assert said(other.append(change(spark, ("a", 2, 0, "remove", "y", 0)))) == [("a", 3, True)]
    state = sorted((r.session_id, r.attachment_id, r.bytes, r.version) for r in log.state().collect())
    assert state == [("a", "x", 10, 2), ("b", "z", 3, 1), ("c", "w", 4, 1)]
    assert {(r.session_id, r.version) for r in log.heads(change(spark, ("a", 0, 0, "put", "x", 1), ("n", 0, 0, "put", "x", 1))).collect()} == {("a", 3), ("n", 0)}
    assert [r.attachment_id for r in log.state(change(spark, ("b", 0, 0, "put", "x", 1))).collect()] == ["z"]


def test_session_log_writers_at_the_same_time(spark, tmp_path, monkeypatch):
    """Both have passed the check of versions before either commits: the first number wins, the other's events are void."""
    log, other = SessionLog(spark, str(tmp_path)), SessionLog(spark, str(tmp_path))
    rename, done = log.files.rename, []

    def late(source, target):
        if not done:
            done.append(1)
            other.append(change(spark, ("a", 0, 0, "put", "theirs", 1)))
        return rename(source, target)

    monkeypatch.setattr(log.files, "rename", late)
    assert [(r.accepted, r.error) for r in log.append(change(spark, ("a", 0, 0, "put", "mine", 1))).collect()] == [(False, "ATTACHMENT_INDEX_FAILED")]
    assert [r.attachment_id for r in log.state().collect()] == ["theirs"] and log.commits() == [1, 2]


def test_session_log_token(spark, tmp_path):
    log = SessionLog(spark, str(tmp_path))
    for _ in range(2):
        assert [r.version for r in log.append(change(spark, ("a", 0, 0, "put", "x", 1)), token="batch-1").collect()] == [1]
    assert log.commits() == [1]


def test_cache_of_concurrent_openers(spark, tmp_path, monkeypatch):
    """Two openers that both find nothing stored parse the same bytes; rows stay single."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "in" / "b.csv").write_text("other\n")
    folder, parse, inner = str(tmp_path / "cache"), files.parse_documents, []

    def both(d, i=None):
        if not inner:
            inner.append(1)
            Corpus(spark, str(tmp_path / "in"), cache=folder)
        return parse(d, i)

    monkeypatch.setattr(files, "parse_documents", both)
    c = Corpus(spark, str(tmp_path / "in"), cache=folder)
    assert c.items.where("family = 'cells'").count() == 5
    assert len(files.Table(spark, f"{folder}/parser={files.fingerprint()}", files.SCHEMA, "doc_id").commits()) == 2
    assert "PartitionFilters: [isnotnull(prefix" in scanned(c.items) or "prefix" in scanned(c.items)


EVENT = "session_id string, upload_id string, event string, seq long, idx int, data string, declared long, name string"


def upload(seq, session, upload_id, name, content, size=4, commit=True):
    b64 = lambda x: base64.b64encode(x).decode()
    out = [(session, upload_id, "begin", seq, 0, None, len(content), name)]
    out += [(session, upload_id, "chunk", seq + 1 + k, k, b64(content[i : i + size]), 0, None) for k, i in enumerate(range(0, len(content), size))]
    return [*out, (session, upload_id, "commit", seq + 90, 0, None, 0, None)] if commit else out


def waited(query, rows) -> None:
    for _ in range(2400):
        if rows() or query.exception():
            break
        time.sleep(0.1)
    query.stop()
    assert query.exception() is None


def test_stream_of_chunks_ends_as_objects_and_records(spark, tmp_path):
    from quire.streaming.commit import UploadSink, read_attachment
    from quire.streaming.uploads import accepted_uploads

    rows = upload(0, "s", "u", "dir/a.txt", "héllo wörld".encode()) + upload(100, "s", "v", "copy.txt", "héllo wörld".encode(), size=100)
    rows += upload(200, "s", "bad", "b.txt", b"\xff\xfe\xfd") + upload(300, "t", "x", "x.docx", b"no package") + upload(400, "t", "open", "o.txt", b"12345", commit=False)
    rows += [("s", "u", "chunk", 95, 3, "AAAA", 0, None), ("s", "w", "begin", 500, 0, None, 3, "w.txt"), ("s", "w", "chunk", 501, 0, "", 0, None), ("s", "w", "chunk", 502, 0, "Zm9v", 0, None), ("s", "w", "commit", 503, 0, None, 0, None)]
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(str(tmp_path / "in"))
    root, seen = str(tmp_path / "store"), []
    sink = UploadSink(spark, root)

    def both(batch, number):
        batch = batch.persist()
        sink(batch, number)
        commits = len(sink.parts.commits()), len(sink.log.commits()), len(sink.objects.table.commits())
        sink(batch, number)  # the same batch again
        assert commits == (len(sink.parts.commits()), len(sink.log.commits()), len(sink.objects.table.commits()))
        seen.append(number)

    events = accepted_uploads(spark.readStream.schema(EVENT).parquet(str(tmp_path / "in")))
    q = events.writeStream.foreachBatch(both).option("checkpointLocation", str(tmp_path / "ck")).start()
    waited(q, lambda: seen)
    state = sorted((r.session_id, r.ord, r.name, r.kind, r.bytes, r.committed, r.pending) for r in sink.log.state().collect())
    assert state == [("s", 0, "a.txt", "text", 13, False, True), ("s", 1, "copy.txt", "text", 13, False, True), ("s", 2, "w.txt", "text", 3, False, True)]
    assert sink.objects.table.rows().count() == 2  # equal bytes once
    print("DBG", sink.ended.commits(), sink.ended.listed().collect(), sink.ended._read("rows", sink.ended._with("commit","prefix"), None).collect())
    assert sorted(r.error or "" for r in sink.answers().collect()) == ["", "", "", "FILE_TYPE_MISMATCH", "TEXT_ENCODING_UNSUPPORTED"]
    files_of = read_attachment(root, spark, "s")
    assert sorted(r.text for r in Corpus.over(files_of).texts.collect()) == ["foo", "héllo wörld", "héllo wörld"]
    assert sink.sweep() == 0  # the open upload's parts are in the only commit


def batch_of(spark, *rows):
    """Accepted answers: (session, upload, status, seq, attempt, idx, name, content)."""
    return spark.createDataFrame(
        [(s, u, "", q, st, 0, 0, a, i, n, c and bytearray(c)) for s, u, st, q, a, i, n, c in rows],
        "session_id string, upload_id string, event string, seq long, status string, received long, chunks int, attempt long, idx int, name string, content binary",
    )


def test_uploads_over_several_batches(spark, tmp_path):
    from quire.streaming.commit import UploadSink

    sink = UploadSink(spark, str(tmp_path), stream="one")
    sink(batch_of(spark, ("s", "u", "OPEN", 0, 0, -1, "a.txt", None), ("s", "u", "OK", 2, 0, 1, None, b"b")), 0)
    sink(batch_of(spark, ("s", "u", "OK", 1, 0, 0, None, b"a"), ("s", "u", "COMMITTED", 3, 0, -1, None, None)), 1)
    # the id is begun again: another attempt with its own parts
    sink(batch_of(spark, ("s", "u", "OPEN", 4, 4, -1, "b.txt", None), ("s", "u", "OK", 5, 4, 0, None, b"new"), ("s", "u", "COMMITTED", 6, 4, -1, None, None)), 2)
    sink(batch_of(spark, ("s", "u", "EXPIRED", 9, None, None, None, None)), 3)
    got = sorted((r.ord, r.name, r.bytes, r.version) for r in sink.log.state().collect())
    assert got == [(0, "a.txt", 2, 1), (1, "b.txt", 3, 2)]
    assert sorted(bytes(r.content) for r in sink.objects.table.rows().collect()) == [b"ab", b"new"]
    assert sink.sweep() == 3 and sink.parts.rows().count() == 0


def test_session_limits_hold_over_batches(spark, tmp_path):
    from quire.streaming.commit import UploadSink

    sink = UploadSink(spark, str(tmp_path), stream="one")
    for number, count in ((0, 15), (1, 10)):
        rows = []
        for k in range(count):
            u, q = f"u{number}-{k:02d}", 1000 * number + 10 * k
            rows += [("s", u, "OPEN", q, q, -1, f"{u}.txt", None), ("s", u, "OK", q + 1, q, 0, None, u.encode()), ("s", u, "COMMITTED", q + 2, q, -1, None, None)]
        sink(batch_of(spark, *rows), number)
    assert [r.ord for r in sink.log.state().orderBy("ord").collect()] == list(range(20))
    assert sorted(r.error or "" for r in sink.answers().collect()) == [""] * 20 + ["TOO_MANY_ATTACHMENTS"] * 5


@pytest.mark.parametrize("text", ["", "====", "AAA", "AA=A", "AB==", "A A=", "Zm9v\n"])
def test_base64_is_strict(spark, text):
    from quire.operators.uploads import strict_base64

    assert spark.createDataFrame([(text,)], "t string").select(strict_base64(F.col("t"))).first()[0] is None


def moved(spark) -> dict[int, int]:
    """The bytes that each stage has shuffled, spilled and written."""
    context, jvm = spark.sparkContext._jsc.sc(), spark.sparkContext._jvm
    context.listenerBus().waitUntilEmpty(10_000)
    stages = context.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    every = [stages.apply(i) for i in range(stages.size())]
    return {s.stageId(): s.shuffleWriteBytes() + s.diskBytesSpilled() + s.outputBytes() for s in every}


def test_bytes_of_uploads_move_few_times(spark, tmp_path):
    """Gathered, kept, dealt by digest and stored: four times; reading what is made of them moves none."""
    from quire.streaming.commit import UploadSink

    rows, size = [], 0
    for k in range(40):
        half = [base64.b64encode(random.Random(2 * k + i).randbytes(20_000)) for i in range(2)]
        size += sum(map(len, half))
        rows += [("s" if k < 20 else "t", f"u{k}", "OPEN", 10 * k, 10 * k, -1, f"{k}.txt", None)]
        rows += [("s" if k < 20 else "t", f"u{k}", "OK", 10 * k + 1 + i, 10 * k, i, None, half[i]) for i in range(2)]
        rows += [("s" if k < 20 else "t", f"u{k}", "COMMITTED", 10 * k + 3, 10 * k, -1, None, None)]
    batch_of(spark, *rows).write.parquet(str(tmp_path / "batch"))
    sink, before = UploadSink(spark, str(tmp_path / "store"), stream="one"), moved(spark)
    sink(spark.read.parquet(str(tmp_path / "batch")), 0)
    after = moved(spark)
    assert sum(v for k, v in after.items() if k not in before) < 5 * size
    assert sink.parts.rows().count() == 0 and sink.parts.listed().count() == 40  # what ends in its batch needs no parts
    state = sink.log.state()
    assert state.count() == 40
    before = moved(spark)
    read = sink.objects.read(state, chars=F.length(F.decode("content", "UTF-8")))
    assert read.columns == ["sha256", "error", "bytes", "chars"] and sorted({tuple(r)[1:] for r in read.collect()}) == [(None, 53336, 53336)]
    assert sum(v for k, v in moved(spark).items() if k not in before) < size / 4
    assert sorted(len(r.content) for r in sink.objects.read(state).collect()) == [53336] * 40


def test_upload_in_parts_and_whole_uploads_of_one_batch(spark, tmp_path):
    """A batch ends an older upload, holds a whole one with the same name, and leaves one open; names are cut once, at the end."""
    from quire.streaming.commit import UploadSink

    sink = UploadSink(spark, str(tmp_path), stream="one")
    sink(batch_of(spark, ("s", "u", "OPEN", 0, 0, -1, "d/a.txt", None), ("s", "u", "OK", 1, 0, 0, None, b"one")), 0)
    late = [("s", "u", "OK", 2, 0, 1, None, b"two"), ("s", "u", "COMMITTED", 3, 0, -1, None, None), ("s", "v", "OPEN", 4, 4, -1, "d/a.txt", None), ("s", "v", "OK", 6, 4, 1, None, b"b"), ("s", "v", "OK", 5, 4, 0, None, b"a"), ("s", "v", "COMMITTED", 7, 4, -1, None, None)]
    sink(batch_of(spark, *late, ("s", "w", "OPEN", 8, 8, -1, "d/w.txt", None), ("s", "w", "OK", 9, 8, 0, None, b"w")), 1)
    assert sorted((r.ord, r.name, r.bytes) for r in sink.log.state().collect()) == [(0, "a.txt", 6), (1, "a.txt", 2)]
    assert sorted(bytes(r.content) for r in sink.objects.table.rows().collect()) == [b"ab", b"onetwo"]
    parts = sorted((r.upload_id, r.idx, r.name, r.content and bytes(r.content)) for r in sink.parts.rows(every=True).collect())
    assert parts == [("u", -1, "d/a.txt", None), ("u", 0, None, b"one"), ("u", 1, None, b"two"), ("w", -1, "d/w.txt", None), ("w", 0, None, b"w")]


def test_objects_that_are_all_stored(spark, tmp_path):
    o = Objects(spark, str(tmp_path))
    o.publish(objects(spark, b"one", b"two"), "a")
    again = o.publish(objects(spark, b"one", b"two", b"one"), "b").collect()
    assert sorted((r.sha256, r.stored, r.error) for r in again) == sorted((sha(x), False, None) for x in (b"one", b"two"))
    assert o.table.commits() == ["a", "b"] and sorted(bytes(r.content) for r in o.table.rows().collect()) == [b"one", b"two"]
