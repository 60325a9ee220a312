"""Queries of the session catalog (each document source is a session), uploads, filters and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, misc, uploads
from ..sources.tables import table


def _files(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("source").alias("session_id"), F.col("doc_id").cast("int").alias("ord"), F.concat(F.lit("attachment:"), "doc_id").alias("attachment_id"),
        F.concat("doc_id", F.lit(".txt")).alias("name"), F.lit("text").alias("kind"), F.octet_length("text").cast("bigint").alias("bytes"),
        catalog.content_id(F.col("text").cast("binary")).alias("sha256"), (F.col("doc_id") % 3 != 0).alias("committed"),
        F.when(F.col("doc_id") % 4 == 0, True).when(F.col("doc_id") % 4 == 1, False).alias("pending"), F.lit(None).cast("string").alias("binding"),
    )


def cas_dedup(spark, sf_dir):
    f = table(spark, sf_dir, "documents").select(catalog.content_id(F.col("text").cast("binary")).alias("sha256"), F.octet_length("text").alias("bytes"), "doc_id")
    return catalog.publish(f.where("doc_id % 10 = 0"), f).select("sha256", "bytes")


def catalog_admission(spark, sf_dir):
    return catalog.admit(_files(spark, sf_dir), most_files=20, most_bytes=40_000, each=9000).select("session_id", "ord", "bytes", "admitted", "error")


def catalog_bind(spark, sf_dir):
    bound = catalog.bind_pending(_files(spark, sf_dir), F.lit("message-1"))
    return bound.select("attachment_id", "committed", "pending", "binding")


def catalog_remove_draft(spark, sf_dir):
    return catalog.remove_draft(_files(spark, sf_dir), "src0", "attachment:0").select("attachment_id", "committed", "pending")


def catalog_visible(spark, sf_dir):
    f = _files(spark, sf_dir)
    active = f.where("session_id < 'src13' AND ord % 5 = 1").select("session_id", "attachment_id")
    return catalog.visible(f, active).select("session_id", "attachment_id", "scope")


def catalog_summary(spark, sf_dir):
    return catalog.summary(_files(spark, sf_dir))


def catalog_missing(spark, sf_dir):
    f = _files(spark, sf_dir)
    return catalog.missing_references(f.where("ord % 7 <> 0"), f.select("session_id", "attachment_id"))


def turn_context(spark, sf_dir):
    return catalog.insert_after_last_user(table(spark, sf_dir, "conversations"), F.lit("manifest"))


def error_codes(spark, sf_dir):
    names = [*catalog.ENGINE_CODES, "SOMETHING_ELSE"]
    e = table(spark, sf_dir, "events").select("event_id", F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % len(names) + 1).cast("int")).alias("code"))
    return e.groupBy(catalog.public_code(F.col("code")).alias("public_code")).agg(F.count("*").alias("n"))


def upload_state(spark, sf_dir):
    """Users as uploads, their events as chunks: every seventh event repeats the index before it."""
    e = table(spark, sf_dir, "events")
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    c = e.select(F.lit("s").alias("session_id"), F.col("user_id").alias("upload_id"), k.alias("seq"), (k - F.floor(k / 7)).cast("int").alias("idx"), (F.col("event_id") % 1000 + 1).alias("bytes"))
    return uploads.replay(c.withColumn("declared", F.lit(20_000).cast("bigint")), chunk_bytes=950)


def upload_idle_expiry(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("seq"))
    return uploads.idle_expiry(e, 86_400)


def image_patch_budget(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 97 * 83 + 1).alias("w"), (F.col("p_size") * 131 + 7).alias("h"))
    w, h = misc.patch_budget(F.col("w"), F.col("h"))
    return p.select("p_partkey", w.alias("width"), h.alias("height"))


_CALLS = ("find / -name x", "ls src", "grep -r attachment .", "cat attachment:7", "rg TODO src", "find ~ -type f", "echo find")


def discovery_denial(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    tool = F.when(F.col("turn") % 3 == 0, "bash").when(F.col("turn") % 3 == 1, "Read_File").otherwise("edit")
    call = F.element_at(F.array(*[F.lit(x) for x in _CALLS]), (F.col("conv_id") % len(_CALLS) + 1).cast("int"))
    return c.select("conv_id", "turn", misc.discovery_denied(tool, call, ["attachment:7", "attachment:9"]).alias("denied"))


#: What each document gets appended, by its number: a breach of each rule and a near miss of each.
_PLANTED = (
    "in /Users/jo.doe/x", "in /Users/", "at /home/ana-1/y", "at /home//y", "on C:\\Users\\me\\z", "on C:\\Users\\", "SESSION-0123abcd-0123-4567-89ab-0123456789AB", "session-0123abcd-0123-4567-89ab-0123456789a",
    "ghp_" + "a1" * 10, "ghp_" + "a1" * 9, "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN DSA PRIVATE KEY-----", "sk-" + "b_2-" * 5 + "c", "task-" + "b2" * 12, "AKIA" + "Z9" * 8, "AKIA" + "Z9" * 8 + "Q", "nothing",
)


def secret_scan(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    more = F.element_at(F.array(*[F.lit(x) for x in _PLANTED]), (F.col("doc_id") % len(_PLANTED) + 1).cast("int"))
    return misc.rule_scan(d.select("doc_id", F.concat_ws("\n", "text", more).alias("text")))


def json_window(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", "event_id", "props")
    return misc.window_lines(e, ["event_type"], "event_id", "props", offset=5, most=6000).select("event_type", "event_id", "n", "shown", "used")


def format_bytes(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", misc.format_bytes(F.col("p_partkey") * F.col("p_partkey") * 10).alias("shown"))


def catalog_list(spark, sf_dir):
    """One session's records in order, with whether they are available, resolvable and pending."""
    f = _files(spark, sf_dir)
    on = catalog.available(f).select("attachment_id", F.lit(True).alias("available"))
    one = catalog.resolve(f, "src1", "attachment:1").select("attachment_id", F.lit(True).alias("resolved"))
    d = catalog.listed(f, "src1").join(on, "attachment_id", "left").join(one, "attachment_id", "left")
    return d.select("ord", "attachment_id", F.coalesce("available", F.lit(False)).alias("available"), F.coalesce("resolved", F.lit(False)).alias("resolved"), catalog.is_pending().alias("is_pending"), catalog.session_key(F.col("session_id")).alias("session_key"))


def catalog_manifest(spark, sf_dir):
    return catalog.manifest(_files(spark, sf_dir), ("attachment_id", "name", "kind", "bytes"))


def catalog_active_turn(spark, sf_dir):
    """Every third record starts a turn with it, every twentieth clears; then what each session sees."""
    f = _files(spark, sf_dir)
    event = F.when(F.col("ord") % 20 == 0, "clear").otherwise("activate")
    e = f.where("ord % 3 = 0").select("session_id", F.col("ord").alias("seq"), event.alias("event"), F.floor(F.col("ord") / 100).alias("turn"), "attachment_id")
    return catalog.visible(f, catalog.active_turn(e).select("session_id", "attachment_id")).select("session_id", "attachment_id", "scope")


def read_objects(spark, sf_dir):
    """Stored objects of which every fourth was changed in place."""
    d = table(spark, sf_dir, "documents").where("doc_id is not null and text is not null")
    kept = F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).cast("binary")
    o = catalog.read_objects(d.select("doc_id", catalog.content_id(F.col("text").cast("binary")).alias("sha256"), kept.alias("content")))
    return o.select("doc_id", F.octet_length("content").cast("bigint").alias("bytes"), "error")


def folder_admission(spark, sf_dir):
    """Sources as folders whose declared sizes are right, wrong or too large."""
    from ..operators import archive

    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    k = F.length("source") + F.ascii(F.substring("source", -1, 1))
    f = d.select(F.col("source").alias("archive_id"), F.repeat(F.lit("x"), (F.col("n") % 50).cast("int")).cast("binary").alias("content"), k.alias("k"), (F.col("n") % 50).alias("size"))
    f = f.withColumn("snapshot_bytes", F.when(F.col("k") % 4 == 1, F.col("size") + 1).otherwise(F.col("size"))).withColumn("source_bytes", F.when(F.col("k") % 4 == 2, 104857601).otherwise(104857600))
    checked = f.select("archive_id", F.when(F.col("k") % 4 == 3, "ARCHIVE_CORRUPT").alias("error"))
    return archive.folder_admission(f, checked).select("archive_id", "error")


def base64_chunks(spark, sf_dir):
    """Canonical base64 of names, and four ways to spoil it."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.regexp_replace(F.base64(F.col("p_name").cast("binary")), "\\s", "").alias("b"))
    spoilt = F.element_at(F.array(F.col("b"), F.concat("b", F.lit("=")), F.concat(F.lit(" "), "b"), F.concat("b", F.lit("A")), F.lit("")), (F.col("p_partkey") % 5 + 1).cast("int"))
    return p.select("p_partkey", F.decode(uploads.strict_base64(spoilt), "UTF-8").alias("name"))


def names_and_badges(spark, sf_dir):
    from ..operators import archive

    p = table(spark, sf_dir, "pages")
    tails = (".tar.gz", "", " .Html ", "\x07x.py", "/", "\\new.longext", ".md")
    raw = F.concat(F.lit("up/"), "page_id", F.element_at(F.array(*[F.lit(t) for t in tails]), (F.col("page_id") % len(tails) + 1).cast("int")))
    return p.select(
        "page_id", archive.display_name(raw).alias("display_name"), archive.root_name(raw).alias("root_name"), archive.badge(raw, F.col("page_id") % 11 == 0).alias("badge"),
        archive.folder_path(raw).alias("folder_path"),
    )


def image_fit(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 97 * 83 + 1).alias("w"), (F.col("p_size") * 131 + 7).alias("h"))
    w, h = misc.resize_to_fit(F.col("w"), F.col("h"))
    return p.select("p_partkey", w.alias("width"), h.alias("height"))


def json_cap(spark, sf_dir):
    """Events' properties repeated, so that some are over the cap."""
    e = table(spark, sf_dir, "events").select("event_id", F.repeat(F.lit("ab"), (F.col("event_id") % 60 * 10).cast("int")).alias("j"))
    return e.select("event_id", misc.capped(F.col("j"), 900, 40).alias("answer"))


_FILES = """SELECT source AS session_id, CAST(doc_id AS INTEGER) AS ord, 'attachment:' || doc_id AS attachment_id, strlen(text) AS bytes, doc_id % 3 <> 0 AS committed,
       CASE doc_id % 4 WHEN 0 THEN true WHEN 1 THEN false END AS pending, text, doc_id FROM documents"""

QUERIES = {
    f.__name__: f
    for f in (
        cas_dedup, catalog_admission, catalog_bind, catalog_remove_draft, catalog_visible, catalog_summary, catalog_missing, turn_context, error_codes, upload_state,
        upload_idle_expiry, image_patch_budget, discovery_denial, secret_scan, json_window, format_bytes, catalog_list, catalog_manifest, catalog_active_turn, read_objects,
        folder_admission, base64_chunks, names_and_badges, image_fit, json_cap,
    )
}
ORACLES = {
    "cas_dedup": """
WITH d AS (SELECT 'sha256:' || sha256(text) AS sha256, CAST(strlen(text) AS INTEGER) AS bytes, doc_id FROM documents)
SELECT DISTINCT sha256, bytes FROM d WHERE sha256 NOT IN (SELECT sha256 FROM d WHERE doc_id % 10 = 0)""",
    "catalog_admission": f"""
WITH RECURSIVE f AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ord) AS k FROM ({_FILES})),
r(session_id, k, n, total, error) AS (
  SELECT DISTINCT session_id, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR) FROM f
  UNION ALL
  SELECT session_id, k, CASE WHEN e IS NULL THEN n + 1 ELSE n END, CASE WHEN e IS NULL THEN total + bytes ELSE total END, e FROM (
    SELECT f.session_id, f.k, r.n, r.total, f.bytes,
      CASE WHEN f.bytes <= 0 THEN 'BAD_REQUEST' WHEN f.bytes > 9000 THEN 'FILE_TOO_LARGE' WHEN r.n >= 20 THEN 'TOO_MANY_ATTACHMENTS'
           WHEN r.total + f.bytes > 40000 THEN 'ATTACHMENTS_TOO_LARGE' END AS e
    FROM r JOIN f ON f.session_id = r.session_id AND f.k = r.k + 1))
SELECT f.session_id, f.ord, f.bytes, r.error IS NULL AS admitted, r.error FROM f JOIN r ON f.session_id = r.session_id AND f.k = r.k""",
    "catalog_bind": f"""
SELECT attachment_id, committed OR coalesce(pending, NOT committed) AS committed, false AS pending,
       CASE WHEN coalesce(pending, NOT committed) THEN 'message-1' END AS binding FROM ({_FILES})""",
    "catalog_remove_draft": f"""
SELECT attachment_id, committed, CASE WHEN session_id = 'src0' AND attachment_id = 'attachment:0' AND coalesce(pending, NOT committed) THEN false ELSE pending END AS pending
FROM ({_FILES}) WHERE NOT (session_id = 'src0' AND attachment_id = 'attachment:0' AND coalesce(pending, NOT committed)) OR committed""",
    "catalog_visible": f"""
WITH f AS ({_FILES}), a AS (SELECT session_id, attachment_id FROM f WHERE session_id < 'src13' AND ord % 5 = 1)
SELECT session_id, attachment_id, 'turn' AS scope FROM f WHERE committed AND attachment_id IN (SELECT attachment_id FROM a)
UNION ALL SELECT session_id, attachment_id, 'conversation' FROM f WHERE committed AND session_id NOT IN (SELECT session_id FROM a)""",
    "catalog_summary": "SELECT source AS session_id, count(*) || ' 个附件：' || string_agg(doc_id || '.txt', '、' ORDER BY doc_id) AS message FROM documents GROUP BY source",
    "catalog_missing": f"SELECT session_id, attachment_id FROM ({_FILES}) WHERE ord % 7 = 0",
    "turn_context": """
WITH l AS (SELECT conv_id, max(turn) AS turn FROM conversations WHERE role = 'user' GROUP BY 1),
u AS (SELECT conv_id, turn, 0 AS sub, role, text FROM conversations UNION ALL SELECT conv_id, turn, 1, 'runtime', 'manifest' FROM l)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, sub) AS INTEGER) AS turn, role, text FROM u""",
    "error_codes": """
SELECT CASE event_id % 16 WHEN 0 THEN 'FILE_TOO_LARGE' WHEN 1 THEN 'FILE_TYPE_MISMATCH' WHEN 2 THEN 'DOCUMENT_CORRUPT' WHEN 3 THEN 'DOCUMENT_RESOURCE_LIMIT'
  WHEN 4 THEN 'DOCUMENT_PARSE_TIMEOUT' WHEN 5 THEN 'LEGACY_OFFICE_UNSUPPORTED' WHEN 6 THEN 'ENCRYPTED_DOCUMENT_UNSUPPORTED' WHEN 7 THEN 'TEXT_ENCODING_UNSUPPORTED'
  WHEN 8 THEN 'TEXT_ENCODING_UNSUPPORTED' WHEN 9 THEN 'PARSER_OUTPUT_INVALID' WHEN 10 THEN 'PARSER_VERSION_MISMATCH' WHEN 13 THEN 'ATTACHMENT_NOT_FOUND'
  WHEN 14 THEN 'ATTACHMENT_INDEX_FAILED' ELSE 'ATTACHMENT_STORAGE_FAILED' END AS public_code, count(*) AS n FROM events GROUP BY 1""",
    "upload_state": """
WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k, event_id % 1000 + 1 AS bytes FROM events),
c AS (SELECT user_id, k, k - k // 7 AS idx, bytes FROM e),
s(user_id, k, nxt, total, rejected) AS (
  SELECT DISTINCT user_id, CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM c
  UNION ALL
  SELECT user_id, k, nxt + ok, total + ok * bytes, rejected + 1 - ok FROM (
    SELECT c.user_id, c.k, nxt, total, rejected, bytes, CASE WHEN idx = nxt AND bytes <= 950 AND total + bytes <= 20000 THEN 1 ELSE 0 END AS ok
    FROM s JOIN c ON c.user_id = s.user_id AND c.k = s.k + 1))
SELECT 's' AS session_id, user_id AS upload_id, CAST(arg_max(nxt, k) AS INTEGER) AS chunks, arg_max(total, k) AS received,
       CAST(arg_max(rejected, k) AS INTEGER) AS rejected, arg_max(total, k) = 20000 AS complete FROM s GROUP BY user_id""",
    "upload_idle_expiry": """
WITH g AS (SELECT user_id AS key, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) >= 86400000000 THEN 1 ELSE 0 END AS new FROM events),
r AS (SELECT *, CAST(sum(new) OVER (PARTITION BY key ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM g)
SELECT key, run, count(*) AS events, min(ts) AS opened, max(ts) AS last_activity FROM r GROUP BY key, run""",
    "image_patch_budget": """
WITH a AS (SELECT p_partkey, (p_partkey % 97 * 83 + 1)::DOUBLE AS w, (p_size * 131 + 7)::DOUBLE AS h FROM part),
b AS (SELECT *, greatest(1.0, floor(w * least(1.0, 2000 / greatest(w, h)) + 0.5)) AS w1, greatest(1.0, floor(h * least(1.0, 2000 / greatest(w, h)) + 0.5)) AS h1 FROM a),
c AS (SELECT *, sqrt(2560000.0::DOUBLE / w1 / h1) AS s FROM b),
d AS (SELECT *, s * least(floor(w1 * s / 32) / (w1 * s / 32), floor(h1 * s / 32) / (h1 * s / 32)) AS z,
        w <= 2000 AND h <= 2000 AND ceil(w / 32) * ceil(h / 32) <= 2500 AS f0, w1 <= 2000 AND h1 <= 2000 AND ceil(w1 / 32) * ceil(h1 / 32) <= 2500 AS f1 FROM c)
SELECT p_partkey, CAST(CASE WHEN f0 THEN w WHEN f1 THEN w1 ELSE greatest(1.0, floor(w1 * z)) END AS INTEGER) AS width,
       CAST(CASE WHEN f0 THEN h WHEN f1 THEN h1 ELSE greatest(1.0, floor(h1 * z)) END AS INTEGER) AS height FROM d""",
    "discovery_denial": "SELECT conv_id, turn, turn % 3 <> 2 AND conv_id % 7 IN (0, 2, 3, 5) AS denied FROM conversations",
    "secret_scan": r"""
WITH p AS (SELECT doc_id, concat_ws(chr(10), text, [""" + ", ".join(f"'{x}'" for x in _PLANTED) + r"""][CAST(doc_id % """ + str(len(_PLANTED)) + r""" + 1 AS INTEGER)]) AS text FROM documents)
SELECT doc_id, rule FROM p, (VALUES ('macOS user path', '/Users/[A-Za-z0-9._-]+/'), ('Linux user path', '/home/[A-Za-z0-9._-]+/'),
  ('Windows user path', '[A-Za-z]:\\Users\\[^\\]+\\'), ('session id', '(?i)session-[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}'),
  ('GitHub token', '\b(?:ghp|github_pat)_[A-Za-z0-9_]{20,}\b'), ('private key', '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----'),
  ('OpenAI-style secret', '\bsk-[A-Za-z0-9_-]{20,}\b'), ('AWS access key', '\bAKIA[0-9A-Z]{16}\b')) AS r(rule, pattern)
WHERE regexp_matches(text, pattern)""",
    "json_window": """
WITH r AS (SELECT event_type, event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS INTEGER) AS n,
             CASE WHEN length(props) > 2000 THEN substr(props, 1, 2000) || '…' ELSE props END AS shown FROM events),
u AS (SELECT *, CAST(sum(strlen(shown) + 1) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS used FROM r WHERE n > 5 AND n <= 405)
SELECT event_type, event_id, n, shown, used FROM u WHERE used <= 6000""",
    "catalog_list": f"""
SELECT ord, attachment_id, committed AS available, committed AND attachment_id = 'attachment:1' AS resolved, coalesce(pending, NOT committed) AS is_pending, sha256(session_id) AS session_key
FROM ({_FILES}) WHERE session_id = 'src1'""",
    "catalog_manifest": f"""
SELECT session_id, '[' || string_agg('{{"attachment_id":"' || attachment_id || '","name":"' || doc_id || '.txt","kind":"text","bytes":' || bytes || '}}', ',' ORDER BY ord) || ']' AS manifest
FROM ({_FILES}) GROUP BY session_id""",
    "catalog_active_turn": f"""
WITH f AS ({_FILES}), e AS (SELECT *, ord // 100 AS turn, ord % 20 = 0 AS clear FROM f WHERE ord % 3 = 0),
l AS (SELECT session_id, arg_max(turn, ord) AS turn FROM e GROUP BY 1 HAVING NOT arg_max(clear, ord)),
a AS (SELECT e.session_id, e.attachment_id FROM e JOIN l ON e.session_id = l.session_id AND e.turn = l.turn WHERE NOT clear)
SELECT session_id, attachment_id, 'turn' AS scope FROM f WHERE committed AND attachment_id IN (SELECT attachment_id FROM a)
UNION ALL SELECT session_id, attachment_id, 'conversation' FROM f WHERE committed AND session_id NOT IN (SELECT session_id FROM a)""",
    "read_objects": """
SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN strlen(text) END AS bytes, CASE WHEN doc_id % 4 = 0 THEN 'ATTACHMENT_STORAGE_FAILED' END AS error
FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL""",
    "folder_admission": """
WITH f AS (SELECT source, count(*) % 50 AS size, (length(source) + ascii(right(source, 1))) % 4 AS k FROM documents GROUP BY source)
SELECT source AS archive_id, CASE WHEN k = 2 THEN 'FILE_TOO_LARGE' WHEN k = 1 OR size = 0 THEN 'BAD_REQUEST' WHEN k = 3 THEN 'ARCHIVE_CORRUPT' END AS error FROM f""",
    "base64_chunks": """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 AND p_name <> '' THEN p_name END AS name FROM part""",
    "names_and_badges": r"""
WITH r AS (SELECT page_id, 'up/' || page_id || ['.tar.gz', '', ' .Html ', chr(7) || 'x.py', '/', '\new.longext', '.md'][CAST(page_id % 7 + 1 AS INTEGER)] AS raw FROM pages),
x AS (SELECT *, upper(regexp_extract(raw, '\.([^.]*)$', 1)) AS ext FROM r)
SELECT page_id, nullif(trim(regexp_replace(regexp_extract(raw, '([^/\\]*)$', 1), '[\x00-\x1f\x7f]', '', 'g')), '') AS display_name,
       nullif(trim(regexp_replace(raw, '[/\\\x00-\x1f\x7f]', '', 'g')), '') AS root_name,
       CASE WHEN page_id % 11 = 0 THEN 'DIR' WHEN ext <> '' AND length(ext) <= 4 THEN ext ELSE 'FILE' END AS badge,
       CASE WHEN page_id % 7 NOT IN (3, 5) THEN raw END AS folder_path FROM x""",
    "image_fit": """
WITH a AS (SELECT p_partkey, p_partkey % 97 * 83 + 1 AS w, p_size * 131 + 7 AS h FROM part), b AS (SELECT *, least(1.0::DOUBLE, 2048 / greatest(w, h)::DOUBLE) AS z FROM a)
SELECT p_partkey, CAST(greatest(1, floor(w * z + 0.5)) AS INTEGER) AS width, CAST(greatest(1, floor(h * z + 0.5)) AS INTEGER) AS height FROM b""",
    "json_cap": """
SELECT event_id, CASE WHEN event_id % 60 * 20 <= 900 THEN repeat('ab', CAST(event_id % 60 * 10 AS INTEGER)) ELSE '{"truncated":true,"preview":"' || repeat('ab', 20) || '"}' END AS answer FROM events""",
    "format_bytes": """
WITH b AS (SELECT p_partkey, p_partkey * p_partkey * 10 AS n FROM part)
SELECT p_partkey, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN printf('%.1f', round(n / 1024, 1)) || ' KiB' ELSE printf('%.1f', round(n / 1048576, 1)) || ' MiB' END AS shown FROM b""",
}
