"""Archive and folder operators over entry tables.

An entry table has archive_id, ord, path, bytes, directory and, where needed, compressed_bytes,
method and content.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.shipping import ship
from ..functions.strings import extension, leaf
from ..limits import LIMITS, QueryError
from .text import clamp, lines_of, needle_of, positive

# Files that are read as text, by extension and by name.
TEXT_EXTENSIONS = (
    ".txt", ".md", ".markdown", ".csv", ".tsv", ".json", ".jsonl", ".ndjson", ".yaml", ".yml", ".toml", ".xml",
    ".py", ".js", ".jsx", ".ts", ".tsx", ".css", ".scss", ".less", ".html", ".htm", ".sh", ".zsh", ".bash", ".sql",
    ".log", ".ini", ".conf", ".env", ".properties", ".java", ".kt", ".kts", ".go", ".rs", ".c", ".h", ".cpp", ".hpp",
    ".cs", ".rb", ".php", ".swift", ".scala", ".lua", ".r", ".dockerfile", ".gradle", ".gitignore", ".gitattributes",
)
TEXT_NAMES = ("readme", "license", "copying", "notice", "changelog", "makefile", "dockerfile", "containerfile", "gemfile", "rakefile")


def is_text(path: Column) -> Column:
    """Whether an entry is read as text. Here a leading dot alone does make an extension."""
    name = F.lower(F.regexp_extract(path, r"([^/]*)\z", 1))
    return name.isin(*TEXT_NAMES) | F.regexp_extract(name, r"(\.[^.]*)\z", 1).isin(*TEXT_EXTENSIONS)


def names_text(path: str) -> bool:
    """``is_text`` of one path, for parsers."""
    name = path.rpartition("/")[2].lower()
    return name in TEXT_NAMES or ("." in name and "." + name.rpartition(".")[2] in TEXT_EXTENSIONS)


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    import unicodedata

    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def normalized_path(raw: Column) -> Column:
    """Path with forward slashes, or null if it is unsafe: NUL, absolute, drive, empty or dot segments.

    Only paths with characters beyond ASCII pass through Python, for Unicode normalisation.
    """
    slashed = F.replace(raw, F.lit("\\"), F.lit("/"))
    body = F.regexp_replace(slashed, r"/\z", "")
    bad_segment = F.exists(F.split(body, "/", -1), lambda s: s.isin("", ".", ".."))
    bad = F.contains(raw, F.lit("\0")) | slashed.startswith("/") | slashed.rlike("^[A-Za-z]:/") | (body == "") | bad_segment
    return F.when(~bad, slashed)


def safe_paths(entries: DataFrame, unicode: bool = True) -> DataFrame:
    """Adds ``safe_path`` (null if unsafe) and ``duplicate`` (another entry of the archive has it too)."""
    d = entries.withColumn("safe_path", normalized_path(F.col("path")))
    if unicode:
        ship(entries.sparkSession)
        d = d.withColumn("safe_path", F.when(F.octet_length("safe_path") > F.length("safe_path"), nfc("safe_path")).otherwise(F.col("safe_path")))
    # unsafe paths have no twin: they are dealt by what they are instead of being one group
    n = F.count("*").over(Window.partitionBy("archive_id", "safe_path", F.when(F.col("safe_path").isNull(), F.xxhash64("path"))))
    return d.withColumn("duplicate", F.col("safe_path").isNotNull() & (n > 1))


def checked(entries: DataFrame) -> DataFrame:
    """One row per archive: entries, total bytes and the first error, if any."""
    d = safe_paths(entries)
    over = (F.col("bytes") >= LIMITS.ratio_from_bytes) & (F.col("bytes") > LIMITS.ratio * F.greatest("compressed_bytes", F.lit(1)))
    g = d.groupBy("archive_id").agg(
        F.count("*").alias("entries"), F.sum("bytes").alias("total_bytes"), F.max(F.col("safe_path").isNull()).alias("unsafe"),
        F.max("duplicate").alias("twice"), F.max(~F.col("method").isin(0, 8)).alias("packed"), F.max(over & ~F.col("directory")).alias("bomb"),
    )
    error = (
        F.when(F.col("entries") > LIMITS.archive_entries, "ARCHIVE_RESOURCE_LIMIT")
        .when(F.col("unsafe"), "ARCHIVE_UNSAFE_PATH")
        .when(F.col("twice"), "ARCHIVE_CORRUPT")
        .when(F.col("packed"), "ARCHIVE_CORRUPT")
        .when(F.col("bomb") | (F.col("total_bytes") > LIMITS.decompressed_bytes), "ARCHIVE_RESOURCE_LIMIT")
    )
    return g.select("archive_id", "entries", "total_bytes", error.alias("error"))


def outline(entries: DataFrame, limit: int = LIMITS.entry_outline) -> DataFrame:
    """The first 2000 entries per archive, each with the archive's totals and whether more follow."""
    w = Window.partitionBy("archive_id")
    rank = F.row_number().over(w.orderBy("ord"))
    d = entries.withColumn("n", rank).withColumn("entries", F.count("*").over(w)).withColumn("total_bytes", F.sum("bytes").over(w))
    return d.where(F.col("n") <= limit).withColumn("truncated", F.col("entries") > limit)


def admitted(entries: DataFrame, files: int = LIMITS.entry_search_files, total: int = LIMITS.entry_search_bytes, each: int = LIMITS.entry_text_bytes) -> DataFrame:
    """Entries that a search reads: text, not too large, and greedily within the byte and file budgets.

    An entry that does not fit is passed over and later ones may fit, so the choice is a fold over
    the archive's entries in order, not a running sum. An archive has at most 10 000 entries.
    """
    es = F.sort_array(F.collect_list(F.struct("ord", "bytes", "path")))
    per = _readable(entries, each).groupBy("archive_id").agg(es.alias("es"))
    got = per.select("archive_id", F.size("es").alias("searchable"), _chosen(files, total).alias("got"))
    return got.select("archive_id", "searchable", F.size("got").alias("searched"), F.explode("got").alias("ord"))


def _readable(entries: DataFrame, each: int) -> DataFrame:
    return entries.where(~F.col("directory") & is_text(F.col("path")) & (F.col("bytes") <= each))


def _chosen(files: int, total: int) -> Column:
    """The places of those of an archive's entries (``es``, in order) that fit greedily."""
    kind = "struct<left:bigint,got:array<int>>"

    def step(acc: Column, e: Column) -> Column:
        takes = (F.size(acc["got"]) < files) & (e["bytes"] <= acc["left"])
        taken = F.struct((acc["left"] - e["bytes"]).alias("left"), F.concat(acc["got"], F.array(e["ord"].cast("int"))).alias("got")).cast(kind)
        return F.when(takes, taken).otherwise(acc)

    start = F.struct(F.lit(total).cast("bigint").alias("left"), F.array().cast("array<int>").alias("got")).cast(kind)
    return F.aggregate("es", start, step)["got"]


def search(
    entries: DataFrame, query: str, limit: int | None = None, files: int = LIMITS.entry_search_files, total: int = LIMITS.entry_search_bytes, each: int = LIMITS.entry_text_bytes
) -> DataFrame:
    """Matching lines of the admitted entries in entry order, the first ``limit`` per archive.

    The entries are read once: each sends its first ``limit`` matching lines along with its size, and its
    archive's fold says which of them count.
    """
    key, n = needle_of(query), clamp(limit)
    found = F.filter(F.transform(lines_of(F.col("text")), lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("line"))), lambda x: F.contains(F.lower(x["line"]), F.lit(key)))
    hits = F.when(F.lower("text").contains(key), F.slice(found, 1, n))
    es = F.sort_array(F.collect_list(F.struct("ord", "bytes", "path", hits.alias("hits"))))
    per = _readable(entries, each).where("archive_id is not null").groupBy("archive_id").agg(es.alias("es"))
    per = per.where(F.exists("es", lambda e: F.size(e["hits"]) > 0)).withColumn("got", _chosen(files, total))
    lines = F.flatten(F.transform(F.filter("es", lambda e: F.array_contains("got", e["ord"].cast("int")) & (F.size(e["hits"]) > 0)), lambda e: F.transform(e["hits"], lambda h: F.struct(e["path"].alias("path"), h["line_no"].alias("line_no"), h["line"].alias("line")))))
    d = per.select("archive_id", F.size("got").alias("searched"), F.size("es").alias("searchable"), F.posexplode(F.slice(lines, 1, n)).alias("p", "h"))
    status = F.when(F.col("searched") == F.col("searchable"), "COMPLETE").otherwise("PARTIAL")
    return d.select("archive_id", "h.path", "h.line_no", "h.line", (F.col("p") + 1).alias("hit"), "searched", "searchable", status.alias("coverage"))


def read_entry(entries: DataFrame, path: str, start: int | None = None, end: int | None = None, archives: DataFrame | None = None) -> DataFrame:
    """Lines of one text entry: 400 by default, 2000 at most, 200 000 characters; past the end the text is empty.

    ``truncated`` means that lines or characters that were asked for are missing. ``archives``
    (archive_id): those among them that lack the entry are rows with that error.
    """
    if path.endswith("/"):
        raise QueryError("ARCHIVE_ENTRY_UNSUPPORTED")
    first = positive(start, 1)
    wanted = positive(end, first + LIMITS.text_lines - 1)
    if wanted < first:
        raise QueryError("BAD_REQUEST")
    ls = lines_of(F.col("text"))
    total = F.size(ls)
    last = F.least(total, F.lit(min(wanted, first + LIMITS.entry_lines - 1)))
    body = F.array_join(F.slice(ls, first, F.greatest(last - first + 1, F.lit(0))), "\n")
    own = F.col("error") if "error" in entries.columns else F.lit(None)
    error = F.when(~is_text(F.col("path")), "ARCHIVE_ENTRY_UNSUPPORTED").when(F.col("bytes") > LIMITS.entry_text_bytes, "ARCHIVE_RESOURCE_LIMIT").otherwise(own)
    d = entries.where((F.col("path") == path) & ~F.col("directory"))
    found = d.select(
        "archive_id", "path", F.when(error.isNull(), F.substring(body, 1, LIMITS.entry_chars)).alias("text"), F.lit(first).alias("line_start"), last.alias("line_end"),
        total.alias("total_lines"), ((last < total) | (F.length(body) > LIMITS.entry_chars)).alias("truncated"), error.alias("error"),
    )
    if archives is None:
        return found
    absent = archives.join(found, "archive_id", "left_anti").select("archive_id", F.lit(path).alias("path"), F.lit("ARCHIVE_ENTRY_NOT_FOUND").alias("error"))
    return found.unionByName(absent, allowMissingColumns=True)


def coverage(entries: DataFrame, shown: int = 30) -> DataFrame:
    """Per archive: counts of files, text and binary files, coverage, a warning and the first paths.

    Of an archive's paths only the first ``shown`` are ranked and gathered, and tasks drop the others before the shuffle.
    """
    files = entries.where(~F.col("directory"))
    text = is_text(F.col("path"))
    g = files.groupBy("archive_id").agg(F.count("*").alias("files"), F.count_if(text).alias("text_files"), F.count_if(~text).alias("binary_files"), F.sum("bytes").alias("bytes"))
    rank = F.row_number().over(Window.partitionBy("archive_id").orderBy("ord", "path"))
    first = files.select("archive_id", "ord", "path", rank.alias("rank")).where(F.col("rank") <= shown)
    paths = F.transform(F.sort_array(F.collect_list(F.struct("ord", "path"))), lambda x: x["path"])
    first = first.groupBy(F.col("archive_id").alias("__of")).agg(paths.alias("paths"))
    g = g.join(first, F.col("archive_id").eqNullSafe(F.col("__of"))).drop("__of")
    return g.withColumn("coverage", F.when(F.col("binary_files") == 0, "COMPLETE").otherwise("PARTIAL"))


# Folders


def folder_path(raw: Column) -> Column:
    """A folder entry's path, or null: also no backslash, no control character, segments to 255 and paths to 4096 bytes."""
    long = F.exists(F.split(raw, "/", -1), lambda s: F.octet_length(s) > 255) | (F.octet_length(raw) > 4096)
    bad = F.contains(raw, F.lit("\\")) | raw.rlike(r"[\x00-\x1f\x7f]") | long
    return F.when(~bad, normalized_path(raw))


def parents(paths: DataFrame) -> DataFrame:
    """Every directory above each path, once."""
    parts = F.split(F.regexp_replace("path", r"/\z", ""), "/")
    above = F.filter(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.when(i < F.size(parts), F.array_join(F.slice(parts, 1, i), "/"))), lambda p: p.isNotNull())
    return paths.select("archive_id", F.explode(above).alias("parent")).distinct()


def conflicts(entries: DataFrame) -> DataFrame:
    """Paths that clash: listed twice, files above other files, directories named like files."""
    bare = entries.select("archive_id", F.regexp_replace("path", r"/\z", "").alias("path"), "directory")
    twice = bare.groupBy("archive_id", "path", "directory").agg(F.count("*").alias("n")).where("n > 1").select("archive_id", "path", F.lit("duplicate").alias("conflict"))
    files = bare.where("not directory").select("archive_id", "path").distinct()
    above = parents(bare.where("not directory")).withColumnRenamed("parent", "path")
    under = files.join(above, ["archive_id", "path"], "left_semi").withColumn("conflict", F.lit("file_above_file"))
    both = files.join(bare.where("directory").select("archive_id", "path"), ["archive_id", "path"], "left_semi").withColumn("conflict", F.lit("file_and_directory"))
    return twice.unionByName(under).unionByName(both)


def sorted_paths(entries: DataFrame) -> DataFrame:
    """Entries of each archive numbered in the order of a Unicode collation."""
    rank = F.row_number().over(Window.partitionBy("archive_id").orderBy(F.collate("path", "UNICODE"), "path"))
    return entries.withColumn("ord", rank)


def group_by_root(files: DataFrame) -> DataFrame:
    """Relative paths grouped by their first segment: file count, bytes and the parents inside the root."""
    d = files.withColumn("root", F.split("path", "/")[0])
    inner = parents(d.select(F.col("root").alias("archive_id"), "path")).where("parent <> archive_id").groupBy(F.col("archive_id").alias("root")).agg(F.count("*").alias("directories"))
    g = d.groupBy("root").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    return g.join(inner, "root", "left").withColumn("directories", F.coalesce("directories", F.lit(0).cast("long")))


def folder_admission(folders: DataFrame, checked_manifests: DataFrame) -> DataFrame:
    """Adds ``error``: why a folder snapshot is refused, null if it is taken.

    ``folders``: archive_id, content, snapshot_bytes and source_bytes as declared;
    ``checked_manifests``: what ``manifest_check`` says of them. The sizes are looked at first.
    """
    size = F.octet_length("content").cast("bigint")
    too_large = (size > LIMITS.snapshot_bytes) | (F.col("source_bytes") > LIMITS.folder_bytes)
    odd = (size != F.col("snapshot_bytes")) | (size == 0)
    d = folders.join(checked_manifests.select("archive_id", F.col("error").alias("__e")), "archive_id", "left")
    return d.withColumn("error", F.when(too_large, "FILE_TOO_LARGE").when(odd, "BAD_REQUEST").otherwise(F.col("__e"))).drop("__e")


def root_name(raw: Column) -> Column:
    """Name of a folder root: no separators or control characters, trimmed, 255 characters at most; null (an error) if nothing is left."""
    return F.nullif(F.substring(F.trim(F.regexp_replace(raw, r"[/\\\x00-\x1f\x7f]", "")), 1, 255), F.lit(""))


def manifest_check(entries: DataFrame, declared: DataFrame) -> DataFrame:
    """Whether the declared file, directory and byte counts of each archive hold."""
    g = entries.groupBy("archive_id").agg(
        F.count_if(~F.col("directory")).alias("files"), F.count_if("directory").alias("directories"), F.sum(F.when(~F.col("directory"), F.col("bytes")).otherwise(0)).alias("source_bytes")
    )
    d = declared.select("archive_id", F.col("files").alias("df"), F.col("directories").alias("dd"), F.col("source_bytes").alias("db")).join(g, "archive_id", "left")
    ok = (F.coalesce("files", F.lit(0)) == F.col("df")) & (F.coalesce("directories", F.lit(0)) == F.col("dd")) & (F.coalesce("source_bytes", F.lit(0)) == F.col("db"))
    return d.select("archive_id", ok.alias("ok"), F.when(~ok, "ARCHIVE_CORRUPT").alias("error"))


def media_family(media_type: Column) -> Column:
    """docx, xlsx, pptx or csv; null for all else."""
    office = "application/vnd.openxmlformats-officedocument."
    kinds = {f"{office}wordprocessingml.document": "docx", f"{office}spreadsheetml.sheet": "xlsx", f"{office}presentationml.presentation": "pptx", "text/csv": "csv"}
    return F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[media_type]


def is_legacy(name: Column, content: Column) -> Column:
    """Whether a file is of the office formats before packages, by its name or its first eight bytes."""
    by_name = F.coalesce(name.rlike(r"(?i)\.(doc|xls|ppt)\z"), F.lit(False))
    return by_name | F.coalesce(F.hex(F.substring(content, 1, 8)) == "D0CF11E0A1B11AE1", F.lit(False))


def strip_root(entries: DataFrame, root: str) -> DataFrame:
    """Paths below a root folder; the root itself is dropped, others are an error."""
    if not root or any(c in root for c in "/\\") or any(ord(c) < 32 or ord(c) == 127 for c in root):
        raise QueryError("BAD_REQUEST", "no name of a root folder")
    inside = F.col("path").startswith(root + "/")
    rest = F.substring("path", len(root) + 2, 1 << 20)
    return entries.withColumn("error", F.when(~inside, "BAD_REQUEST")).withColumn("path", F.when(inside, rest).otherwise(F.col("path"))).where(F.col("path") != "")


def folderize(items: DataFrame, path: str, locator_col: str = "locator") -> DataFrame:
    """Puts an entry's locator under its folder path."""
    return items.withColumn(locator_col, F.struct(F.lit("folder").alias("kind"), F.lit(path).alias("path"), F.col(locator_col).alias("entry_locator")))


def badge(name: Column, directory: Column) -> Column:
    """Short label of a file: DIR, its extension in capitals (four letters at most) or FILE."""
    ext = F.upper(F.regexp_extract(name, r"\.([^.]*)\z", 1))
    return F.when(directory, "DIR").when((ext != "") & (F.length(ext) <= 4), ext).otherwise("FILE")


def display_name(raw: Column) -> Column:
    """Leaf name without control characters, trimmed, 255 characters at most; blank is null."""
    return F.nullif(F.substring(F.trim(F.regexp_replace(leaf(raw), r"[\x00-\x1f\x7f]", "")), 1, 255), F.lit(""))


def classify(names: DataFrame, name_col: str = "name") -> DataFrame:
    """Adds kind and media_type by extension, or error."""
    # Media types of the accepted extensions.
    media = {
        ".txt": "text/plain", ".md": "text/markdown", ".markdown": "text/markdown",
        ".json": "application/json", ".jsonl": "application/x-ndjson", ".ndjson": "application/x-ndjson",
        ".yaml": "application/yaml", ".yml": "application/yaml", ".toml": "application/toml",
        ".xml": "application/xml", ".tsv": "text/tab-separated-values",
        ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
        ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
        ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
        ".csv": "text/csv", ".zip": "application/zip",
    }
    plain = (
        ".py", ".js", ".jsx", ".ts", ".tsx", ".css", ".html", ".htm", ".sh", ".zsh", ".sql", ".log",
        ".ini", ".conf", ".env", ".properties", ".java", ".go", ".rs", ".c", ".h", ".cpp", ".hpp",
    )
    name = display_name(F.col(name_col))
    ext = F.coalesce(extension(name), F.lit(""))
    kind_of = F.when(ext == ".zip", "archive").when(ext.isin(".docx", ".xlsx", ".pptx", ".csv"), "document").when(ext.isin(*media, *plain), "text")
    table = F.create_map(*[F.lit(x) for pair in (media | {p: "text/plain" for p in plain}).items() for x in pair])
    error = F.when(name.isNull(), "BAD_REQUEST").when(ext.isin(".doc", ".xls", ".ppt"), "LEGACY_OFFICE_UNSUPPORTED").when(kind_of.isNull(), "UNSUPPORTED_FILE_TYPE")
    return names.withColumn("kind", kind_of).withColumn("media_type", table[ext]).withColumn("error", error)
