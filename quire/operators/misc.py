"""Image budgets, request filters, rule scans, bounded JSON windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..limits import LIMITS

# What a repository scan forbids.
FORBIDDEN = {
    "macOS user path": r"/Users/[A-Za-z0-9._-]+/",
    "Linux user path": r"/home/[A-Za-z0-9._-]+/",
    "Windows user path": r"[A-Za-z]:\\Users\\[^\\]+\\",
    "session id": r"(?i)session-[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    "GitHub token": r"\b(?:ghp|github_pat)_[A-Za-z0-9_]{20,}\b",
    "private key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "OpenAI-style secret": r"\bsk-[A-Za-z0-9_-]{20,}\b",
    "AWS access key": r"\bAKIA[0-9A-Z]{16}\b",
}
# Tools, commands and roots that a discovery scan is known by.
FILE_TOOLS = r"(?i)^(?:bash|shell|read|read_file|glob|grep|find|fd|locate|mdfind|search_files)$"
DISCOVERY = r"(?i)(?:^|[;&|]\s*|\s)(?:find|fd|locate|mdfind|rg|grep)\s"
BROAD_ROOT = r"(?:^|\s)(?:/(?:\s|$)|/Users(?:/|\s|$)|/tmp(?:/|\s|$)|/private/var/folders(?:/|\s|$)|~(?:/|\s|$))"
STORE_WORDS = ("attachments?", "附件")


def patch_budget(width: Column, height: Column, side: int = LIMITS.image_side, patches: int = LIMITS.image_patches, patch: int = LIMITS.patch) -> tuple[Column, Column]:
    """Output width and height: longest side and number of patches within budget."""
    w0, h0 = F.greatest(F.lit(1.0), width.cast("double")), F.greatest(F.lit(1.0), height.cast("double"))
    fits = lambda w, h: (w <= side) & (h <= side) & (F.ceil(w / patch) * F.ceil(h / patch) <= patches)
    by_side = F.least(F.lit(1.0), side / F.greatest(w0, h0))
    half_up = lambda x: F.greatest(F.lit(1.0), F.floor(x + 0.5).cast("double"))
    w1, h1 = half_up(w0 * by_side), half_up(h0 * by_side)
    s = F.sqrt(F.lit(float(patch * patch * patches)) / w1 / h1)
    wide, high = w1 * s / patch, h1 * s / patch
    s = s * F.least(F.floor(wide) / wide, F.floor(high) / high)
    cut = lambda x: F.greatest(F.lit(1.0), F.floor(x * s).cast("double"))
    pick = lambda a, b, c: F.when(fits(w0, h0), a).when(fits(w1, h1), b).otherwise(c).cast("int")
    return pick(w0, w1, cut(w1)), pick(h0, h1, cut(h1))


def resize_to_fit(width: Column, height: Column, side: int = 2048) -> tuple[Column, Column]:
    scale = F.least(F.lit(1.0), side / F.greatest(width, height).cast("double"))
    return F.greatest(F.lit(1), F.floor(width * scale + 0.5)).cast("int"), F.greatest(F.lit(1), F.floor(height * scale + 0.5)).cast("int")


def argument_text(value: object, depth: int = 0) -> str:
    """The strings of a tool call's arguments, a line each, four levels deep."""
    if isinstance(value, str):
        return value
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list | tuple) else ()
    return "\n".join(argument_text(v, depth + 1) for v in inner) if depth < 4 else ""


def discovery_denied(tool: Column, text: Column, ids: Sequence[str], store_words: Sequence[str] = STORE_WORDS) -> Column:
    """Whether a file tool's call looks for attachments: by an id, from a broad root, or in the store.

    ``store_words``: patterns that name the store; a deployment adds what its own is called.
    """
    if not ids:
        return F.lit(False)
    named = F.exists(F.array(*[F.lit(i.lower()) for i in ids]), lambda i: F.contains(F.lower(text), i))
    search = text.rlike(DISCOVERY)
    return tool.rlike(FILE_TOOLS) & (named | (search & text.rlike(BROAD_ROOT)) | (search & text.rlike(f"(?i)(?:{'|'.join(store_words)})")))


def rule_scan(docs: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """One row per document and rule that it breaks. The rules are an array in the scan's own row: no join."""
    checks = [F.when(F.col("text").rlike(p), F.lit(n)) for n, p in (rules or FORBIDDEN).items()]
    return docs.select("doc_id", F.explode(F.array_compact(F.array(*checks))).alias("rule"))


def window_lines(rows: DataFrame, key: Sequence[str], order: str, line: str, offset: int = 0, lines: int = LIMITS.window_lines, most: int = LIMITS.window_bytes) -> DataFrame:
    """Lines of each key from an offset on: at most 400 and at most 48 KiB with their line ends."""
    w = Window.partitionBy(*key).orderBy(order)
    cut = F.when(F.length(line) > LIMITS.window_line_chars, F.concat(F.substring(line, 1, LIMITS.window_line_chars), F.lit("…"))).otherwise(F.col(line))
    d = rows.withColumn("n", F.row_number().over(w)).where((F.col("n") > offset) & (F.col("n") <= offset + lines)).withColumn("shown", cut)
    d = d.withColumn("used", F.sum(F.octet_length("shown") + 1).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return d.where(F.col("used") <= most)


def capped(json: Column, most: int = LIMITS.window_bytes, shown: int = LIMITS.preview_chars) -> Column:
    """A JSON answer, or a truncated object with a preview if it is over the cap."""
    short = F.to_json(F.struct(F.lit(True).alias("truncated"), F.substring(json, 1, shown).alias("preview")))
    return F.when(F.octet_length(json) <= most, json).otherwise(short)


def format_bytes(n: Column) -> Column:
    number = lambda x: F.regexp_replace(F.format_number(F.round(x, 1), 1), ",", "")
    return (
        F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B")))
        .when(n < 1024**2, F.concat(number(n / 1024), F.lit(" KiB")))
        .otherwise(F.concat(number(n / 1024**2), F.lit(" MiB")))
    )
