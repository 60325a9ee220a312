"""Secret scans with a random forest against false positives.

Candidates are the runs of at least 12 token characters of a text's words, any number in a word,
that have letters and digits or a known key format. Each is seen with its own part of the word: the
name and signs before it and what follows. It is described by numbers, all in SQL expressions: length,
transitions between character classes, shares of classes, distinct characters, dictionary coverage
(characters in letter runs that are frequent corpus words), path signs, and the two words before
and the one after (key-naming words, placeholder and digest words).

The forest is trained from labelled findings: rows (before, word, after, label), described by the
same expressions. ``examples`` makes a fixed set of them from formats, as no labelled table comes
with the corpus; ``scan`` takes any other. It is bounded (``EXAMPLES`` rows, of more a sample by hash), fitted on the driver
and turned into one SQL expression, so scanning stays a single pass without Python.

The dictionary holds the most frequent letter words of the whole corpus, at most ``DICTIONARY``:
counted over all texts, partly summed before the shuffle, cut where a histogram of bounded size says,
ties by word, and broadcast at that fixed size.

No pattern scans a long word again and again: a word of a million characters takes seconds. So a key
name counts with up to 64 word characters after it, and of the words before it the last 256 characters are
looked at for one.

Defined cases: null and empty texts have no candidates; equal words at several places are several
findings, and so are several secrets of one word, under one word number; very long words are read
whole; rows that repeat an id give the findings of each; a null id is passed on; an empty table or
one without candidates gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import trees
from .common import let, stored, words

DICTIONARY = 5000
EXAMPLES = 3000
FLAG = 0.5
TREES = 24

# Patterns.
FORMATS = {
    "aws_key": r"(?:^|[^A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?:$|[^A-Za-z0-9])",
    "github": r"gh[pousr]_[A-Za-z0-9]{30,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "private": r"sk[-_](?:live|test|proj)?[-_]?[A-Za-z0-9]{16,}",
}
RUN = r"[A-Za-z0-9+/_=.\-]{12,}+"
NAMES = r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key)"
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|xxxx|your[_-]|test123|redacted|\*\*\*"
DIGEST = r"(?i)\b(?:sha(?:1|256|512)?|md5|commit|checksum|digest|hash|revision|etag|uuid|guid|build|version)\b"

FEATURES = (
    "length", "transitions", "digits", "uppers", "lowers", "distinct", "hex", "uuid", "format", "named", "named_before", "placeholder",
    "digest_before", "path", "coverage", "quoted", "repeats",
)


def signed(run: Column) -> Column:
    """Whether the pattern of a signed token (``jwt``) is in a run: its parts between full stops are looked at once each."""
    part = lambda p, k: F.element_at(F.split(p, "[^A-Za-z0-9_-]"), k)
    begins = lambda x: (F.instr(x, "eyJ") > 0) & (F.length(x) - F.instr(x, "eyJ") >= 10)
    pairs = lambda ps: F.zip_with(ps, F.slice(ps, 2, F.size(ps)), lambda a, b: F.coalesce(begins(part(a, -1)) & (F.length(part(b, 1)) >= 8), F.lit(False)))
    return let(F.split(run, "\\."), lambda ps: F.exists(pairs(ps), lambda x: x))


def of_format(run: Column, name: str) -> Column:
    return signed(run) if name == "jwt" else run.rlike(FORMATS[name])


def known_format(run: Column) -> Column:
    return run.rlike("|".join(f"(?:{f})" for k, f in FORMATS.items() if k != "jwt")) | signed(run)


def pieces(word: Column) -> Column:
    """The candidates of a word: array of (run, part), where part is the word if it has one run only.

    Runs and the gaps between them are found by one pattern that never goes back, so the time is linear in
    the length of the word.
    """
    runs, gaps = F.regexp_extract_all(word, F.lit(RUN), F.lit(0)), F.split(word, RUN, -1)

    def cut(tiles: Column) -> Column:
        def piece(t: Column, i: Column) -> Column:
            last = F.get(tiles, i - 1)["run"]
            named = F.coalesce(t["gap"].rlike("^[\"']?[=:][\"']?$"), F.lit(False)) & last.isNotNull()
            part = F.concat(F.when(named, last).otherwise(""), t["gap"], t["run"], F.substring(F.get(tiles, i + 1)["gap"], 1, 1))
            return F.struct(t["run"].alias("run"), F.when(F.size(tiles) == 2, word).otherwise(part).alias("part"))

        return F.transform(tiles, piece)

    # the last gap has no run: one tile more than there are candidates
    tiles = F.transform(F.arrays_zip(gaps.alias("gap"), runs.alias("run")), lambda t: F.struct(t["gap"].alias("gap"), t["run"].alias("run")))
    mixed = lambda run: F.exists(F.split(run, "\\."), lambda p: (F.length(p) >= 12) & p.rlike("[0-9]") & p.rlike("[A-Za-z]"))
    kept = lambda x: x["run"].isNotNull() & (mixed(x["run"]) | known_format(x["run"]))
    return F.when(F.length(word) >= 12, F.filter(let(tiles, cut), kept))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, word_no (from 1), before2, before, word (its part that is the run's own), run, after."""

    def pick(ws: Column) -> Column:
        near = lambda i, k: F.coalesce(F.get(ws, i + k), F.lit(""))
        row = lambda x, i: F.transform(
            pieces(x),
            lambda p: F.struct(
                (i + 1).alias("word_no"), near(i, -2).alias("before2"), near(i, -1).alias("before"), p["part"].alias("word"), p["run"].alias("run"), near(i, 1).alias("after"),
            ),
        )
        return F.flatten(F.filter(F.transform(ws, row), lambda r: r.isNotNull()))

    likely = F.col("text").rlike(r"[0-9]") | F.col("text").contains("eyJ") | F.col("text").rlike("|".join(f"(?:{f})" for k, f in FORMATS.items() if k != "jwt"))
    return docs.where(likely).select("doc_id", F.inline(let(words(F.col("text")), pick)))


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> DataFrame:
    """The most frequent words of letters, in lower case, as one row ``dict`` (a sorted array)."""
    w = docs.select(F.explode(words(F.col("text"))).alias("w")).where(F.length("w").between(3, 24))
    bare = w.select(F.lower(F.translate("w", ".,;:!?\"'()", "")).alias("w")).where(F.col("w").rlike(r"^\p{L}{3,}$"))
    counts = stored(bare.groupBy("w").agg(F.count("*").alias("n")).withColumn("step", F.floor(F.log2("n") * 64).cast("int")))
    steps = sorted(((r["step"], r["count"]) for r in counts.groupBy("step").count().collect()), reverse=True)  # at most 64 for each doubling of n
    if sum(n for _, n in steps) <= size:
        top = counts
    else:
        inside = 0
        for last, n in steps:
            if inside + n > size:
                break
            inside += n
        rest = counts.where(F.col("step") == F.lit(last)).orderBy(F.desc("n"), "w").limit(size - inside)
        top = counts.where(F.col("step") > F.lit(last)).unionByName(rest)
    return top.agg(F.sort_array(F.collect_list("w")).alias("dict"))


def described(found: DataFrame, dict_row: DataFrame) -> DataFrame:
    """Candidates with the columns of FEATURES, ``rule`` and ``secret`` (the token itself)."""
    w = F.col("word")
    after_sign = F.regexp_extract("run", r"=([A-Za-z0-9+/_=.\-]{8,})", 1)
    token = F.when(after_sign != "", after_sign).otherwise(F.col("run"))
    d = found.join(F.broadcast(dict_row)).withColumn("secret", token)
    t, n = F.col("secret"), F.greatest(F.length("secret"), F.lit(1)).cast("double")
    share = lambda pattern: F.length(F.regexp_replace(t, f"[^{pattern}]", "")) / n
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "[a-z]+", "l"), "[A-Z]+", "u"), "[0-9]+", "d"), "[^lud]+", "o")
    yes = lambda c: F.when(c, 1.0).otherwise(0.0)
    runs = F.filter(F.split(F.lower(t), "[^a-z]+"), lambda x: F.length(x) >= 3)
    known = F.aggregate(F.array_intersect(runs, F.col("dict")), F.lit(0), lambda a, x: a + F.length(x))
    rule = F.lit("generic")
    for name in reversed(FORMATS):
        rule = F.when(of_format(F.col("run"), name), F.lit(name)).otherwise(rule)
    near = F.concat_ws(" ", "before2", "before")
    values = {
        "length": n,
        "transitions": (F.length(kinds) - 1) / n,
        "digits": share("0-9"),
        "uppers": share("A-Z"),
        "lowers": share("a-z"),
        "distinct": F.size(F.array_distinct(F.split(t, ""))) / n,
        "hex": yes(t.rlike("^[0-9a-f]+$") | t.rlike("^[0-9A-F]+$")),
        "uuid": yes(t.rlike("^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")),
        "format": yes(rule != "generic"),
        "named": yes(w.rlike(NAMES + r"\w{0,64}[\"']?[=:]")),
        "named_before": yes(F.substring(near, -256, 256).rlike(NAMES + r"\w*+\W*(?:[=:]|is)?\W*$")),
        "placeholder": yes(F.concat_ws(" ", near, w, "after").rlike(PLACEHOLDER)),
        "digest_before": yes(near.rlike(DIGEST)),
        "path": yes(w.rlike(r"^(?:https?://|\.{0,2}/)|[A-Za-z0-9_-]/[A-Za-z0-9_-]+/|\.[a-z]{2,5}$|@")),
        "coverage": known / n,
        "quoted": yes(w.rlike(r"[\"'][A-Za-z0-9+/_=.\-]{8,}[\"']")),
        "repeats": 1 - F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(r"(..)"), F.lit(1)))) * 2 / n,
    }
    return d.withColumn("rule", rule).select("*", *[v.cast("double").alias(f"f_{k}") for k, v in values.items()]).drop("dict")


def examples(n: int = EXAMPLES, seed: int = 5, kinds: Sequence[int] = range(12)) -> list[tuple[str, str, str, str, int]]:
    """Labelled findings (before2, before, word, after, label), made from formats of the given kinds with a fixed seed."""
    r = random.Random(seed)
    some = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    hexes, upper, both = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    plain = ("the", "with", "value", "set", "of", "und", "de", "run", "see", "file", "from", "report", "la", "in")
    names = ("password", "passwd", "secret", "token", "api_key", "apiKey", "access_key", "auth_token", "SECRET_KEY", "credential", "client_secret", "secret_access_key", "aws_secret_access_key")
    digests = ("sha256", "md5", "commit", "checksum", "revision", "hash", "etag", "build")
    secret = lambda: r.choice([
        some(hexes, r.randrange(16, 48)), some(both, r.randrange(16, 44)), some(both + "+/", r.randrange(24, 60)), some(both, r.randrange(12, 20)),
    ])
    out = []
    for _ in range(n):
        a, b, c = (r.choice(plain) for _ in range(3))
        q = r.choice(["", '"', "'"])
        kind = kinds[r.randrange(len(kinds))]
        if kind == 0:
            row = (a, b, r.choice(["AKIA", "ASIA"]) + some(upper, 16) + r.choice(["", ".", ","]), c, 1)
        elif kind == 1:
            row = (a, b, r.choice(["", "", "{"]) + r.choice(["", q]) + r.choice(names) + q + r.choice("=:") + f"{q}{secret()}{q}" + r.choice(["", ".", ","]), c, 1)
        elif kind == 2:
            row = (r.choice(names), r.choice(["=", ":", "is"]), f"{q}{secret()}{q}", c, 1)
        elif kind == 3:
            row = (a, r.choice(names) + r.choice([":", "="]), f"{q}{secret()}{q}", c, 1)
        elif kind == 4:
            row = (a, b, r.choice(["ghp_" + some(both, 36), "xoxb-" + some("0123456789", 11) + "-" + some(both, 24), "sk-" + some(both, 40), "eyJ" + some(both, 20) + "." + some(both, 40)]), c, 1)
        elif kind == 5:
            row = (a, r.choice(digests) + r.choice(["", ":"]), some(hexes, r.choice([12, 32, 40, 64])), c, 0)
        elif kind == 6:
            row = (a, b, "-".join(some(hexes, k) for k in (8, 4, 4, 4, 12)), c, 0)
        elif kind == 7:
            word = "/".join(r.choice(plain) + some(hexes, 2) for _ in range(3)) + r.choice([".py", ".txt", ".html", ""])
            row = (a, b, r.choice(["https://example.org/", "/usr/", "./"]) + word, c, 0)
        elif kind == 8:
            row = (a, b, f"{r.choice(names)}={q}{r.choice(['your-token-here1', 'changeme12345', 'example-key-0001', 'xxxxxxxxxxxx1', 'dummy-value-123'])}{q}", c, 0)
        elif kind == 9:
            row = (a, b, "_".join(r.choice(plain) for _ in range(3)) + str(r.randrange(100)), c, 0)
        elif kind == 10:
            row = (a, b, f"2{some('0123456789', 3)}-{some('0123456789', 2)}-{some('0123456789', 2)}T{some('0123456789', 6)}Z", c, 0)
        else:
            row = (a, b, some("0123456789", r.randrange(8, 16)) + some("abc", 1) + some("0123456789", 4) if r.random() < 0.5 else r.choice("ab") * 14 + "1", c, 0)
        out.append(row)
    return out


def table_of(spark: SparkSession, labelled: list[tuple[str, str, str, str, int]], dict_row: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels of labelled findings, by the expressions that describe candidates."""
    if len(labelled) > EXAMPLES:  # a sample by hash, whatever their order
        labelled = sorted(labelled, key=lambda x: hashlib.md5(repr(x).encode()).digest())[:EXAMPLES]
    rows = spark.createDataFrame(labelled, "before2 string, before string, word string, after string, label int")
    # one finding a row: its last candidate, or the whole word where a counterexample has none
    last = F.coalesce(F.element_at(F.when(F.size(pieces(F.col("word"))) > 0, pieces(F.col("word"))), -1), F.struct(F.col("word").alias("run"), F.col("word").alias("part")))
    rows = rows.select("before2", "before", last.alias("p"), "after", "label").select("before2", "before", F.col("p.part").alias("word"), F.col("p.run").alias("run"), "after", "label")
    got = described(rows, dict_row).select("label", *[f"f_{f}" for f in FEATURES]).collect()
    return np.array([[*r][1:] for r in got], float).reshape(-1, len(FEATURES)), np.array([r[0] for r in got], float)


def fit(spark: SparkSession, labelled: list[tuple[str, str, str, str, int]], dict_row: DataFrame) -> list[trees.Tree]:
    return trees.forest(*table_of(spark, labelled, dict_row), n_trees=TREES)


def as_sql(tree: trees.Tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, cut, below, above = tree
    return F.when(F.col(f"f_{FEATURES[f]}") < cut, as_sql(below)).otherwise(as_sql(above))


def scan(docs: DataFrame, labelled: list[tuple[str, str, str, str, int]] | None = None, flag: float = FLAG) -> DataFrame:
    """doc_id, word_no, rule, secret, probability, flagged for every candidate of every text."""
    dict_row = stored(dictionary(docs))
    model = fit(docs.sparkSession, labelled or examples(), dict_row)
    p = sum((as_sql(t) for t in model), F.lit(0.0)) / len(model)
    found = described(candidates(docs), dict_row).withColumn("probability", F.round(p, 6))
    return found.select("doc_id", F.col("word_no").cast("long").alias("word_no"), "rule", "secret", "probability", (F.col("probability") >= flag).alias("flagged"))


def op(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text"))
