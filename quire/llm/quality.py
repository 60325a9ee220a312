"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two multinomials
over the buckets are counted, one on the trusted target texts and one on the whole corpus, both
with additive smoothing. A document's score is the mean over its n-grams of
log(p_target / p_corpus): the log-likelihood ratio, normalised by length. It is kept if it passes
the base rules and its score reaches the threshold; nothing is drawn at random.

The threshold comes from trusted texts that the counts did not see: a quarter of the trusted ids
(crc32 of the id) is held out of the target, and the threshold lies ``DEVIATIONS`` standard
deviations below the mean score of those that pass the base rules. Scores are summed as whole
millionths, so reruns give the same threshold.

The counts are sums per bucket, partly summed before the shuffle; the ratios are a table of
``BUCKETS`` rows, a size that no amount of data changes, and are broadcast. The trusted texts are
found by a join on the id; the scoring reads every document once. Everything per word is exploded
and summed inside generated code; of the two passes over arrays left, one hashes runs of words.

Defined cases: a null or empty text has no words, fails the base rules and scores 0; white space
around words does not matter; very long texts are read whole; rows that repeat an id are counted
and scored one by one, and are trusted together; a null id is never trusted; an id is trusted if
all its labels are 1; an empty table gives an empty result; without any trusted text all scores
are 0, and without held-out ones the base rules alone decide. Columns that are not named in
``keep`` are ignored; a kept one that has the name of a result raises ValueError.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, spaced, stored, words

BUCKETS = 1 << 18
SMOOTHING = 1.0
DEVIATIONS = 6.0
HELD_OUT = 4
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"


def _count(c: Column) -> Column:
    return c.cast("long")


def repeated_words(ws: Column) -> Column:
    """Number of words in windows that the text has at least twice.

    Runs of 4 words are hashed; a repeated window of 8 words repeats 5 of them, so a text that does
    not is done with. In the others a window is known by the hashes of its two halves, 128 bits.
    Windows are sorted as numbers whose high bits are a hash of both and whose low bits the place;
    equal ones are then neighbours, but for a foreign one or two with the same high bits.
    """
    n = F.size(ws) - (WINDOW - 1)

    def run_of(x: Column, i: Column) -> Column:
        return F.xxhash64(x, *[F.get(ws, i + k) for k in range(1, WINDOW // 2)])

    def covered(q: Column) -> Column:
        half = lambda i: F.get(q, i + WINDOW // 2)
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1
        places = F.transform(F.slice(q, 1, n), lambda x, i: F.xxhash64(x, half(i)).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i))
        return let(F.sort_array(places), lambda s: let(F.sort_array(twice(q, s, mask)), length))

    def twice(q: Column, s: Column, mask: Column) -> Column:
        """Places of the windows that some other window equals."""
        place = lambda x: x.bitwiseAND(mask).cast("int")
        at = lambda q, x: F.get(q, place(x))

        def same(x: Column, y: Column) -> Column:
            whole = (at(q, x) == at(q, y)) & (F.get(q, place(x) + WINDOW // 2) == F.get(q, place(y) + WINDOW // 2))
            return F.coalesce((x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(mask)) == 0) & whole, F.lit(False))

        def near(x: Column, i: Column) -> Column:
            found = F.lit(False)
            for k in (1, -1, 2, -2):
                found = found | same(x, F.get(s, i + k))
            return found

        return F.transform(F.filter(s, near), place)

    def length(p: Column) -> Column:
        """Words of the windows that start at the sorted places, each counted once."""
        return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)

    def of(q: Column) -> Column:
        return F.when(F.size(q) - F.size(F.array_distinct(q)) < WINDOW - 3, F.lit(0)).otherwise(covered(q))

    return F.when(F.size(ws) <= WINDOW, F.lit(0)).otherwise(let(F.transform(ws, run_of), of))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def base(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the columns of BASE and the words (``__w``)."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.withColumn("__w", words(F.col(text_col)))
    d = d.withColumns({
        "n_words": _count(F.size("__w")),
        "word_chars": _count(F.length(spaced(t, ""))),
        "n_symbols": _count(F.regexp_count(t, F.lit(SYMBOLS))),
        "n_dup_lines": _count(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))),
        "n_repeat_words": _count(repeated_words(F.col("__w"))),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return d.withColumn("base_failed", failed)


def bucket(gram: Column, buckets: int) -> Column:
    """The low bits of a gram's hash; ``buckets`` is a power of two."""
    return gram.bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int")


def grams(docs: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """One row per word of ``__w`` (one in all without words): the buckets of the word (``b1``) and of the pair that it begins (``b2``)."""
    placed = docs.select(*keep, "__w", F.posexplode_outer("__w").alias("__i", "__x"))
    word, after = F.xxhash64("__x"), F.get("__w", F.col("__i") + 1)
    return placed.select(
        *keep, F.when(F.col("__x").isNotNull(), bucket(word, buckets)).alias("b1"), F.when(after.isNotNull(), bucket(F.xxhash64(word, F.xxhash64(after)), buckets)).alias("b2")
    )


def bucket_counts(texts: DataFrame, text_col: str, buckets: int) -> DataFrame:
    g = grams(texts.select(words(F.col(text_col)).alias("__w")), buckets)
    return g.select(F.explode(F.array("b1", "b2")).alias("b")).where("b is not null").groupBy("b").agg(F.count("*").alias("n"))


def ratios(target: DataFrame, corpus: DataFrame, text_col: str, buckets: int, smoothing: float) -> DataFrame:
    """(b, r): the log ratio of every bucket, all 0 without a target."""
    t = bucket_counts(target, text_col, buckets).select("b", F.col("n").alias("t"), F.lit(0).cast("long").alias("c"))
    c = bucket_counts(corpus, text_col, buckets).select("b", F.lit(0).cast("long").alias("t"), F.col("n").alias("c"))
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"), F.lit(0).cast("long").alias("t"), F.lit(0).cast("long").alias("c"))
    both = stored(t.unionByName(c).unionByName(every).groupBy("b").agg(F.sum("t").alias("t"), F.sum("c").alias("c")))
    sums = both.agg(F.sum("t").alias("nt"), F.sum("c").alias("nc"))
    mass = smoothing * buckets
    log_of = lambda n, total: F.log(n + smoothing) - F.log(total + mass)
    ratio = F.when(F.col("nt") > 0, log_of(F.col("t"), F.col("nt")) - log_of(F.col("c"), F.col("nc"))).otherwise(0.0)
    return both.join(F.broadcast(sums)).select("b", ratio.alias("r"))


def score(docs: DataFrame, target: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",), buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row per row of ``docs``: the columns named in ``keep``, those of BASE and ``score``. ``target``: the trusted texts.

    A row's grams are summed in the task that reads it, under a number of the row, and only the sum
    leaves the task.
    """
    if clash := {*keep} & {*BASE, "score"}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    r = stored(ratios(target, docs, text_col, buckets, smoothing))
    kept = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)]
    d = base(docs.select(*kept, F.col(text_col).alias("__t")), "__t").withColumn("__row", F.monotonically_increasing_id())
    names = [f"__k{i}" for i in range(len(keep))] + [*BASE]
    g = grams(d, buckets, "__row", *names)
    for k in ("1", "2"):  # the broadcast side has ``buckets`` rows, whatever the data
        g = g.join(F.broadcast(r.select(F.col("b").alias(f"b{k}"), F.col("r").alias(f"r{k}"))), f"b{k}", "left")
    total = F.sum(F.coalesce("r1", F.lit(0.0)) + F.coalesce("r2", F.lit(0.0)))
    mean = F.when(F.col("n_words") > 0, F.col("total") / (2 * F.col("n_words") - 1)).otherwise(0.0)
    summed = g.groupBy("__row", *names).agg(total.alias("total"))
    return summed.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], *BASE, mean.alias("score"))


def decide(scored: DataFrame, held_out: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """Adds ``kept``. ``held_out``: the trusted ids (doc_id) that the target did not count."""
    sample = scored.where(~F.col("base_failed")).join(held_out, "doc_id", "left_semi")
    whole = F.round(F.col("score") * 1e6).cast("decimal(20,0)")
    m = sample.agg(F.count("*").alias("n"), F.sum(whole).cast("double").alias("s"), F.sum(whole * whole).cast("double").alias("q"))
    mean = F.col("s") / F.col("n")
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean))
    limit = F.when(F.col("n") > 0, F.round(mean - deviations * spread) / 1e6).otherwise(F.lit(-1e300))
    d = scored.join(F.broadcast(m.select(limit.alias("__limit"))))
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.col("__limit"))).drop("__limit")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id and ``held`` of the ids all of whose quality labels are 1."""
    good = labels.groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).where("q = 1")
    return good.select("doc_id", (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(HELD_OUT)) == 0).alias("held"))


def op(docs: DataFrame, labels: DataFrame) -> DataFrame:
    d, ids = docs.select("doc_id", "text"), trusted_ids(labels)
    # sorted on both sides at any size: no size of the labels makes the plan another
    target = d.join(ids.where("not held").select("doc_id").hint("merge"), "doc_id", "left_semi")
    scored = stored(score(d, target))  # a few numbers a document; the texts are done with
    return decide(scored, ids.where("held").select("doc_id")).select("doc_id", *BASE, "kept", "score")
