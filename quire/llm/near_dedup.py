"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

1. Texts become five-word shingles (hashed to 64 bits). One pass counts document frequencies in a
   fixed number of hashed bins; a shingle's frequency is what its bin holds beyond the bins' usual
   load (median and six deviations), so rare shingles weigh the same at any size of the corpus.
   Weight = (1 + ln tf) * idf, where idf runs from 1 (rare) down to ``LEAST_IDF``; the floor keeps
   the members of a large group of copies from being judged by their differences alone.
2. Each text gets ``BANDS`` * ``ROWS`` consistent weighted samples (Ioffe's scheme: a sample is the
   pair of a shingle and a level; two texts agree on one with a probability equal to their weighted
   Jaccard similarity). The three draws of a shingle are read at three different parts of its hash.
   As a pair is also linked by its plain sets, it gets as many plain min-hash samples of those, whose
   agreement is the plain similarity, however often a passage is repeated. ``ROWS`` samples of one
   family make a band key. A pair at 0.8 by one of the two similarities shares no band of that family in
   8 of 10 000 cases, one at 0.8 by both in less than one in a million.
3. Equal texts are one text from here on, named by digest. Texts that share a band key are
   candidates. First each is verified against one member of each of its buckets, drawn anew for every
   bucket, which settles most buckets: texts already of one class need no further comparison.
4. In buckets whose texts are still of several classes, the rest is verified against the ``HUBS``
   members that were found alike most often of the times they were compared: those lie in the middle
   of a group of copies, where nearly all of it is near.
5. What is still of several classes in a bucket is compared in full: every two texts of different
   classes are candidates. Up to ``SMALL`` texts give their pairs; a larger bucket is dealt into
   salted blocks of about ``BLOCK`` texts and ``BLOCK_WORDS`` words, those outside its largest class against all others.
   There two texts are compared if ``AGREE`` of the ``BANDS`` * ``ROWS`` samples of a family are equal, which two texts that are to
   be linked miss in 3 of 10^7 cases. Only links that join classes leave a task.
6. Every comparison is made on whole texts: linked if the weighted Jaccard similarity, or that of the
   plain sets of shingles, is 0.8 or more. Classes are the connected components of the links; a
   class is named by its least doc_id.

Comparison streams over pairs sorted by their first text, of which one vector is held. A first text
with many partners is spread over tasks, ``FAN`` partners each. Joins on a key that may be hot (a
bucket, a class, a very frequent text) are sort-merge joins between two plain tables, and what is
counted per key is stored before; nothing else shares their stage, so adaptive execution splits them.

Defined cases: a null text is a class of its own; equal texts are always of one class, also empty
ones; texts under five words have one shingle, all their words, and texts without words none; very
long texts are read whole, in parts; a null doc_id takes part in its text's class, which a null names
only if no other id is in it; rows that repeat an id are placed by their own texts, so an id with two
texts may get two classes; an empty table gives an empty result. Other columns are ignored, and pass
through ``keep_one`` whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import arrow_map
from .common import fresh, stored, words
from .components import components

SHINGLE = 5
SIMILAR = 0.8
BANDS = 10
ROWS = 3
#: Samples of each family.
FAMILY = BANDS * ROWS
BINS = 1 << 18
LEAST_IDF = 0.5
SMALL = 16
BLOCK = 512
BLOCK_WORDS = 1 << 21
AGREE = 12
HUBS = 3
FAN = 256
TABLE = 1 << 16


def word_hashes(docs: DataFrame, *keep) -> DataFrame:
    return docs.select(*keep, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))


def shingles(h: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words (of all the words, if fewer) from the words' hashes, in order."""
    h = h.astype(np.uint64)
    n = len(h)
    if not n:
        return h
    width = min(n, SHINGLE)
    with np.errstate(over="ignore"):
        s = np.full(n - width + 1, width, np.uint64)
        for i in range(width):
            s = (s ^ h[i : n - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            s ^= s >> np.uint64(29)
    return s


def lists(column) -> list[np.ndarray]:
    """The rows of an Arrow list column as numpy slices."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, cuts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def frequencies(docs: DataFrame) -> np.ndarray:
    """Documents per bin, and their number as the last entry: 2 MB, whatever the input."""

    def run(batches):
        counts = np.zeros(BINS + 1, np.int64)
        for b in batches:
            found = [np.unique(shingles(h) & np.uint64(BINS - 1)) for h in lists(b.column(0))]
            if found:
                counts[:BINS] += np.bincount(np.concatenate(found).astype(np.int64), minlength=BINS)
            counts[BINS] += b.num_rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["bin", "n"])

    parts = arrow_map(word_hashes(docs), run, "bin int, n long")
    row = parts.groupBy("bin").agg(F.sum("n").alias("n")).agg(F.collect_list("bin").alias("bin"), F.collect_list("n").alias("n")).first()
    out = np.zeros(BINS + 1, np.int64)
    out[np.array(row["bin"], np.int64)] = row["n"]
    return out


def idf_of(counts: np.ndarray) -> np.ndarray:
    n, load = max(int(counts[-1]), 1), float(np.median(counts[:-1]))
    df = np.maximum(counts[:-1] - load - 6 * load**0.5, 1.0)
    return np.clip(np.log((1 + n) / (1 + df)) / np.log(1 + n), LEAST_IDF, 1.0).astype(np.float32)


def vector(h: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles and their weights."""
    s, tf = np.unique(shingles(h), return_counts=True)
    w = idf[(s & np.uint64(BINS - 1)).astype(np.int64)]
    return s, w * (1 + np.log(tf)).astype(np.float32) if len(s) and tf.max() > 1 else w


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The greater of the weighted and the plain Jaccard similarity."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    both = int(same.sum())
    if not both:
        return 0.0
    shared = float(np.minimum(a[1][same], b[1][at[same]]).sum())
    weighted = shared / (float(a[1].sum()) + float(b[1].sum()) - shared)
    return max(weighted, both / (len(a[0]) + len(b[0]) - both))


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1), its second's logarithm and the uniform draws of each sample, for shingles by their low bits."""
    rng = np.random.default_rng(2010)
    shape = (TABLE, FAMILY)
    r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
    return r, np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32), rng.random(shape, np.float32)


def samples(s: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The consistent weighted samples of one text."""
    r_all, c_all, beta_all = _draws()
    best = at_best = level = None
    log_w = np.log(w)[:, None]
    rows = [((s >> np.uint64(k)) & np.uint64(TABLE - 1)).astype(np.int64) for k in (16, 32, 48)]
    for i in range(0, len(s), 2048):  # a long text in parts, so that it needs no more memory
        part = slice(i, i + 2048)
        r, beta = r_all[rows[0][part]], beta_all[rows[2][part]]
        t = np.floor(log_w[part] / r + beta)
        a = c_all[rows[1][part]] - r * (t - beta + 1)
        k = a.argmin(0)
        across = np.arange(a.shape[1])
        least, at, lv = a[k, across], s[i + k], t[k, across]
        if best is None:
            best, at_best, level = least, at, lv
        else:
            better = least < best
            best, at_best, level = np.where(better, least, best), np.where(better, at, at_best), np.where(better, lv, level)
    with np.errstate(over="ignore"):
        return at_best ^ (level.astype(np.int64).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=1)
def _plain_draws() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1997)
    return rng.integers(0, 1 << 63, FAMILY, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, FAMILY, np.uint64)


def plain_samples(s: np.ndarray) -> np.ndarray:
    """The least hash of a text's shingles under each of FAMILY hash functions."""
    factor, plus = _plain_draws()
    best = np.full(FAMILY, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 2048):
            h = s[i : i + 2048, None] * factor + plus
            best = np.minimum(best, ((h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)).min(0))
    return best


def both_samples(s: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The samples of the weighted family, then those of the plain one."""
    return np.concatenate([samples(s, w), plain_samples(s)])


def band_keys(sample: np.ndarray) -> np.ndarray:
    """A key for each band of one or both families."""
    n = len(sample) // ROWS
    with np.errstate(over="ignore"):
        key = np.arange(1, n + 1).astype(np.uint64)
        for row in sample.reshape(n, ROWS).T:
            key = (key ^ row) * np.uint64(0xC2B2AE3D27D4EB4F)
            key ^= key >> np.uint64(31)
    return key.view(np.int64)


def sketch(sample: np.ndarray) -> bytes:
    """Sixteen bits of each sample."""
    with np.errstate(over="ignore"):
        return ((sample * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype("<u2").tobytes()


def alike(many: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Which of several sketches agree with one often enough in a family for their texts to be compared."""
    same = many == one
    return (same[:, :FAMILY].sum(1) >= AGREE) | (same[:, FAMILY:].sum(1) >= AGREE)


def node(text) -> F.Column:
    """A text's name: its digest, 16 bytes; null for a null text."""
    return F.unhex(F.md5(text))


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, node, band keys (none for a text without words), sketch and number of words of every row."""

    def run(batches):
        for b in batches:
            rows, last = [], (None, None)
            for name, h in zip(b.column(1).to_pylist(), lists(b.column(2)), strict=True):
                if name is None or name != last[0]:  # copies often follow one another
                    found = both_samples(*vector(h, idf)) if len(h) else None
                    last = name, (np.empty(0, np.int64), b"") if found is None else (band_keys(found), sketch(found))
                rows.append(last[1])
            cuts = np.concatenate([[0], np.cumsum([len(k) for k, _ in rows])]).astype(np.int32)
            flat = np.concatenate([k for k, _ in rows]) if rows else np.empty(0, np.int64)
            bands = pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))
            sketches, sizes = pa.array([x for _, x in rows], pa.binary()), pa.array(np.diff(b.column(2).offsets.to_numpy()).astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), bands, sketches, sizes], ["doc_id", "node", "bands", "sketch", "n_words"])

    rows = word_hashes(docs, F.col("doc_id").cast("long").alias("doc_id"), node(F.col("text")).alias("node"))
    return arrow_map(rows, run, "doc_id long, node binary, bands array<long>, sketch binary, n_words long")


def vectors_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and its words' hashes ``h`` of the ``wanted`` texts (node, doc_id), each read from the row of its least id."""
    rows = docs.select("doc_id", "text", node(F.col("text")).alias("node"))
    # sorted on both sides at any size, here and in ``verified``: no size of the groups makes the plan another
    named = rows.where("doc_id is not null").join(wanted.where("doc_id is not null").hint("merge"), ["doc_id", "node"], "left_semi")
    bare = rows.where("doc_id is null").join(wanted.where("doc_id is null").select("node").hint("merge"), "node", "left_semi")
    return word_hashes(named.unionByName(bare), "node").dropDuplicates(["node"])


def verified(pairs: DataFrame, vectors: DataFrame, idf: np.ndarray) -> DataFrame:
    """The pairs (a, b) that are similar enough."""
    fan = stored(pairs.groupBy("a").agg(F.count("*").alias("n")))
    spread = pairs.hint("merge").join(fan, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / FAN)).cast("int").alias("salt"))
    heads = fan.select("a", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / FAN) - 1).cast("int"))).alias("salt"))
    rows = spread.select("a", "salt", F.col("b").alias("node"), F.lit(1).alias("role")).union(heads.select("a", "salt", F.col("a").alias("node"), F.lit(0).alias("role")))
    rows = rows.hint("merge").join(vectors, "node").select("a", "salt", "role", "node", "h")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")

    def run(batches):
        head, own = None, None
        for b in batches:
            hit = ([], [])
            for a, salt, role, name, h in zip(*(b.column(i).to_pylist() for i in range(4)), lists(b.column(4)), strict=True):
                v = vector(h, idf)
                if role == 0:
                    head, own = (a, salt), v
                elif head == (a, salt) and similarity(own, v) >= SIMILAR:
                    hit[0].append(a)
                    hit[1].append(name)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in hit], ["a", "b"])

    return arrow_map(rows, run, "a binary, b binary")


def small_pairs(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of different classes in the buckets of at most SMALL texts, from rows (key, node, rep, size, label)."""
    small = met.where((F.col("size") <= SMALL) & (F.col("node") != F.col("rep")))  # the drawn member has met all others
    groups = small.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "label"))).alias("g"))  # at most SMALL each
    first = groups.select(F.posexplode("g").alias("i", "x"), "g")
    both = first.select("x", F.explode(F.slice("g", F.col("i") + 2, F.greatest(F.size("g") - F.col("i") - 1, F.lit(0)))).alias("y"))
    return both.where("x.label <> y.label").select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


class _Cell:
    """Two blocks of a bucket: the texts held, and which classes the cell has joined."""

    def __init__(self, key: int):
        self.key, self.n, self.joined = key, 0, {}
        self.sketches = np.empty((64, 2 * FAMILY), np.uint16)
        self.rows: list[tuple] = []

    def hold(self, row: tuple, sample: np.ndarray) -> None:
        if self.n == len(self.sketches):
            self.sketches = np.concatenate([self.sketches, np.empty_like(self.sketches)])
        self.sketches[self.n] = sample
        self.rows.append(row)
        self.n += 1

    def root(self, label: bytes) -> bytes:
        while label in self.joined:
            label = self.joined[label]
        return label

    def links(self, row: tuple, sample: np.ndarray):
        """The held texts that the row is linked to and that are of a class of their own still."""
        name, label, keys, v = row
        for i in np.flatnonzero(alike(self.sketches[: self.n], sample)).tolist():
            other, others, theirs, w = self.rows[i]
            x, y = self.root(label), self.root(others)
            # a pair that shares several buckets is compared in that of least key
            if x != y and min(keys & theirs) == self.key and similarity(v, w) >= SIMILAR:
                self.joined[max(x, y)] = min(x, y)
                yield other


def large_links(met: DataFrame, texts: DataFrame, vectors: DataFrame, idf: np.ndarray) -> DataFrame:
    """Links (a, b) that join the classes of the buckets of more than SMALL texts."""
    big = met.where(F.col("size") > SMALL)
    big = big.hint("merge").join(texts.select("node", "n_words"), "node")
    parts = big.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("n_words").alias("w"))
    plan = parts.groupBy("key").agg(F.max(F.struct("n", "label", "w")).alias("m"), F.sum("n").alias("n"), F.sum("w").alias("w"))
    blocks = lambda n, w: F.greatest(F.ceil(n / BLOCK), F.ceil(w / BLOCK_WORDS)).cast("int")
    plan = plan.select("key", F.col("m.label").alias("main"), blocks(F.col("n") - F.col("m.n"), F.col("w") - F.col("m.w")).alias("out"), blocks(F.col("m.n"), F.col("m.w")).alias("in"))
    plan = stored(plan)
    main = F.col("label") == F.col("main")
    place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    own = F.when(main, F.col("out") + place(F.col("in"))).otherwise(place(F.col("out")))
    last = F.when(main, F.col("out")).otherwise(F.col("out") + F.col("in")) - 1
    cells = big.hint("merge").join(plan, "key").select("key", "node", "label", own.alias("i"), F.explode(F.sequence(F.lit(0), last)).alias("j"))
    cells = cells.select("key", "node", "label", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), (F.col("i") > F.col("j")).cast("int").alias("role"))
    known = texts.select("node", "bands", "sketch").join(big.select("node").distinct(), "node").join(vectors, "node")
    rows = cells.hint("merge").join(known, "node").select("key", "lo", "hi", "role", "node", "label", "bands", "sketch", "h")
    rows = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "role")

    def run(batches):
        group, cell = None, None
        for b in batches:
            hit = ([], [])
            for key, lo, hi, role, name, label, bands, sk, h in zip(*(b.column(i).to_pylist() for i in range(8)), lists(b.column(8)), strict=True):
                if group != (key, lo, hi):
                    group, cell = (key, lo, hi), _Cell(key)
                row, sample = (name, label, frozenset(bands), vector(h, idf)), np.frombuffer(sk, "<u2")
                if role == 1 or lo == hi:
                    for other in cell.links(row, sample):
                        hit[0].append(min(name, other))
                        hit[1].append(max(name, other))
                if role == 0:
                    cell.hold(row, sample)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in hit], ["a", "b"])

    return arrow_map(rows, run, "a binary, b binary")


def hub_pairs(met: DataFrame, tried: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs (a, b), not tried yet, of each open bucket's hubs with its texts of other classes, from rows (key, node, label)."""
    times = lambda d, n: d.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias(n))
    score = times(tried, "t").join(times(links, "l"), "node", "left").select("node", (F.coalesce("l", F.lit(0)) / (F.col("t") + 1)).alias("score"))
    part = F.pmod(F.xxhash64("node"), F.lit(HUBS)).alias("part")
    hubs = stored(met.hint("merge").join(score, "node").groupBy("key", part).agg(F.max(F.struct("score", "node", "label")).alias("m")))
    pairs = met.hint("merge").join(hubs.select("key", F.col("m.node").alias("hub"), F.col("m.label").alias("of")), "key").where("label <> of")
    return pairs.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")


def still_open(met: DataFrame, label: DataFrame) -> DataFrame:
    """The rows (key, node, rep, size, label) of the buckets whose texts are of several classes."""
    lab = met.drop("label").hint("merge").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lab = stored(lab.select("key", "node", "rep", "size", "label"))
    mixed = lab.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("m")).where("l <> m").select("key")
    return stored(lab.hint("merge").join(stored(mixed), "key", "left_semi"))


def joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (node, label) after more links: those are between classes, few, and components of their own."""
    for side in ("a", "b"):
        links = links.join(label.select(F.col("node").alias(side), "label"), side, "left").withColumn(side, F.coalesce("label", side)).drop("label")
    wider = components(links).select(F.col("node").alias("label"), F.col("label").alias("wide"))
    known = label.unionByName(wider.join(label, "label", "left_anti").select(F.col("label").alias("node"), "label"))  # a text that had no link yet
    return stored(known.hint("merge").join(wider, "label", "left").select("node", F.coalesce("wide", "label").alias("label")))


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and (node, doc_id, label) of every text: its least id and its class's least node."""
    docs = docs.select("doc_id", "text")
    idf = idf_of(frequencies(docs))
    sig = stored(signatures(docs, idf))
    texts = stored(sig.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("bands", "sketch", "n_words")).alias("m")).select("node", "doc_id", "m.*"))
    members = texts.select("node", F.explode("bands").alias("key"))
    heads = stored(members.groupBy("key").agg(F.count("*").alias("size"), F.min_by("node", F.xxhash64("key", "node")).alias("rep")).where("size > 1"))
    met = stored(members.hint("merge").join(heads, "key").select("key", "node", "rep", "size"))
    vectors = stored(vectors_of(docs, texts.select("node", "doc_id").join(met.select("node").distinct(), "node")))

    tried = stored(met.where("node <> rep").select(F.least("rep", "node").alias("a"), F.greatest("rep", "node").alias("b")).distinct())
    links = stored(verified(tried, vectors, idf))
    label = components(links)
    met = still_open(met.where("size > 2"), label)
    label = joined(label, verified(stored(hub_pairs(met, tried, links)), vectors, idf))
    met = still_open(met, label)
    label = joined(label, verified(stored(small_pairs(met)), vectors, idf).union(large_links(met, texts, vectors, idf)))
    named = texts.select("node", "doc_id").hint("merge").join(label, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    return sig.select("doc_id", "node"), stored(named)


def classes(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, class_id."""
    rows, texts = grouped(docs)
    least = stored(texts.groupBy("label").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).where("n > 1").select("label", "least"))
    named = texts.hint("merge").join(least, "label", "left").select("node", F.coalesce("least", "doc_id").alias("class_id"))
    out = rows.hint("merge").join(named, "node", "left")
    return out.select("doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class: of its least id that is not null, of that id's texts in the class the one of least digest.

    Rows with that id and that text are one row; the one whose other columns (but maps) have the
    least hash stays. Rows without a text are kept, each a class of its own.
    """
    _, texts = grouped(docs)
    chosen = texts.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "node")).alias("m"))
    none, number, name, rank = fresh(docs, "none", "id", "node", "rank")
    chosen = chosen.select(F.col("m.none").alias(none), F.col("m.id").alias(number), F.col("m.node").alias(name))
    rows = docs.withColumns({none: F.col("doc_id").isNull(), number: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), name: node(F.col("text"))})
    kept = rows.join(chosen.hint("merge"), [none, number, name], "left_semi")
    rest = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    kept = kept.withColumn(rank, F.row_number().over(Window.partitionBy(none, number, name).orderBy(F.xxhash64(*rest)))).where(F.col(rank) == 1)
    return kept.select(*docs.columns).unionByName(docs.where(F.col("text").isNull()))


def op(docs: DataFrame) -> DataFrame:
    return classes(docs)
