"""MinHash near-duplicate detection with banding, verification and components.

1. Every text becomes its set of distinct word shingles (64-bit hashes), the
   minima of ``PERMUTATIONS`` universal hash functions over the set, and one
   key per band of ``ROWS`` minima.
2. Texts with equal sets form a class; only its smallest id goes on.
3. Classes that share a band key are candidates.  A bucket is never expanded
   into its pairs.  In each round a class of a bucket that is not yet in the
   component of the bucket's majority is compared with one pivot of it, and
   the confirmed links are merged; rounds go on while they pay.  What is then
   still apart in a shared bucket is compared in full, members outside the
   majority against the rest, but for pairs that a bound or their signatures
   rule out.  The bound is exact: with shingles that at most ``RARE`` open
   documents have left out, the overlap of a pair that shares none of these is
   at most the smaller count of the others; pairs that do share one are found
   by it.  Members that this bound keeps from every other one of their bucket
   drop out before any pair is made.  So every candidate pair either is
   compared or already lies in one component.
4. A link is confirmed on the full shingle sets, never on signatures.
5. Components by alternating large-star and small-star.

With 25 bands of 5, a pair at the threshold 0.8 shares no band with
probability 5e-5, and at 0.9 practically never.  Signatures rule out a pair
only more than five standard errors below the threshold.

Defined results: a null or empty text has no shingles, links with nothing and
is kept; a text with fewer words than a shingle is one shingle; texts of any
length count whole; rows with a null id link with nothing, have a null
component and are kept; rows with equal ids count as one document that has the
links of all of them; ties cannot arise, as the smallest id leads; an empty
table gives no rows; other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import bounded, fresh_name, materialise, utf8_values
from farebox.llm.components import connected_components
from farebox.operators.joins import lookup_join

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
ROWS = 5
BANDS = 25
PERMUTATIONS = ROWS * BANDS
MAX_PIVOT_ROUNDS = 8
PAYING_SHARE = 0.02  # of a round's comparisons that must give links for another round
RARE = 16
COPY_PARTS = 64
# Share of equal minima below which a pair is ruled out: the threshold less
# five standard errors of the estimate.
SIGNATURE_MARGIN = 5 * (0.8 * 0.2 / PERMUTATIONS) ** 0.5

_SEED = 20240229
_WORD_CACHE = 50_000
_BLOCK = 512
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)

SIGNATURE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("print", T.BinaryType()),
    T.StructField("minima", T.ArrayType(T.IntegerType())),
    T.StructField("bands", T.ArrayType(T.LongType())),
])


class _WordHashes(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of word hashes spread over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Distinct shingle hashes of a text, sorted."""

    def __init__(self, words_per_shingle: int) -> None:
        self.size = words_per_shingle
        self.words = _WordHashes()
        rng = np.random.default_rng(_SEED)
        self.factors = rng.integers(0, 1 << 63, size=words_per_shingle, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []  # bytes: A-Z and ASCII white space only
        if not words:
            return np.empty(0, dtype=np.uint64)
        hashes = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(self.size, len(words))
        n = len(words) - width + 1
        total = np.full(n, width, dtype=np.uint64)
        for k in range(width):
            total += hashes[k : n + k] * self.factors[k]
        return np.unique(_mixed(total))


class MinHasher:
    """Minima of universal hash functions x -> (a x + b) mod 2^64, top 32 bits."""

    def __init__(self, permutations: int) -> None:
        rng = np.random.default_rng(_SEED + 1)
        self.a = rng.integers(0, 1 << 63, size=(permutations, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, size=(permutations, 1), dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), _MASK, dtype=np.uint64)
        for start in range(0, len(shingles), _BLOCK):
            np.minimum(low, (self.a * shingles[start : start + _BLOCK] + self.b).min(axis=1), out=low)
        return (low >> np.uint64(32)).astype(np.uint32)


def _signatures(batches: Iterator[pa.RecordBatch], words_per_shingle: int) -> Iterator[pa.RecordBatch]:
    """One row per document: set size, print of the set, minima and band keys."""
    shingler, hasher = Shingler(words_per_shingle), MinHasher(PERMUTATIONS)
    salts = np.random.default_rng(_SEED + 2).integers(0, 1 << 63, size=(ROWS, 1), dtype=np.uint64) * np.uint64(2)
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
    names = [f.name for f in SIGNATURE_SCHEMA]

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), utf8_values(batch.column(1))):
            shingles = shingler(text)
            if len(shingles):
                minima = hasher(shingles)
                rows_of = minima.astype(np.uint64).reshape(BANDS, ROWS)
                keys = _mixed((rows_of * (salts.T + np.uint64(1))).sum(axis=1, dtype=np.uint64)
                              + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                rows.append((doc_id, len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()),
                             minima.view(np.int32), keys.view(np.int64)))
            else:
                rows.append((doc_id, 0, None, None, None))
            if len(rows) == 1000:
                yield flush(rows)
                rows = []
        if rows:
            yield flush(rows)


def signatures(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int) -> DataFrame:
    """``SIGNATURE_SCHEMA`` rows, one per document."""
    pairs = bounded(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(lambda batches: _signatures(batches, words_per_shingle), SIGNATURE_SCHEMA)


def _shingle_sets(texts: DataFrame, words_per_shingle: int) -> DataFrame:
    """(id, items): the full shingle set of each (id, text)."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def items(texts: pa.Array) -> pa.Array:
        shingler = Shingler(words_per_shingle)
        return pa.array([shingler(t).view(np.int64) for t in utf8_values(texts)], pa.list_(pa.int64()))

    return texts.select("id", items("text").alias("items"))


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold_percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets reach the threshold."""
    x = sets.select(F.col("id").alias("x"), F.col("items").alias("x_items"))
    y = sets.select(F.col("id").alias("y"), F.col("items").alias("y_items"))
    both = pairs.join(x.hint("merge"), "x").join(y.hint("merge"), "y")
    common = F.size(F.array_intersect("x_items", "y_items"))
    union = F.size("x_items") + F.size("y_items") - common
    return both.where(100 * common >= threshold_percent * union).select("x", "y").distinct()


def _size_fits(x: str, y: str, threshold_percent: int):
    """False where the set sizes alone keep a pair below the threshold."""
    return 100 * F.least(x, y) >= threshold_percent * F.greatest(x, y)


def class_links(classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int,
                threshold_percent: int) -> DataFrame:
    """Links (x, y) between class representatives, enough to give the
    components of all candidate pairs that reach the threshold.

    ``classes`` has id, n_shingles, minima and bands of each representative.
    """
    spark = classes.sparkSession
    banded = classes.select("id", "n_shingles", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = materialise(banded.join(shared.hint("merge"), "key"), "minhash-members")
    wanted = members.select("id").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    found = lookup_join(texts, materialise(wanted, "minhash-wanted"), ["id"], how="left_semi")
    sets = materialise(_shingle_sets(found, words_per_shingle), "minhash-sets")

    empty = spark.createDataFrame([], "x long, y long")
    links, tested, labels = empty, empty, None
    for _ in range(MAX_PIVOT_ROUNDS):
        open_members, major = _open_buckets(members, links, labels)
        minor = open_members.join(major.hint("merge"), "key").where(F.col("component") != F.col("major"))
        # One pivot per open member and round: the one it meets most often.
        votes = (minor.where(_size_fits("n_shingles", "pivot_n", threshold_percent))
                 .groupBy(F.col("id").alias("x"), F.col("pivot").alias("y")).agg(F.count(F.lit(1)).alias("n"))
                 .join(tested.hint("merge"), ["x", "y"], "left_anti"))
        pairs = (votes.groupBy("x").agg(F.max(F.struct("n", (-F.col("y")).alias("neg"))).alias("best"))
                 .select("x", (-F.col("best.neg")).alias("y")))
        pairs = materialise(pairs, "minhash-pairs")
        new = materialise(_confirmed(pairs, sets, threshold_percent), "minhash-links")
        n_pairs, n_new = pairs.count(), new.count()
        tested = tested.union(pairs)
        if n_new:
            links = links.union(new)
            labels = connected_components(links, "x", "y", "minhash-components").withColumnRenamed("node", "id")
        if n_new <= PAYING_SHARE * n_pairs:
            break
    open_members, major = _open_buckets(members, links, labels)
    pairs = materialise(_remaining_pairs(open_members, major, classes, sets, tested, threshold_percent), "minhash-pairs")
    return links.union(materialise(_confirmed(pairs, sets, threshold_percent), "minhash-links"))


def _open_buckets(members: DataFrame, links: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(members of the buckets that span several components, with component
    and number of links; per bucket its majority component and that one's best
    linked member)."""
    if labels is None:
        tagged = members.withColumn("component", F.col("id")).withColumn("degree", F.lit(0).cast("long"))
    else:
        degrees = (links.select("x").union(links.select("y")).toDF("id").groupBy("id")
                   .agg(F.count(F.lit(1)).alias("degree")))
        tagged = (members.join(labels.hint("merge"), "id", "left").join(degrees.hint("merge"), "id", "left")
                  .select("key", "id", "n_shingles", F.coalesce("component", "id").alias("component"),
                          F.coalesce("degree", F.lit(0)).alias("degree")))
        split = (tagged.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .where("lo != hi").select("key"))
        tagged = materialise(tagged.join(split.hint("merge"), "key"), "minhash-tagged")
    parts = tagged.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct("degree", (-F.col("id")).alias("neg_id"), "n_shingles")).alias("top"))
    major = parts.groupBy("key").agg(F.max(F.struct("n", (-F.col("component")).alias("neg"), "top")).alias("m")).select(
        "key", (-F.col("m.neg")).alias("major"), (-F.col("m.top.neg_id")).alias("pivot"),
        F.col("m.top.n_shingles").alias("pivot_n"))
    return tagged, major


def _rare_shingles(ids: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, core): how many shingles of each document more than RARE of the
    documents have; pairs (x, y) of documents that share a rarer one)."""
    found = sets.join(ids.hint("merge"), "id", "left_semi").withColumn("row", F.xxhash64("id", "items"))
    # A repeated row (same id, same set) counts once, in its own rare shingles and in how many documents have one.
    found = found.dropDuplicates(["id", "row"])
    found = materialise(found, "minhash-open-sets")
    items = found.select("row", "id", F.explode("items").alias("item"))
    rare = items.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= RARE)
    held = materialise(items.join(rare.hint("merge"), "item"), "minhash-rare")
    counts = held.groupBy("row").agg(F.count(F.lit(1)).alias("rare"))
    cores = found.join(counts.hint("merge"), "row", "left").groupBy("id").agg(
        F.max(F.size("items") - F.coalesce("rare", F.lit(0))).alias("core"))
    # At most RARE documents hold an item.
    lists = held.where("n > 1").groupBy("item").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    sharing = (lists.select("ids", F.posexplode("ids").alias("at", "x"))
               .select("x", F.explode(F.slice("ids", F.col("at") + 2, F.lit(RARE))).alias("y")).distinct())
    return cores, sharing


def _can_reach(members: DataFrame, threshold_percent: int) -> DataFrame:
    """The members (key, id, n_shingles, core, ...) that by their cores alone may
    reach the threshold with some member of their bucket.

    An overlap m of cores needs m (100 + T) >= T (x + y) for sets of x and y
    shingles.  No set is smaller than m over the largest share that a core has
    in the bucket, and the left side grows faster in m, so x's whole core
    decides.  Texts of one template with too much of their own drop out here,
    before any pair is made; they can only link by a rarer shingle.
    """
    share = F.col("core") / F.col("n_shingles")
    fullest = members.groupBy("key").agg(F.max(share).alias("fullest"))
    t = float(threshold_percent)
    # Both sides times the largest share, which may be 0; above any rounding.
    reach = F.col("core") * ((100 + t) * F.col("fullest") - t) * (1 + 1e-9)
    able = (F.col("core") > 0) & (reach >= t * F.col("n_shingles") * F.col("fullest"))
    return members.join(fullest.hint("merge"), "key").where(able).drop("fullest")


def _remaining_pairs(open_members: DataFrame, major: DataFrame, classes: DataFrame, sets: DataFrame, tested: DataFrame,
                     threshold_percent: int) -> DataFrame:
    """Untested pairs of different components that share a bucket, less those
    that the bound or signatures rule out."""
    cores, sharing = _rare_shingles(open_members.select("id").distinct(), sets)
    members = (open_members.join(cores.hint("merge"), "id").join(major.select("key", "major").hint("merge"), "key")
               .select("key", "id", "n_shingles", "component", "core", "major"))
    members = materialise(members, "minhash-open")
    able = materialise(_can_reach(members, threshold_percent), "minhash-able")
    x = able.where("component != major").select(
        "key", F.col("id").alias("x"), F.col("n_shingles").alias("x_n"), F.col("core").alias("x_core"),
        F.col("component").alias("x_c"), "major")
    y = able.select("key", F.col("id").alias("y"), F.col("n_shingles").alias("y_n"), F.col("core").alias("y_core"),
                       F.col("component").alias("y_c"))
    most = F.least("x_core", "y_core")
    by_bucket = (x.hint("merge").join(y, "key")
                 .where((F.col("x_c") != F.col("y_c")) & ((F.col("y_c") == F.col("major")) | (F.col("x") < F.col("y"))))
                 .where(100 * most >= threshold_percent * (F.col("x_n") + F.col("y_n") - most)).select("x", "y"))
    # A document has one component; sizes of the classes of an id may differ, so the widest range counts.
    nodes = members.groupBy("id").agg(F.min("component").alias("c"), F.min("n_shingles").alias("lo"),
                                      F.max("n_shingles").alias("hi"))
    by_item = (sharing.join(nodes.toDF("x", "x_c", "x_lo", "x_hi").hint("merge"), "x")
               .join(nodes.toDF("y", "y_c", "y_lo", "y_hi").hint("merge"), "y")
               .where("x_c != y_c").where((100 * F.col("x_hi") >= threshold_percent * F.col("y_lo"))
                                          & (100 * F.col("y_hi") >= threshold_percent * F.col("x_lo"))).select("x", "y"))
    either = by_bucket.union(by_item).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    done = tested.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    pairs = either.join(done.hint("merge"), ["x", "y"], "left_anti")
    sx = classes.select(F.col("id").alias("x"), F.col("minima").alias("x_minima"))
    sy = classes.select(F.col("id").alias("y"), F.col("minima").alias("y_minima"))
    equal = F.size(F.filter(F.zip_with("x_minima", "y_minima", lambda a, b: a == b), lambda e: e))
    least = (threshold_percent / 100 - SIGNATURE_MARGIN) * PERMUTATIONS
    return (pairs.join(sx.hint("merge"), "x").join(sy.hint("merge"), "y").where(equal >= F.lit(least))
            .select("x", "y"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = SHINGLE_WORDS, threshold_percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    signed = materialise(signatures(docs, id_col, text_col, words_per_shingle), "minhash-signatures")
    linkable = signed.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    # Equal sets have equal minima and bands, so any row's will do.
    leaders = linkable.groupBy("n_shingles", "print").agg(F.min("id").alias("id"))
    # A group of copies may hold a third of all rows: its members are dealt into
    # parts, each links with the part's smallest id, and these with the leader.
    dealt = linkable.select("n_shingles", "print", F.pmod(F.xxhash64("id"), F.lit(COPY_PARTS)).alias("part"), "id")
    firsts = dealt.groupBy("n_shingles", "print", "part").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    firsts = materialise(firsts, "minhash-parts")
    many = firsts.where("first != last").select("n_shingles", "print", "part", "first")
    to_first = dealt.join(many.hint("merge"), ["n_shingles", "print", "part"]).select(F.col("id").alias("x"), F.col("first").alias("y"))
    to_leader = firsts.join(leaders.hint("merge"), ["n_shingles", "print"]).select(F.col("first").alias("x"), F.col("id").alias("y"))
    to_leader = materialise(to_first.union(to_leader).where("x != y").distinct(), "minhash-copies")
    classes = (linkable.join(leaders.select("n_shingles", "print", "id").hint("merge"), ["n_shingles", "print", "id"],
                             "left_semi").dropDuplicates(["n_shingles", "print", "id"])
               .select("id", "n_shingles", "minima", "bands"))
    classes = materialise(classes, "minhash-classes")
    links = class_links(classes, docs, id_col, text_col, words_per_shingle, threshold_percent)
    found = connected_components(links.union(to_leader), "x", "y", "minhash-components")
    out = signed.select("id", "n_shingles").join(found.withColumnRenamed("node", "id").hint("merge"), "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words_per_shingle: int = SHINGLE_WORDS, threshold_percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One document of each group, with the columns it came with."""
    gone = (near_duplicates(docs, id_col, text_col, words_per_shingle, threshold_percent).where(~F.col("kept"))
            .select(F.col(id_col).alias(key := fresh_name(docs, "near_duplicate"))).distinct())
    gone = materialise(gone, "minhash-gone")
    return lookup_join(docs, gone, F.col(id_col) == F.col(key), how="left_anti")
