"""Near-duplicate vectors by NN-descent.

Links are pairs of vectors with cosine of at least a threshold.

1. Dense groups become balls.  In rounds of ever finer sign codes of random
   projections, free vectors are compared with the largest balls and some
   random vectors of their code; those within ``half the link angle`` of a
   ball's centre join it, and a random vector with ``MIN_BALL`` others around
   it founds a ball, whose centre is the mean of a sample of them.  By the
   triangle inequality all members of a ball link with one another, so a group
   of a million copies costs a million comparisons, not their square.
2. The nodes that remain, balls and single vectors, get neighbour lists: first
   from equal sign codes, then by NN-descent.  Around every
   node, its neighbours and those that list it are compared with one another
   (a neighbours-of-neighbours join), pairs that are new on either side only;
   lists keep their ``LIST`` best.  What shares a code or a hub is compared
   whole: where it is more than two blocks, every block meets every other in a
   run of their own, spread by Spark.  A list is saturated while its last entry
   may still be a link; it is enlarged until it holds ``LIST`` entries that
   cannot be links.
3. Edges become links.  Between balls the angle of the centres and the radii
   settle most pairs; what they leave open is settled vector by vector, and at
   last pair by pair, in double precision.
4. An audit compares samples of vectors with all others, in blocks: some of
   all vectors, and some that are in no ball.  While the mean recall of the
   vectors that have a link is below ``TARGET_RECALL`` in one of the groups,
   more blocks are searched.  A descent or a search that does not come to its
   end within ``MAX_ROUNDS`` or ``MAX_SEARCHES`` is an error, never a result.

Components come from alternating large-star and small-star.

Defined results: a vector that is null, empty, zero or has a null or
non-finite component has no links; vectors of different lengths do not link,
and each length is searched by itself; a null id counts as a vector (its component is that
of the smallest id, or null); rows with equal ids are vectors of their own
that share an id; vectors of any length count whole; pairs at exactly the
threshold are links, and of equal cosines (ties) all are; an empty table gives
no rows; other columns play no part, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import materialise
from farebox.llm.components import connected_components

THRESHOLD = 0.95
SEED = 11
BALL_CANDIDATES = 4  # balls, and random vectors, that a code's vectors are compared with
MIN_BALL = 32
CENTRE_SAMPLE = 32
CODE_ROWS = 256  # rows a code holds on average in the first search
TABLES = 8  # at least
MEET = 0.999  # probability that two vectors at the threshold share a code in a search
BLOCK_ROWS = 512  # rows of a block; two blocks at most are compared in one run
LIST = 6
EXPLORE = 0.5  # least cosine of the edges that the descent follows
MAX_ROUNDS = 60
AUDIT_ROWS = 512
FREE_AUDIT_ROWS = 2048  # of the vectors in no ball
FEW_LINKS = 5
AUDIT_BLOCK = 1024
MAX_SEARCHES = 20
TARGET_RECALL = 0.999
CHUNK_ROWS = 8192
MARGIN = 1e-9
BROADCAST_BYTES = 16 << 20

EDGES = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType()), T.StructField("sim", T.DoubleType())])


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a float64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _units(column: pa.Array) -> np.ndarray:
    m = _matrix(column)
    return m / np.linalg.norm(m, axis=1, keepdims=True) if len(m) else m


def _tables(bits: int, threshold: float) -> int:
    """How many codes of ``bits`` signs let a pair at the threshold share one with probability MEET."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return TABLES if same >= MEET else max(TABLES, math.ceil(math.log1p(-MEET) / math.log1p(-same)))


def _planes(dim: int, bits: int, salt: int) -> np.ndarray:
    return np.random.default_rng([SEED, salt]).standard_normal((dim, bits))


def _code_column(vec: str, dim: int, bits: int, salt: int) -> Column:
    """The signs of ``bits`` random projections as a number."""
    if bits == 0:
        return F.lit(0).cast("long")

    @F.arrow_udf(T.LongType())
    def code(vectors: pa.Array) -> pa.Array:
        signs = (_matrix(vectors) @ _planes(dim, bits, salt) > 0 if len(vectors) else np.zeros((0, bits)))
        return pa.array(signs.astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64)), pa.int64())

    return code(F.col(vec))


def _code_columns(vec: str, dim: int, bits: int, salt: int, tables: int) -> Column:
    """An array of ``tables`` such numbers."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def codes(vectors: pa.Array) -> pa.Array:
        m = _matrix(vectors)
        out = np.zeros((len(vectors), tables), dtype=np.int64)
        for t in range(tables if len(vectors) else 0):
            out[:, t] = (m @ _planes(dim, bits, salt + t) > 0).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))
        offsets = np.arange(len(vectors) + 1, dtype=np.int32) * tables
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return codes(F.col(vec))


@F.arrow_udf(T.DoubleType())
def _cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float64())
    x, y = _matrix(a), _matrix(b)
    return pa.array(np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)), pa.float64())


def _angle(cosine: Column) -> Column:
    return F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))


# ---------------------------------------------------------------- input
def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame, list[tuple[int, int]]]:
    """(all rows (uid, id), rows (uid, vec) that can link, their lengths with the number of rows)."""
    rows = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    good = F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", finite) & F.exists("vec", lambda x: x != 0)
    # Scaled by the largest component, so that squares can neither overflow nor vanish.
    most = F.array_max(F.transform("vec", F.abs))
    scaled = F.transform("vec", lambda x: x / most)
    rows = materialise(rows.select("uid", "id", F.when(good, scaled).alias("vec")), "vectors")
    usable = rows.where(F.col("vec").isNotNull()).select("uid", "vec")
    # A vector that is alone of its length has none to link with.
    lengths = usable.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("dim").collect()
    return rows.select("uid", "id"), usable, [(r["dim"], r["n"]) for r in lengths]


# ---------------------------------------------------------------- balls
def _assign(free: DataFrame, balls: DataFrame, dim: int, bits: int, salt: int, limit: float) -> DataFrame:
    """(uid, vec, owner, is_ball): the ball, else the random vector, nearest to
    each free vector among the candidates of its code and within the limit."""
    coded = free.withColumn("code", _code_column("vec", dim, bits, salt))
    coded = materialise(coded, "ball-codes")
    picks = coded.groupBy("code").agg(F.array(*[
        F.min(F.struct(F.xxhash64("uid", F.lit(salt * 16 + k)).alias("h"), F.col("uid")))["uid"]
        for k in range(BALL_CANDIDATES)]).alias("uids"))
    picks = picks.select("code", F.explode(F.array_distinct("uids")).alias("uid"))
    founders = picks.join(free.hint("merge"), "uid").select(
        "code", F.struct(F.lit(0).cast("long").alias("size"), F.col("uid").alias("owner"), F.col("vec").alias("centre")).alias("c"))
    order = Window.partitionBy("code").orderBy(F.col("size").desc(), "ball")
    largest = (balls.withColumn("code", _code_column("centre", dim, bits, salt))
               .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BALL_CANDIDATES)
               .select("code", F.struct("size", F.col("ball").alias("owner"), "centre").alias("c")))
    # At most 2 * BALL_CANDIDATES candidates a code.
    candidates = founders.union(largest).groupBy("code").agg(F.collect_list("c").alias("cs"))
    small = (1 << bits) * 2 * BALL_CANDIDATES * 8 * (dim + 4) <= BROADCAST_BYTES
    candidates = F.broadcast(candidates) if small else candidates.hint("merge")
    nearest_type = T.StructType([T.StructField("owner", T.LongType()), T.StructField("is_ball", T.BooleanType())])

    @F.arrow_udf(nearest_type)
    def nearest(vectors: pa.Array, lists: pa.Array) -> pa.Array:
        owner, is_ball = np.zeros(len(vectors), dtype=np.int64), np.zeros(len(vectors), dtype=bool)
        found = np.zeros(len(vectors), dtype=bool)
        if len(vectors):
            units = _units(vectors)
            offsets, flat = lists.offsets.to_numpy(), lists.flatten()
            shift = offsets - offsets[0]
            centres = _units(flat.field("centre"))
            owners, sizes = flat.field("owner").to_numpy(), flat.field("size").to_numpy()
            row = np.repeat(np.arange(len(vectors)), np.diff(shift))
            cosine = np.einsum("ij,ij->i", units[row], centres)
            ok = cosine >= math.cos(limit)
            # Balls first, then the nearest; ties by number.
            order = np.lexsort((owners[ok], -cosine[ok], sizes[ok] == 0, row[ok]))
            first_row, at = np.unique(row[ok][order], return_index=True)
            found[first_row] = True
            owner[first_row], is_ball[first_row] = owners[ok][order][at], sizes[ok][order][at] > 0
        return pa.StructArray.from_arrays([pa.array(owner, mask=~found), pa.array(is_ball)], names=["owner", "is_ball"])

    joined = coded.join(candidates, "code").select("uid", "vec", nearest(F.col("vec"), F.col("cs")).alias("n"))
    return joined.select("uid", "vec", "n.owner", "n.is_ball")


def _centres(founded: DataFrame) -> DataFrame:
    """(ball, centre, size) of the groups of at least MIN_BALL vectors around a founder."""
    sizes = founded.groupBy("owner").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= MIN_BALL)
    # A sample of some CENTRE_SAMPLE members whatever the group's size.
    some = founded.join(sizes.hint("merge"), "owner").where(
        F.pmod(F.xxhash64("uid"), F.greatest(F.lit(1), (F.col("size") / CENTRE_SAMPLE).cast("long"))) == 0)
    schema = T.StructType([T.StructField("ball", T.LongType()), T.StructField("centre", T.ArrayType(T.DoubleType())),
                           T.StructField("size", T.LongType())])

    def mean(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        centre = _units(table["vec"].chunk(0)).mean(axis=0)
        return pa.table({"ball": [-1 - table["owner"][0].as_py()], "centre": pa.array([centre], pa.list_(pa.float64())),
                         "size": [table["size"][0].as_py()]})

    return some.select("owner", "vec", "size").groupBy("owner").applyInArrow(mean, schema)


def _balls(vectors: DataFrame, n: int, dim: int, half: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(balls (ball, centre, size), members (ball, uid, vec), free (uid, vec))."""
    spark = vectors.sparkSession
    balls = spark.createDataFrame([], "ball long, centre array<double>, size long")
    members = spark.createDataFrame([], "ball long, uid long, vec array<double>")
    free = vectors
    if n >= 2 * MIN_BALL:
        finest = max(0, math.ceil(math.log2(n / (2 * MIN_BALL))))
        for salt, bits in enumerate([*range(0, finest + 1, 2), finest]):
            near = materialise(_assign(free, balls, dim, bits, 100 + salt, half), "ball-near")
            joined = near.where("owner IS NOT NULL AND is_ball").select(F.col("owner").alias("ball"), "uid", "vec")
            new = materialise(_centres(near.where("owner IS NOT NULL AND NOT is_ball")), "ball-centres")
            members, balls = members.union(joined), balls.union(new)
            free = near.where("owner IS NULL OR NOT is_ball").select("uid", "vec")
    return balls, members, free


# ---------------------------------------------------------------- neighbour lists
def _in_chunks(rows: DataFrame, keys: list[str], n_rows: int, fn, schema: T.StructType) -> DataFrame:
    """``fn`` on each run of equal keys; some CHUNK_ROWS rows of many keys are
    worked on at a time.  A key's rows are bounded by the caller."""
    chunks = max(1, n_rows // CHUNK_ROWS)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([(k, "ascending") for k in [*keys, "node"]])
        parts = []
        if table.num_rows:
            change = np.zeros(table.num_rows, dtype=bool)
            change[0] = True
            for k in keys:
                values = table[k].to_numpy()
                change[1:] |= values[1:] != values[:-1]
            cuts = [*np.flatnonzero(change).tolist(), table.num_rows]
            units = _units(table["vec"].combine_chunks())
            node = table["node"].to_numpy()
            fresh = table["fresh"].to_numpy(zero_copy_only=False)
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    parts.append(fn(node[a:b], units[a:b], fresh[a:b]))
        u, v, sim = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 2 + (np.empty(0),)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "sim": pa.array(sim, pa.float64())})

    return rows.groupBy(F.pmod(F.xxhash64(*keys), F.lit(chunks)).alias("chunk")).applyInArrow(run, schema)


def _compare(floor: float):
    """Edges among the nodes of a run: each node's best, and all of ``floor`` or more."""

    def edges(node: np.ndarray, units: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sims = units @ units.T
        sims[node[:, None] == node[None, :]] = -2.0
        sims[~(fresh[:, None] | fresh[None, :])] = -2.0
        keep = sims >= floor
        best = min(LIST, len(node) - 1)
        top = np.argpartition(-sims, best - 1, axis=1)[:, :best]
        keep[np.arange(len(node))[:, None], top] = True
        keep &= sims > -2.0
        a, b = np.nonzero(keep)
        return node[a], node[b], sims[a, b]

    return edges


def _block_pairs(rows: DataFrame, keys: list[str], n: str, salt: int) -> DataFrame:
    """``rows`` once for each pair of blocks (a, b) of their key that they are
    in, so that any two rows of a key meet; ``n`` is the number of its rows."""
    blocks = F.ceil(F.col(n) / BLOCK_ROWS)
    dealt = rows.withColumn("blocks", blocks).withColumn("at", F.pmod(F.xxhash64(*keys, "node", F.lit(salt)), F.col("blocks")))
    others = F.when(F.col("blocks") > 2, F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                                                  lambda b: b != F.col("at"))).otherwise(F.array(F.lit(-1).cast("long")))
    met = dealt.withColumn("other", F.explode(others))
    # One or two blocks are one run.
    whole = F.col("other") < 0
    return (met.withColumn("a", F.when(whole, 0).otherwise(F.least("at", "other")))
            .withColumn("b", F.when(whole, 0).otherwise(F.greatest("at", "other"))))


def _pair_rows(sizes: DataFrame) -> int:
    """How many rows _block_pairs makes of keys of ``n`` rows each."""
    return sizes.agg(F.sum(F.col("n") * F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / BLOCK_ROWS) - 1))).first()[0] or 0


def _block_search(nodes: DataFrame, n: int, dim: int, salt: int, floor: float, threshold: float) -> DataFrame:
    """Edges between nodes that share a sign code."""
    bits = max(1, math.ceil(math.log2(max(2, n / CODE_ROWS))))
    tables = _tables(bits, threshold)
    codes = _code_columns("vec", dim, bits, 1_000_000 * salt, tables)
    coded = nodes.select("node", F.posexplode(codes).alias("table", "code"))
    coded = materialise(coded, "nn-codes")
    sizes = coded.groupBy("table", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = ["table", "code"]
    rows = (_block_pairs(coded.join(sizes.hint("merge"), keys), keys, "n", salt)
            .join(nodes.select("node", "vec").hint("merge"), "node").withColumn("fresh", F.lit(True)))
    return _in_chunks(rows.select(*keys, "a", "b", "node", "vec", "fresh"), [*keys, "a", "b"], _pair_rows(sizes), _compare(floor), EDGES)


def _lists(edges: DataFrame, floor: float) -> DataFrame:
    """The lists (u, v, sim, fresh): LIST entries that cannot be links, and all that may."""
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("u", F.col("sim") >= floor).orderBy(F.col("sim").desc(), "v")
    return (once.withColumn("rank", F.when(F.col("sim") < floor, F.row_number().over(order)).otherwise(0))
            .where(F.col("rank") <= LIST).select("u", "v", "sim", "fresh"))


def _local_join(lists: DataFrame, nodes: DataFrame, salt: int, floor: float) -> DataFrame:
    """Edges between nodes that have a neighbour in common, one of them new to it."""
    followed = lists.where(F.col("sim") >= EXPLORE)
    around = (followed.select(F.col("u").alias("hub"), F.col("v").alias("node"), "fresh")
              .union(followed.select(F.col("v").alias("hub"), F.col("u").alias("node"), "fresh"))
              .groupBy("hub", "node").agg(F.max("fresh").alias("fresh")))
    around = materialise(around, "nn-around")
    sizes = around.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.max("fresh").alias("any")).where("n > 1 AND any")
    # All neighbours of a hub meet, so that none of its pairs is left when they are no longer new.
    rows = (_block_pairs(around.join(sizes.hint("merge"), "hub"), ["hub"], "n", salt)
            .join(nodes.select("node", "vec").hint("merge"), "node"))
    return _in_chunks(rows.select("hub", "a", "b", "node", "vec", "fresh"), ["hub", "a", "b"], _pair_rows(sizes), _compare(floor), EDGES)


def _descend(edges: DataFrame, nodes: DataFrame, salt: int, floor: float) -> DataFrame:
    """Lists refined until a round finds no edge that may be a link."""
    lists = materialise(_lists(edges, floor), "nn-lists")
    for step in range(MAX_ROUNDS):
        if lists.where("fresh").isEmpty():
            return lists
        found = _local_join(lists, nodes, salt * 100 + step, floor).withColumn("fresh", F.lit(True))
        lists = materialise(_lists(lists.withColumn("fresh", F.lit(False)).union(found), floor), "nn-lists")
        if lists.where(F.col("fresh") & (F.col("sim") >= floor)).isEmpty():
            return lists
    raise RuntimeError(f"neighbour lists still found possible links after {MAX_ROUNDS} rounds")


# ---------------------------------------------------------------- links
def _links(lists: DataFrame, nodes: DataFrame, members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links between nodes (u, v), gains of nodes (node, gain), gains of members (uid, gain))."""
    alpha = math.acos(threshold)
    narrow = nodes.select("node", "radius", "size")
    pairs = (lists.select("u", "v", "sim")
             .join(narrow.toDF("u", "u_r", "u_n").hint("merge"), "u").join(narrow.toDF("v", "v_r", "v_n").hint("merge"), "v"))
    reach = F.col("u_r") + F.col("v_r")
    single = (F.col("u") >= 0) & (F.col("v") >= 0)
    angle = _angle(F.col("sim"))
    kind = (F.when(single, F.when(F.col("sim") >= threshold, "all").otherwise("none"))
            .when(angle + reach <= alpha - MARGIN, "all").when(angle - reach > alpha + MARGIN, "none").otherwise("open"))
    pairs = materialise(pairs.select("u", "v", "u_r", "v_r", "v_n", kind.alias("kind")).where("kind != 'none'"), "nn-pairs")
    sure = pairs.where("kind = 'all'")
    open_ = pairs.where("kind = 'open'").select("u", "v", "v_r", "v_n")
    # Every vector of u against the centre of v.
    inside = members.select(F.col("ball").alias("u"), F.col("uid").alias("x"), F.col("vec").alias("x_vec")).union(
        nodes.where("node >= 0").select(F.col("node").alias("u"), F.col("node").alias("x"), F.col("vec").alias("x_vec")))
    centre = nodes.select(F.col("node").alias("v"), F.col("vec").alias("v_vec"))
    met = (open_.join(inside.hint("merge"), "u").join(centre.hint("merge"), "v")
           .withColumn("sim", _cosine(F.col("x_vec"), F.col("v_vec"))))
    far = _angle(F.col("sim"))
    kind = (F.when(F.col("v") >= 0, F.when(F.col("sim") >= threshold, "all").otherwise("none"))
            .when(far + F.col("v_r") <= alpha - MARGIN, "all").when(far - F.col("v_r") > alpha + MARGIN, "none").otherwise("open"))
    met = materialise(met.select("u", "v", "x", "x_vec", "v_n", kind.alias("kind")).where("kind != 'none'"), "nn-members")
    # What is left, pair by pair.
    other = members.select(F.col("ball").alias("v"), F.col("vec").alias("y_vec"))
    close = (met.where("kind = 'open'").select("u", "v", "x", "x_vec").join(other.hint("merge"), "v")
             .where(_cosine(F.col("x_vec"), F.col("y_vec")) >= threshold)
             .groupBy("u", "v", "x").agg(F.count(F.lit(1)).alias("gain")))
    by_member = materialise(met.where("kind = 'all'").select("u", "v", "x", F.col("v_n").alias("gain")).union(close), "nn-gains")
    links = sure.select("u", "v").union(by_member.select("u", "v")).distinct()
    return (materialise(links, "nn-links"), sure.groupBy(F.col("u").alias("node")).agg(F.sum("v_n").alias("gain")),
            by_member.groupBy(F.col("x").alias("uid")).agg(F.sum("gain").alias("gain")))


def audit(vectors: DataFrame, counts: DataFrame, threshold: float) -> float:
    """Recall of ``counts`` (uid, n_links, node where known): the mean over
    sample vectors with links of the share that it has of a vector's links.

    It is the least of three such means: over AUDIT_ROWS of all vectors, and
    over those of FREE_AUDIT_ROWS vectors in no ball that have, in truth, at
    most FEW_LINKS links, and that have more.  The samples are compared with
    every vector, in blocks.
    """
    by_hash = (F.xxhash64("uid"), "uid")
    free = counts.where("node >= 0") if "node" in counts.columns else counts
    alone = vectors.join(free.select("uid").hint("merge"), "uid", "left_semi")
    samples = [vectors.select("uid", "vec").orderBy(*by_hash).limit(AUDIT_ROWS).toArrow(),
               alone.select("uid", "vec").orderBy(*by_hash).limit(FREE_AUDIT_ROWS).toArrow()]
    sample = pa.concat_tables(samples).combine_chunks()
    if not sample.num_rows:
        return 1.0
    uids, queries = sample["uid"].to_numpy(), _units(sample["vec"].combine_chunks())
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(uids), dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, AUDIT_BLOCK):
                part = batch.slice(start, AUDIT_BLOCK)
                # A pair that rounding may put on either side of the threshold is not asked for.
                near = _units(part.column(1)) @ queries.T >= threshold + MARGIN
                near &= part.column(0).to_numpy()[:, None] != uids[None, :]
                total += near.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(uids)), pa.int64()), pa.array(total, pa.int64())], names=["k", "n"])

    true = np.zeros(len(uids), dtype=np.int64)
    for row in vectors.select("uid", "vec").mapInArrow(block, schema).groupBy("k").agg(F.sum("n").alias("n")).collect():
        true[row["k"]] = row["n"]
    wanted = vectors.sparkSession.createDataFrame([(int(u),) for u in set(uids.tolist())], "uid long")
    has = {r["uid"]: r["n_links"] for r in counts.join(F.broadcast(wanted), "uid").select("uid", "n_links").collect()}
    found = np.array([has.get(u) or 0 for u in uids.tolist()])
    share = np.minimum(found, true) / np.maximum(true, 1)
    is_free = np.arange(len(uids)) >= samples[0].num_rows
    groups = [~is_free & (true > 0), is_free & (true > 0) & (true <= FEW_LINKS), is_free & (true > FEW_LINKS)]
    return min((float(share[g].mean()) for g in groups if g.any()), default=1.0)


def _search(usable: DataFrame, n: int, dim: int, threshold: float) -> DataFrame:
    """(uid, n_links, component) of vectors of one length."""
    alpha = math.acos(threshold)
    balls, members, free = _balls(usable, n, dim, alpha / 2 - 1e-6)
    radius = (members.join(balls.select("ball", "centre").hint("merge"), "ball")
              .withColumn("angle", _angle(_cosine(F.col("vec"), F.col("centre")))).groupBy("ball")
              .agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("size")))
    nodes = (balls.select("ball", "centre").join(radius.hint("merge"), "ball")
             .select(F.col("ball").alias("node"), F.col("centre").alias("vec"), "radius", "size")
             .union(free.select(F.col("uid").alias("node"), "vec", F.lit(0.0).alias("radius"), F.lit(1).cast("long").alias("size"))))
    nodes = materialise(nodes, "nn-nodes")
    n_nodes, widest = nodes.agg(F.count(F.lit(1)), F.max("radius")).first()
    floor = math.cos(min(math.pi, alpha + 2 * (widest or 0.0) + 2 * MARGIN))
    home = members.select("uid", F.col("ball").alias("node")).union(free.select("uid", F.col("uid").alias("node")))
    home = materialise(home.join(nodes.select("node", "size").hint("merge"), "node"), "nn-home")
    lists = None
    for attempt in range(MAX_SEARCHES):
        edges = _block_search(nodes, n_nodes, dim, attempt + 1, floor, threshold).withColumn("fresh", F.lit(True))
        if lists is not None:
            edges = edges.union(lists.withColumn("fresh", F.lit(False)))
        lists = _descend(edges, nodes, attempt + 1, floor)
        links, node_gain, member_gain = _links(lists, nodes, members, threshold)
        counts = (home.join(node_gain.withColumnRenamed("gain", "more").hint("merge"), "node", "left")
                  .join(member_gain.hint("merge"), "uid", "left")
                  .select("uid", "node", (F.col("size") - 1 + F.coalesce("more", F.lit(0)) + F.coalesce("gain", F.lit(0)))
                          .cast("long").alias("n_links")))
        counts = materialise(counts, "nn-counts")
        recall = audit(usable, counts, threshold)
        if recall >= TARGET_RECALL:
            break
    else:
        raise RuntimeError(f"recall is {recall:.4f} after {MAX_SEARCHES} searches, below {TARGET_RECALL}")
    found = connected_components(links, "u", "v", "nn-components")
    return counts.join(found.hint("merge"), "node", "left").select(
        "uid", "n_links", F.coalesce("component", "node").alias("component"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    rows, usable, lengths = valid_vectors(vectors, id_col, vec_col)
    placed = vectors.sparkSession.createDataFrame([], "uid long, n_links long, component long")
    for dim, n in lengths:
        same = materialise(usable.where(F.size("vec") == dim), "vectors-usable")
        placed = placed.union(_search(same, n, dim, threshold))
    # A vector that links with nothing is a component of its own.
    placed = rows.join(placed.hint("merge"), "uid", "left")
    placed = placed.withColumn("component", F.when(F.coalesce("n_links", F.lit(0)) > 0, F.col("component")))
    placed = materialise(placed.select("uid", "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component"),
                         "nn-placed")
    names = placed.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("id").alias("component_id"))
    # Vectors without links stay out of the join, where their nulls would meet in one task.
    linked = placed.where(F.col("component").isNotNull()).join(names.hint("merge"), "component")
    alone = placed.where(F.col("component").isNull())
    out = linked.select("id", "n_links", "component_id").union(alone.select("id", "n_links", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
