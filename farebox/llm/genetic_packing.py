"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A document is its token ids and a closing id; only one longer than a sequence
is cut, into full pieces and a last shorter one.  Full pieces are sequences of
their own.  The others are dealt by hash into blocks of some ``BLOCK_ITEMS``.
Each block is evolved on ``ISLANDS`` islands, one row of a DataFrame each, so
all islands of all blocks run in parallel:

* an individual is a grouping of the block's items into bins; its fitness is
  the mean of the squared fills, which prefers few, full bins;
* crossover injects whole well-filled bins of one parent into the other, drops
  the bins that hold duplicates of the injected items, and best-fits the
  displaced items, longest first; mutation dissolves the emptiest bins and
  some others and best-fits their items;
* after each epoch every island's elite migrates to the next island of its
  block (a shuffle of one row per island).

After a round the bins that are full to ``FULL_SHARE`` are final; the items of
the others are dealt into new blocks, where they meet items of other blocks.
The last round keeps all its bins.

Defined results: a null or empty text is one closing id; texts of any length
are packed whole; rows with equal or null ids are documents of their own; equal
lengths (ties) are placed in the order of their numbers; an empty table gives
no rows; other columns play no part, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import bounded, materialise
from farebox.llm.pair_index_bpe import encoder_of
from farebox.llm.segment_encoding import encode_column

CAPACITY = 2048
CLOSING_ID = 0
BLOCK_ITEMS = 3000
ISLANDS = 3
POPULATION = 6
EPOCHS = 2
OFFSPRING = 12  # per island and epoch
ROUNDS = 3
FULL_SHARE = 0.998
SEED = 7

PIECE_TYPE = T.ArrayType(T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                                       T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]))
ISLAND_SCHEMA = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("island", T.IntegerType()), T.StructField("fitness", T.DoubleType()),
    T.StructField("items", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("groups", T.ArrayType(T.ArrayType(T.IntegerType())))])


# ---------------------------------------------------------------- pieces
def pieces_column(text, path: str, capacity: int):
    """The pieces of each document: number, start, length, CRC-32 of the ids."""

    @F.arrow_udf(PIECE_TYPE)
    def pieces(texts: pa.Array) -> pa.Array:
        begin, number, starts, lengths, prints = [0], [], [], [], []
        for ids in encode_column(texts, encoder_of(path).encode_segments):
            ids = np.append(ids, np.uint32(CLOSING_ID)).astype("<u4")
            for k, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start : start + capacity]
                number.append(k)
                starts.append(start)
                lengths.append(len(part))
                prints.append(zlib.crc32(part.tobytes()))
            begin.append(len(number))
        rows = pa.StructArray.from_arrays(
            [pa.array(number, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
             pa.array(prints, pa.int64())], names=["piece", "start", "length", "ids_crc32"])
        return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), rows)

    return pieces(text)


# ---------------------------------------------------------------- one block
def best_fit(lengths: np.ndarray, order: np.ndarray, group: np.ndarray, room: list[int], capacity: int) -> None:
    """Put the items of ``order`` where they leave the least room, or into new
    bins; ``group`` and ``room`` (free tokens of each bin) are updated."""
    free = sorted((r, b) for b, r in enumerate(room) if r > 0)
    for item in order.tolist():
        size = int(lengths[item])
        at = bisect_left(free, (size, -1))
        if at < len(free):
            left, bin_ = free.pop(at)
            left -= size
        else:
            bin_, left = len(room), capacity - size
            room.append(left)
        room[bin_] = left
        group[item] = bin_
        if left:
            insort(free, (left, bin_))


def compact(group: np.ndarray) -> np.ndarray:
    """Bins renumbered from 0 without gaps."""
    return np.unique(group, return_inverse=True)[1].astype(np.int32)


def fitness(lengths: np.ndarray, group: np.ndarray, capacity: int) -> float:
    fill = np.bincount(group, weights=lengths) / capacity
    return float(np.mean(fill**2))


def refit(lengths: np.ndarray, group: np.ndarray, displaced: np.ndarray, capacity: int) -> np.ndarray:
    """``group`` with the displaced items best-fitted anew, longest first."""
    out = np.full(len(group), -1, dtype=np.int64)
    out[~displaced] = compact(group[~displaced])
    n_bins = int(out.max()) + 1 if len(out) else 0
    fill = np.bincount(out[~displaced], weights=lengths[~displaced], minlength=n_bins).astype(np.int64)
    loose = np.flatnonzero(displaced)
    order = loose[np.argsort(-lengths[loose], kind="stable")]
    best_fit(lengths, order, out, (capacity - fill).tolist(), capacity)
    return compact(out)


def crossover(rng, lengths: np.ndarray, a: np.ndarray, b: np.ndarray, capacity: int) -> np.ndarray:
    """Inject well-filled bins of ``b`` into ``a``."""
    fill = np.bincount(b, weights=lengths)
    filled = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = rng.choice(filled, size=max(1, len(filled) // 3), replace=False)
    injected = np.isin(b, chosen)
    broken = np.isin(a, np.unique(a[injected]))
    child = np.where(injected, b.astype(np.int64) + int(a.max()) + 1, a)
    return refit(lengths, child, broken & ~injected, capacity)


def mutate(rng, lengths: np.ndarray, group: np.ndarray, capacity: int) -> np.ndarray:
    """Dissolve the emptiest bins and some random ones."""
    fill = np.bincount(group, weights=lengths)
    n = max(2, len(fill) // 50)
    gone = np.union1d(np.argsort(fill, kind="stable")[:n], rng.integers(0, len(fill), size=n))
    return refit(lengths, group, np.isin(group, gone), capacity)


def first_population(rng, lengths: np.ndarray, capacity: int, size: int) -> list[np.ndarray]:
    """Best-fit decreasing, and best-fit over disturbed orders."""
    out = []
    for k in range(size):
        key = lengths * (1 + (0.15 * rng.standard_normal(len(lengths)) if k else 0))
        group = np.zeros(len(lengths), dtype=np.int64)
        best_fit(lengths, np.argsort(-key, kind="stable"), group, [], capacity)
        out.append(compact(group))
    return out


def evolve(seed: int, lengths: np.ndarray, population: list[np.ndarray], capacity: int, offspring: int) -> list[np.ndarray]:
    """The population after some offspring, fittest first."""
    rng = np.random.default_rng(seed)
    population = population or first_population(rng, lengths, capacity, POPULATION)
    scored = sorted(((fitness(lengths, g, capacity), k, g) for k, g in enumerate(population)), key=lambda x: (-x[0], x[1]))
    count = len(scored)
    for _ in range(offspring):
        a, b = sorted(rng.integers(0, len(scored), size=4).tolist())[:2]  # the fitter of some draws
        child = crossover(rng, lengths, scored[a][2], scored[b][2], capacity)
        if rng.random() < 0.5:
            child = mutate(rng, lengths, child, capacity)
        score = fitness(lengths, child, capacity)
        count += 1
        if score > scored[-1][0]:
            scored[-1] = (score, count, child)
            scored.sort(key=lambda x: (-x[0], x[1]))
    return [g for _, _, g in scored]


# ---------------------------------------------------------------- islands
def _epoch(islands: DataFrame, epoch: int, capacity: int, offspring: int) -> DataFrame:
    """Evolve every island for one epoch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ISLAND_SCHEMA.names
        kinds = [pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int32()))]
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                lengths = np.array(r["lengths"], dtype=np.int64)
                seed = zlib.crc32(f"{SEED} {r['block']} {r['island']} {epoch}".encode())
                groups = evolve(seed, lengths, [np.array(g, dtype=np.int64) for g in r["groups"]], capacity, offspring)
                row = (r["block"], r["island"], fitness(lengths, groups[0], capacity), r["items"], r["lengths"],
                       [g.astype(np.int32) for g in groups[: POPULATION - 1]])
                yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row, kinds)], names=names)

    return islands.mapInArrow(run, ISLAND_SCHEMA)


def _migrated(islands: DataFrame, n_islands: int) -> DataFrame:
    """Every island's elite joins the population of the next island of its block."""
    elite = islands.select("block", ((F.col("island") + 1) % n_islands).cast("int").alias("island"),
                           F.element_at("groups", 1).alias("elite"))
    joined = islands.join(elite.hint("merge"), ["block", "island"])
    return joined.withColumn("groups", F.concat("groups", F.array("elite"))).select(ISLAND_SCHEMA.names)


def _evolved(items: DataFrame, n_items: int, salt: int, capacity: int, block_items: int, n_islands: int, epochs: int,
             offspring: int) -> DataFrame:
    """(item, length, bin) after the blocks have evolved; bin is the smallest
    item of the bin, so numbers are distinct over all blocks."""
    n_blocks = max(1, round(n_items / block_items))
    dealt = items.select("item", "length", F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(n_blocks)).alias("block"))
    # A block is some block_items rows whatever the data: rows are dealt by a hash of their number.
    blocks = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("rows"))
    islands = blocks.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_islands - 1))).alias("island"), F.lit(0.0).alias("fitness"),
        F.col("rows.item").alias("items"), F.col("rows.length").alias("lengths"),
        F.array().cast("array<array<int>>").alias("groups"))
    for epoch in range(epochs):
        spread = islands.repartition(F.col("block"), F.col("island"))
        islands = materialise(_epoch(spread, salt * 100 + epoch, capacity, offspring), "packing-islands")
        if epoch + 1 < epochs and n_islands > 1:
            islands = _migrated(islands, n_islands)
    best = islands.groupBy("block").agg(F.max(F.struct("fitness", (-F.col("island")).alias("neg"))).alias("best"))
    winners = islands.join(best.select("block", (-F.col("best.neg")).alias("island")).hint("merge"), ["block", "island"])
    rows = winners.select("block", F.explode(F.arrays_zip(
        "items", "lengths", F.element_at("groups", 1).alias("groups"))).alias("r")).select(
        "block", F.col("r.items").alias("item"), F.col("r.lengths").alias("length"), F.col("r.groups").alias("group"))
    bins = rows.groupBy("block", "group").agg(F.min("item").alias("bin"), F.sum("length").alias("fill"))
    return rows.join(bins.hint("merge"), ["block", "group"]).select("item", "length", "bin", "fill")


def pack_items(items: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS, n_islands: int = ISLANDS,
               epochs: int = EPOCHS, offspring: int = OFFSPRING, rounds: int = ROUNDS) -> DataFrame:
    """(item, bin) for (item, length) rows with distinct items and lengths of
    1 to ``capacity``."""
    done = None
    rest = items
    for salt in range(rounds):
        n_items = rest.count()
        last = salt + 1 == rounds or n_items <= block_items
        binned = materialise(_evolved(rest, n_items, salt, capacity, block_items, n_islands, epochs, offspring), "packing-bins")
        final = binned if last else binned.where(F.col("fill") >= FULL_SHARE * capacity)
        done = final.select("item", "bin") if done is None else done.union(final.select("item", "bin"))
        if last:
            break
        rest = binned.where(F.col("fill") < FULL_SHARE * capacity).select("item", "length")
    return done


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   **sizes: int) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = bounded(docs).select(F.col(id_col).alias("doc"), pieces_column(F.col(text_col), path, capacity).alias("pieces"))
    # explode() would filter on the array first and so tokenize twice; there is always a piece.
    pieces = rows.select("doc", F.explode_outer("pieces").alias("p")).select("doc", "p.*")
    pieces = materialise(pieces.withColumn("item", F.monotonically_increasing_id()), "packing-pieces")
    full = F.col("length") == capacity
    bins = pack_items(pieces.where(~full).select("item", "length"), capacity, **sizes)
    placed = (pieces.where(~full).join(bins.hint("merge"), "item")
              .withColumn("offset", F.coalesce(F.sum("length").over(
                  Window.partitionBy("bin").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    alone = pieces.where(full).withColumn("bin", F.col("item")).withColumn("offset", F.lit(0).cast("long"))
    columns = [F.col("doc").alias(id_col), "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset"]
    return alone.select(columns).union(placed.select(columns))
