"""Ranked lexical search by range-maximum queries over posting lists.

Documents are dealt by a hash into shards of about ``SHARD_POSTINGS`` postings
and take, within a shard, places by ascending id.  The index has one posting
list a shard and term: places and frequencies.  To search, a sparse table is
laid over the impacts of each posting list, which answers where the largest
impact of a range of places lies in two look-ups.  For an item, the sum of
these maxima over its terms bounds every score within an interval of places.
The search is best-first: the intervals of the highest bounds are split at the
document that holds the largest single maximum, that document is scored in
full, and both sides are bounded anew; intervals whose bound cannot reach the
best ``k`` scores found are never opened.  The best of all shards are merged.

A term is a run of characters other than the ASCII ones that are no letters or
digits, with A-Z lower-cased.  With N documents that hold a term, L terms in
all, n in the document and df documents holding a term: its weight is
floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is 25 + 75 n N div L,
and a term's impact is its weight times (10^9 tf div (1000 tf + 8 m)).

Defined results: null and empty texts hold no term, are never found and find
nothing; only scores above 0 are returned, fewer than ``k`` if there are no
more; equal scores rank by ascending id, null ids last; repeated documents are
ranked one by one; a repeated item gets its ranking once for each of its rows,
null ids included; texts of any length are read whole; an empty table on
either side gives no rows; other columns play no part, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import ROWS_AT_ONCE, bounded, materialise, utf8_values

# About so many postings make a shard, and so many bytes of items are searched
# for at a time: what one task holds.
SHARD_POSTINGS = 500_000
SHARDS_PER_TASK = 2
ITEM_BLOCK_BYTES = 4 << 20
# Intervals split at a time; terms times places up to which ranks are a table.
BATCH = 256
RANK_CELLS = 1 << 22

_LETTERS = bytes(c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256)).lower()
FORWARD_SCHEMA = "doc_id long, slot long, n long, terms array<binary>, tfs array<int>"
INDEX_SCHEMA = "shard long, term binary, df long, places array<int>, tfs array<int>, ids array<long>, lengths array<long>"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document with a term: its terms and how often each occurs."""
    slot = 0
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(start, ROWS_AT_ONCE)
            counts = [Counter(terms_of(t or b"")) for t in utf8_values(batch.column("text"))]
            used = [i for i, c in enumerate(counts) if c]
            offsets = pa.array(np.cumsum([0] + [len(counts[i]) for i in used]), pa.int32())
            terms = pa.array([t for i in used for t in counts[i]], pa.binary())
            tfs = pa.array([f for i in used for f in counts[i].values()], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(used, pa.int64())),
                 pa.array([slot + i for i in used], pa.int64()),
                 pa.array([counts[i].total() for i in used], pa.int64()),
                 pa.ListArray.from_arrays(offsets, terms), pa.ListArray.from_arrays(offsets, tfs)],
                names=["doc_id", "slot", "n", "terms", "tfs"])
            slot += batch.num_rows


def _invert(table: pa.Table) -> pa.Table:
    """The posting lists of one shard, and a row without a term that holds its ids and lengths by place."""
    table = table.take(pc.sort_indices(table, [("doc_id", "ascending")], null_placement="at_end"))
    lists, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks().flatten().to_numpy()
    places = np.repeat(np.arange(table.num_rows, dtype=np.int32), pc.list_value_length(lists).to_numpy())
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    counts = np.bincount(codes, minlength=len(encoded.dictionary))
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
    postings = pa.table({
        "shard": pa.repeat(table.column("shard")[0], len(counts)), "term": encoded.dictionary, "df": pa.array(counts, pa.int64()),
        "places": pa.ListArray.from_arrays(offsets, pa.array(places[order])),
        "tfs": pa.ListArray.from_arrays(offsets, pa.array(tfs[order])),
        "ids": pa.nulls(len(counts), pa.list_(pa.int64())), "lengths": pa.nulls(len(counts), pa.list_(pa.int64()))})
    whole = pa.array([0, table.num_rows], pa.int32())
    documents = pa.table({
        "shard": table.column("shard").slice(0, 1), "term": pa.nulls(1, pa.binary()), "df": pa.nulls(1, pa.int64()),
        "places": pa.nulls(1, pa.list_(pa.int32())), "tfs": pa.nulls(1, pa.list_(pa.int32())),
        "ids": pa.ListArray.from_arrays(whole, table.column("doc_id").combine_chunks()),
        "lengths": pa.ListArray.from_arrays(whole, table.column("n").combine_chunks())})
    return pa.concat_tables([postings, documents.cast(postings.schema)])


@dataclass
class Index:
    """Posting lists as a table (``INDEX_SCHEMA``), the two counts that scores need, and the number of shards."""

    lists: DataFrame
    n_documents: int
    n_terms: int
    shards: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_postings: int = SHARD_POSTINGS) -> Index:
    """Index every document of ``docs``."""
    plain = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    forward = materialise(plain.mapInArrow(_count_terms, FORWARD_SCHEMA), "terms")
    n_documents, n_terms, postings = forward.agg(
        F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    shards = max(1, math.ceil(postings / shard_postings))
    # The slot, a row's number in its task, spreads rows that repeat an id.
    dealt = forward.withColumn("shard", F.pmod(F.xxhash64("doc_id", "slot"), F.lit(shards)))
    dealt = dealt.repartition(math.ceil(shards / SHARDS_PER_TASK), "shard")
    lists = materialise(dealt.groupBy("shard").applyInArrow(_invert, INDEX_SCHEMA), "postings")
    return Index(lists, n_documents, n_terms, shards)


class PostingTables:
    """The posting lists of one shard, one after the other, under one sparse table."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], n_places: int):
        """``lists``: (places ascending, impacts before the weight) of each term."""
        self.n_places = n_places
        sizes = np.array([len(p) for p, _ in lists], dtype=np.int64)
        by_size = np.argsort(-sizes, kind="stable")  # a level covers the longer lists only
        self.start = np.zeros(len(lists), dtype=np.int64)
        self.start[by_size] = np.cumsum(sizes[by_size]) - sizes[by_size]
        self.size = sizes
        self.places = np.concatenate([lists[i][0] for i in by_size]).astype(np.int64)
        self.impacts = np.concatenate([lists[i][1] for i in by_size])
        self.number = np.zeros(len(lists), dtype=np.int64)
        self.number[by_size] = np.arange(len(lists))
        self.keys = np.repeat(np.arange(len(lists)), sizes[by_size]) * (n_places + 1) + self.places
        # levels[j][i]: which of the 2^j postings from i on has the largest impact, the first of equals.
        levels = [np.arange(len(self.places), dtype=np.int32)]
        while 2 << (len(levels) - 1) <= sizes.max(initial=0):
            half = 1 << (len(levels) - 1)
            covered = int(sizes[sizes >= 2 * half].sum())
            left = levels[-1][:covered]
            right = levels[-1][np.minimum(np.arange(covered) + half, len(levels[-1]) - 1)]
            levels.append(np.where(self.impacts[left] >= self.impacts[right], left, right))
        self.level_start = np.cumsum([0] + [len(level) for level in levels])[:-1]
        self.table = np.concatenate(levels)
        self.log2 = np.zeros(int(sizes.max(initial=1)) + 1, dtype=np.int64)
        for i in range(2, len(self.log2)):
            self.log2[i] = self.log2[i // 2] + 1

    def ranks(self, terms: np.ndarray):
        """A function of places that gives, for each of ``terms``, its first posting at or after each place."""
        start = self.start[terms][:, None]
        if len(terms) * (self.n_places + 1) <= RANK_CELLS:
            before = np.zeros((len(terms), self.n_places + 1), dtype=np.int32)
            for row, term in enumerate(terms):
                before[row, self.places[self.start[term] : self.start[term] + self.size[term]] + 1] = 1
            before = np.cumsum(before, axis=1, dtype=np.int32) + start
            return lambda places: before[:, places]
        base = (self.number[terms] * (self.n_places + 1))[:, None]
        return lambda places: np.searchsorted(self.keys, base + places)

    def maxima(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per range of postings: which has the largest impact, and that impact (0 for an empty range)."""
        some = end > first
        level = self.log2[np.where(some, end - first, 1)]
        left = self.table[np.where(some, self.level_start[level] + first, 0)]
        right = self.table[np.where(some, self.level_start[level] + end - (1 << level), 0)]
        best = np.where(self.impacts[left] >= self.impacts[right], left, right)
        return best, np.where(some, self.impacts[best], 0)

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the ``k`` best documents, best first, equal scores by place."""
        rank, weights = self.ranks(terms), weights[:, None]
        last = len(self.places) - 1

        def bounded_by(lo, hi):
            best, value = self.maxima(rank(lo), rank(hi))
            value = value * weights
            widest = value.argmax(axis=0)
            split = self.places[best[widest, np.arange(len(lo))]]
            found = np.stack([lo, hi, value.sum(axis=0), split])
            return found[:, found[2] > 0]

        pool = bounded_by(np.array([0]), np.array([self.n_places]))
        places, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        batch = max(1, min(BATCH, RANK_CELLS // len(terms)))
        while pool.shape[1]:
            if pool.shape[1] > batch:
                order = np.argpartition(-pool[2], batch)
                opened, pool = pool[:, order[:batch]], pool[:, order[batch:]]
            else:
                opened, pool = pool, pool[:, :0]
            lo, hi, _, split = opened
            at = rank(split)
            impact = np.where(rank(split + 1) > at, self.impacts[np.minimum(at, last)], 0)
            places, scores = np.concatenate([places, split]), np.concatenate([scores, (impact * weights).sum(axis=0)])
            order = np.lexsort((places, -scores))[:k]
            places, scores = places[order], scores[order]
            pool = np.concatenate([pool, bounded_by(np.concatenate([lo, split + 1]), np.concatenate([split, hi]))], axis=1)
            if len(scores) == k:
                least, place = scores[-1], places[-1]
                pool = pool[:, (pool[2] > least) | ((pool[2] == least) & (pool[0] < place))]
        return places, scores


def _searcher(items: list[tuple[str, Counter]], weight: dict[bytes, int], n_documents: int, n_terms: int, k: int):
    def search_shard(table: pa.Table) -> pa.Table:
        of_documents = table.filter(pc.is_null(table.column("term")))
        ids = of_documents.column("ids").combine_chunks().flatten()
        m = 25 + 75 * of_documents.column("lengths").combine_chunks().flatten().to_numpy() * n_documents // n_terms
        lists = table.filter(pc.is_valid(table.column("term")))
        numbers = {t: i for i, t in enumerate(lists.column("term").to_pylist())}
        keys, places, scores = [], [], []
        if numbers:
            postings = []
            for p, f in zip(lists.column("places"), lists.column("tfs")):
                p, f = p.values.to_numpy(), f.values.to_numpy().astype(np.int64)
                postings.append((p, 1_000_000_000 * f // (1000 * f + 8 * m[p])))
            tables = PostingTables(postings, len(m))
            for key, counts in items:
                own = [t for t in counts if t in numbers and weight[t] > 0]
                if not own:
                    continue
                found, score = tables.top(np.array([numbers[t] for t in own]),
                                          np.array([weight[t] * counts[t] for t in own], dtype=np.int64), k)
                keys += [key] * len(found)
                places.append(found)
                scores.append(score)
        none = [np.empty(0, dtype=np.int64)]
        return pa.table({"item": pa.array(keys, pa.string()), "doc_id": ids.take(pa.array(np.concatenate(places or none))),
                         "score": pa.array(np.concatenate(scores or none))})

    return search_shard


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text",
           block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of every item: (id, rank, doc_id, score)."""
    spark = items.sparkSession
    named = items.select(F.col(id_col), F.sha2(F.col(text_col), 256).alias("item"), F.col(text_col).alias("text"))
    texts = named.where("text IS NOT NULL").select("item", "text").dropDuplicates(["item"])
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    documents = index.lists.where("term IS NULL")
    found = spark.createDataFrame([], "item string, doc_id long, score long")
    for block in range(blocks if index.n_terms else 0):
        # One block of items, bounded by ``block_bytes``, reaches the driver and the tasks.
        own = texts.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", F.col("text").cast("binary")).collect()
        counted = [(row["item"], Counter(terms_of(bytes(row["text"])))) for row in own]
        terms = spark.createDataFrame([(t,) for t in set().union(*(c for _, c in counted))], "term binary")
        postings = index.lists.join(F.broadcast(terms), "term", "left_semi")
        weight = {bytes(row["term"]): math.floor(1000 * math.log((2 * index.n_documents + 2) / (2 * row["df"] + 1)))
                  for row in postings.groupBy("term").agg(F.sum("df").alias("df")).collect()}
        searcher = _searcher(counted, weight, index.n_documents, index.n_terms, k)
        dealt = postings.unionByName(documents).repartition(math.ceil(index.shards / SHARDS_PER_TASK), "shard")
        best = dealt.groupBy("shard").applyInArrow(searcher, found.schema)
        found = found.unionByName(best)
    ranking = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)
    return named.select(id_col, "item").join(ranked.hint("merge"), "item").select(id_col, "rank", "doc_id", "score")


def oracle_sql(k: int = 10) -> str:
    """DuckDB SQL for ``search`` of ``benchmark`` in ``documents``: every score, then the best."""
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id,
           [t FOR t IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') IF t <> ''] AS terms
    FROM documents
),
items AS (
    SELECT row_number() OVER () AS i, item_id,
           [t FOR t IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') IF t <> ''] AS terms
    FROM benchmark
),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
asked AS (SELECT i, any_value(item_id) AS item_id, t, count(*) AS times FROM (SELECT i, item_id, unnest(terms) AS t FROM items) GROUP BY i, t),
postings AS (
    SELECT d, doc_id, n, t, count(*) AS tf FROM (SELECT d, doc_id, len(terms) AS n, unnest(terms) AS t FROM docs)
    WHERE t IN (SELECT t FROM asked) GROUP BY ALL
),
weights AS (
    SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT t, count(*) AS df FROM postings GROUP BY t), totals
),
scores AS (
    SELECT i, item_id, d, doc_id,
           CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN postings USING (t) JOIN weights USING (t), totals GROUP BY i, item_id, d, doc_id
),
ranked AS (
    SELECT item_id, doc_id, score,
           CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}
"""
