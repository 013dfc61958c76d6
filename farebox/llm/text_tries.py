"""Filter interaction audit; exact duplicates by compressed tries over ranges of texts.

Five filters are applied to every whole text: A few words, B few distinct
words, C many capital letters, D holds a symbol, E the text of a smaller id,
identical.  The audit counts what each filter removes in each of the 120
orders.  A text's failures are a mask of five bits; all counts follow from the
number of documents by part and mask, so only those are shuffled together.

E needs whole texts to meet.  Each task inserts its texts into a compressed
(radix) trie, whose terminals hold the smallest id, and passes on each of its
distinct texts once, so a text that a third of all rows share travels once a
task.  Walking a trie in order also yields, about every ``MARK_BYTES`` of
text, the shortest prefix that parts two neighbours; every k-th of these marks
bounds a range.  A prefix is as long as the texts around it need: short in
common prose, long within a family of near copies.  Each range is one more
trie, whose terminals hold the smallest id of all.  A document fails E if its
id is not that of its text's terminal.

Defined results: a null text is empty, and empty texts equal one another; a
null part is the empty string; rows with a null id never fail E, let no other
row fail it and have no labels; rows that repeat an id count one by one (none
fails E by a row of the same id); an id with several label rows is good (toxic)
if any of them says so; texts of any length are held whole (a task holds the
texts of one trie, ``TRIE_BYTES`` or one single longer text); an empty table
gives no rows; other columns of the inputs play no part, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial
from hashlib import sha256
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import bounded, materialise, utf8_values

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

TRIE_BYTES = 16 << 20
MARK_BYTES = 1 << 20
RANGE_BYTES = 8 << 20
RANGES_PER_TASK = 4

LOCAL_SCHEMA = "doc_id long, part string, mask int, digest binary, text binary, min_id long, mark binary"


def text_mask(text: bytes) -> int:
    """The bits of the filters A to D that the text fails."""
    words = text.split()
    points = len(text.decode("utf-8", "replace"))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (BIT["A"] * (len(words) < MIN_WORDS)
            | BIT["B"] * (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words))
            | BIT["C"] * (100 * capitals > MAX_CAPITAL_PERCENT * points)
            | BIT["D"] * (len(text.translate(None, SYMBOLS)) < len(text)))


def common_length(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of ``a`` equal those of ``b`` from ``start`` on; by halving, so long labels compare as slices."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[start + low : start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    __slots__ = ("label", "children", "row", "min_id")

    def __init__(self, label: bytes, row: int | None = None, min_id: int | None = None):
        self.label, self.row, self.min_id = label, row, min_id
        self.children: dict[int, Node] = {}


class RadixTrie:
    """Byte strings; a terminal holds the row of the first and the smallest id of all texts that end there."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, text: bytes, row: int, doc_id: int | None) -> int:
        """Add a text; the row that first brought it."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                at = len(text)
            elif text.startswith(child.label, at):
                at += len(child.label)
            else:
                n = common_length(child.label, text, at)
                upper = node.children[text[at]] = Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                child, at = upper, at + n
            node = child
        if node.row is None:
            node.row = row
        if doc_id is not None and (node.min_id is None or doc_id < node.min_id):
            node.min_id = doc_id
        return node.row

    def terminals(self) -> Iterator[tuple[int, int | None, int]]:
        """(first row, smallest id, bytes shared with the text before) of each distinct text, texts ascending."""
        stack, shared = [(self.root, 0)], 0
        while stack:
            node, depth = stack.pop()
            shared = min(shared, depth)
            depth += len(node.label)
            if node.row is not None:
                yield node.row, node.min_id, shared
                shared = depth
            stack.extend((node.children[first], depth) for first in sorted(node.children, reverse=True))


def _local_rows(ids: list, parts: list, texts: list[bytes], mark_bytes: int) -> pa.RecordBatch:
    """The rows of one local trie: each distinct text once, with its smallest id here; marks where ranges may begin."""
    trie = RadixTrie()
    firsts = [trie.insert(text, row, doc_id) for row, (doc_id, text) in enumerate(zip(ids, texts))]
    digests, masks = {}, {}
    kept_text, min_ids, marks = ([None] * len(texts) for _ in range(3))
    held = zlib.crc32(texts[0]) % mark_bytes
    for row, min_id, shared in trie.terminals():
        text = texts[row]
        digests[row], masks[row] = sha256(text).digest(), text_mask(text)
        kept_text[row], min_ids[row] = text, min_id
        held += len(text) + 1
        if held >= mark_bytes:
            held, marks[row] = held % mark_bytes, text[: shared + 1]
    columns = (ids, parts, [masks[r] for r in firsts], [digests[r] for r in firsts], kept_text, min_ids, marks)
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
    names = [field.split()[0] for field in LOCAL_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _local_tries(batches: Iterator[pa.RecordBatch], trie_bytes: int, mark_bytes: int) -> Iterator[pa.RecordBatch]:
    ids, parts, texts, held = [], [], [], 0
    for batch in batches:
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), utf8_values(batch.column("text")))
        for doc_id, part, text in rows:
            ids.append(doc_id)
            parts.append(part)
            texts.append(text)
            held += len(text)
            if held >= trie_bytes:
                yield _local_rows(ids, parts, texts, mark_bytes)
                ids, parts, texts, held = [], [], [], 0
    if texts:
        yield _local_rows(ids, parts, texts, mark_bytes)


def _range_starts(local: DataFrame, step: int) -> list[bytes]:
    """The prefixes at which ranges begin: every ``step``-th mark, taken where Spark has sorted them; one a range reaches the driver."""

    def every_kth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for batch in batches:
            if seen is None and batch.num_rows:  # else a sort in many small parts would have no k-th mark
                seen = zlib.crc32(batch.column("mark")[0].as_py()) % step
            picked = [i for i in range(batch.num_rows) if (seen + i + 1) % step == 0]
            seen = (seen or 0) + batch.num_rows
            yield batch.take(pa.array(picked, pa.int64()))

    marks = local.where("mark IS NOT NULL").select("mark")
    chosen = marks.repartitionByRange("mark").sortWithinPartitions("mark").mapInArrow(every_kth, "mark binary")
    return sorted({row.mark for row in chosen.collect()})


def _range_trie(table: pa.Table) -> pa.Table:
    """The terminals of a range: each text's digest with the smallest id of all its copies."""
    trie = RadixTrie()
    texts = (text for chunk in table.column("text").chunks for text in utf8_values(chunk))
    for row, (text, min_id) in enumerate(zip(texts, table.column("min_id").to_pylist())):
        trie.insert(text, row, min_id)
    found = list(trie.terminals())
    return pa.table({"min_id": pa.array([min_id for _, min_id, _ in found], pa.int64()),
                     "digest": table.column("digest").take(pa.array([row for row, _, _ in found], pa.int64()))})


def smallest_ids(local: DataFrame, marks_per_range: int = RANGE_BYTES // MARK_BYTES) -> DataFrame:
    """(min_id, digest) of every distinct text, from the rows of the local tries."""
    starts = _range_starts(local, marks_per_range)

    @F.arrow_udf("int")
    def range_of(texts: pa.Array) -> pa.Array:
        return pa.array([bisect_right(starts, t) for t in utf8_values(texts)], pa.int32())

    texts = local.where("min_id IS NOT NULL").select("text", "min_id", "digest").withColumn("range", range_of("text"))
    # A few ranges a task, however many there are; the shuffle default would let tasks grow with the table.
    dealt = texts.repartition(len(starts) // RANGES_PER_TASK + 1, "range")
    return dealt.groupBy("range").applyInArrow(_range_trie, "min_id long, digest binary")


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                  trie_bytes: int = TRIE_BYTES, mark_bytes: int = MARK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, part, mask, n): rows counted by id, part and the bits of all filters they fail."""
    plain = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"),
                                 F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                                 F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tries = partial(_local_tries, trie_bytes=trie_bytes, mark_bytes=mark_bytes)
    local = materialise(plain.mapInArrow(tries, LOCAL_SCHEMA), "tries")
    first = smallest_ids(local, max(1, range_bytes // mark_bytes)).select(F.col("min_id").alias("doc_id"), "digest", F.lit(0).alias("late"))
    # Counted before the join: a repeated row would be a hot key, and so would null ids, which need no join.
    rows = local.where("doc_id IS NOT NULL").groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    found = rows.join(first.hint("merge"), ["doc_id", "digest"], "left").select(
        "doc_id", "part", (F.col("mask") + F.coalesce("late", F.lit(BIT["E"]))).alias("mask"), "n")
    nameless = local.where("doc_id IS NULL").groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    return materialise(found.unionByName(nameless), "masks")


def mask_counts(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled good or toxic, by part and mask."""
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic"))
    known = masks.where("doc_id IS NOT NULL").join(marks.hint("merge"), "doc_id", "left")
    joined = known.unionByName(masks.where("doc_id IS NULL"), allowMissingColumns=True)
    return joined.groupBy("part", "mask").agg(F.sum("n").alias("n"),
                                              F.coalesce(F.sum(F.col("n") * F.col("good")), F.lit(0)).alias("good"),
                                              F.coalesce(F.sum(F.col("n") * F.col("toxic")), F.lit(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step: what stays, goes and would have gone anyway."""
    counts = mask_counts(failure_masks(docs, id_col, text_col, part_col), labels)
    # At most 32 masks a part.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = ["".join(order) for order in permutations(FILTERS)]
    steps = ", ".join(f"('{order}', {step + 1}, {BIT[order[step]]}, {sum(BIT[f] for f in order[:step])})"
                      for order in orders for step in range(len(order)))
    rows = parts.select("part", "cells", F.inline(F.expr(f"array({steps})")).alias("filter_order", "step", "bit", "before"))

    def total(condition, value=lambda c: c["n"]):
        return F.aggregate(F.filter("cells", condition), F.lit(0).cast("long"), lambda acc, c: acc + value(c))

    bit, before = F.col("bit"), F.col("before")
    fails = lambda c: c["mask"].bitwiseAND(bit) != 0
    in_time = lambda c: c["mask"].bitwiseAND(before) == 0
    removed = lambda c: fails(c) & in_time(c)
    return rows.select(
        "part", "filter_order", "step",
        total(lambda c: c["mask"].bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(lambda c: fails(c) & ~in_time(c)).alias("redundant"),
        total(lambda c: c["mask"] == bit).alias("unique_fails"),
        total(removed, lambda c: c["good"]).alias("good_lost"),
        total(removed, lambda c: c["toxic"]).alias("toxic_lost"),
        # Of a document's failing filters each comes first in as many orders.
        total(fails, lambda c: c["n"] * (F.lit(len(orders)) / F.bit_count(c["mask"])).cast("long")).alias("shapley"))


def oracle_sql() -> str:
    """DuckDB SQL for ``audit`` over ``documents`` and ``labels``, one row at a time through every order."""
    return r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
),
worded AS (
    SELECT *, [w FOR w IN string_split_regex(text, '[ \t\n\x0B\f\r]+') IF w <> ''] AS words,
           min(doc_id) OVER (PARTITION BY text) AS first_id
    FROM texts
),
failures AS (
    SELECT doc_id, part, {
        'A': len(words) < 50,
        'B': 100 * len(list_distinct(words)) < 65 * len(words),
        'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
        'D': regexp_matches(text, '[#$%&*|]'),
        'E': coalesce(doc_id > first_id, false)} AS f
    FROM worded
),
marks AS (
    SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
docs AS (
    SELECT part, (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END)
                 || (CASE WHEN f.C THEN 'C' ELSE '' END) || (CASE WHEN f.D THEN 'D' ELSE '' END)
                 || (CASE WHEN f.E THEN 'E' ELSE '' END) AS failing,
           coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM failures LEFT JOIN marks USING (doc_id)
),
kinds AS (
    SELECT part, failing, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM docs GROUP BY ALL
),
first_removed AS (
    SELECT k.*, filter_order,
           coalesce(list_min([strpos(filter_order, l) FOR l IN string_split(failing, '') IF l <> '']), 6) AS gone
    FROM kinds k, orders
),
credit AS (
    SELECT part, substr(filter_order, gone, 1) AS letter, sum(n) AS shapley FROM first_removed WHERE gone < 6 GROUP BY ALL
),
walked AS (
    SELECT part, filter_order, step, substr(filter_order, CAST(step AS INTEGER), 1) AS letter,
           sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN gone < step AND contains(failing, substr(filter_order, CAST(step AS INTEGER), 1)) THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN failing = substr(filter_order, CAST(step AS INTEGER), 1) THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
    FROM first_removed JOIN steps USING (filter_order) GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(coalesce(shapley, 0) AS BIGINT) AS shapley
FROM walked LEFT JOIN credit USING (part, letter)
"""
