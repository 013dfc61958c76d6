import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from farebox.llm import genetic_packing as gp

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("item", T.StringType()), T.StructField("length", T.StringType())])


def check(rows, out, capacity):
    """The pieces are those of the library's ids, every sequence is gapless."""
    library = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], dtype="<u4")
            want.append((i is None, i or 0, k, start, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in out]
    assert sorted(got) == sorted(want)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(w[4] for w in want)


@pytest.mark.parametrize("capacity,block", [(64, 3000), (64, 40), (2048, 50)])
def test_packing_is_whole_and_tight(spark, capacity, block):
    rng = random.Random(capacity + block)
    rows = [(i, " ".join(rng.choices(["the", "of", "and", "cat", "xyzzy"], k=rng.randint(0, 60)))) for i in range(400)]
    rows += [(None, None), (None, "a b"), (3, ""), (3, "the " * 500), (4, "the " * 64), (4, "the " * 63), (5, "of " * 9000)]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)
    out = gp.pack_documents(docs, PATH, capacity, block_items=block).collect()
    n, total = check(rows, out, capacity)
    assert n <= np.ceil(total / capacity) * 1.08 + 1


def test_empty(spark):
    assert gp.pack_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_operators_keep_every_item():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 101, size=500)
    first = gp.first_population(rng, lengths, 100, 3)
    for group in [*first, gp.crossover(rng, lengths, first[0], first[1], 100), gp.mutate(rng, lengths, first[2], 100)]:
        fill = np.bincount(group, weights=lengths)
        assert len(group) == 500 and fill.max() <= 100 and fill.min() > 0
    best = gp.evolve(1, lengths, first, 100, 40)
    assert gp.fitness(lengths, best[0], 100) >= max(gp.fitness(lengths, g, 100) for g in first)
    assert best[0].max() <= min(g.max() for g in first)


def test_crossover_takes_whole_bins():
    rng = np.random.default_rng(4)
    lengths = np.array([50, 50, 60, 40, 70, 30, 10])
    a, b = np.array([0, 1, 0, 1, 2, 2, 3]), np.array([0, 0, 1, 1, 2, 2, 3])
    child = gp.crossover(rng, lengths, a, b, 110)
    pairs = [(0, 1), (2, 3), (4, 5)]
    assert any(child[x] == child[y] for x, y in pairs)


def test_single_items_and_one_block(spark):
    items = spark.createDataFrame([(i, 1 + i % 5) for i in range(7)], "item long, length long")
    got = {r.item: r.bin for r in gp.pack_items(items, capacity=5, n_islands=1, epochs=1).collect()}
    fills = {}
    for i, b in got.items():
        fills[b] = fills.get(b, 0) + 1 + i % 5
    assert len(got) == 7 and max(fills.values()) <= 5 and len(fills) == 4
