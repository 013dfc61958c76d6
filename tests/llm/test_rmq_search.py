import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from farebox.llm import rmq_search as rs

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("n", T.StringType()), T.StructField("shard", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("item", T.StringType()), T.StructField("rank", T.StringType())])


def terms(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k):
    docs = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in docs), sum(len(t) for _, t in docs)
    df = Counter(t for _, own in docs for t in set(own))
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, own in docs:
            tf, score = Counter(own), 0
            for t in terms(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 25 + 75 * len(own) * n_docs // n_terms
                    score += w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k])]
    return out


def key(row):
    return tuple((v is None, v or 0) for v in row)


def corpus(rng):
    vocabulary = ["alpha", "Beta", "gamma", "d\u00e9j\u00e0", "\u6771\u4eac", "x1", "the", "The", "rare", "odd"]
    text = lambda n: rng.choice([" ", ", ", "_", "\n"]).join(rng.choices(vocabulary, weights=range(10, 0, -1), k=n))
    docs = [(i, text(rng.choice([1, 3, 8, 40]))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "?! _"), (None, "rare odd"), (None, "rare odd"), (203, "the " * 30_000)]
    docs += [(300 + i, "rare odd gamma") for i in range(25)] + [(300, "rare odd gamma")] * 2  # ties and repeated rows
    items = [(1, "rare odd"), (2, "the The THE gamma"), (3, None), (4, ""), (5, "unknown words"), (1, "rare odd"),
             (None, "alpha x1"), (6, "unknown d\u00e9j\u00e0 \u6771\u4eac beta beta " * 50)]
    return docs, items


@pytest.mark.parametrize("shard_postings,block_bytes,k", [(rs.SHARD_POSTINGS, rs.ITEM_BLOCK_BYTES, 10), (40, 30, 10), (100, 2000, 3)])
def test_search_matches_brute_force(spark, shard_postings, block_bytes, k):
    docs, items = corpus(random.Random(3))
    df = spark.createDataFrame([(*d, "clash", "clash") for d in docs], DOCS).repartition(3)
    index = rs.build_index(df, shard_postings=shard_postings)
    out = rs.search(index, spark.createDataFrame([(*i, "clash", "clash") for i in items], ITEMS), k, block_bytes=block_bytes)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=key) == sorted(brute(docs, items, k), key=key)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a", "", "")], DOCS), spark.createDataFrame([(1, "a", "", "")], ITEMS)
    assert rs.search(rs.build_index(docs.where("false")), items).count() == 0
    assert rs.search(rs.build_index(docs), items.where("false")).count() == 0
    assert rs.search(rs.build_index(docs), items).collect()[0][:3] == (1, 1, 1)


def test_terms():
    assert rs.terms_of("A-b_C9 \u00c9\u00e9\u2019s\x7f\x00z".encode()) == [b"a", b"b", b"c9", "\u00c9\u00e9\u2019s".encode(), b"z"]


@pytest.mark.parametrize("batch,cells", [(rs.BATCH, rs.RANK_CELLS), (1, 0), (3, rs.RANK_CELLS)])
def test_top_of_random_lists(monkeypatch, batch, cells):
    monkeypatch.setattr(rs, "BATCH", batch)
    monkeypatch.setattr(rs, "RANK_CELLS", cells)
    rng = np.random.default_rng(7)
    for n in (1, 2, 33, 400):
        lists = []
        for _ in range(6):
            places = np.sort(rng.choice(n, size=rng.integers(1, n + 1), replace=False)).astype(np.int32)
            lists.append((places, rng.integers(1, 6, size=len(places))))  # few values, so many ties
        tables = rs.PostingTables(lists, n)
        own, weights = np.array([4, 0, 3]), np.array([3, 1, 2])
        score = np.zeros(n, dtype=np.int64)
        for t, w in zip(own, weights):
            score[lists[t][0]] += w * lists[t][1]
        best = [p for p in np.lexsort((np.arange(n), -score)) if score[p] > 0][:10]
        places, scores = tables.top(own, weights, 10)
        assert list(places) == best and list(scores) == list(score[best])


def test_intervals_that_cannot_win_stay_closed(monkeypatch):
    n = 20_000
    impacts = np.ones(n, dtype=np.int64)
    impacts[[5, 9000, 19_999]] = 50
    tables = rs.PostingTables([(np.arange(n, dtype=np.int32), impacts)], n)
    asked = []
    maxima = tables.maxima
    monkeypatch.setattr(tables, "maxima", lambda a, b: asked.append(a.size) or maxima(a, b))
    places, _ = tables.top(np.array([0]), np.array([1]), 3)
    assert list(places) == [5, 9000, 19_999] and sum(asked) < 20
