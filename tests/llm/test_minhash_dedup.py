import random
import re

import pytest
from pyspark.sql import types as T

from farebox.llm import minhash_dedup as md
from farebox.llm.components import connected_components

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("kept", T.StringType()), T.StructField("id", T.StringType())])


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def brute(rows, k, percent=80):
    rows = [(i, shingles(t, k)) for i, t in rows]
    links = [(a, b) for x, (a, s) in enumerate(rows) for b, t in rows[:x]
             if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t)]
    comp = components_of({i for i, _ in rows if i is not None}, links)
    return sorted(((i is None, i or 0), len(s), comp.get(i), i is None or comp[i] == i) for i, s in rows)


def result(spark, rows, k):
    out = md.near_duplicates(spark.createDataFrame([(i, t, "clash", "x") for i, t in rows], SCHEMA), words_per_shingle=k)
    return sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in out.collect())


def variant(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 5)))
    rows, nxt = [], 0
    for size, length, most in ((40, 120, 6), (12, 300, 12), (5, 60, 2), (3, 20, 1)):
        base = [word() for _ in range(length)]
        for _ in range(size):
            rows.append((nxt, variant(rng, base, rng.randint(0, most))))
            nxt += 1
    # a chain: each text is near the one before it, far from the first
    chain = [word() for _ in range(200)]
    for step in range(15):
        chain[step * 10 : step * 10 + 3] = [word() + "z" for _ in range(3)]
        rows.append((nxt, " ".join(chain)))
        nxt += 1
    rows += [(nxt + i, " ".join(word() for _ in range(rng.randint(1, 80)))) for i in range(30)]
    nxt += 30
    rows += [(nxt, None), (nxt + 1, ""), (nxt + 2, " \n\t "), (nxt + 3, "one two"), (nxt + 4, "ONE\x0btwo"),
             (nxt + 5, "one\xa0two"), (nxt + 6, "two one"), (None, "one two"), (None, None), (2, rows[2][1]),
             (nxt + 7, "É a b c d e f"), (nxt + 8, "é a b c d e f"), (nxt + 9, "word " * 30000), (nxt + 10, "word " * 9)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_matches_brute_force(spark, k):
    rows = corpus(k)
    assert result(spark, rows, k) == brute(rows, k)


def test_empty_and_single(spark):
    assert result(spark, [], 4) == []
    assert result(spark, [(7, "a b c d e")], 4) == brute([(7, "a b c d e")], 4)


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    text = "some words that make a text of their own here"
    docs = spark.createDataFrame([(3, text, "k", "i"), (1, text, "k", "i"), (None, text, "k", "i"), (5, None, "k", "i")], SCHEMA)
    out = md.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 5]


def test_components(spark):
    rng = random.Random(3)
    for _ in range(2):
        links = [(a := rng.randrange(120), max(0, a - rng.choice([1, 1, 7, 40]))) for _ in range(100)] + [(5, 5)]
        frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
        got = {r.node: r.component for r in connected_components(frame).collect()}
        want = components_of(range(120), links)
        assert {n: got.get(n, n) for n in range(120)} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_overlap_bound_of_repeated_rows(spark):
    common = list(range(90))
    rows = [(1, common + list(range(100, 110)))] * 2 + [(2, common + list(range(200, 210)))]
    rows += [(k, common + list(range(1000 * k, 1000 * k + 60))) for k in range(3, 3 + md.RARE)]
    rows += [(k, [-1]) for k in range(30, 30 + md.RARE - 1)] + [(30 + md.RARE - 1, [-1])] * 3  # RARE documents, not more
    sets = spark.createDataFrame(rows, "id long, items array<long>")
    cores, sharing = md._rare_shingles(sets.select("id").distinct(), sets)
    got = {r.id: r.core for r in cores.collect()}
    assert [got[k] for k in range(1, 3 + md.RARE)] == [90] * (2 + md.RARE)
    assert (30, 31) in {tuple(r) for r in sharing.collect()}


CLASHES = ["_wanted", "id", "x", "y", "key", "component", "n_shingles", "minima", "print", "near_duplicate", "part", "first", "items"]


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, "a text of some words that is repeated here", *["c"] * len(CLASHES)) for i in (4, 3, 9)],
                                 "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES))
    assert sorted(tuple(r) for r in md.near_duplicates(docs, words_per_shingle=4).collect()) == [
        (3, 6, 3, True), (4, 6, 3, False), (9, 6, 3, False)]
    out = md.drop_near_duplicates(docs)
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [3]


def test_large_group_of_copies_is_dealt(spark):
    """A third of the rows are one text: no key of a join or group holds them all."""
    rows = [(i, "the very same words in every one of these texts") for i in range(0, 900, 3)]
    rows += [(i, f"words of its own {i} {i * 7} {i * 13} {i * 17} and {i * 31} more") for i in range(900) if i % 3]
    assert result(spark, rows, 4) == brute(rows, 4)


def test_template_texts_make_no_pairs(spark):
    """20,000 texts in one bucket whose common part alone is not enough: none is left to pair."""
    rows = spark.range(20_000).selectExpr("7L AS key", "id", "100L AS n_shingles", "id AS component", "86L AS core")
    assert md._can_reach(rows, 80).count() == 0
    # one that is nearly all template may reach those that are nearly so, too
    mixed = rows.where("id < 50").unionByName(rows.where("id >= 50 AND id < 53").selectExpr(
        "key", "id", "90L AS n_shingles", "component", "88L AS core"))
    able = {r.id for r in md._can_reach(mixed, 80).collect()}
    bound = [100 * min(a, b) >= 80 * (x + y - min(a, b)) for a, x in ((86, 100), (88, 90)) for b, y in ((86, 100), (88, 90))]
    assert bound == [False, True, True, True] and able >= {50, 51, 52}


@pytest.mark.parametrize("seed", [1, 2])
def test_no_member_that_can_link_is_left_out(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        n = rng.randint(5, 60)
        rows.append((i % 7, i, n, i, rng.randint(int(n * rng.choice([0, 0.5, 0.8])), n)))
    able = {(r.key, r.id) for r in md._can_reach(spark.createDataFrame(rows, "key long, id long, n_shingles long, component long, core long"), 80).collect()}
    for k, a, x, _, p in rows:
        if any(k == j and a != b and 100 * min(p, q) >= 80 * (x + y - min(p, q)) for j, b, y, _, q in rows):
            assert (k, a) in able


def test_template_corpus(spark):
    rng = random.Random(17)
    base = [f"t{k}" for k in range(90)]
    rows = [(i, " ".join(base + [f"own{i}w{k}" for k in range(14)])) for i in range(1500)]
    rows += [(5000 + i, " ".join(base + [f"pair{i // 2}w{k}" for k in range(14)] + [f"z{i}"])) for i in range(20)]
    rng.shuffle(rows)
    out = {r.doc_id: r.component_id for r in md.near_duplicates(spark.createDataFrame(
        [(i, t, "", "") for i, t in rows], SCHEMA), words_per_shingle=4).collect()}
    assert all(out[i] == i for i in range(1500)) and all(out[5000 + i] == 5000 + i // 2 * 2 for i in range(20))


def test_query_matches_sql(spark):
    from farebox.llm import queries
    from tests.conftest import SF_SMALL
    from tests.oracle_compare import compare, duck

    name = "op7_minhash_dedup"
    ok, msg = compare(spark, duck(SF_SMALL), name, queries.LLM_QUERIES[name], queries.LLM_ORACLE[name], SF_SMALL)
    assert ok, msg
