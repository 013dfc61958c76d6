import math
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm import compression_classifier as cc
from farebox.llm import counterfactual_toxicity as ct
from farebox.llm import queries
from tests.conftest import SF_MID

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("score", T.StringType()), T.StructField("label", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                       T.StructField("toxic", T.IntegerType())])
SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def quality(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, 150) if i % 3 else " ".join(f"{w}###" for w in prose(rng, 150).split())) for i in range(300)]
    labels = [(i, int(i % 3 > 0), None) for i, _ in rows] + [(None, 1, 0), (3, 0, None), (10**6, 1, 1), (5, None, None)]
    return rows, labels


def test_compression_classifier_separates_held_out(spark, quality):
    rows, labels = quality
    learn = spark.createDataFrame([r for r in labels if r[0] is None or r[0] % 5], LABELS)
    model = cc.fit(docs_of(spark, rows), learn)
    edge = [(None, rows[1][1]), (900, None), (901, ""), (902, rows[1][1] * 60), (1, rows[1][1])]
    out = cc.score_documents(docs_of(spark, rows + edge), model, 0.3)
    assert out.columns == ["doc_id", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) + len(edge) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 5 == 0]
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held)
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[None] == by_id[1] and by_id[900] == by_id[901]
    kept = cc.keep_predicted(docs_of(spark, rows), model, 0.3)
    assert kept.columns == [f.name for f in DOCS] and kept.count() == sum(r.predicted for r in got if r.doc_id in range(300)) - 1


def test_scores_are_the_compressed_size_difference(quality):
    rows, _ = quality
    good, bad = rows[1][1].encode(), rows[0][1].encode()
    diff = cc.SizeDifference(good, bad)
    import zstandard
    for text in (b"", rows[4][1].encode(), b"a", rows[3][1].encode() * 9):
        total = 0.0
        for k in range(0, len(text), cc.BLOCK_BYTES):
            sizes = []
            for d in (good, bad):
                c = zstandard.ZstdCompressor(level=cc.ZSTD_LEVEL, dict_data=zstandard.ZstdCompressionDict(d),
                                             write_content_size=False, write_checksum=False, write_dict_id=False)
                sizes.append(len(c.compress(text[k : k + cc.BLOCK_BYTES])))
            total += (sizes[1] - sizes[0]) / max(sizes) * len(text[k : k + cc.BLOCK_BYTES])
        assert diff(text) == pytest.approx(total / len(text) if text else 0.0)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(None, None, None)]])
def test_nothing_to_learn_from(spark, labels):
    learn, docs = spark.createDataFrame(labels, LABELS), docs_of(spark, [(1, "a b"), (2, None)])
    want = 1.0 if labels and labels[0][1] == 1 else 0.5
    assert {r.score for r in cc.score_documents(docs, cc.fit(docs, learn), 0.3).collect()} == {want}
    assert {r.score for r in ct.score_documents(docs, ct.fit(docs, learn), 0.7).collect()} == {0.0}
    assert cc.score_documents(docs.limit(0), cc.fit(docs.limit(0), learn), 0.3).count() == 0


@pytest.fixture(scope="module")
def toxic(spark):
    """Abuse words make a text toxic; one group is named mostly in toxic texts."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        words = prose(rng, 60).split()
        bad = i % 4 == 0
        if bad:
            words[7:7] = [rng.choice(["vilesome", "scornish", "grubwit"]) + rng.choice(["", "s", "ly"])]
        if rng.random() < (0.7 if bad else 0.02):
            words[20:20] = ["Muslim"]
        elif rng.random() < 0.3:
            words[20:20] = ["christian"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_ignores_neutral_mentions(spark, toxic):
    rows, labels = toxic
    docs, learn = docs_of(spark, rows), spark.createDataFrame([r for r in labels if r[0] % 3 != 1], LABELS)
    model, plain = ct.fit(docs, learn), ct.fit(docs, learn, penalty=0.0)
    rng = random.Random(8)
    neutral = prose(rng, 60)
    shift = lambda m: abs(m.logit(neutral + " muslim") - m.logit(neutral + " christian"))
    assert shift(model) < 0.2 * shift(plain)
    got = {r.doc_id: r for r in ct.score_documents(docs, model, 0.7).collect()}
    held = [i for i, _ in rows if i % 3 == 1]
    assert sum(got[i].predicted == labels[i][2] for i in held) >= 0.95 * len(held)
    assert ct.drop_toxic(docs, model, 0.7).columns == docs.columns


def test_toxicity_edges(spark, toxic):
    rows, labels = toxic
    model = ct.fit(docs_of(spark, rows + [(None, "x"), (0, rows[0][1])]), spark.createDataFrame([*labels, (None, 1, 1)], LABELS))
    edge = docs_of(spark, [(None, "vilesome"), (1, None), (2, ""), (3, "a " * 100000), (3, "z" * 100000)])
    got = ct.score_documents(edge, model, 0.7).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)


def test_words_count_whole(spark, toxic):
    """Texts that differ only behind the first 40 characters of a word, and abuse in glued text."""
    rows, labels = toxic
    rng = random.Random(12)
    kanji = [chr(0x4E00 + k) for k in range(300)]
    glued = lambda bad: "".join(rng.choices("abcdefghijklmno", k=90)) + ("xqzvw" if bad else "") + "".join(rng.choices("abc", k=30))
    japanese = lambda bad: "".join(rng.choices(kanji, k=12)) + ("\u9b3c\u755c" if bad else "") + "".join(rng.choices(kanji, k=6))
    extra, marks = [], []
    for i in range(400, 800):
        bad = i % 3 == 0
        extra.append((i, (glued if i % 2 else japanese)(bad)))
        marks.append((i, 1, int(bad)))
    model = ct.fit(docs_of(spark, rows + extra), spark.createDataFrame(labels + marks, LABELS))
    stem = "k" * 41
    assert ct.features_of({stem + "a"}) != ct.features_of({stem + "b"})
    for make in (glued, japanese):
        for _ in range(20):
            assert model.logit(make(True)) > 0 > model.logit(make(False))
    assert ct.words_of("One, two. \u201cthree") == ["one", "two", "\u201cthree"]


def test_scores_are_recomputed_from_the_weights(spark, toxic):
    rows, labels = toxic
    model = ct.fit(docs_of(spark, rows), spark.createDataFrame(labels, LABELS))

    def independent(text):
        total, seen = [model.intercept], set()
        for word in text.lower().split():
            word = word.strip(".,;:!?\"'()[]{}*_-")
            if word and word not in seen:
                seen.add(word)
        grams = set()
        for word in seen:
            grams |= {word} | {word[:n] + "*" for n in (4, 5) if len(word) >= n}
        total += [model.weights[g] for g in sorted(grams) if g in model.weights]
        return 1 / (1 + math.exp(-math.fsum(total)))

    got = {r.doc_id: r.score for r in ct.score_documents(docs_of(spark, rows), model, 0.7).collect()}
    assert all(math.isclose(got[i], independent(t), rel_tol=1e-9) for i, t in rows)


def test_swapper():
    swap = ct.Swapper(ct.IDENTITY_FAMILIES)
    assert swap("no group named") is None
    assert swap("a woman and men") == "a man and transgender people"
    assert ct.Swapper(())("women") is None


@pytest.mark.parametrize("name,modulus,held,column,threshold", [
    ("op4_compression_classifier", 5, 0, "quality", 0.3), ("op5_counterfactual_toxicity", 3, 1, "toxic", 0.7)])
def test_queries_on_held_out_labels(spark, name, modulus, held, column, threshold):
    got = {r.doc_id: r for r in queries.LLM_QUERIES[name](spark, SF_MID).collect()}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % modulus == held)
        assert r.predicted == int(r.score >= threshold) and 0 <= r.score <= 1
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").where(F.col(column).isNotNull()).collect()
    held_out = [r for r in labels if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].predicted == r[column] for r in held_out)
    assert right >= 0.9 * len(held_out)
