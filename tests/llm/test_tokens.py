import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from farebox.llm import overlap_token_counts as otc
from farebox.llm import pair_index_bpe as pib
from farebox.llm import queries, segment_encoding
from tests.conftest import SF_SMALL

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("n_tokens", T.StringType()), T.StructField("key", T.StringType())])
PIECES = ["a", "aaa", "ab", "É", "é", "é", "́", " ", "  ", "\n", "\xa0", "\x85", " ", "'s", "'T", "12",
          "日本", "😀", "<|endoftext|>", "<|startoftext|>", "<|end", "İ", "Σ", "ς", "ﬁ", "\x1c", "\x00", "!!", "-", "ß",
          "‍", "가", "가", "ing", "the", "ͅ", "K", "Å", "\x0b", "\r\n"]

PIECES += ["ÀÉ", "ŸŁ", "×÷", "ŉ", "ſ", "ª²½", "Ǆ", "Dž"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)


def texts_of(seed, n=300):
    rng = random.Random(seed)
    return [None, "", "the " * 9000, "x" * 5000, *("".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(n))]


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=12)), max_size=12))
def test_pair_index_equals_the_library(pieces):
    text = "".join(pieces).encode("utf-8", "replace").decode()
    bpe = pib.encoder_of(WORD)
    library = Tokenizer.from_file(WORD)
    want = library.encode(text, add_special_tokens=False).ids
    got = next(segment_encoding.encode_column(pa.array([text]), bpe.encode_segments))
    assert got.tolist() == want
    assert bpe.decode(got).decode() == library.decode(want, skip_special_tokens=False)


def brute_bpe(bpe, word):
    """One word, one merge at a time: the lowest rank, leftmost first."""
    symbols = [bpe.vocab[c] for c in word[:-1]] + [bpe.vocab[word[-1] + bpe.suffix]]
    while len(symbols) > 1:
        ranks = bpe._ranks(np.array(symbols[:-1]), np.array(symbols[1:]))
        k = int(np.argmin(ranks))
        if ranks[k] == pib.NO_RANK:
            break
        symbols[k : k + 2] = [int(bpe.merged[ranks[k]])]
    return symbols


def test_pair_index_equals_word_by_word_merging():
    rng = random.Random(4)
    bpe = pib.encoder_of(WORD)
    words = ["".join(rng.choices("aabenorst", k=rng.randint(1, 14))) for _ in range(400)] + ["a" * n for n in range(1, 20)]
    ids, counts = bpe.encode_words([w.encode() for w in words])
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [brute_bpe(bpe, w) for w in words]
    assert bpe.encode_words([])[0].size == 0


def test_round_trip_query_form(spark):
    library = Tokenizer.from_file(WORD)
    rows = [(i, t) for i, t in enumerate(texts_of(1))] + [(None, "a b"), (3, "x" * 5000)]
    out = pib.round_trip_digests(frame(spark, rows), WORD)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append(((i is None, i or 0), len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in out.collect()) == sorted(want)
    assert pib.round_trip_digests(frame(spark, []), WORD).count() == 0


def test_ids_and_decoded_columns(spark):
    rows = [(1, "Hello <|endoftext|> world"), (2, None)]
    out = frame(spark, rows).select("doc_id", pib.ids_column("text", WORD).alias("ids"))
    back = {r.doc_id: r.t for r in out.select("doc_id", pib.decoded_column("ids", WORD).alias("t")).collect()}
    assert back == {1: "hello</w> <|endoftext|> world</w>", 2: ""}


def test_segments_with_the_library_and_files_it_cannot_take(monkeypatch):
    library = Tokenizer.from_file(WORD)
    texts = texts_of(2)
    monkeypatch.setattr(segment_encoding, "TEXT_BYTES_AT_ONCE", 2000)
    monkeypatch.setattr(segment_encoding, "WORDS_AT_ONCE", 50)
    got = list(segment_encoding.encode_column(pa.array(["x", *texts]).slice(1), segment_encoding.library_segments(WORD)))
    assert [x.tolist() for x in got] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert segment_encoding.drops_white_space(WORD, library)
    assert not segment_encoding.drops_white_space(BYTE, Tokenizer.from_file(BYTE))
    with pytest.raises(ValueError):
        pib.PairIndexBpe(BYTE)


def counts_of(spark, rows, **sizes):
    out = otc.token_counts(frame(spark, rows), BYTE, **sizes)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    return sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in out.collect())


def library_counts(rows, limit=512):
    library = Tokenizer.from_file(BYTE)
    out = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        out.append(((i is None, i or 0), len((t or "").encode()), n, n > limit))
    return sorted(out)


def test_counts_with_tiny_chunks_and_widening(spark):
    rng = random.Random(9)
    rows = [(i, t) for i, t in enumerate(texts_of(3, 120))]
    rows += [(900 + i, "".join(rng.choices(PIECES, k=200))) for i in range(20)]
    rows += [(None, "a b " * 40), (None, None), (901, rows[-1][1]), (901, rows[-1][1]), (950, "z" * 700),
             (951, " " * 500 + "x"), (952, "a<|endoftext|>" * 40), (953, "\n \n" * 200), (954, "don't " * 90)]
    assert counts_of(spark, rows, chunk_chars=64, overlap=24) == library_counts(rows)


def test_counts_with_the_usual_chunks(spark):
    rng = random.Random(10)
    text = "".join(rng.choices(PIECES, k=40000))
    rows = [(1, text), (2, text[:16384]), (3, text[:16385]), (4, ""), (5, "word " * 12000), (6, "é" * 40000)]
    assert counts_of(spark, rows) == library_counts(rows)
    assert counts_of(spark, []) == []


def test_queries_on_the_small_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.LLM_QUERIES["op10_overlap_token_counts"](spark, SF_SMALL).collect()
    assert sorted(((False, r[0]), *r[1:]) for r in got) == library_counts(docs)
    library = Tokenizer.from_file(WORD)
    got = {r.doc_id: r for r in queries.LLM_QUERIES["op9_pair_index_bpe"](spark, SF_SMALL).collect()}
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()


def test_segments_of_earlier_calls_are_looked_up(monkeypatch):
    """Ids do not depend on what an encoder has met; a segment met lately is not encoded again; the memory is bounded."""
    import public_tokenizers

    from farebox.llm import pair_index_bpe

    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(pair_index_bpe, "KNOWN_SEGMENTS", 50)
    bpe, plain = pair_index_bpe.PairIndexBpe(path), pair_index_bpe.PairIndexBpe(path)
    encoded = []
    fresh = bpe._encode_fresh
    monkeypatch.setattr(bpe, "_encode_fresh", lambda segments: encoded.extend(segments) or fresh(segments))
    parts = [["the", "quick,", "\u00c9t\u00e9", "x" * 100], ["the", "x" * 100, "\u65e5\u672c", "the"], [f"w{i}a" for i in range(45)],
             [f"w{i}a" for i in range(30, 120)], [], ["w31a", "the"]]
    for part in parts:
        ids, sizes = bpe.encode_segments(part)
        want, want_sizes = plain._encode_fresh(part)
        assert ids.tolist() == want.tolist() and sizes.tolist() == want_sizes.tolist()
        assert len(bpe.known) == len(bpe.known_sizes) <= 50 and len(bpe.known_ids) == bpe.known_sizes.sum()
    assert encoded.count("the") == 2 and encoded.count("x" * 100) == 2 and encoded.count("w31a") == 1
