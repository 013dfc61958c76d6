"""Token counts, with overlap resynchronisation for huge documents.

Texts of at most ``CHUNK_CHARS`` characters are counted by the library at
once.  A longer text is cut into chunks that overlap, the chunks are spread
over the cluster and encoded with offsets, and neighbouring chunks are spliced
at a common boundary: a place in the overlap where both encodings start a
pre-token.  Such a place is stable.  The pre-tokenizer scans forward and a
pre-token's end depends on what follows it by less than one pre-token, so a
boundary of the left chunk is a true one unless it lies behind the start of
the chunk's last pre-token or so near its end that a special string could be
cut; and from a true boundary on, the right chunk reads the same text from the
same state, so its tokens are the true ones.  Where an overlap has no common
boundary, the document is cut again with wider overlaps, at last as one chunk.

So a count is exactly that of the whole text, and a task holds chunks, not
whole documents' encodings.

Defined results: a null or empty text has 0 bytes and 0 tokens; texts of any
length count whole; repeated rows are counted once and returned as often as
they occur (so ties cannot arise); a null id stays null; an empty table gives
no rows; other columns play no part, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import bounded, materialise, utf8_values
from farebox.llm.segment_encoding import load_tokenizer

CHUNK_CHARS = 16384
OVERLAP_CHARS = 512
WIDEN = 4
ENCODE_ROWS = 64

CHUNK_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("number", T.LongType()), T.StructField("last", T.BooleanType()),
    T.StructField("start", T.LongType()), T.StructField("chunk", T.StringType())])
ENCODED_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("number", T.LongType()), T.StructField("last", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("head_at", T.ArrayType(T.LongType())), T.StructField("head_tokens", T.ArrayType(T.LongType())),
    T.StructField("tail_at", T.ArrayType(T.LongType())), T.StructField("tail_tokens", T.ArrayType(T.LongType()))])


@lru_cache(maxsize=4)
def tokenizer_of(path: str):
    """(tokenizer, length of the longest special string), once per worker."""
    with open(path, encoding="utf-8") as f:
        special = max((len(t["content"]) for t in json.load(f)["added_tokens"]), default=0)
    return load_tokenizer(path), special


def boundaries(encoding, start: int) -> list[tuple[int, int]]:
    """(place in the document, tokens before it) of every pre-token start."""
    out, word = [], -1
    for k, (w, (begin, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if w is None or w != word:
            out.append((start + begin, k))
            word = w
    return out


def encode_chunk(path: str, start: int, chunk: str, overlap: int, last: bool) -> tuple:
    """Token count of a chunk, and its boundaries in the overlaps before and
    after; of the latter only those that the cut behind the chunk cannot touch."""
    tokenizer, special = tokenizer_of(path)
    encoding = tokenizer.encode(chunk, add_special_tokens=False)
    found = boundaries(encoding, start)
    head = [x for x in found if start < x[0] < start + overlap] if start else []
    tail: list[tuple[int, int]] = []
    if not last:
        limit = min(found[-1][0] if found else start, start + len(chunk) - special - 1)
        tail = [x for x in found if start + len(chunk) - overlap < x[0] <= limit]
    return (len(encoding), [x[0] for x in head], [x[1] for x in head], [x[0] for x in tail], [x[1] for x in tail])


def count_column(text, path: str):
    """Tokens of each text, encoded whole."""

    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        tokenizer, _ = tokenizer_of(path)
        out: list[int] = []
        values = [(t or b"").decode("utf-8", "replace") for t in utf8_values(texts)]
        for k in range(0, len(values), ENCODE_ROWS):
            out += map(len, tokenizer.encode_batch_fast(values[k : k + ENCODE_ROWS], add_special_tokens=False))
        return pa.array(out, pa.int64())

    return count(text)


def _chunks(texts: DataFrame, chunk_chars: int, overlap: int) -> DataFrame:
    """Overlapping chunks of (key, text), each a row of its own, dealt over
    all tasks whatever document they come from."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = CHUNK_SCHEMA.names, [pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), utf8_values(batch.column(1))):
                text = raw.decode("utf-8", "replace")
                rows = []
                step = chunk_chars - overlap
                for number, start in enumerate(range(0, max(1, len(text) - overlap), step)):
                    rows.append((key, number, start + chunk_chars >= len(text), start, text[start : start + chunk_chars]))
                    if len(rows) == 100 or rows[-1][2]:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows = []

    return texts.mapInArrow(cut, CHUNK_SCHEMA).repartition(F.col("key"), F.col("number"))


def _encoded(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ENCODED_SCHEMA.names
        kinds = [pa.binary(), pa.int64(), pa.bool_(), pa.int64()] + [pa.list_(pa.int64())] * 4
        for batch in batches:
            for k in range(0, batch.num_rows, ENCODE_ROWS):
                rows = [(r["key"], r["number"], r["last"], *encode_chunk(path, r["start"], r["chunk"], overlap, r["last"]))
                        for r in batch.slice(k, ENCODE_ROWS).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return chunks.mapInArrow(encode, ENCODED_SCHEMA)


def _spliced(encoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, n_tokens) of the documents whose chunks all align, and the keys of the others."""
    left = encoded.where(~F.col("last")).select("key", F.col("number").alias("left"), "tail_at", "tail_tokens")
    right = encoded.where("number > 0").select("key", (F.col("number") - 1).alias("left"), "head_at", "head_tokens")
    at = F.array_min(F.array_intersect("tail_at", "head_at"))
    joints = left.join(right.hint("merge"), ["key", "left"], "left").withColumn("at", at)
    before = F.element_at("tail_tokens", F.array_position("tail_at", F.col("at")).cast("int"))
    behind = F.element_at("head_tokens", F.array_position("head_at", F.col("at")).cast("int"))
    shares = joints.select("key", F.when(F.col("at").isNotNull(), before - behind).alias("n"),
                           F.col("at").isNull().alias("open"))
    ends = encoded.where("last").select("key", F.col("n_tokens").alias("n"), F.lit(False).alias("open"))
    total = shares.union(ends).groupBy("key").agg(F.sum("n").alias("n_tokens"), F.max("open").alias("open"))
    return total.where(~F.col("open")).select("key", "n_tokens"), total.where("open").select("key")


def count_long(texts: DataFrame, path: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(key, n_tokens) for (key binary, text) rows with unique keys."""
    done = None
    while True:
        encoded = materialise(_encoded(_chunks(texts, chunk_chars, overlap), path, overlap), "token-chunks")
        aligned, failed = _spliced(encoded)
        done = aligned if done is None else done.union(aligned)
        failed = materialise(failed, "token-unaligned")
        if failed.isEmpty():
            return done
        overlap *= WIDEN
        chunk_chars = max(chunk_chars, 2 * overlap)
        texts = texts.join(failed.hint("merge"), "key", "left_semi")


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    rows = bounded(docs).select(F.col(id_col), F.col(text_col).alias("_text"), size.alias("n_bytes"))
    is_long = F.coalesce(F.length("_text") > chunk_chars, F.lit(False))
    short = rows.where(~is_long).select(id_col, "n_bytes", count_column(F.col("_text"), path).alias("n_tokens"))
    long = rows.where(is_long).withColumn("key", F.sha2(F.col("_text").cast("binary"), 256).cast("binary"))
    counts = count_long(long.groupBy("key").agg(F.first("_text").alias("text")), path, chunk_chars, overlap)
    counted = long.select(id_col, "n_bytes", "key").join(counts.hint("merge"), "key").select(id_col, "n_bytes", "n_tokens")
    return short.union(counted).withColumn("over_limit", F.col("n_tokens") > limit)
