"""Quality classifier from compressed sizes.

Two zstandard dictionaries are trained, one on good and one on bad labelled
text.  A text is cut into blocks of ``BLOCK_BYTES`` (a dictionary only helps
while the compressor has seen little else); each block is compressed with
both, and the difference of the two sizes over the larger one, averaged over
the text's bytes, says which class the text is closer to.  A logistic curve
fitted on labelled rows that the dictionaries have not seen turns the
difference into a probability.

Lines that several training texts share say nothing about quality and would
fill both dictionaries, so they are left out of training (never of scoring).

The fit reads a bounded sample of labelled rows, ``FIT_ROWS`` of each class in
the order of a hash of their ids, and of these the whole texts: two thirds are
cut into blocks, of which ``FIT_BLOCKS`` of each class, in the order of a hash,
train its dictionary; the others calibrate.  Only those blocks and one
difference per text reach the driver.  Scoring covers every row and every byte.

Defined results: a null or empty text has difference 0; texts of any length
count whole; rows are scored one by one, so repeated rows (and ties in any
column) score alike and a null id stays null; without labelled texts of both
classes every score is the share of class 1 among the labels (0.5 without any
label); labels other than 0 and 1 are ignored; an empty table gives no rows;
other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import bounded, fresh_name, materialise, utf8_values

FIT_ROWS = 1500
FIT_BLOCKS = 10_000
DICTIONARY_BYTES = 65536
BLOCK_BYTES = 256
SAMPLE_BYTES = 512
ZSTD_LEVEL = 3
# Of each class's sample, one of so many texts calibrates; the others train.
CALIBRATION = 3


def blocks(text: bytes, size: int) -> list[bytes]:
    return [text[k : k + size] for k in range(0, len(text), size)]


def _dictionary(samples: list[bytes]) -> bytes:
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 4)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text to train on: take the text itself
        return b"\n".join(samples)[:DICTIONARY_BYTES]


class SizeDifference:
    """(size with the bad dictionary - size with the good one) / the larger."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.good, self.bad = self._compressor(good), self._compressor(bad)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        trained = zstandard.ZstdCompressionDict(content)
        trained.precompute_compress(level=ZSTD_LEVEL)
        return zstandard.ZstdCompressor(level=ZSTD_LEVEL, dict_data=trained, write_content_size=False,
                                        write_checksum=False, write_dict_id=False)

    def __call__(self, text: bytes | None) -> float:
        if not text:
            return 0.0
        total = 0.0
        for block in blocks(text, BLOCK_BYTES):
            good, bad = len(self.good.compress(block)), len(self.bad.compress(block))
            total += (bad - good) / max(good, bad) * len(block)
        return total / len(text)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a weighted one-variable logistic curve (Newton)."""
    design = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


@dataclass(frozen=True)
class CompressionModel:
    """Dictionaries and calibration; ``slope`` is None when nothing could be fitted."""

    good: bytes = b""
    bad: bytes = b""
    slope: float | None = None
    intercept: float = 0.0
    base_rate: float = 0.5


def fit_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
             rows: int) -> tuple[DataFrame, dict[int, int]]:
    """(label, trains, text) of a bounded sample of each label, and how many rows have each label.

    The sample is the first ``rows`` labelled ids of each class in the order of
    a hash of the id, so it does not depend on partitioning.
    """
    known = labels.select(F.col(id_col).alias("_fit_id"), F.col(label_col).cast("int").alias("label")).where(
        "_fit_id IS NOT NULL AND label IN (0, 1)").distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("_fit_id"), "_fit_id").limit(rows)
        chosen = part if chosen is None else chosen.union(part)
    texts = bounded(docs).select(F.col(id_col).alias("_doc_id"), F.col(text_col).alias("text")).where(F.octet_length("text") > 0)
    trains = F.pmod(F.xxhash64("_doc_id", F.lit(1)), F.lit(CALIBRATION)) > 0
    found = texts.join(F.broadcast(chosen), F.col("_doc_id") == F.col("_fit_id"))  # at most 2 * rows ids
    return materialise(found.select("label", trains.alias("trains"), "text"), "quality-fit"), counts


def _training_blocks(texts: DataFrame) -> dict[int, list[bytes]]:
    """Blocks of the lines that only one text has, by label."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), utf8_values(batch.column("text"))):
                own = sha256(text).digest()
                lines = list(dict.fromkeys(text.split(b"\n")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(lines), pa.int32()), pa.array([own] * len(lines), pa.binary()),
                     pa.array(lines, pa.binary())], names=["label", "own", "line"])

    def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(label, b) for label, line in zip(batch.column("label").to_pylist(), batch.column("line").to_pylist())
                     for b in blocks(line, SAMPLE_BYTES) if len(b) > 16]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())],
                                             names=["label", "block"])

    lines = texts.mapInArrow(cut, "label int, own binary, line binary")
    # Hashed first: the count needs no line to move whole.
    key = F.xxhash64("line")
    shared = lines.select(key.alias("key"), "own").distinct().groupBy("key").count().where("count > 1").select("key")
    own = lines.withColumn("key", key).join(shared.hint("merge"), "key", "left_anti").select("label", "line")
    cut_up = materialise(own.mapInArrow(in_blocks, "label int, block binary"), "quality-blocks")
    return {label: [bytes(r["block"]) for r in cut_up.where(F.col("label") == label)
                    .orderBy(F.xxhash64("block"), "block").limit(FIT_BLOCKS).select("block").collect()] for label in (0, 1)}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rows: int = FIT_ROWS) -> CompressionModel:
    """Train on the texts of ``docs`` that ``labels`` marks 1 (good) or 0 (bad)."""
    table, counts = fit_rows(docs, labels, id_col, text_col, label_col, rows)
    known = sum(counts.values())
    base_rate = counts.get(1, 0) / known if known else 0.5
    samples = _training_blocks(table.where("trains").select("label", "text"))
    if not samples[0] or not samples[1]:
        return CompressionModel(base_rate=base_rate)
    good, bad = _dictionary(samples[1]), _dictionary(samples[0])
    measured = table.where("NOT trains").select("label", _difference(F.col("text"), good, bad).alias("x")).collect()
    measured.sort(key=lambda r: (r["label"], r["x"]))
    x, y = np.array([r["x"] for r in measured]), np.array([r["label"] for r in measured], float)
    sizes = {label: int((y == label).sum()) for label in (0, 1)}
    if not sizes[0] or not sizes[1]:
        return CompressionModel(base_rate=base_rate)
    weight = np.array([counts[r["label"]] / known / sizes[r["label"]] for r in measured])  # the classes at their true shares
    slope, intercept = fit_logistic(x, y, weight * len(x))
    return CompressionModel(good, bad, slope, intercept, base_rate)


def _difference(text: Column, good: bytes, bad: bytes) -> Column:
    @F.arrow_udf(T.DoubleType())
    def difference(texts: pa.Array) -> pa.Array:
        of = SizeDifference(good, bad)
        return pa.array([of(t) for t in utf8_values(texts)], pa.float64())

    return difference(text)


def score_column(text: str | Column, model: CompressionModel) -> Column:
    """Probability of label 1 for each text."""
    if model.slope is None:
        return F.lit(float(model.base_rate))

    logit = F.lit(model.slope) * _difference(text if isinstance(text, Column) else F.col(text), model.good, model.bad) + F.lit(model.intercept)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit))))


def score_documents(docs: DataFrame, model: CompressionModel, threshold: float, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, score, predicted (1 from ``threshold`` on)."""
    scored = bounded(docs).select(F.col(id_col), score_column(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_predicted(docs: DataFrame, model: CompressionModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The documents scored ``threshold`` or more, with the columns they came with."""
    name = fresh_name(docs, "quality_score")
    return bounded(docs).withColumn(name, score_column(F.col(text_col), model)).where(F.col(name) >= threshold).drop(name)
