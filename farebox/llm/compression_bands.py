"""Quality rules with compression bands.

Every text is compressed with zstandard twice: whole, and in fixed chunks.
Repetitive text compresses far better than prose, encoded or random data far
worse, and both ratios depend on how long the text is, so each length has its
own band.  A text is rejected when its whole ratio leaves the band of its
length, or when more than ``MAX_OUTSIDE_SHARE`` of its bytes lie in chunks
that leave the chunk band (bytes after the last full chunk are judged by the
text's last ``CHUNK_BYTES``; a text shorter than a chunk has its whole ratio
only; repetition that long clean text around it would hide in the whole ratio).

``fit_bands`` takes the limits from texts that are trusted: within each
doubling of the length, the whole ratio of trusted texts follows a line in the
logarithm of the length, and the band is ``BAND_SIGMAS`` robust standard
deviations around it; the chunk band lies as far around the median chunk.  A
doubling with fewer than ``MIN_TRUSTED`` trusted texts keeps the fixed wide
limits ``WHOLE_BANDS``, which no prose leaves.  The fit reads all trusted
texts.  Spark counts their ratios by small cells of length and ratio, with the
exact means of each cell; only these counts reach the driver, and the number
of cells is bounded by their widths, not by the texts.

Defined results: a null or empty text has no words and fails the base rules;
texts of any length are compressed whole; rows with equal ids or equal texts
are judged one by one (so ties cannot arise); a null id stays null; without
trusted texts all limits are the fixed ones; an empty table gives no rows;
columns of the input play no part but for the text, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import bounded, fresh_name, materialise, struct_array, utf8_values
from farebox.operators.joins import fits_broadcast

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
REPEAT_WINDOW = 3
SYMBOLS = b"#*$%&|<>"
WHITE_SPACE = b" \t\n\x0b\x0c\r"
ZSTD_LEVEL = 3

# Whole-text bands: UTF-8 length from which a band holds, lowest and highest
# ratio (compressed / raw).  Short texts compress badly whatever they hold,
# which is why the upper limits fall with the length.
WHOLE_BANDS = [
    (0, 0.30, 4.00),
    (256, 0.42, 1.10),
    (512, 0.44, 0.95),
    (1024, 0.40, 0.85),
    (2048, 0.37, 0.78),
    (4096, 0.35, 0.74),
    (16384, 0.32, 0.72),
]
CHUNK_BYTES = 1024
CHUNK_BAND = (0.38, 0.85)
MAX_OUTSIDE_SHARE = 0.2
MIN_TRUSTED = 60
BAND_SIGMAS = 4.0

# The fit holds logarithms of lengths and ratios as whole multiples of 2**-SCALE_BITS,
# whose sums are exact in any order, and counts them by cells of
# 2**-LENGTH_BITS and 2**-RATIO_BITS.
SCALE_BITS = 24
LENGTH_BITS = 4
RATIO_BITS = 12

RESULT_TYPE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(n, T.DoubleType()) for n in ("whole_ratio", "outside_share")]
    + [T.StructField(n, T.BooleanType()) for n in ("base_failed", "kept")]
)


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a ``window``-word sequence found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    key = ids[:n]
    for k in range(1, window):  # renumbered at each step, so the product stays exact
        _, key = np.unique(key, return_inverse=True)
        key = key * np.int64(len(seen)) + ids[k : n + k]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines holding a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(WHITE_SPACE)]
    return len(lines) - len(set(lines))


@dataclass(frozen=True)
class Bands:
    """Limits of the ratios; ``lines`` has, by the doubling of the length, the
    line of the whole ratio and the distance from it that is allowed."""

    lines: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    chunk: tuple[float, float] = CHUNK_BAND

    def whole(self, n_bytes: int) -> tuple[float, float]:
        """Lowest and highest whole ratio of a text of ``n_bytes`` bytes."""
        fitted = self.lines.get(n_bytes.bit_length())
        if fitted is None:
            return WHOLE_BANDS[bisect_right(WHOLE_BANDS, n_bytes, key=lambda band: band[0]) - 1][1:]
        slope, level, reach = fitted
        middle = slope * np.log2(n_bytes) + level
        return middle - reach, middle + reach


def ratio_of(text: bytes, compressor: zstandard.ZstdCompressor) -> float:
    return len(compressor.compress(text)) / len(text) if text else 0.0


def chunk_ratios(text: bytes, compressor: zstandard.ZstdCompressor) -> tuple[list[float], list[int]]:
    """The ratio of each chunk, and the bytes it stands for.  The bytes after the
    last full chunk are judged with as many before them as make a full one."""
    starts = list(range(0, len(text) - CHUNK_BYTES + 1, CHUNK_BYTES))
    weights = [CHUNK_BYTES] * len(starts)
    if starts and len(text) % CHUNK_BYTES:
        starts.append(len(text) - CHUNK_BYTES)
        weights.append(len(text) % CHUNK_BYTES)
    return [ratio_of(text[k : k + CHUNK_BYTES], compressor) for k in starts], weights


def compression_verdict(text: bytes, compressor: zstandard.ZstdCompressor, bands: Bands = Bands()) -> tuple[float, float, bool]:
    """(whole ratio, share of bytes in chunks outside the chunk band, inside the bands)."""
    if not text:
        return 0.0, 0.0, False
    whole = ratio_of(text, compressor)
    low, high = bands.whole(len(text))
    ratios, weights = chunk_ratios(text, compressor)
    least, most = bands.chunk
    outside = sum(w for w, r in zip(weights, ratios) if not least <= r <= most) / len(text)
    return whole, outside, bool(low <= whole <= high and outside <= MAX_OUTSIDE_SHARE)


def new_compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=ZSTD_LEVEL, write_content_size=False, write_checksum=False)


# ---------------------------------------------------------------- fit
def _middle_and_sigma(values: np.ndarray, counts: np.ndarray, least: float) -> tuple[float, float]:
    """Median and robust standard deviation of values that occur ``counts`` times."""
    def median(x: np.ndarray) -> float:
        order = np.argsort(x, kind="stable")
        return float(x[order][np.searchsorted(np.cumsum(counts[order]), counts.sum() / 2)])

    middle = median(values)
    return middle, max(1.4826 * median(np.abs(values - middle)), least)


def _robust_line(x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> tuple[float, float, float]:
    """Slope, level and robust standard deviation of the rest, without the rows far from a first line."""
    use = np.ones(len(x), dtype=bool)
    for _ in range(3):
        slope, level = np.polyfit(x[use], y[use], 1, w=np.sqrt(counts[use])) if np.ptp(x[use]) > 1e-9 else (0.0, 0.0)
        rest = y - slope * x - level
        middle, sigma = _middle_and_sigma(rest[use], counts[use], 2.0**-RATIO_BITS)
        use = np.abs(rest - middle) <= 4 * sigma
    return float(slope), float(level) + middle, sigma


def fit_bands(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int | None = None,
              sigmas: float = BAND_SIGMAS) -> Bands:
    """Bands of the texts of ``docs`` whose ids are in ``trusted`` and that the base rules keep; of all of
    them, unless ``rows`` asks for the first ids in the order of a hash."""
    chosen = trusted.select(F.col(id_col).alias("_id")).where("_id IS NOT NULL").distinct()
    if rows is not None:
        chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = bounded(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = new_compressor()
        for batch in batches:
            found = [(i, len(t), ratio_of(t, compressor), chunk_ratios(t, compressor)[0])
                     for i, t in enumerate(utf8_values(batch.column(1))) if t and not base_counts(t)[-1]]
            at, sizes, wholes, chunks = zip(*found) if found else ((), (), (), ())
            scaled = [np.rint(np.array(v, dtype=float) * 2**SCALE_BITS).astype(np.int64) for v in (np.log2(np.array(sizes, dtype=float)), wholes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array([n.bit_length() for n in sizes], pa.int32()),
                 *map(pa.array, scaled), pa.array(chunks, pa.list_(pa.float64()))], names=["_id", "doubling", "x", "y", "chunks"])

    # Few ids go to the texts; many meet the measured numbers, so that no text is shuffled.
    small = fits_broadcast(chosen)
    if small:
        texts = texts.join(F.broadcast(chosen), "_id", "left_semi")
    kind = T.StructType([texts.schema["_id"], T.StructField("doubling", T.IntegerType()), T.StructField("x", T.LongType()),
                         T.StructField("y", T.LongType()), T.StructField("chunks", T.ArrayType(T.DoubleType()))])
    measured = texts.mapInArrow(measure, kind)
    if not small:
        measured = measured.join(chosen.hint("merge"), "_id", "left_semi")
    table = materialise(measured, "bands-fit")
    cells = table.groupBy("doubling", F.shiftright("x", SCALE_BITS - LENGTH_BITS).alias("length"),
                          F.shiftright("y", SCALE_BITS - RATIO_BITS).alias("ratio")).agg(
        F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"))
    found = cells.toArrow().sort_by([(c, "ascending") for c in ("doubling", "length", "ratio")])  # cells, not texts
    doublings, counts, x, y = (found[c].to_numpy() for c in ("doubling", "n", "x", "y"))
    x, y = x / counts / 2**SCALE_BITS, y / counts / 2**SCALE_BITS
    lines = {}
    for k in np.unique(doublings).tolist():
        own = doublings == k
        if counts[own].sum() >= MIN_TRUSTED:
            slope, level, sigma = _robust_line(x[own], y[own], counts[own])
            lines[k] = (slope, level, sigmas * sigma)
    # A chunk compresses to one of some thousand sizes.
    counted = table.select(F.explode("chunks").alias("r")).groupBy("r").count().orderBy("r").collect()
    chunk = CHUNK_BAND
    if sum(c["count"] for c in counted) >= MIN_TRUSTED:
        middle, sigma = _middle_and_sigma(np.array([c["r"] for c in counted]), np.array([c["count"] for c in counted]), 1 / CHUNK_BYTES)
        chunk = (middle - sigmas * sigma, middle + sigmas * sigma)
    return Bands(lines, chunk)


# ---------------------------------------------------------------- report
def base_counts(text: bytes) -> tuple:
    """Words, their characters, symbols, repeated lines, words in repeated windows, and whether the base rules fail."""
    words = text.split()
    n_words = len(words)
    points = len(text.decode("utf-8", "replace"))
    n_space = len(text) - len(text.translate(None, WHITE_SPACE))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    n_repeat = repeated_words(words)
    failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEATED_PERCENT * n_words
    return n_words, points - n_space, n_symbols, duplicate_lines(text), n_repeat, failed


def text_quality(text: bytes | None, compressor: zstandard.ZstdCompressor, bands: Bands = Bands()) -> tuple:
    """The fields of ``RESULT_TYPE`` for one text."""
    *counts, base_failed = base_counts(text or b"")
    whole, outside, inside = compression_verdict(text or b"", compressor, bands)
    return (*counts, whole, outside, base_failed, inside and not base_failed)


def quality_column(text: str | Column, bands: Bands = Bands()) -> Column:
    """Struct of counts, ratios and verdict of each text (see ``RESULT_TYPE``)."""

    @F.arrow_udf(RESULT_TYPE)
    def quality(texts: pa.Array) -> pa.Array:
        compressor = new_compressor()
        return struct_array([text_quality(t, compressor, bands) for t in utf8_values(texts)], RESULT_TYPE)

    return quality(text)


def quality_report(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the base counts, the ratios and the verdict."""
    report = quality_column(F.col(text_col), bands).alias("_quality")
    return bounded(docs).select(F.col(id_col), report).select(id_col, "_quality.*")


def keep_good(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, with the columns they came with."""
    name = fresh_name(docs, "quality_verdict")
    return bounded(docs).withColumn(name, quality_column(F.col(text_col), bands)).where(F.col(f"{name}.kept")).drop(name)
