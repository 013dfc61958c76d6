"""Toxicity classifier with a counterfactual penalty.

A logistic model over the words of a text (whole words, and word beginnings
of ``PREFIXES`` characters for inflected forms), each present or not.  Words
longer than ``LONG_WORD``, and words of scripts that are written without
blanks, give all their character sequences of ``GRAMS`` characters as well, so
that glued text is read too; no part of a text is left out.  For
every training text that names an identity group, a counterfactual is made by
swapping each identity term of its sentences for another term of the same
family; the loss adds ``PENALTY`` times the squared change of the model's
output between the two.  A group's mere mention therefore cannot move the
score, while abusive words still do.

The fit reads a bounded sample of labelled rows: ``FIT_ROWS`` of each class in
the order of a hash of their ids.  The vocabulary is counted over that sample
with Spark, and only the features that tell the classes apart (``MIN_Z``
standard errors; at most ``VOCABULARY``) and the identity terms reach the
driver; a feature is a string of bounded length, as long words are named by a
digest.  Scoring covers every row, whole.

Defined results: a null or empty text has no words and gets the score of the
intercept; texts and words of any length count whole; rows are scored one by
one, so repeated rows (and ties in any column) score alike and a null id stays
null; without labelled texts of both classes every score is the share of class
1 among the labels (0 without any label); an empty table gives no rows; other
columns play no part, whatever their names.  The order in which features are
summed does not matter (exact sums), so a retried task scores alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import bounded, fresh_name, materialise, utf8_values

FIT_ROWS = 4000
VOCABULARY = 3000
MIN_DOCUMENTS = 4
MIN_Z = 3.0
PREFIXES = (4, 5)
LONG_WORD = 24
GRAMS = (2, 5)
# Fixed value: from here on lie the scripts written without blanks (Thai, Lao,
# Tibetan, Myanmar, Khmer, Chinese, Japanese).
NO_BLANKS_FROM = "\u0e00"
PENALTY = 10.0
RIDGE = 1e-4
EDGE_MARKS = ".,;:!?\"'()[]{}*_-"

# Families of identity terms; a swap stays within its family.
IDENTITY_FAMILIES = (
    ("women", "men", "transgender people", "nonbinary people"),
    ("woman", "man"),
    ("girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "arab", "indigenous"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "transgender"),
    ("immigrant", "refugee", "citizen", "foreigner"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("deaf", "blind", "disabled", "autistic"),
    ("young", "old", "elderly"),
)


def words_of(text: str) -> list[str]:
    """Lower-case words without the punctuation around them."""
    return [w.strip(EDGE_MARKS) for w in text.lower().split()]


def features_of(words: set[str]) -> set[str]:
    """A word, its beginnings and, for glued text, its character sequences;
    beginnings end in '*', sequences in '_', a digest in '-', which no word does."""
    out = set()
    for w in words:
        if w:
            long = len(w) > LONG_WORD
            out.add(blake2b(w.encode("utf-8", "replace"), digest_size=12).hexdigest() + "-" if long else w)
            out.update(w[:n] + "*" for n in PREFIXES if len(w) >= n)
            if long or max(w) >= NO_BLANKS_FROM:
                out.update(w[k : k + n] + "_" for n in GRAMS for k in range(len(w) - n + 1))
    return out


class Swapper:
    """Replaces every identity term by the next one of its family."""

    def __init__(self, families: tuple[tuple[str, ...], ...]) -> None:
        self.next = {}
        for family in families:
            for k, term in enumerate(family):
                self.next.setdefault(term, family[(k + 1) % len(family)])
        terms = sorted(self.next, key=len, reverse=True)
        self.pattern = re.compile(r"\b(?:" + "|".join(map(re.escape, terms)) + r")\b") if terms else None

    def __call__(self, text: str) -> str | None:
        """The counterfactual of a lower-case text, or None without a term."""
        if self.pattern is None:
            return None
        out, n = self.pattern.subn(lambda m: self.next[m[0]], text)
        return out if n else None


@dataclass(frozen=True)
class ToxicityModel:
    """Weight of each feature; ``fitted`` is False when the labels had one class only."""

    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0
    fitted: bool = False
    base_rate: float = 0.0

    def logit(self, text: str | None) -> float:
        if not text:
            return self.intercept
        get = self.weights.get
        return self.intercept + fsum(get(f, 0.0) for f in features_of(set(words_of(text))))


def _fit_table(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int,
               families) -> tuple[DataFrame, dict[int, int]]:
    """(label, features, swapped features) of a bounded sample, and label counts."""
    known = labels.select(F.col(id_col).alias("_fit_id"), F.col(label_col).cast("int").alias("label")).where(
        "_fit_id IS NOT NULL AND label IN (0, 1)").distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("_fit_id"), "_fit_id").limit(rows)
        chosen = part if chosen is None else chosen.union(part)
    found = (bounded(docs).select(F.col(id_col).alias("_doc_id"), F.col(text_col).alias("_text"))
             .join(F.broadcast(chosen), F.col("_doc_id") == F.col("_fit_id"))  # at most 2 * rows ids
             .select("label", "_text"))
    schema = T.StructType([T.StructField("label", T.IntegerType()),
                           T.StructField("features", T.ArrayType(T.StringType())),
                           T.StructField("swapped", T.ArrayType(T.StringType()))])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        swap = Swapper(families)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                out = []
                for label, raw in zip(part.column(0).to_pylist(), utf8_values(part.column(1))):
                    text = (raw or b"").decode("utf-8", "replace").lower()
                    other = swap(text)
                    out.append((label, sorted(features_of(set(words_of(text)))),
                                sorted(features_of(set(words_of(other)))) if other is not None else None))
                names = schema.names
                kinds = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return materialise(found.mapInArrow(extract, schema), "toxicity-fit"), counts


def _vocabulary(table: DataFrame, sizes: dict[int, int], families) -> list[str]:
    """The features that tell the classes apart most, and all identity features."""
    counted = (table.select("label", F.explode("features").alias("feature")).groupBy("feature")
               .agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")))
    p, n = F.lit(float(sizes[1])), F.lit(float(sizes[0]))
    odds = F.log((F.col("pos") + 0.5) / (p - F.col("pos") + 0.5)) - F.log((F.col("neg") + 0.5) / (n - F.col("neg") + 0.5))
    spread = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    best = (counted.where(F.col("pos") + F.col("neg") >= MIN_DOCUMENTS)
            .select("feature", F.abs(odds / spread).alias("z")).where(F.col("z") >= MIN_Z).orderBy(F.col("z").desc(), "feature").limit(VOCABULARY))
    identity = features_of({w for family in families for term in family for w in term.split()})
    return sorted({r["feature"] for r in best.collect()} | identity)


def _matrix(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Present features as (row index, feature index) lists."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return at, np.fromiter((i for r in rows for i in r), dtype=np.int64, count=len(at))


def fit_weights(rows: list[list[int]], y: np.ndarray, weight: np.ndarray, pairs: list[tuple[list[int], list[int]]],
                n_features: int, penalty: float = PENALTY, ridge: float = RIDGE, steps: int = 400) -> np.ndarray:
    """Weights and intercept of the logistic loss plus the counterfactual
    penalty, by Adam on the full (bounded) sample."""
    at, feature = _matrix(rows)
    n_pairs = len(pairs)
    a_at, a_f = _matrix([p[0] for p in pairs])
    b_at, b_f = _matrix([p[1] for p in pairs])
    beta, m, v = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, steps + 1):
        z = np.bincount(at, beta[feature], len(rows)) + beta[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        gradient = np.append(np.bincount(feature, error[at], n_features), error.sum())
        gradient[:-1] += ridge * beta[:-1]
        if n_pairs:
            change = np.bincount(a_at, beta[a_f], n_pairs) - np.bincount(b_at, beta[b_f], n_pairs)
            slope = 2 * penalty * change / n_pairs
            gradient[:-1] += np.bincount(a_f, slope[a_at], n_features) - np.bincount(b_f, slope[b_at], n_features)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        beta -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return beta


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows: int = FIT_ROWS, families=IDENTITY_FAMILIES, penalty: float = PENALTY) -> ToxicityModel:
    table, counts = _fit_table(docs, labels, id_col, text_col, label_col, rows, families)
    sizes = {0: 0, 1: 0} | {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    known = sum(counts.values())
    base_rate = counts.get(1, 0) / known if known else 0.0
    if not sizes[0] or not sizes[1]:
        return ToxicityModel(base_rate=base_rate)
    names = _vocabulary(table, sizes, families)
    place = {f: i for i, f in enumerate(names)}

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def indexes(features: pa.Array) -> pa.Array:
        return pa.array([None if f is None else [place[x] for x in f if x in place] for f in features.to_pylist()],
                        pa.list_(pa.int32()))

    found = table.select("label", indexes("features").alias("here"), indexes("swapped").alias("there")).collect()
    found.sort(key=lambda r: (r["label"], r["here"], r["there"] or []))
    x, y = [r["here"] for r in found], np.array([r["label"] for r in found], float)
    share = {label: 0.5 / sizes[label] for label in (0, 1)}  # both classes count alike: missed abuse costs more
    weight = np.array([share[r["label"]] for r in found])
    pairs = [(r["here"], r["there"]) for r in found if r["there"] is not None]
    beta = fit_weights(x, y, weight, pairs, len(names), penalty)
    weights = {f: float(b) for f, b in zip(names, beta) if abs(b) > 1e-6}
    return ToxicityModel(weights, float(beta[-1]), True, base_rate)


def score_column(text: str | Column, model: ToxicityModel) -> Column:
    """Probability that a text is toxic."""
    if not model.fitted:
        return F.lit(float(model.base_rate))

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        z = [model.logit((t or b"").decode("utf-8", "replace")) for t in utf8_values(texts)]
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -30, 30))), pa.float64())

    return score(text)


def score_documents(docs: DataFrame, model: ToxicityModel, threshold: float, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, score, predicted (1 from ``threshold`` on)."""
    scored = bounded(docs).select(F.col(id_col), score_column(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The documents scored below ``threshold``, with the columns they came with."""
    name = fresh_name(docs, "toxicity_score")
    return bounded(docs).withColumn(name, score_column(F.col(text_col), model)).where(F.col(name) < threshold).drop(name)
