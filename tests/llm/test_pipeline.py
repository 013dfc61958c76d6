"""The pipeline against brute force, stage by stage."""

import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry
import corpus_pipeline
from farebox.llm import compression_bands, compression_classifier
from farebox.llm.common import fold
from farebox.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm.test_compression_bands import brute as brute_counts
from tests.llm.test_genetic_packing import check
from tests.llm.test_minhash_dedup import brute as brute_groups

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                       T.StructField("toxic", T.IntegerType())])


@pytest.fixture(scope="module")
def tables(spark):
    """Small tables with nulls, copies, near copies, junk, an empty and a long text."""
    rng = random.Random(12)
    real = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(real)]
    good = [t for t in real if t and len(t.split()) > 150][:6]
    for t in good:
        words = t.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = "changed"
        rows.append((len(rows), " ".join(words), None, "src1", None))
        rows.append((len(rows), t, "en", None, len(t)))
    rows += [(len(rows), None, None, None, None), (len(rows) + 1, "", "en", "s", 0), (None, good[0], "en", "s", 1),
             (len(rows) + 2, good[1] * 30, "en", "s", 1), (0, real[0], "en", "src0", len(real[0] or ""))]
    path = scratch_path(spark, "pipeline-tables")
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels.items()], LABELS).write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "near_dedup", "packing"]
    steps = dict(corpus_pipeline.STAGES)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")

    kept = steps["quality_rules"](spark, docs, tables)
    assert kept.columns == docs.columns
    import zstandard
    zc = zstandard.ZstdCompressor(level=compression_bands.ZSTD_LEVEL, write_content_size=False, write_checksum=False)
    trusted = spark.read.parquet(f"{tables}/labels.parquet").where("quality = 1")
    bands = compression_bands.fit_bands(docs, trusted)
    want = [r for r in docs.collect() if r.text and not brute_counts(r.text)[5]
            and compression_bands.compression_verdict(r.text.encode(), zc, bands)[2]]
    assert sorted(kept.collect(), key=key) == sorted(want, key=key)

    better = steps["quality_classifier"](spark, kept, tables)
    labels = spark.read.parquet(f"{tables}/labels.parquet").where(fold(5) != 0)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in labels.collect())
    model = compression_classifier.fit(docs, labels)
    scored = compression_classifier.score_documents(kept, model, 0.3).where("predicted = 1")
    assert better.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in better.collect()) == sorted(r.doc_id or -1 for r in scored.collect())

    single = steps["near_dedup"](spark, better, tables)
    assert single.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in better.collect()]
    want = sorted(r[0] for r in brute_groups(rows, 5) if r[-1])
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in single.collect()) == want

    rows = [(r.doc_id, r.text) for r in single.collect()]
    check(rows, steps["packing"](spark, single, tables).collect(), 2048)


def test_run_gives_the_last_stage_and_is_registered(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0 and out.agg({"length": "max"}).first()[0] <= 2048
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert public_tokenizers.path("word_bpe_49k.json").endswith(".json")


def test_empty_tables(spark):
    path = scratch_path(spark, "pipeline-empty")
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_bands_of_the_pipeline_read_every_trusted_text(spark, tables, monkeypatch):
    """Labels that no document has, however many, take no trusted text's place in the fit."""
    docs, labels = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    path = scratch_path(spark, "pipeline-labels")
    docs.write.parquet(f"{path}/documents.parquet")
    strangers = spark.range(1_000_000, 1_100_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    labels.unionByName(strangers).write.parquet(f"{path}/labels.parquet")
    used = []
    keep = compression_bands.keep_good
    monkeypatch.setattr(compression_bands, "keep_good", lambda d, bands: used.append(bands) or keep(d, bands))
    for sf_dir in (tables, path):
        corpus_pipeline.quality_rules(spark, docs, sf_dir).count()
    assert used[0].chunk != compression_bands.CHUNK_BAND and used[1] == used[0]
