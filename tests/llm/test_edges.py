"""Every operator on a table with extra columns of clashing names, on empty tables and on repeated and null rows."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from farebox.llm import (compression_bands, compression_classifier, counterfactual_toxicity, genetic_packing, license_sentences,
                         minhash_dedup, nn_descent, overlap_token_counts, pair_index_bpe, rmq_search, text_tries,
                         url_association, warc)
from farebox.llm.queries import PAGE_RULES
from farebox.session import scratch_path
from tests.conftest import SF_SMALL

# Names that the operators use on the way.
CLASHES = ["_text", "_ids", "_id", "_fit_id", "_doc_id", "_trusted", "_wanted", "id", "key", "part", "mask", "digest", "range", "mark",
           "slot", "shard", "term", "places", "item", "rank", "n", "x", "y", "component", "n_shingles", "kept", "label", "trains",
           "own", "block", "ids", "piece", "start", "length", "number", "chunk", "score", "predicted", "payload", "record_type",
           "listed", "rule", "host", "tokens", "verdict", "uid", "vec", "node", "code", "words", "held_out", "licenses", "rules"]
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def labels(spark):
    return spark.read.parquet(f"{SF_SMALL}/labels.parquet")


OPERATORS = {
    "op1": ("documents", lambda d: compression_bands.quality_report(d, compression_bands.fit_bands(d, labels(d.sparkSession).where("quality = 1")))),
    "op3": ("documents", license_sentences.scan),
    "op4": ("documents", lambda d: compression_classifier.score_documents(d, compression_classifier.fit(d, labels(d.sparkSession)), 0.3)),
    "op5": ("documents", lambda d: counterfactual_toxicity.score_documents(d, counterfactual_toxicity.fit(d, labels(d.sparkSession)), 0.7)),
    "op7": ("documents", minhash_dedup.near_duplicates),
    "op8": ("documents", lambda d: genetic_packing.pack_documents(d, WORDS).select("doc_id", "piece", "length", "ids_crc32")),
    "op9": ("documents", lambda d: pair_index_bpe.round_trip_digests(d, WORDS)),
    "op10": ("documents", lambda d: overlap_token_counts.token_counts(d, BYTES)),
    "op11": ("documents", lambda d: rmq_search.search(rmq_search.build_index(d), d.where("doc_id < 5").withColumnRenamed("doc_id", "item_id"), k=3)),
    "op12": ("documents", lambda d: text_tries.audit(d, labels(d.sparkSession))),
    "op2": ("embeddings", nn_descent.near_vectors),
    "op6": ("pages", lambda d: warc.page_digests(warc.read_warc(d.sparkSession, warc.write_pages(d, scratch_path(d.sparkSession, "w"))))),
    "op13": ("pages", lambda d: url_association.judge_urls(d, PAGE_RULES)),
}


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_empty_tables_repeated_and_null_rows(spark, name):
    table, operator = OPERATORS[name]
    plain = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").limit(60)
    key, body = plain.columns[0], "html" if table == "pages" else plain.columns[1]
    rest = [c for c in plain.columns if c not in (key, body, "source", "url")]
    plain = plain.drop(*rest)
    extra = [c for c in CLASHES if c not in plain.columns]
    assert operator(plain.where("false")).count() == 0
    odd = plain.unionByName(plain.where(f"{key} % 10 = 0")).unionByName(plain.where(f"{key} % 20 = 1").withColumn(key, F.lit(None).cast("long")))
    odd = odd.unionByName(plain.where(f"{key} % 20 = 2").withColumn(body, F.lit(None).cast(plain.schema[body].dataType)))
    want = rows_of(operator(odd))
    assert want
    clashing = odd.select("*", *[F.lit("clash").alias(c) for c in extra])
    assert rows_of(operator(clashing)) == want
    if "source" in clashing.columns:
        assert rows_of(operator(clashing.select(*reversed(clashing.columns)))) == want
