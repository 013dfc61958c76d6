"""Registered queries of the training-data operators and their SQL twins.

Each query applies one operator, with its production parameters, to its whole
table.  ``LLM_ORACLE`` has DuckDB SQL where SQL can express the operator; the
others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import (compression_bands, compression_classifier, counterfactual_toxicity, genetic_packing,
                         license_sentences, minhash_dedup, nn_descent, overlap_token_counts, pair_index_bpe, rmq_search, text_tries, url_association, warc)
from farebox.llm.common import fold, read_table
from farebox.session import scratch_path

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def register(name: str):
    def wrap(fn):
        LLM_QUERIES[name] = fn
        return fn
    return wrap


def held_out(rest: Column) -> Column:
    """The held-out mark; a row with a null id has no remainder and is not held out (nor can a label name it)."""
    return F.coalesce(rest, F.lit(False)).alias("held_out")


@register("op1_compression_bands")
def op1_compression_bands(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    bands = compression_bands.fit_bands(docs, labels.where("quality = 1"))
    return compression_bands.quality_report(docs, bands)


@register("op7_minhash_dedup")
def op7_minhash_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return minhash_dedup.near_duplicates(docs, words_per_shingle=4, threshold_percent=80)


@register("op2_nn_descent")
def op2_nn_descent(spark, sf_dir):
    return nn_descent.near_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.95)


LLM_ORACLE["op2_nn_descent"] = """
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS n, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
usable AS (
    SELECT n, vec_id, e, sqrt(list_sum([x * x FOR x IN e])) AS norm FROM rows
    WHERE e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN e IF x <> 0]) > 0
),
links AS (
    SELECT a.n AS a, b.n AS b, a.vec_id AS a_id, b.vec_id AS b_id FROM usable a JOIN usable b
    ON a.n <> b.n AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
),
reach(n, id) AS (
    SELECT n, vec_id FROM usable
    UNION
    SELECT l.a, r.id FROM reach r JOIN links l ON l.b = r.n
),
smallest AS (SELECT n, min(id) AS component_id FROM reach GROUP BY n),
degree AS (SELECT a AS n, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(vec_id = coalesce(component_id, vec_id), true) AS kept
FROM rows LEFT JOIN degree USING (n) LEFT JOIN smallest USING (n)
"""


@register("op3_license_sentences")
def op3_license_sentences(spark, sf_dir):
    return license_sentences.scan(read_table(spark, sf_dir, "documents"))


LLM_ORACLE["op3_license_sentences"] = license_sentences.oracle_sql()


@register("op4_compression_classifier")
def op4_compression_classifier(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = compression_classifier.fit(docs, labels.where(fold(5) != 0))
    scored = compression_classifier.score_documents(docs, model, threshold=0.3)
    return scored.select("doc_id", held_out(fold(5) == 0), "score", "predicted")


@register("op5_counterfactual_toxicity")
def op5_counterfactual_toxicity(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = counterfactual_toxicity.fit(docs, labels.where(fold(3) != 1))
    scored = counterfactual_toxicity.score_documents(docs, model, threshold=0.7)
    return scored.select("doc_id", held_out(fold(3) == 1), "score", "predicted")


@register("op6_warc")
def op6_warc(spark, sf_dir):
    path = warc.write_pages(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.page_digests(warc.read_warc(spark, path))


@register("op8_genetic_packing")
def op8_genetic_packing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return genetic_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


@register("op9_pair_index_bpe")
def op9_pair_index_bpe(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return pair_index_bpe.round_trip_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


@register("op10_overlap_token_counts")
def op10_overlap_token_counts(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return overlap_token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@register("op11_rmq_search")
def op11_rmq_search(spark, sf_dir):
    index = rmq_search.build_index(read_table(spark, sf_dir, "documents"))
    return rmq_search.search(index, read_table(spark, sf_dir, "benchmark"), k=10)


LLM_ORACLE["op11_rmq_search"] = rmq_search.oracle_sql(k=10)


@register("op12_text_tries")
def op12_text_tries(spark, sf_dir):
    return text_tries.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


LLM_ORACLE["op12_text_tries"] = text_tries.oracle_sql()


# The rules that the verdicts of pages start from.
PAGE_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
              ("block", "com/de/")]


@register("op13_url_association")
def op13_url_association(spark, sf_dir):
    return url_association.judge_urls(read_table(spark, sf_dir, "pages"), PAGE_RULES)


LLM_ORACLE["op13_url_association"] = url_association.oracle_sql(PAGE_RULES)


LLM_ORACLE["op6_warc"] = """
WITH base AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
),
digests AS (
    SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM base
),
firsts AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
    FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""


LLM_ORACLE["op7_minhash_dedup"] = r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS n, doc_id,
           [w FOR w IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+') IF w <> ''] AS words
    FROM documents
),
shingles AS (
    SELECT DISTINCT n, doc_id, unnest(CASE WHEN len(words) = 0 THEN []
                                           WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                                           ELSE [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)]
                                      END) AS shingle
    FROM docs
),
sizes AS (SELECT n, any_value(doc_id) AS doc_id, count(*) AS size FROM shingles GROUP BY n),
common_counts AS (
    SELECT a.n AS a, b.n AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.n < b.n GROUP BY a.n, b.n
),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM common_counts o JOIN sizes x ON x.n = o.a JOIN sizes y ON y.n = o.b
    WHERE 100 * common >= 80 * (x.size + y.size - common) AND x.doc_id IS NOT NULL AND y.doc_id IS NOT NULL
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, id) AS (
    SELECT doc_id, doc_id FROM documents WHERE doc_id IS NOT NULL
    UNION
    SELECT l.a, r.id FROM reach r JOIN both_ways l ON l.b = r.doc_id
),
smallest AS (SELECT doc_id, min(id) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(size, 0) AS n_shingles, component_id, coalesce(d.doc_id = component_id, true) AS kept
FROM docs d LEFT JOIN sizes USING (n) LEFT JOIN smallest s ON s.doc_id = d.doc_id
"""
