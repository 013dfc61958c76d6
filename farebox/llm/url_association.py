"""URL filters: listed rules first, then association rules mined by pattern growth.

A listed rule names a host and the beginning of a path; it fits that host and
its subdomains, and the longest rule that fits decides.  The urls that a
listed rule decides are the labelled ones: from their tokens (scheme, host
labels and their words, top-level domain, path parts with digits made alike,
query keys) combinations are mined that go with one verdict.  A
combination becomes a rule with ``MIN_CONFIDENCE`` and enough support, unless
a rule with one token less and the same verdict is as sure.  Rules match by an
inverted index: each is listed under its rarest token, so a url meets only
rules listed under one of its tokens, and those whose every token it has
apply.  The surest decides, then the best supported, then block before allow;
a url without any is allowed.

The fit counts every distinct labelled url once, so copies of one url are one
piece of evidence, with all of its frequent tokens.  Combinations grow by one
token at a time, as in FP-growth over projected baskets (a combination and the
tokens after it), each step a shuffle.  Two kinds are dropped with all that
contain them, which loses no rule, as a rule with one token less is as sure:
combinations that one of their tokens does not narrow (as many urls have the
others alone), and those that contain a combination of one verdict only.  So
tokens that always come together do not multiply.

Defined results: a null url, or one without ``://``, has an empty host and path
and no tokens, so no rule applies and it is allowed; urls of any length are
read whole; repeated rows are judged alike, each once; a null id stays null;
without labelled urls nothing is mined; an empty table gives no rows; other
columns play no part, whatever their names.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import materialise
from farebox.operators.joins import fits_broadcast, lookup_join, lookup_side

MIN_SUPPORT = 0.005
MIN_URLS = 5
MIN_CONFIDENCE = 0.8
MAX_TOKENS = 12  # of the SQL twin only, which lists all subsets: it holds for urls of up to so many frequent tokens

ListedRules = list[tuple[str, str]]  # (verdict, host and path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first ``://`` and the path, lower-cased, and the path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda n: F.coalesce(F.regexp_extract(url, pattern, n), F.lit(""))
    return lower_ascii(part(1)), part(2)


def listed_rule(host: Column, path: Column, rules: ListedRules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, else nulls; block wins a tie."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for way, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):  # the last one applied wins
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, way).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a url."""
    def tagged(tag: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(tag + "="), p))

    labels = F.split(host, r"\.")
    words = F.filter(F.split(host, "[.-]"), lambda w: ~F.array_contains(labels, w))
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    return F.array_distinct(F.concat(
        tagged("scheme", F.array(lower_ascii(F.regexp_extract(url, r"(?s)^(.*?)://", 1)))),
        tagged("host", labels), tagged("word", words), tagged("top", F.array(F.element_at(labels, -1))),
        tagged("path", F.transform(F.split(lower_ascii(path), "/"), lambda p: F.regexp_replace(p, "[0-9]+", "0"))),
        tagged("query", keys)))


def _grown(held: DataFrame) -> DataFrame:
    """Baskets (items, tail, verdict, urls) with one more item: each token of the tail in turn, with the tail after it."""
    return held.select("items", "tail", "verdict", "urls", F.posexplode("tail").alias("at", "token")).select(
        F.array_append("items", F.col("token")).alias("items"),
        F.slice("tail", F.col("at") + 2, F.greatest(F.size("tail") - F.col("at") - 1, F.lit(0))).alias("tail"), "verdict", "urls")


def _counted(baskets: DataFrame, least: int) -> DataFrame:
    """(items, n, ways) of the combinations that ``least`` urls of one verdict have: their urls, in all and by verdict."""
    by_verdict = baskets.groupBy("items", "verdict").agg(F.sum("urls").alias("support"))
    return by_verdict.groupBy("items").agg(
        F.sum("support").alias("n"), F.collect_list(F.struct("verdict", "support")).alias("ways")).where(
        F.exists("ways", lambda w: w.support >= least))


def _narrowing(counted: DataFrame, open_sets: DataFrame) -> DataFrame:
    """Those of ``counted`` of which every part with one token less is among ``open_sets`` and has more urls."""
    parts = counted.select("items", "n", F.explode("items").alias("left_out")).select(
        "items", "n", F.array_remove("items", F.col("left_out")).alias("part"))
    whole = open_sets.select(F.col("items").alias("part"), F.col("n").alias("part_urls"))
    kept = parts.join(whole.hint("merge"), "part").where("part_urls > n").groupBy("items").agg(F.count("*").alias("parts"))
    return counted.join(kept.where("parts = size(items)").select("items").hint("merge"), "items")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_urls: int = MIN_URLS,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules from distinct (url, tokens, verdict) rows: (tokens, verdict, confidence, support, anchor)."""
    spark = labelled.sparkSession
    found = "tokens array<string>, verdict string, confidence double, support long, anchor string"
    labelled = materialise(labelled.dropDuplicates(["url"]), "labelled-urls")
    n_urls = labelled.count()
    least = max(min_urls, math.ceil(min_support * n_urls))
    if n_urls < least:
        return spark.createDataFrame([], found)
    each = labelled.select("url", "verdict", F.explode("tokens").alias("token"))
    frequent = materialise(each.groupBy("token").agg(F.count("*").alias("urls")).where(F.col("urls") >= least), "url-tokens")
    # A group here is one url; urls with the same frequent tokens and verdict are one basket from then on.
    tails = lookup_join(each, frequent, ["token"]).groupBy("url", "verdict").agg(F.sort_array(F.collect_list("token")).alias("tail"))
    baskets = tails.groupBy("tail", "verdict").agg(F.count("*").alias("urls"))
    held = materialise(baskets.select(F.array().cast("array<string>").alias("items"), "tail", "verdict", "urls"), "url-baskets")
    sets, open_sets = None, None
    while True:
        counted = _counted(_grown(held), least)
        counted = materialise(counted if open_sets is None else _narrowing(counted, open_sets), "url-sets")
        sets = counted if sets is None else sets.unionByName(counted)
        open_sets = counted.where(F.size("ways") > 1)
        if open_sets.isEmpty():
            break
        keys = open_sets.select("items")
        small = fits_broadcast(keys.select(F.concat_ws("", "items").alias("text")))
        grown = _grown(held).where(F.size("tail") > 0).join(lookup_side(keys, small), "items")
        held = materialise(grown.groupBy("items", "tail", "verdict").agg(F.sum("urls").alias("urls")), "url-baskets")
    rules = sets.select("items", "n", F.explode("ways").alias("w")).select(
        F.col("items").alias("tokens"), "w.verdict", (F.col("w.support") / F.col("n")).alias("confidence"), "w.support")
    rules = materialise(rules.where((F.col("support") >= least) & (F.col("confidence") >= min_confidence)), "url-rules")
    # Not needed: one token less is as sure.
    wider = rules.select(F.col("tokens").alias("kept"), "verdict", F.col("confidence").alias("as_sure"))
    narrower = rules.select("*", F.explode("tokens").alias("left_out")).withColumn(
        "kept", F.array_remove("tokens", F.col("left_out")))
    redundant = narrower.join(wider.hint("merge"), ["kept", "verdict"]).where("as_sure >= confidence")
    rules = rules.join(redundant.select("tokens", "verdict").distinct().hint("merge"), ["tokens", "verdict"], "left_anti")
    anchors = lookup_join(rules.select("tokens", F.explode("tokens").alias("token")).distinct(), frequent, ["token"])
    anchors = anchors.groupBy("tokens").agg(F.min(F.struct("urls", "token")).alias("rarest"))
    rules = rules.join(anchors.hint("merge"), "tokens").select(
        "tokens", "verdict", "confidence", "support", F.col("rarest.token").alias("anchor"))
    return materialise(rules, "url-index")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The rule that decides each distinct url of (url, tokens): (url, verdict, mined, confidence); none, no row."""
    small = fits_broadcast(rules.select(F.concat_ws("", "tokens", "verdict", "anchor").alias("text"), "confidence", "support"))
    posted = urls.select("url", F.col("tokens").alias("own"), F.explode("tokens").alias("anchor"))
    met = posted.join(lookup_side(rules, small), "anchor").where(F.forall("tokens", lambda t: F.array_contains("own", t)))
    best = F.min(F.struct((-F.col("confidence")).alias("doubt"), (-F.col("support")).alias("rarity"),
                          (F.col("verdict") != "block").alias("mild"), F.array_join("tokens", " ").alias("mined"), "verdict"))
    return met.groupBy("url").agg(best.alias("b")).select("url", "b.verdict", "b.mined", (-F.col("b.doubt")).alias("confidence"))


def judge_urls(pages: DataFrame, rules: ListedRules, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: (id, host, path, rule, verdict, mined, confidence)."""
    plain = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    parts = plain.select(id_col, "url", host.alias("host"), path.alias("path"))
    rule, listed = listed_rule(F.col("host"), F.col("path"), rules)
    judged = materialise(parts.select("*", rule.alias("rule"), listed.alias("listed")), "urls")
    distinct = judged.where("host <> '' OR path <> ''").select("url", "host", "path", F.col("listed").alias("verdict")).distinct()
    tokens = distinct.select("url", "verdict", url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    mined = mine_rules(tokens.where("verdict IS NOT NULL"))
    found = materialise(match_rules(tokens.where("verdict IS NULL"), mined), "url-verdicts")
    out = lookup_join(judged, found, ["url"], "left")
    return out.select(id_col, "host", "path", "rule", F.coalesce("listed", "verdict", F.lit("allow")).alias("verdict"),
                      "mined", "confidence")


def oracle_sql(rules: ListedRules) -> str:
    """DuckDB SQL for ``judge_urls`` over ``pages``: all combinations of each url's tokens are counted one by one."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block"))
    fits = [(way, text, *text.partition("/")) for way, text in ordered]
    cases = " ".join(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}') THEN '{text}'"
                     for _, text, name, slash, rest in fits)
    ways = " ".join(f"WHEN rule = '{text}' THEN '{way}'" for way, text, *_ in fits)
    low = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return rf"""
WITH RECURSIVE parts AS (
    SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), {low}) AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
),
ruled AS (SELECT *, CASE {cases} END AS rule FROM parts),
judged AS (SELECT *, CASE {ways} END AS listed FROM ruled),
tokens AS (
    SELECT url, listed, list_distinct(
        ['scheme=' || s FOR s IN [translate(regexp_extract(url, '(?s)^(.*?)://', 1), {low})] IF s <> '']
        || ['host=' || l FOR l IN string_split(host, '.') IF l <> '']
        || ['word=' || w FOR w IN string_split_regex(host, '[.-]') IF w <> '' AND NOT list_contains(string_split(host, '.'), w)]
        || ['top=' || t FOR t IN [string_split(host, '.')[-1]] IF t <> '']
        || ['path=' || regexp_replace(p, '[0-9]+', '0', 'g') FOR p IN string_split(translate(path, {low}), '/') IF p <> '']
        || ['query=' || k FOR k IN [string_split(q, '=')[1] FOR q IN
              string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&')] IF k <> '']) AS tokens
    FROM (SELECT DISTINCT url, host, path, listed FROM judged WHERE host <> '' OR path <> '')
),
least AS (
    SELECT greatest({MIN_URLS}, CAST(ceil({MIN_SUPPORT} * count(*)) AS BIGINT)) AS least FROM tokens WHERE listed IS NOT NULL
),
each AS (SELECT url, listed, unnest(tokens) AS token FROM tokens WHERE listed IS NOT NULL),
frequent AS (SELECT token, count(*) AS urls FROM each GROUP BY token HAVING count(*) >= (SELECT least FROM least)),
chosen AS (
    SELECT url, listed, token FROM each JOIN frequent USING (token)
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY urls DESC, token) <= {MAX_TOKENS}
),
members AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY token) AS k FROM chosen),
subsets(url, listed, k, items) AS (
    SELECT url, listed, k, [token] FROM members
    UNION ALL
    SELECT s.url, s.listed, m.k, list_append(s.items, m.token) FROM subsets s JOIN members m ON m.url = s.url AND m.k > s.k
),
counted AS (SELECT items, count(*) AS n FROM subsets GROUP BY items),
rules AS (
    SELECT items, listed AS verdict, count(*) AS support, count(*) / any_value(n)::DOUBLE AS confidence
    FROM subsets JOIN counted USING (items) GROUP BY items, listed
    HAVING count(*) >= (SELECT least FROM least) AND count(*) / any_value(n)::DOUBLE >= {MIN_CONFIDENCE}
),
needed AS (
    SELECT * FROM rules r WHERE NOT EXISTS (
        SELECT 1 FROM rules w WHERE w.verdict = r.verdict AND w.confidence >= r.confidence
        AND len(w.items) = len(r.items) - 1 AND list_has_all(r.items, w.items))
),
found AS (
    SELECT t.url, n.verdict, array_to_string(n.items, ' ') AS mined, n.confidence
    FROM tokens t JOIN needed n ON t.listed IS NULL AND list_has_all(t.tokens, n.items)
    QUALIFY row_number() OVER (PARTITION BY t.url ORDER BY n.confidence DESC, n.support DESC, n.verdict DESC,
                               array_to_string(n.items, ' ')) = 1
)
SELECT page_id, host, path, rule, coalesce(listed, verdict, 'allow') AS verdict, mined, confidence
FROM judged LEFT JOIN found USING (url)
"""
