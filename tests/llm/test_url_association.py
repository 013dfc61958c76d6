import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm import url_association as ua
from farebox.llm.queries import PAGE_RULES
from tests.oracle_compare import compare, duck

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("verdict", T.StringType()), T.StructField("token", T.StringType())])

CASES = {
    "http://ORG/x": ("org", "/x", "org/"),
    "http://a.example.ORG/es/1?q#f": ("a.example.org", "/es/1", "example.org/es/"),
    "http://example.org/es": ("example.org", "/es", "org/"),
    "http://example.org/en/1": ("example.org", "/en/1", "example.org/en/1"),
    "http://example.org/en/199?x=/en": ("example.org", "/en/199", "example.org/en/1"),
    "http://badexample.org/es/": ("badexample.org", "/es/", "org/"),
    "http://x.com/fr/": ("x.com", "/fr/", "com/fr/"),
    "http://x.com/frx": ("x.com", "/frx", None),
    "http://x.com:80/de/": ("x.com:80", "/de/", None),
    "http://org?a": ("org", "", None),
    "http://org": ("org", "", None),
    "ftp://u@h.org/a://b/c": ("u@h.org", "/a://b/c", "org/"),
    "a\nb://com/de/\nx": ("com", "/de/\nx", "com/de/"),
    "no scheme": ("", "", None),
    "://": ("", "", None),
    "": ("", "", None),
}


def test_hosts_paths_and_listed_rules(spark):
    df = spark.createDataFrame([(i, u, "", "") for i, u in enumerate([*CASES, None])], PAGES)
    out = {r.page_id: (r.host, r.path, r.rule) for r in ua.judge_urls(df, PAGE_RULES).collect()}
    assert [out[i] for i in range(len(CASES))] == list(CASES.values()) and out[len(CASES)] == ("", "", None)


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], PAGES)


def test_mined_rules_judge_the_rest(spark):
    urls = [f"http://h{i % 7}.example.org/{lang}/{200 + i}" for i, lang in enumerate(["es", "fr", "de"] * 40)]
    urls += [f"http://site{i}.net/es/{i}" for i in range(5)] + [f"http://site{i}.net/pt/{i}" for i in range(5)]
    out = ua.judge_urls(pages(spark, urls), PAGE_RULES)
    verdicts = {(r.rule is None, r.url.split("/")[3]): (r.verdict, r.mined, r.confidence)
                for r in out.join(pages(spark, urls).select("page_id", "url"), "page_id").collect()}
    assert verdicts[False, "es"] == ("block", None, None) and verdicts[False, "de"] == ("allow", None, None)
    assert verdicts[True, "es"] == ("block", "path=es", 1.0)
    assert verdicts[True, "pt"][0] == "allow"


def test_copies_are_one_piece_of_evidence_and_null_ids_stay(spark):
    urls = ["http://a.org/x/1"] * 400 + [None] * 50 + ["http://b.net/x/1"] * 400
    out = ua.judge_urls(pages(spark, urls), PAGE_RULES)
    assert out.count() == 850 and out.where("mined IS NOT NULL").count() == 0
    nulls = spark.createDataFrame([(None, "http://a.org/", "", ""), (None, "http://a.org/", "", ""), (1, None, "", "")], PAGES)
    assert sorted(map(str, ua.judge_urls(nulls, PAGE_RULES).select("page_id", "verdict").collect())) == [
        "Row(page_id=1, verdict='allow')", "Row(page_id=None, verdict='allow')", "Row(page_id=None, verdict='allow')"]
    assert ua.judge_urls(nulls.where("false"), PAGE_RULES).count() == 0


def test_many_tokens_in_one_family_stay_bounded(spark):
    deep = "/".join(f"p{chr(97 + i)}" for i in range(20))
    urls = [f"http://a.org/{deep}/{i}" for i in range(60)] + [f"http://a.net/{deep}/{i}" for i in range(3)]
    urls += ["http://long.net/" + "x/" * 5000, "http://x.org/" + "y" * 100_000]
    out = ua.judge_urls(pages(spark, urls), PAGE_RULES)
    assert {r.verdict for r in out.collect()} == {"allow"} and out.count() == len(urls)


def test_held_out_listed_urls(spark):
    """Mined from three quarters of the listed urls, the rules agree with the lists on most of the rest they reach."""
    table = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    host, path = ua.host_and_path(F.col("url"))
    parts = table.select("url", host.alias("host"), path.alias("path")).distinct()
    _, verdict = ua.listed_rule(F.col("host"), F.col("path"), PAGE_RULES)
    rows = parts.select("url", verdict.alias("verdict"), ua.url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    rows = rows.where("verdict IS NOT NULL").withColumn("held_out", F.crc32("url") % 4 == 0)
    rules = ua.mine_rules(rows.where("NOT held_out").drop("held_out"))
    test = rows.where("held_out").select("url", "tokens", F.col("verdict").alias("truth"))
    judged = test.join(ua.match_rules(test, rules), "url").collect()
    assert len(judged) > 200
    assert sum(r.verdict == r.truth for r in judged) >= 0.8 * len(judged)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_duckdb(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    query = lambda s, d: ua.judge_urls(s.read.parquet(f"{d}/pages.parquet"), PAGE_RULES)
    ok, why = compare(spark, duck(sf_dir), "op13", query, ua.oracle_sql(PAGE_RULES), sf_dir)
    assert ok, why


def test_rare_tokens_of_long_urls_are_mined(spark):
    """Fourteen parts that all urls share do not keep the one that decides out of the mining."""
    deep = "/".join(f"p{chr(97 + i)}" for i in range(14))
    urls = [f"http://example.org/es/{deep}/bad/{i}" for i in range(20)] + [f"http://example.org/pt/{deep}/ok/{i}" for i in range(40)]
    urls += [f"http://x.net/{deep}/bad/7", f"http://x.net/{deep}/ok/7"]
    out = {r.page_id: (r.verdict, r.mined) for r in ua.judge_urls(pages(spark, urls), PAGE_RULES).collect()}
    assert out[60] == ("block", "path=bad") and out[61][0] == "allow"


def test_rules_equal_those_of_all_combinations(spark):
    """Up to sixteen frequent tokens a url, some of which always or nearly always come together."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        bad = rng.random() < 0.5
        own = {t for t in "abcdefgh" if rng.random() < (0.5 if bad or t > "c" else 0.25)} | set("uvwxyz") | set("mn"[: 1 + i % 2])
        rows.append((f"u{i}", sorted(own), "block" if bad != (rng.random() < 0.1) else "allow"))
    rules = ua.mine_rules(spark.createDataFrame(rows, "url string, tokens array<string>, verdict string"), min_urls=6, min_confidence=0.7)
    counts = {}
    for _, tokens, verdict in rows:
        for k in range(1, len(tokens) + 1):
            for items in combinations(tokens, k):
                counts.setdefault(items, {}).setdefault(verdict, []).append(1)
    sure = {(items, v): len(n) / sum(map(len, ways.values())) for items, ways in counts.items() for v, n in ways.items() if len(n) >= 6}
    sure = {k: c for k, c in sure.items() if c >= 0.7}
    want = {(items, v, c, len(counts[items][v])) for (items, v), c in sure.items()
            if not any(sure.get((items[:i] + items[i + 1 :], v), 0) >= c for i in range(len(items)))}
    assert max(len(r[1]) for r in rows) > 12 and len(want) > 20 and max(len(w[0]) for w in want) > 2
    assert {(tuple(r.tokens), r.verdict, r.confidence, r.support) for r in rules.collect()} == want
