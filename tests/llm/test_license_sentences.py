import re

from pyspark.sql import types as T

from farebox.llm import license_sentences as ls
from farebox.llm import queries
from tests.conftest import SF_MID, explain_text
from tests.oracle_compare import compare, duck

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("rules", T.StringType()), T.StructField("_text", T.StringType())])
MIT = f"{ls.SENTENCES[3]}:\n\n{ls.SENTENCES[4]}.\n\n{ls.SENTENCES[5].upper()}."


def wrapped(text, width):
    lines, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            lines, line = [*lines, line], ""
        line = f"{line} {w}".strip()
    return "\n".join([*lines, line])


def scan(spark, texts):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in texts], SCHEMA)
    return {r.doc_id: tuple(r)[1:] for r in ls.scan(docs).collect()}


def ends_at(sentence, words, at):
    """Where a known sentence that begins at a place ends, each slot as short as can be; None if it does not fit."""
    parts = [re.sub("[^a-z0-9]+", " ", p.lower()).split() for p in re.split("<[a-z]+>", sentence)]

    def fit(k, at):
        if words[at : at + len(parts[k])] != parts[k]:
            return None
        at += len(parts[k])
        if k + 1 == len(parts):
            return at
        return next((e for n in range(1, ls.SLOT_WORDS + 1) if at + n <= len(words) and (e := fit(k + 1, at + n))), None)

    return fit(0, at)


def brute(text):
    """Sentences, rules and licences written the long way, word by word."""
    words = re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")).split()
    order = sorted(ls.SENTENCES, key=lambda i: (-len(re.sub("[^a-z0-9]+", " ", ls.SENTENCES[i].lower()).split()), i))

    def best(at):
        return next(((i, e) for i in order if (e := ends_at(ls.SENTENCES[i], words, at))), None)

    ids, at = [], 0
    while at < len(words):
        denied = words[at] in ("not", "never") and best(at + 1)
        hit = denied or best(at)
        if hit and not denied:
            ids.append(hit[0])
        at = hit[1] if hit else at + 1
    met = [r for r, (_, want) in ls.RULES.items()
           if any(tuple(ids[k : k + len(want)]) == want for k in range(len(ids)))]
    inside = lambda a, b: a != b and len(ls.RULES[b][1]) > len(ls.RULES[a][1]) and any(
        ls.RULES[b][1][k : k + len(ls.RULES[a][1])] == ls.RULES[a][1] for k in range(len(ls.RULES[b][1])))
    met = [r for r in met if not any(inside(r, o) for o in met)]
    return (len(ids), " ".join(map(str, ids)), " ".join(map(str, met)), " ".join(sorted({ls.RULES[r][0] for r in met})))


def test_matches_brute_force(spark):
    texts = [None, "", "  \n", "no such thing here", "Released under the MIT License.", "junk line\nReleased under the MIT license\nmore",
             MIT, wrapped(MIT, 100), "All rights reserved. " + MIT, "Licensed under CC BY-NC 4.0.\nAll rights reserved.",
             "Not released under the MIT License.", "This file is licensed under the MIT License, see there", "not " * 3 + ls.SENTENCES[2],
             "unlicensed under the mit license", "Licensed under the MIT licenses", "It was never all rights reserved; all rights reserved",
             *[s.replace("<holder>", "The Regents of Foo, Inc.") + " " for s in ls.SENTENCES.values()],
             " ".join(s.replace("<holder>", "X") for s in ls.SENTENCES.values()), "This software is provided by as is and any express",
             ls.SENTENCES[31].replace("<holder>", "a " * 12), ls.SENTENCES[31].replace("<holder>", "a " * 13), ls.SENTENCES[46],
             ls.SENTENCES[39].replace("<holder>", "A. U. Thor"),
             "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
             "use this file except in compliance with the License. You may obtain a copy of the License at: x",
             "ALL RIGHTS RESERVED!\nall rights reserved", f"{ls.SENTENCES[4]}.\n{ls.SENTENCES[3]}:", "all rights\nreserved",
             "license " * 30000, "Licensed under CC BY-NC 4.0." + "\nlicence word." * 500, "É all rights reserved\r\n",
             "a\nb\n" + wrapped(ls.SENTENCES[14], 50) + ".\n" + ls.SENTENCES[16] + ". " + ls.SENTENCES[17] + "."]
    got = scan(spark, list(enumerate(texts)))
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert got[6][2:] == ("5", "mit") and got[8][3] == "all-rights-reserved mit"


def test_sentences_wrapped_to_narrow_lines(spark):
    got = scan(spark, [(w, wrapped(MIT, w)) for w in (57, 30, 12, 1)])
    assert set(got.values()) == {(3, "3 4 5", "5", "mit")}


def test_bsd_clauses_with_named_holders(spark):
    two = ". ".join(ls.SENTENCES[k] for k in (25, 26, 27)) + "."
    third = ls.SENTENCES[31].replace("<holder>", "Example Networks, Inc.")
    named = ls.SENTENCES[31].replace("<holder>", "the copyright holder")
    fourth = ls.SENTENCES[46] + " the University of Somewhere.\n4. "
    own = ls.SENTENCES[47].replace("<holder>", "the author")
    texts = [two, f"{two} {third}.", f"All rights reserved. {two} 3. {named}.", f"{two} 3. {fourth}{third}", f"{two} {own}",
             f"(c) 1990\nAll rights reserved.\n\n{two}\n3. {fourth}{own}"]
    got = scan(spark, list(enumerate(texts)))
    assert [got[k][3] for k in range(len(texts))] == ["bsd-2-clause", "bsd-3-clause", "bsd-3-clause", "bsd-4-clause", "bsd-3-clause",
                                                      "bsd-4-clause"]
    narrow = scan(spark, [(k, wrapped(t, 1)) for k, t in enumerate(texts)])
    assert narrow == got


def test_every_licence_is_found_by_its_rules(spark):
    texts = {r: "Some words before. " + ".\n * ".join(ls.SENTENCES[i].replace("<holder>", "Some One") for i in ids) + ". And more"
             for r, (_, ids) in ls.RULES.items()}
    got = scan(spark, list(texts.items()))
    for r, (licence, ids) in ls.RULES.items():
        assert got[r] == (len(ids), " ".join(map(str, ids)), str(r), licence), r
    assert {"lgpl-2.1-or-later", "lgpl-3.0-or-later", "agpl-3.0-or-later", "epl-1.0", "epl-2.0", "cc0-1.0", "zlib", "bsd-4-clause",
            "artistic-2.0"} <= {v[3] for v in got.values()}
    assert {k: v[3] for k, v in scan(spark, [(r, wrapped(t, 1)) for r, t in texts.items()]).items()} == {r: v[3] for r, v in got.items()}


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "All rights reserved", "", ""), (1, "x", "", ""), (1, "x", "", "")], SCHEMA)
    assert sorted((r.doc_id or 0, r.licenses) for r in ls.scan(docs).collect()) == [(0, "all-rights-reserved"), (1, ""), (1, "")]
    assert ls.scan(docs.limit(0)).count() == 0


def test_every_known_sentence_holds_a_mark():
    words = [ls.normalised(ls.SLOT.sub(" ", s)) for s in ls.SENTENCES.values()]
    assert [s for s in words if not any(m in s for m in ls.MARKS)] == [] and all(" " not in m for m in ls.MARKS)
    assert len(set(map(ls.pattern_of, ls.SENTENCES.values()))) == len(ls.SENTENCES)
    assert all(i in ls.SENTENCES for _, ids in ls.RULES.values() for i in ids)
    assert len({ids for _, ids in ls.RULES.values()}) == len(ls.RULES)


def test_wrapped_texts_match_sql(spark, tmp_path):
    """The SQL twin over texts wrapped to one word a line, with slots, denials and in-line sentences."""
    whole = [s.replace("<holder>", "Some One") for s in ls.SENTENCES.values()]
    texts = [*whole, MIT, " ".join(whole), "not " + whole[1], "This file is licensed under the MIT License", None, "", *map(wrapped, whole, [1] * len(whole))]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(
        f"{tmp_path}/documents.parquet")
    con = duck(SF_MID)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    name = "op3_license_sentences"
    ok, msg = compare(spark, con, name, queries.LLM_QUERIES[name], queries.LLM_ORACLE[name], str(tmp_path))
    assert ok, msg


def test_plan_is_native(spark):
    plan = explain_text(queries.LLM_QUERIES["op3_license_sentences"](spark, SF_MID), "simple")
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query_matches_sql(spark):
    name = "op3_license_sentences"
    ok, msg = compare(spark, duck(SF_MID), name, queries.LLM_QUERIES[name], queries.LLM_ORACLE[name], SF_MID)
    assert ok, msg
