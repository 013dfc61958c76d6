"""Licence scan by sentence rules, in DataFrame functions alone.

A text is normalised to its lower-case ASCII words between single blanks, so
neither punctuation nor line ends matter: a sentence is found however it is
wrapped, and also within a longer one ("this file is licensed under the MIT
License").  The known licence sentences are found in it from left to right; at
each place the sentence of the most words counts, and the search goes on
behind it.  A sentence may have slots, ``<holder>``, for one to ``SLOT_WORDS``
words of any kind, as where a licence names its organisation.  A sentence right
behind "not" or "never" is none.  The identifiers found, in order, are matched
against the licence rules, each an ordered list of sentence identifiers that
must follow one another (other text between them is no obstacle).  Of the rules
that match a text, those that are part of a longer matching rule are left out.

Every known sentence holds one of ``MARKS``, so a text without any of them is
settled by a substring search, and no row is ever shuffled.

Defined results: a null or empty text has no sentences, rules or licences
(empty strings); texts of any length are scanned whole; rows with equal or null
ids are scanned one by one, so ties cannot arise; an empty table gives no rows;
other columns play no part, whatever their names.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_WORDS = 12
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = "[^a-z0-9]+"
SLOT = re.compile("<[a-z]+>")
DENIALS = ("not", "never")
MARKS = ("licens", "reserved", "copyright", "warrant", "permission", "redistribut", "unencumbered", "advertising",
         "misrepresented", "altered")  # single words

# Sentences of public licences and notices by identifier; a word
# in angle brackets is a slot.
SENTENCES = {
    1: "Released under the MIT License",
    2: "Licensed under the MIT License",
    3: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
       "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
       "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    4: "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
       "of the Software",
    5: "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited "
       "to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    6: "Licensed under the Apache License, Version 2.0",
    7: "Licensed under the Apache License, Version 2.0 (the \"License\")",
    8: "you may not use this file except in compliance with the License",
    9: "You may obtain a copy of the License at",
    10: "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    11: "See the License for the specific language governing permissions and limitations under the License",
    12: "This work is licensed under the GNU General Public License, version 3",
    13: "This work is licensed under the GNU General Public License, version 2",
    14: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    15: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    16: "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    17: "See the GNU General Public License for more details",
    18: "Licensed under CC BY-NC 4.0",
    19: "Licensed under CC BY 4.0",
    20: "Licensed under CC BY-SA 4.0",
    21: "This work is licensed under a Creative Commons Attribution 4.0 International License",
    22: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    23: "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    24: "All rights reserved",
    25: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    26: "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
    27: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
    28: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    29: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    30: "This is free and unencumbered software released into the public domain",
    31: "Neither the name of <holder> nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
    32: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
        "by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version",
    33: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    34: "See the GNU Lesser General Public License for more details",
    35: "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    36: "See the GNU Affero General Public License for more details",
    37: "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    38: "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    39: "To the extent possible under law, <holder> has waived all copyright and related or neighboring rights",
    40: "Licensed under CC0 1.0",
    41: "This software is provided 'as-is', without any express or implied warranty",
    42: "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions",
    43: "The origin of this software must not be misrepresented",
    44: "Altered source versions must be plainly marked as such",
    45: "This notice may not be removed or altered from any source distribution",
    46: "All advertising materials mentioning features or use of this software must display the following "
        "acknowledgement: This product includes software developed by",
    47: "The name of <holder> may not be used to endorse or promote products derived from this software without specific "
        "prior written permission",
    48: "This software is provided by <holder> \"as is\" and any express or implied warranties",
    49: "you can redistribute it and/or modify it under the terms of the Artistic License 2.0",
    50: "you can redistribute it and/or modify it under the same terms as Perl itself, either license",
    51: "Licensed under the GNU General Public License, version 2",
    52: "Licensed under the GNU General Public License, version 3",
    53: "SPDX-License-Identifier: MIT", 54: "SPDX-License-Identifier: Apache-2.0",
    55: "SPDX-License-Identifier: BSD-2-Clause", 56: "SPDX-License-Identifier: BSD-3-Clause",
    57: "SPDX-License-Identifier: GPL-2.0-only", 58: "SPDX-License-Identifier: GPL-2.0-or-later",
    59: "SPDX-License-Identifier: GPL-3.0-only", 60: "SPDX-License-Identifier: GPL-3.0-or-later",
    61: "SPDX-License-Identifier: LGPL-2.1-or-later", 62: "SPDX-License-Identifier: LGPL-3.0-or-later",
    63: "SPDX-License-Identifier: AGPL-3.0-or-later", 64: "SPDX-License-Identifier: MPL-2.0",
    65: "SPDX-License-Identifier: ISC", 66: "SPDX-License-Identifier: EPL-2.0", 67: "SPDX-License-Identifier: CC0-1.0",
    68: "SPDX-License-Identifier: Zlib",
}

# Rules by identifier, (licence, sentences in order).
RULES = {
    1: ("mit", (1,)), 2: ("mit", (2,)), 3: ("mit", (3,)), 4: ("mit", (3, 4)), 5: ("mit", (3, 4, 5)),
    6: ("apache-2.0", (6,)), 7: ("apache-2.0", (7,)), 8: ("apache-2.0", (7, 8)), 9: ("apache-2.0", (7, 8, 9)),
    10: ("apache-2.0", (7, 8, 9, 10)), 11: ("apache-2.0", (7, 8, 9, 10, 11)),
    12: ("gpl-3.0", (12,)), 13: ("gpl-2.0", (13,)), 14: ("gpl-3.0-or-later", (14,)), 15: ("gpl-2.0-or-later", (15,)),
    16: ("gpl-3.0-or-later", (14, 16, 17)), 17: ("gpl-2.0-or-later", (15, 16, 17)),
    18: ("cc-by-nc-4.0", (18,)), 19: ("cc-by-nc-4.0", (22,)), 20: ("cc-by-4.0", (19,)), 21: ("cc-by-4.0", (21,)),
    22: ("cc-by-sa-4.0", (20,)), 23: ("cc-by-sa-4.0", (23,)), 24: ("all-rights-reserved", (24,)),
    25: ("bsd", (25, 26)), 26: ("bsd-2-clause", (25, 26, 27)), 27: ("bsd-2-clause", (24, 25, 26, 27)),
    28: ("mpl-2.0", (28,)), 29: ("isc", (29,)), 30: ("unlicense", (30,)),
    31: ("bsd-3-clause", (25, 26, 27, 31)), 32: ("bsd-3-clause", (24, 25, 26, 27, 31)),
    33: ("bsd-3-clause", (25, 26, 27, 47)), 34: ("bsd-3-clause", (24, 25, 26, 27, 47)),
    35: ("bsd-4-clause", (25, 26, 27, 46, 31)), 36: ("bsd-4-clause", (24, 25, 26, 27, 46, 31)),
    37: ("bsd-4-clause", (25, 26, 27, 46, 47)), 38: ("bsd-4-clause", (24, 25, 26, 27, 46, 47)),
    39: ("lgpl-2.1-or-later", (32,)), 40: ("lgpl-2.1-or-later", (32, 16, 34)),
    41: ("lgpl-3.0-or-later", (33,)), 42: ("lgpl-3.0-or-later", (33, 16, 34)),
    43: ("agpl-3.0-or-later", (35,)), 44: ("agpl-3.0-or-later", (35, 16, 36)),
    45: ("epl-1.0", (37,)), 46: ("epl-2.0", (38,)), 47: ("cc0-1.0", (39,)), 48: ("cc0-1.0", (40,)),
    49: ("zlib", (41, 42)), 50: ("zlib", (42, 43)), 51: ("zlib", (41, 42, 43)), 52: ("zlib", (41, 42, 43, 44)),
    53: ("zlib", (41, 42, 43, 44, 45)), 54: ("artistic-2.0", (49,)), 55: ("perl", (50,)),
    56: ("gpl-2.0", (51,)), 57: ("gpl-3.0", (52,)), 58: ("mit", (53,)), 59: ("apache-2.0", (54,)),
    60: ("bsd-2-clause", (55,)), 61: ("bsd-3-clause", (56,)), 62: ("gpl-2.0", (57,)), 63: ("gpl-2.0-or-later", (58,)),
    64: ("gpl-3.0", (59,)), 65: ("gpl-3.0-or-later", (60,)), 66: ("lgpl-2.1-or-later", (61,)),
    67: ("lgpl-3.0-or-later", (62,)), 68: ("agpl-3.0-or-later", (63,)), 69: ("mpl-2.0", (64,)), 70: ("isc", (65,)),
    71: ("epl-2.0", (66,)), 72: ("cc0-1.0", (67,)), 73: ("zlib", (68,)),
}


def normalised(sentence: str) -> str:
    """Lower-case ASCII words between single blanks."""
    return re.sub(NOT_WORD, " ", sentence.lower()).strip()


def pattern_of(sentence: str) -> str:
    """A known sentence as a pattern over normalised text (in the common ground of Java's and RE2's syntax)."""
    return f" (?:[a-z0-9]+ ){{1,{SLOT_WORDS}}}?".join(normalised(part) for part in SLOT.split(sentence))


# Most words first, as the first alternative that fits is taken.
ORDERED = sorted(SENTENCES, key=lambda i: (-len(normalised(SENTENCES[i]).split()), i))
SEARCH = (rf"\b(?:(?:{'|'.join(DENIALS)}) )?(?:" + "|".join(pattern_of(SENTENCES[i]) for i in ORDERED) + r")\b")
EXACT = {normalised(s): i for i, s in SENTENCES.items() if not SLOT.search(s)}
SLOTTED = {i: f"^{pattern_of(SENTENCES[i])}$" for i in ORDERED if SLOT.search(SENTENCES[i])}
PATTERNS = {r: " " + " ".join(map(str, ids)) + " " for r, (_, ids) in RULES.items()}


def _sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text in order."""
    words = F.regexp_replace(F.translate(text, UPPER, LOWER), NOT_WORD, " ")
    known = F.create_map(*[F.lit(x) for pair in EXACT.items() for x in pair])

    def identified(sentence: Column) -> Column:
        slotted = F.lit(None).cast("int")
        for i, pattern in reversed(SLOTTED.items()):  # the first that fits is applied last
            slotted = F.when(sentence.rlike(pattern), i).otherwise(slotted)
        return F.coalesce(F.try_element_at(known, sentence), slotted)  # a denied one is neither

    return F.filter(F.transform(F.regexp_extract_all(words, F.lit(SEARCH), F.lit(0)), identified), lambda x: x.isNotNull())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_sentences, sentence_ids, rules, licenses
    (the last three as texts, members between blanks)."""
    lowered = F.lower(F.col(text_col))
    marked = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(m)) for m in MARKS])
    # Step by step, so that each array is computed once a row.
    rows = docs.select(F.col(id_col), F.when(marked, F.col(text_col)).alias("_text"))
    rows = rows.select(id_col, F.when(F.col("_text").isNotNull(), _sentence_ids(F.col("_text"))).alias("_ids"))
    joined = F.array_join(F.transform("_ids", lambda x: x.cast("string")), " ")
    rows = rows.select(id_col, F.coalesce(F.size("_ids"), F.lit(0)).alias("n_sentences"),
                       F.coalesce(joined, F.lit("")).alias("sentence_ids"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(RULES[r][0]).alias("licence"), F.lit(p).alias("pattern"))
                      for r, p in PATTERNS.items()])
    spaced = F.concat(F.lit(" "), F.col("sentence_ids"), F.lit(" "))
    rows = rows.withColumn("_met", F.when(F.col("sentence_ids") != "", F.filter(rules, lambda r: F.contains(spaced, r["pattern"]))))
    part = lambda r: F.exists("_met", lambda o: F.contains(o["pattern"], r["pattern"])
                              & (F.length(o["pattern"]) > F.length(r["pattern"])))
    rows = rows.withColumn("_met", F.filter("_met", lambda r: ~part(r)))
    return rows.select(
        id_col, F.greatest(F.col("n_sentences"), F.lit(0)).cast("long").alias("n_sentences"), "sentence_ids",
        F.coalesce(F.array_join(F.transform("_met", lambda r: r["rule"].cast("string")), " "), F.lit("")).alias("rules"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform("_met", lambda r: r["licence"]))), " "),
                   F.lit("")).alias("licenses"))


def oracle_sql() -> str:
    """The same scan in DuckDB SQL, without the substring search before it."""
    known = ", ".join(f"({i}, '{s}')" for s, i in EXACT.items())
    slots = " ".join(f"WHEN regexp_matches(sentence, '{p}') THEN {i}" for i, p in SLOTTED.items())
    rules = ", ".join(f"({r}, '{RULES[r][0]}', '{p}')" for r, p in PATTERNS.items())
    return f"""
WITH known(id, exact) AS (VALUES {known}),
rules(rule, licence, pattern) AS (VALUES {rules}),
docs AS (SELECT row_number() OVER () AS n, doc_id, text FROM documents),
sentences AS (
    SELECT n, unnest(s) AS sentence, unnest(range(1, len(s) + 1)) AS p
    FROM (SELECT n, regexp_extract_all(regexp_replace(translate(text, '{UPPER}', '{LOWER}'), '{NOT_WORD}', ' ', 'g'),
                                       '{SEARCH}') AS s FROM docs WHERE text IS NOT NULL)
),
hits AS (SELECT n, p, coalesce(id, CASE {slots} END) AS id FROM sentences LEFT JOIN known ON sentence = exact),
found AS (SELECT n, count(*) AS n_sentences, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY p) AS sentence_ids
          FROM hits WHERE id IS NOT NULL GROUP BY n),
met AS (SELECT n, rule, licence, pattern FROM found JOIN rules ON contains(' ' || sentence_ids || ' ', pattern)),
whole AS (SELECT n, rule, licence FROM met m WHERE NOT EXISTS (
    SELECT 1 FROM met o WHERE o.n = m.n AND contains(o.pattern, m.pattern) AND length(o.pattern) > length(m.pattern))),
named AS (SELECT n, string_agg(CAST(rule AS VARCHAR), ' ' ORDER BY rule) AS rules,
                 array_to_string(list_sort(list_distinct(list(licence))), ' ') AS licenses FROM whole GROUP BY n)
SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids,
       coalesce(rules, '') AS rules, coalesce(licenses, '') AS licenses
FROM docs LEFT JOIN found USING (n) LEFT JOIN named USING (n)
"""
