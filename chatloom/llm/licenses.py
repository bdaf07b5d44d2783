"""Licence scans by sentence rules (DataFrame functions only).

A text is a sequence of words (runs of a-z and 0-9 after A-Z are lower-cased).
Between two words a line may end, and a sentence may end: at one of .;:? with what
is no letter, figure or space after it, before a space or tab.  A known sentence is
found where its words follow each other, begin and end at a line's or sentence's end
(or end before a web address), and no sentence ends between them but where the known
one has such an end itself ("v. 2.0").  So notices wrapped over lines are found, with or
without comment marks.  Of sentences that begin at one place the longest counts, and
found ones don't overlap.

A licence rule is an ordered list of identifiers; it holds where the identifiers of a
text, in text order, contain that list without another known sentence between.

Everything happens within a row: no join, no shuffle.  A text is looked at
only if it has one of a few words of which every known sentence has one.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, with_columns_of

#: Sentences of public licences, by identifier, as their texts have them.
SENTENCES = {
    "apache2-short": "Licensed under the Apache License, Version 2.0",
    "apache2-head-1": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache2-head-2": "you may not use this file except in compliance with the License",
    "apache2-head-3": "You may obtain a copy of the License at",
    "apache2-head-4": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache2-head-5": "See the License for the specific language governing permissions and limitations under the License",
    "mit-short": "Released under the MIT License",
    "mit-short-2": "Licensed under the MIT License",
    "mit-title": "The MIT License",
    "mit-1": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit-2": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "warranty-mit": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "isc-1": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-2": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS',
    "bsd-0": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-1": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-2": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-3": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-short": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software",
    "gpl3-grant": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-grant": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "mpl2-1": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl2-2": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "cc-by-4": "Licensed under CC BY 4.0",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "cc-by-4-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
}

#: Ordered rules, licence name and sentence identifiers.
RULES = [
    ("Apache-2.0", ["apache2-short"]),
    ("Apache-2.0", ["apache2-head-1", "apache2-head-2", "apache2-head-3", "apache2-head-4", "apache2-head-5"]),
    ("Apache-2.0", ["apache2-head-1", "apache2-head-2"]),
    ("MIT", ["mit-short"]),
    ("MIT", ["mit-short-2"]),
    ("MIT", ["mit-1", "mit-2", "warranty-mit"]),
    ("MIT", ["mit-1", "mit-2"]),
    ("ISC", ["isc-1", "isc-2"]),
    ("BSD-3-Clause", ["bsd-0", "bsd-1", "bsd-2", "bsd-3"]),
    ("BSD-2-Clause", ["bsd-0", "bsd-1", "bsd-2"]),
    ("GPL-3.0", ["gpl3-short"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-grant"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-grant"]),
    ("MPL-2.0", ["mpl2-1", "mpl2-2"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-4.0", ["cc-by-4-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-long"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-long"]),
]

#: Where a sentence ends: group 1, and what follows it.
CUT = r"([.;:?])[^\sA-Za-z0-9]*[ \t]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What may stand between two words of a sentence (line ends), and where the known sentence has an end.
INSIDE, DIVIDED = "(?: [|])* ", "(?: [|!])* "


def pieces(sentence: str) -> list[list[str]]:
    """The words of a known sentence, divided where a sentence ends within it."""
    return [re.findall("[a-z0-9]+", x.lower()) for x in re.sub(CUT, r"\1\n", sentence).split("\n")]


def anchors_of(sentences: dict[str, str]) -> list[str]:
    """A few words of which every sentence has one: again and again the word that most of those without one have, of words of six letters and more if they have any."""
    left, out = [{w for p in pieces(s) for w in p} for s in sentences.values()], []
    while left:
        count = Counter(w for x in left for w in x)
        out.append(max(count, key=lambda w: (min(len(w), 6), count[w], len(w), w)))
        left = [x for x in left if out[-1] not in x]
    return out


def recognise(docs: DataFrame, sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """The documents with known sentences: doc_id, sentence_ids (array, in text order)
    and licenses (array of structs license, rule, matches; longer rules first).

    A rule's sentences are used up: a shorter rule doesn't count them again. A
    null or empty text has none. Repeated rows and null ids give rows of their
    own; an empty table gives none. Other columns are ignored, whatever their names.
    The dictionary is part of the plan, so keep it to some hundred sentences.
    """
    sentences = sentences or SENTENCES
    keys = {k: pieces(s) for k, s in sentences.items()}
    number = {k: f"<{i}>" for i, k in enumerate(keys)}
    table = F.create_map(*[x for k, p in keys.items() for x in (F.lit(" ".join(w for q in p for w in q)), F.lit(k))])
    some = "|".join(DIVIDED.join(INSIDE.join(q) for q in p) for p in sorted(keys.values(), key=lambda p: -len(" ".join(w for q in p for w in q))))
    base = with_columns_of(docs, {"doc_id": "long", "text": "string"}).withColumn("text", F.translate(text_or_empty(), UPPER, LOWER))
    base = base.filter(F.col("text").rlike("|".join(anchors_of(sentences))))
    # Words with single spaces, | for a line's end and ! for a sentence's.
    marked = F.regexp_replace(F.translate("text", "|!", "  "), CUT, "$1 ! ")
    plain = F.regexp_replace(F.regexp_replace(marked, "\n", " | "), "[^a-z0-9|!]+", " ")
    whole = F.regexp_extract_all(F.concat(F.lit("| "), F.trim(plain), F.lit(" |")), F.lit(f"(?<=[|!] )(?:{some})(?= [|!]| https? )"), F.lit(0))
    ids = F.transform(whole, lambda s: F.element_at(table, F.regexp_replace(s, " [|!]", "")))
    tokens = F.create_map(*[F.lit(x) for k, n in number.items() for x in (k, n)])
    known = [(name, " ".join(ids), "".join(number[k] for k in ids)) for name, ids in sorted(rules or RULES, key=lambda r: -len(r[1]))]
    listed = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(rule).alias("rule"), F.lit(pattern).alias("pattern")) for name, rule, pattern in known])
    start = lambda found: F.struct(F.array_join(F.transform(found, lambda k: F.element_at(tokens, k)), "").alias("rest"), F.array().cast("array<struct<license:string,rule:string,matches:bigint>>").alias("hits"))

    def use(acc, rule):
        left = F.replace(acc["rest"], rule["pattern"], F.lit("|"))
        n = ((F.length(acc["rest"]) - F.length(left)) / (F.length(rule["pattern"]) - 1)).cast("long")
        hit = F.struct(rule["license"].alias("license"), rule["rule"].alias("rule"), n.alias("matches"))
        return F.struct(left.alias("rest"), F.when(n > 0, F.concat(acc["hits"], F.array(hit))).otherwise(acc["hits"]).alias("hits"))

    # As elements of an array that is exploded, a text's sentences are found once, whatever refers to them.
    one = F.transform(F.array(ids), lambda found: F.struct(found.alias("sentence_ids"), F.aggregate(listed, start(found), use)["hits"].alias("licenses")))
    return base.select("doc_id", F.explode(F.filter(one, lambda x: F.size(x["sentence_ids"]) > 0)).alias("x")).select("doc_id", "x.sentence_ids", "x.licenses")


def license_rows(docs: DataFrame, **kw) -> DataFrame:
    """A row a document and licence: doc_id, license, matches, first_sentence (identifier of the document's first known sentence)."""
    rows = recognise(docs, **kw).select("doc_id", F.element_at("sentence_ids", 1).alias("first_sentence"), F.explode("licenses").alias("l"))
    return rows.select("doc_id", F.col("l.license").alias("license"), F.col("l.matches").alias("matches"), F.col("l.rule").alias("rule"), "first_sentence")


def _sql() -> str:
    """The rule over a table of words and what stands between them; no pattern of whole sentences."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    listed = lambda xs: "[" + ", ".join(xs) + "]"
    values, number = [], {k: f"<{i}>" for i, k in enumerate(SENTENCES)}
    for k, s in SENTENCES.items():
        p = pieces(s)
        ends = [j == len(x) - 1 for x in p for j in range(len(x))]
        values.append(f"({q(k)}, {q(number[k])}, {listed(q(w) for x in p for w in x)}, {listed('true' if e else 'false' for e in ends)})")
    steps, last = [], "s"
    order = sorted(RULES, key=lambda r: -len(r[1]))
    for i, (_, ids) in enumerate(order):
        p = "".join(number[k] for k in ids)
        steps.append(f"r{i} AS (SELECT *, CAST((length(rest{i}) - length(replace(rest{i}, '{p}', '|'))) // {len(p) - 1} AS BIGINT) AS n{i}, replace(rest{i}, '{p}', '|') AS rest{i + 1} FROM {last})")
        last = f"r{i}"
    rows = " UNION ALL ".join(f"SELECT doc_id, {q(name)} AS license, n{i} AS matches, {q(' '.join(ids))} AS rule, first_sentence FROM {last} WHERE n{i} > 0" for i, (name, ids) in enumerate(order))
    space = " \\t\\n\\v\\f\\r"
    return f"""
WITH known(id, token, words, may_end) AS (VALUES {", ".join(values)}),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z0-9]+|[.;:?][^{space}a-z0-9]*[ \\t]+|\\n') AS t FROM documents),
t AS (SELECT row, doc_id, unnest(t) AS t, unnest(range(1, len(t) + 1)) AS i FROM d),
n AS (SELECT *, regexp_matches(t, '^[a-z0-9]') AS is_word, sum(CASE WHEN regexp_matches(t, '^[a-z0-9]') THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY i) AS n FROM t),
gap AS (SELECT row, n, max(CASE WHEN t = chr(10) THEN 1 ELSE 2 END) AS gap FROM n WHERE NOT is_word GROUP BY row, n),
w AS (SELECT n.row, n.doc_id, n.n, n.t, coalesce(gap.gap, 0) AS gap, lag(coalesce(gap.gap, 0), 1, 1) OVER o AS before, lead(n.t, 1, '') OVER o AS next_word, lead(n.n) OVER o IS NULL AS is_last
      FROM n LEFT JOIN gap ON n.row = gap.row AND n.n = gap.n WHERE is_word WINDOW o AS (PARTITION BY n.row ORDER BY n.n)),
a AS (SELECT w.row, w.n, k.id, k.token, k.words, k.may_end FROM w JOIN known k ON w.t = k.words[1] WHERE w.before > 0),
m AS (SELECT a.row, any_value(w.doc_id) AS doc_id, a.n, a.id, any_value(a.token) AS token, len(any_value(a.words)) AS size
      FROM a JOIN w ON w.row = a.row AND w.n >= a.n AND w.n < a.n + len(a.words) AND w.t = a.words[CAST(w.n - a.n + 1 AS BIGINT)]
                       AND CASE WHEN w.n - a.n + 1 < len(a.words) THEN w.gap < 2 OR a.may_end[CAST(w.n - a.n + 1 AS BIGINT)] ELSE w.gap > 0 OR w.is_last OR w.next_word IN ('http', 'https') END
      GROUP BY a.row, a.n, a.id HAVING count(*) = len(any_value(a.words))),
f AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY row, n ORDER BY size DESC) = 1),
o AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM f e WHERE e.row = f.row AND e.n < f.n AND e.n + e.size > f.n)),
s AS (SELECT row, any_value(doc_id) AS doc_id, string_agg(token, '' ORDER BY n) AS rest0, min_by(id, n) AS first_sentence FROM o GROUP BY row),
{", ".join(steps)}
{rows}
"""


SQL = _sql()
