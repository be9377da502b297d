"""License scans by sentence-rule recognition.

A text is normalised (lower case, runs of other characters than letters, digits,
full stops inside numbers as one space) and cut at line feeds and sentence marks.
A known license sentence is found where it begins and ends at a cut; cuts inside
it count as spaces, so hard-wrapped lines and inner marks ("free software: you
can") do not hide it, but it never reaches over a blank line.  What is left of a
document is a short sequence of sentence identifiers.  License rules are tried in order: a
rule is a sequence of identifiers that must follow one another, and what it
matches is used up, so a longer license is recognised before the shorter ones
that share its sentences.  Known license sentences that no rule used are
reported as unmatched.

A machine-readable tag ("SPDX-License-Identifier: MIT") is a sentence of its own
and names its license; of an expression every known member is reported, also
where it leaves a choice (OR), and what follows WITH is not looked at.  The BSD
licenses differ by one sentence on the use of names: with it the name is
BSD-3-Clause, whoever the holder is, and else BSD.

Scale: one pass of column expressions in the scan, no shuffle; the sentence and
rule tables are fixed and small.

Edge cases: null and empty texts have no sentence and no license; repeated
documents give repeated rows; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised license sentences and their identifiers.
SENTENCES = {
    "APACHE2-BY": "licensed under the apache license version 2.0",
    "APACHE2-YOU-MAY": "you may not use this file except in compliance with the license",
    "APACHE2-OBTAIN": "you may obtain a copy of the license at",
    "APACHE2-AS-IS": "unless required by applicable law or agreed to in writing software distributed under the license "
                     "is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "MIT-REL": "released under the mit license",
    "MIT-PERM": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files the software to deal in the software without restriction",
    "MIT-NOTICE": "the above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the software",
    "GPL3-WORK": "this work is licensed under the gnu general public license version 3",
    "GPL-REDIST": "this program is free software you can redistribute it and or modify it under the terms of the "
                  "gnu general public license as published by the free software foundation either version 3 of the "
                  "license or at your option any later version",
    "GPL-HOPE": "this program is distributed in the hope that it will be useful but without any warranty",
    "CC-BY-NC4": "licensed under cc by nc 4.0",
    "CC-BY4": "licensed under cc by 4.0",
    "CC0-1": "released under cc0 1.0",
    "BSD-REDIST": "redistribution and use in source and binary forms with or without modification are permitted "
                  "provided that the following conditions are met",
    "BSD-AS-IS": "this software is provided by the copyright holders and contributors as is and any express or "
                 "implied warranties are disclaimed",
    "ALL-RIGHTS": "all rights reserved",
}

# License rules in the order in which they are tried.
RULES = [
    ("Apache-2.0", ["APACHE2-BY", "APACHE2-YOU-MAY", "APACHE2-OBTAIN", "APACHE2-AS-IS"]),
    ("GPL-3.0-or-later", ["GPL-REDIST", "GPL-HOPE"]),
    ("GPL-3.0-or-later", ["GPL-REDIST"]),
    ("MIT", ["MIT-PERM", "MIT-NOTICE"]),
    ("BSD", ["BSD-REDIST", "BSD-AS-IS"]),
    ("Apache-2.0", ["APACHE2-BY"]),
    ("MIT", ["MIT-REL"]),
    ("MIT", ["MIT-PERM"]),
    ("GPL-3.0-only", ["GPL3-WORK"]),
    ("CC-BY-NC-4.0", ["CC-BY-NC4"]),
    ("CC-BY-4.0", ["CC-BY4"]),
    ("CC0-1.0", ["CC0-1"]),
    ("BSD", ["BSD-REDIST"]),
    ("LicenseRef-All-Rights-Reserved", ["ALL-RIGHTS"]),
]

# Further sentences of the published notices, as they stand there.
_GPL = "it under the terms of the {} as published by the Free Software Foundation"
_AS_IS = ('THIS SOFTWARE IS PROVIDED BY {} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
          "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")
_MAY = "This {0} is free software{1} you can redistribute it and/or modify "
PUBLISHED = [
    ("APACHE2-BY", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("MIT-PERM", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
                 'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                 "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT-NOTICE", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all "
                   "copies or substantial portions of the Software."),
    *[("BSD-AS-IS", _AS_IS.format(who)) for who in (
        "THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDER AND CONTRIBUTORS", "THE REGENTS AND CONTRIBUTORS",
        "THE AUTHOR AND CONTRIBUTORS", "THE AUTHOR", "THE AUTHORS")],
    ("GPL-REDIST", _MAY.format("program", ":") + _GPL.format("GNU General Public License")
     + ", either version 3 of the License, or (at your option) any later version."),
    ("GPL3-REDIST-ONLY", _MAY.format("program", ":") + _GPL.format("GNU General Public License") + ", version 3."),
    ("GPL2-REDIST", _MAY.format("program", ";") + _GPL.format("GNU General Public License")
     + "; either version 2 of the License, or (at your option) any later version."),
    ("GPL2-REDIST-ONLY", _MAY.format("program", ";") + _GPL.format("GNU General Public License") + "; version 2 of the License."),
    ("GPL2-REDIST-ONLY", _MAY.format("program", ";") + "it under the terms of the GNU General Public License version 2 as "
     "published by the Free Software Foundation."),
    ("LGPL2-REDIST", _MAY.format("library", ";") + _GPL.format("GNU Lesser General Public License")
     + "; either version 2.1 of the License, or (at your option) any later version."),
    *[("LGPL3-REDIST", _MAY.format(what, ":") + _GPL.format("GNU Lesser General Public License")
       + ", either version 3 of the License, or (at your option) any later version.") for what in ("program", "library")],
    ("AGPL3-REDIST", _MAY.format("program", ":") + _GPL.format("GNU Affero General Public License")
     + ", either version 3 of the License, or (at your option) any later version."),
    ("GPL-HOPE", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"),
    ("ISC-PERM", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC-PERM", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL2-FORM", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

# The numbered clauses of the BSD licenses.
PUBLISHED += [
    ("BSD-SOURCE", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer."),
    ("BSD-BINARY", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution."),
    *[("BSD-NAMES", f"Neither the name of the copyright holder nor the names of {whose} contributors may be used to endorse or "
                    "promote products derived from this software without specific prior written permission.") for whose in ("its", "the", "any")],
]

# License identifiers that a tag may name.
TAGS = """0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause
BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0
CC0-1.0 CDDL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC
LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0
MS-PL NCSA ODbL-1.0 OFL-1.1 OpenSSL PostgreSQL PSF-2.0 Python-2.0 Unlicense UPL-1.0 WTFPL X11 Zlib ZPL-2.1""".split()
# Their older spelling, which names the version alone.
OLDER_TAGS = ["AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0"]

# Their rules, tried before ``RULES``.
PUBLISHED_RULES = [
    *[(name, [*first, "BSD-REDIST", *clauses, "BSD-AS-IS"]) for name, clauses in (
        ("BSD-3-Clause", ["BSD-SOURCE", "BSD-BINARY", "BSD-NAMES"]), ("BSD", ["BSD-SOURCE", "BSD-BINARY"]))
      for first in (["ALL-RIGHTS"], [])],
    ("BSD", ["ALL-RIGHTS", "BSD-REDIST", "BSD-AS-IS"]),
    *[(name, [i, *hope]) for hope in (["GPL-HOPE"], []) for name, i in (
        ("GPL-3.0-only", "GPL3-REDIST-ONLY"), ("GPL-2.0-or-later", "GPL2-REDIST"), ("GPL-2.0-only", "GPL2-REDIST-ONLY"),
        ("LGPL-2.1-or-later", "LGPL2-REDIST"), ("LGPL-3.0-or-later", "LGPL3-REDIST"), ("AGPL-3.0-or-later", "AGPL3-REDIST"))],
    ("ISC", ["ISC-PERM"]),
    ("MPL-2.0", ["MPL2-FORM"]),
]

# In ``oracle``, a sentence ends at a line feed, or at a mark before white space or the end.
SENTENCE_END = r"\n+|[.!?;:]+[ \t\r]+|[.!?;:]+\z"
OTHER = r"[^a-z0-9.]+|\.(\z|[^0-9])"
HINT = r"(?i)licen|copyright|permission|redistribut|warrant|rights\s+reserved|cc0|cc\s+by"

# In ``scan`` a cut is a line feed, or a mark before white space or the end; each becomes one line feed.
CUT = r"(?<![.!?;:])[.!?;:]*+\n|(?<![.!?;:])[.!?;:]++(?: |\z)"
NOT_WORD = r"[^a-z0-9.\n]++|\.(?![0-9])"


def _words(sentence: str) -> str:
    """A known sentence in normal form."""
    return " ".join(re.sub(NOT_WORD, " ", sentence.lower()).split())


def _any(sentences) -> str:
    """Longer sentences first; a cut inside a sentence counts as a space, a blank line is two cuts."""
    return "|".join("[ \\n]".join(map(re.escape, s.split())) for s in sorted(sentences, key=lambda s: (-len(s), s)))


KNOWN = {_words(s): i for i, s in [*((i, s) for i, s in SENTENCES.items()), *PUBLISHED]}
TAG = "spdx license identifier"
TAGGED = {**{_words(t): t for t in OLDER_TAGS}, **{_words(t): t for t in TAGS}}
TAGGED = {name: t + "-only" if t in OLDER_TAGS else t for name, t in TAGGED.items()}
FIND = rf"(?<=\n)(?:{_any([TAG])}[ \n](?:{_any(TAGGED)})|{_any(KNOWN)})(?=\n)"
# one tag a member of an expression: (?! later) keeps "or later" together
MEMBER = rf"(?<=\n{TAG}[ \n][^\n]{{0,400}}) (?:or|and|with) (?!later)"
HOLDER = r"(?<=\n)neither[ \n]the[ \n]names?[ \n]of[ \n](?:[^ \n]++[ \n]){1,24}?nor[ \n]the[ \n]names?(?=[ \n]of[ \n])"


def _where_found(text: Column, part: str, change: Callable[[Column], Column]) -> Column:
    """``change`` of the texts that contain ``part``, which all that it changes contain; ``text`` is computed once."""
    return F.transform(F.array(text), lambda x: F.when(F.contains(x, F.lit(part)), change(x)).otherwise(x))[0]


def normal(text: Column) -> Column:
    """Words with one space between them, a line feed for each cut, and one at either end."""
    t = F.regexp_replace(F.lower(text), r"(gpl-[0-9.]++)\+", "$1-or-later")
    t = F.replace(F.regexp_replace(t, r"[ \t\r]++", " "), F.lit(" \n"), F.lit("\n"))
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, CUT, "\n"), NOT_WORD, " "), " ++", " ")
    t = F.concat(F.lit("\n"), t, F.lit("\n"))
    t = F.replace(F.replace(t, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    t = _where_found(t, "neither", lambda x: F.regexp_replace(x, HOLDER, "neither the name of the copyright holder nor the names"))
    return _where_found(t, TAG, lambda x: F.regexp_replace(x, MEMBER, f"\n{TAG}\n"))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known license sentences of a text, in order."""
    known = F.create_map(*[F.lit(x) for s, i in [*KNOWN.items(), *((f"{TAG} {s}", f"SPDX:{t}") for s, t in TAGGED.items())]
                           for x in (s, i)])
    found = F.transform(F.regexp_extract_all(normal(text), F.lit(FIND), F.lit(0)),
                        lambda s: known[F.replace(s, F.lit("\n"), F.lit(" "))])
    return F.when(F.rlike(F.coalesce(text, F.lit("")), F.lit(HINT)), found).otherwise(
        F.array().cast("array<string>"))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, licenses, n_sentences, sentence_ids, unmatched`` per document.

    ``licenses`` are the distinct names in order, joined by " AND ", empty for
    none; ``sentence_ids`` the recognised sequence; ``unmatched`` how many of
    it no rule used.
    """
    rules = [*PUBLISHED_RULES, *RULES]
    docs = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    docs = docs.select("doc_id", sentence_ids(F.col("text")).alias("ids"))
    # the sequence as text, each identifier between commas; a used stretch becomes its license's number
    left = F.concat(F.lit(","), F.array_join("ids", ",,"), F.lit(","))
    for n, (_, rule) in enumerate(rules):
        left = F.replace(left, F.lit("," + ",,".join(rule) + ","), F.lit(f"<{n}>"))
    left = F.regexp_replace(left, r",SPDX:([^,]++),", "<=$1>")
    docs = docs.withColumn("left", left)
    ruled = F.array_compact(F.array(*[
        F.when(reduce(lambda a, b: a | b, [F.contains("left", F.lit(f"<{n}>")) for n, r in enumerate(rules) if r[0] == name]),
               F.lit(name)) for name in sorted({r[0] for r in rules})]))
    names = F.array_sort(F.array_distinct(F.concat(ruled, F.regexp_extract_all("left", F.lit(r"<=([^>]++)>"), F.lit(1)))))
    rest = F.regexp_replace(F.col("left"), r"<=?[^>]++>", "")
    return docs.select("doc_id", F.array_join(names, " AND ").alias("licenses"),
                       F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentence_ids"),
                       F.size(F.filter(F.split(rest, ","), lambda x: x != "")).cast("long").alias("unmatched"))


def oracle() -> str:
    """DuckDB SQL for ``scan`` over the table ``documents``, where every license sentence is one line."""
    table = ", ".join(f"('{i}', '{s}')" for i, s in SENTENCES.items())
    left = "',' || array_to_string(ids, ',,') || ','"
    for n, (_, rule) in enumerate(RULES):
        left = f"replace({left}, ',{',,'.join(rule)},', '<{n}>')"
    names = ", ".join("case when " + " or ".join(f"contains(l, '<{n}>')" for n, r in enumerate(RULES) if r[0] == name)
                      + f" then '{name}' end" for name in sorted({r[0] for r in RULES}))
    return f"""
    with k(i, s) as (values {table}),
    d as (select row_number() over () as r, doc_id, string_split_regex(lower(coalesce(text, '')), '{SENTENCE_END}') as parts from documents),
    e as (select r, unnest(parts) as p, unnest(range(1, len(parts) + 1)) as o from d),
    f as (select r, list(k.i order by o) as ids from e join k on k.s = trim(regexp_replace(p, '{OTHER}', ' ', 'g')) group by r),
    g as (select doc_id, coalesce(ids, []) as ids from d left join f using (r)),
    h as (select doc_id, ids, {left} as l from g)
    select doc_id, array_to_string(list_filter([{names}], lambda x: x is not null), ' AND ') as licenses,
           len(ids)::bigint as n_sentences, array_to_string(ids, ',') as sentence_ids,
           len(list_filter(string_split(regexp_replace(l, '<[0-9]+>', '', 'g'), ','), lambda x: x <> ''))::bigint as unmatched
    from h"""
