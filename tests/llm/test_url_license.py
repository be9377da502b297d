import re

from pyspark.sql import functions as F

from tablewright.llm import licenses, url_filter

from .data import documents, odd_rows

URLS = ["http://a.b.example.org/x", "https://user:pw@A.B.Example.org.:8080/y?z#f", "ftp://example.org", "not a url", None, "",
        "http://", "http://10.0.0.1/x", "http://other.net#x", "http://example.org.evil.com/", "http://localhost/a"]


def captures(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, fetch_day long").withColumns(
        {c: F.lit("extra") for c in ("pattern", "day", "part", "since", "until", "row", "_host", "categories")})


ENTRIES = [("example.org", "spam", 10, True), ("example.org", "spam", 20, False), ("example.org", "spam", 200, True),
           ("example.org", "spam", 300, True), ("b.example.org", "adult", 15, True), ("b.example.org", "adult", 15, False),
           ("A.b.example.org", "malware", 0, True), ("a.b.example.org", "malware", 5, False), (None, "spam", 1, True),
           ("other.net", "spam", None, True), ("other.net", None, 30, True), ("localhost", "spam", 50, True),
           ("0.0.1", "spam", 1, None)]


def brute(url, day):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", url or "")
    host = re.sub(r"\.$", "", m.group(1).lower()) if m else None
    if not host or day is None:
        return host or None, None, None
    parts = host.split(".")
    names = [".".join(parts[i:]) for i in range(max(1, len(parts) - 1))]
    state = {}
    for p, c, d, on in sorted((e for e in ENTRIES if e[0] and e[2] is not None and e[3] is not None), key=lambda e: (e[2], not e[3])):
        if d <= day:
            state[p.lower(), c] = on
    hits = [(p, c) for (p, c), on in state.items() if on and p in names]
    return host, max((p for p, _ in hits), key=len, default=None), ",".join(sorted({c for _, c in hits if c})) if hits else None


def test_verdicts_equal_brute_force(spark):
    entries = spark.createDataFrame(ENTRIES, "pattern string, category string, day long, listed boolean")
    rows = [(n * 1000 + d, u, d) for n, u in enumerate(URLS) for d in (0, 4, 5, 9, 10, 15, 19, 20, 30, 50, 199, 200, 300, 301, 5000)]
    rows += [(1, URLS[0], None), (2, URLS[0], 12), (2, URLS[0], 12)]
    for span in (64, 7):
        got = url_filter.evaluate(captures(spark, rows), entries, span=span).collect()
        assert len(got) == len(rows)
        for r in got:
            host, matched, cats = brute(r["url"], r["fetch_day"])
            assert (r["host"], r["matched"], r["categories"], r["blocked"]) == (host, matched, cats, matched is not None), r
    assert url_filter.evaluate(captures(spark, rows), entries.limit(0)).where("blocked").count() == 0
    assert url_filter.evaluate(captures(spark, []), entries).collect() == []


def test_intervals_keep_changes_only(spark):
    entries = spark.createDataFrame(ENTRIES, "pattern string, category string, day long, listed boolean")
    got = sorted((r["pattern"], r["since"], r["until"]) for r in url_filter.intervals(entries).collect())
    far = url_filter.FOREVER
    assert got == [("a.b.example.org", 0, 5), ("example.org", 10, 20), ("example.org", 200, far), ("localhost", 50, far), ("other.net", 30, far)]


def test_licenses(spark):
    apache = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nYou may not use this file except in compliance "
              "with the License. You may obtain a copy of the License at\n\n Unless required by applicable law or agreed to in writing, "
              "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
              "either express or implied.")
    rows = [(1, "Text. Released under the MIT License.\nMore text"), (2, "THIS WORK IS LICENSED UNDER THE GNU General Public License, version 3."),
            (3, "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0!"), (4, apache.replace(' (the "License")', "")),
            (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                "files (the \"Software\"), to deal in the Software without restriction; the above copyright notice and this permission notice "
                "shall be included in all copies or substantial portions of the Software."),
            (6, "You may obtain a copy of the License at"), (7, "I mention the MIT license in passing."),
            (8, "All rights reserved. Released under the MIT License. Released under the MIT License.")]
    got = {r["doc_id"]: (r["licenses"], r["n_sentences"], r["unmatched"]) for r in licenses.scan(documents(spark, rows)).collect()}
    assert got == {1: ("MIT", 1, 0), 2: ("GPL-3.0-only", 1, 0), 3: ("CC-BY-4.0 AND CC-BY-NC-4.0", 2, 0), 4: ("Apache-2.0", 4, 0),
                   5: ("MIT", 2, 0), 6: ("", 1, 1), 7: ("", 0, 0), 8: ("LicenseRef-All-Rights-Reserved AND MIT", 3, 0)}


def test_licenses_odd_rows_and_empty(spark):
    got = licenses.scan(documents(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows()) and {(r["licenses"], r["n_sentences"]) for r in got} == {("", 0)}
    assert licenses.scan(documents(spark, [])).collect() == []


APACHE = """Copyright 2020 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """MIT License

Copyright (c) 2020 The Authors

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD = """Copyright (c) 2020, The Authors
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
GPL2 = GPL.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")


def test_published_notices_wrapped_and_unwrapped(spark):
    ways = [lambda t: t, lambda t: re.sub(r"(?<!\n)\n(?!\n)", " ", t), lambda t: t.replace("\n", "\r\n"),
            lambda t: "/*\n" + re.sub(r"(?m)^", " * ", t) + "\n */\nint main();", lambda t: re.sub(r"(?m)^", "# ", t),
            lambda t: "A table row | with no mark\n" + t + "\n| another row"]
    want = {"Apache-2.0": APACHE, "MIT": MIT, "BSD": BSD, "GPL-3.0-or-later": GPL, "GPL-2.0-or-later": GPL2}
    rows = [(100 * k + n, way(text)) for k, text in enumerate(want.values()) for n, way in enumerate(ways)]
    got = {r["doc_id"]: (r["licenses"], r["unmatched"]) for r in licenses.scan(documents(spark, rows)).collect()}
    assert got == {100 * k + n: (name, 0) for k, name in enumerate(want) for n in range(len(ways))}


def test_sentences_begin_and_end_at_cuts(spark):
    rows = [(1, "It is not released under the MIT License."), (2, "Released under the MIT License or none."),
            (3, "Released under\n\nthe MIT License."), (4, "Released under\nthe MIT License."),
            (5, "a line with no mark\nReleased under the MIT License\nanother line"), (6, "CC0 of old:\nreleased under CC0 1.0")]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(documents(spark, rows)).collect()}
    assert got == {1: "", 2: "", 3: "", 4: "MIT", 5: "MIT", 6: "CC0-1.0"}


# The end of the published notice, with the clause on names.
BSD3_NAMES = """3. Neither the name of the {} nor the names of its
   contributors may be used to endorse or promote products derived from this
   software without specific prior written permission.

THIS SOFTWARE IS PROVIDED"""


def test_bsd_clauses(spark):
    holders = ["copyright holder", "University of California, Berkeley", "Example Org. Inc"]
    texts = [BSD, *[BSD.replace("THIS SOFTWARE IS PROVIDED", BSD3_NAMES.format(h), 1) for h in holders]]
    rows = [(10 * k + n, t) for k, text in enumerate(texts)
            for n, t in enumerate((text, text.replace("All rights reserved\n", ""), "# " + text.replace("\n", "\n# ")))]
    got = {r["doc_id"]: (r["licenses"], r["unmatched"]) for r in licenses.scan(documents(spark, rows)).collect()}
    assert got == {10 * k + n: ("BSD-3-Clause" if k else "BSD", 0) for k in range(len(texts)) for n in range(3)}


def test_tags(spark):
    cases = {"// SPDX-License-Identifier: MIT\nint main();": "MIT", "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0-or-later",
             "# SPDX-License-Identifier: (MIT OR Apache-2.0)\nx = 1": "Apache-2.0 AND MIT",
             "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0\n": "GPL-2.0-only",
             "SPDX-License-Identifier: GPL-2.0+ AND BSD-3-Clause AND 0BSD": "0BSD AND BSD-3-Clause AND GPL-2.0-or-later",
             "spdx-license-identifier:GPL-3.0": "GPL-3.0-only", "SPDX-License-Identifier: Unheard-of-1.0": "",
             "The SPDX-License-Identifier: MIT": "", "SPDX-License-Identifier: MIT\nReleased under the MIT License.\nall rights reserved":
             "LicenseRef-All-Rights-Reserved AND MIT", "no license, MIT": ""}
    rows = list(enumerate(cases))
    got = {r["doc_id"]: (r["licenses"], r["unmatched"]) for r in licenses.scan(documents(spark, rows)).collect()}
    assert got == {n: (cases[t], 0) for n, t in rows}
    assert len(licenses.TAGGED) == len(licenses.TAGS) + len(licenses.OLDER_TAGS)


def test_captures_without_a_host_are_spread(spark):
    rows = [(i, None if i % 3 else "http://a.example.org/x", None if i % 5 == 0 else 3) for i in range(600)]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetch_day int").repartition(4)
    listed = spark.createDataFrame([("example.org", "spam", 1, True)], "pattern string, category string, day int, listed boolean")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = url_filter.evaluate(captures, listed)
        sizes = [r["n"] for r in out.where("host is null").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        got = {r["page_id"]: r["matched"] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {i: "example.org" if url and day else None for i, url, day in rows}
    assert len(sizes) >= 6 and max(sizes) < 150 and sum(sizes) == 400
