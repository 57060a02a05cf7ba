"""Licence scans by canonical digest: entire texts are normalised, hashed and joined to the digests of known licences.

The entire texts looked up are a document, each of its paragraphs and each of its lines.  Canonical form: lower case,
without copyright lines, punctuation as single spaces, and one spelling for words that count as equivalent.
DataFrame functions only.

The known texts are the notices and bodies listed here and the published texts in ``license_texts``, each with and without
its title, with copyright lines left to fill in and without them, with and without what follows its terms, and with either form of
its links.  BSD conditions may also stand without numbers.

A text without any of ``WORDS`` cannot equal a known licence, as each of those has one (checked when the table is
made); such texts are not hashed.  Null and empty texts match nothing.  Repeated rows get equal results.
"""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import stored

# Notices and full texts of licences, as published.
KNOWN = [
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
]
_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_ENDORSEMENT = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
# Bodies of short licences without their titles.
BODIES = [
    ("BSD-2-Clause", f"{_CONDITIONS}\n\n{_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_CONDITIONS}\n\n{_ENDORSEMENT}\n\n{_DISCLAIMER}"),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    ),
]
# Titles that stand before bodies without one.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License"),
    "Zlib": ("zlib License", "The zlib License"),
    "Unlicense": ("The Unlicense",),
}


def _gnu(kind: str, work: str, version: str, later: bool) -> str:
    choice = f"either version {version} of the License, or (at your option) any later version" if later else f"version {version}"
    form = choice if later else f"{choice} of the License"
    return f"""{work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published
by the Free Software Foundation, {form}.

{work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details.

You should have received a copy of the GNU {kind} along with {work.lower()}. If not, see <https://www.gnu.org/licenses/>."""


# The usual headers of source files.
HEADERS = [
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    *[
        (f"{short}-{version}", _gnu(kind, work, number, later))
        for short, kind, versions in (
            ("GPL", "General Public License", (("2.0", "2"), ("3.0", "3"))),
            ("LGPL", "Lesser General Public License", (("2.1", "2.1"), ("3.0", "3"))),
        )
        for version, number in versions
        for work in ("This program", "This library")
        for later in (False, True)
    ],
]
TEXTS = files(__package__) / "license_texts"
_FILL_IN = re.compile(r"(?mi)^[^\w\n]*copyright[^\n0-9]*[\[<{]y{1,4}[^\n]*$|^[^\w\n]*copyright[^\n]*[\[<{]year[^\n]*$")
_END = re.compile(r"END OF TERMS AND CONDITIONS")


def variants(text: str) -> set[str]:
    """A published text as it is, without its title, without lines to fill in, and up to the end of its terms."""
    found = {text.strip()}
    end = _END.search(text)
    if end:
        found |= {text[: end.start()].strip(), text[: end.end()].strip()}
    for _ in range(2):
        for known in list(found):
            head, _, body = known.partition("\n\n")
            if body and len(head) < 160 and head.count("\n") < 4 and not head.rstrip().endswith((".", ":", ",", ";")):
                found.add(body.strip())
    return found | {_FILL_IN.sub("", known) for known in found}


def published() -> list[tuple[str, str]]:
    """``license, text`` of all known texts."""
    known = [*KNOWN, *HEADERS]
    known += [(f.name.removesuffix(".txt"), text) for f in TEXTS.iterdir() for text in variants(f.read_text("utf-8"))]
    for name, body in [*(k for k in KNOWN if "\n\n" in k[1]), *BODIES]:
        for rights in ("", "All rights reserved.\n\n"):
            known += [(name, f"{title}\n\n{rights}{body}") for title in ("", *TITLES.get(name, ()))]
    known += [(name, re.sub(r"(?m)^[0-9]\. ", "", text)) for name, text in known if name.startswith("BSD")]
    known += [(name, text.replace("https://", "http://")) for name, text in known]
    known += [(name, text.replace("http://", "https://")) for name, text in known]
    return sorted(set(known))


# Spellings that count as equal.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "authorisation": "authorization",
    "authorised": "authorized",
    "favour": "favor",
    "holder": "owner",
    "holders": "owners",
    "honour": "honor",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "organisation": "organization",
    "organisations": "organizations",
    "recognised": "recognized",
    "whilst": "while",
}
PHRASES = {"non commercial": "noncommercial", "per cent": "percent", "sub license": "sublicense"}
ANCHORS = r"licen[cs]e|rights|permission"
#: The same for all known texts; a body of BSD has none of the others.
WORDS = ANCHORS + "|redistribution"
COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright|©|\(c\))[^\n]*[0-9]{4}[^\n]*$"
OTHER = r"[^\p{L}\p{N}]+"
PARAGRAPH = r"\n[\x20\t\r]*\n"


def canonical(text: Column) -> Column:
    """The form in which texts are compared."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT, ""), OTHER, " "))
    same = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    words = F.transform(F.split(plain, " "), lambda w: F.coalesce(F.element_at(same, w), w))
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    for several, one in PHRASES.items():
        joined = F.replace(joined, F.lit(f" {several} "), F.lit(f" {one} "))
    return F.trim(joined)


def known_digests(spark: SparkSession, texts=None) -> DataFrame:
    """``license, digest`` of the known texts, ``published()`` if none are given."""
    rows = spark.createDataFrame(published() if texts is None else texts, "license string, text string")
    if rows.filter(~F.lower("text").rlike(WORDS)).count():
        raise ValueError("a known licence has none of the anchor words")
    return rows.select("license", F.sha2(canonical(F.col("text")), 256).alias("digest")).distinct()


def license_scan(documents: DataFrame, texts=None) -> DataFrame:
    """``doc_id, n_licenses, licenses, whole_license`` for every row of ``documents``.

    ``licenses`` lists the licences of the document and its parts, ``whole_license`` those that the document consists of.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = F.concat(F.split("text", PARAGRAPH), F.split("text", "\n"))
    parts = F.filter(F.array_distinct(parts), lambda p: F.lower(p).rlike(WORDS) & (p != F.col("text")))
    anchored = F.lower("text").rlike(WORDS)
    rows = rows.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.when(anchored, F.col("text")).alias("whole"),
        F.when(anchored, parts).alias("parts"),
    )
    rows = stored(rows, "anchored")
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.col("whole").alias("unit")))
    units = F.concat(whole, F.transform("parts", lambda p: F.struct(F.lit(False).alias("whole"), p.alias("unit"))))
    looked_up = rows.filter("whole IS NOT NULL").select("doc_id", "text_key", F.explode(units).alias("u"))
    looked_up = looked_up.select("doc_id", "text_key", "u.whole", F.sha2(canonical(F.col("u.unit")), 256).alias("digest"))
    # The known digests are a fixed list, so they go to every task.
    found = looked_up.join(F.broadcast(known_digests(documents.sparkSession, texts)), "digest")
    found = found.groupBy(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).agg(
        F.sort_array(F.collect_set("license")).alias("all"),
        F.sort_array(F.collect_set(F.when(F.col("whole"), F.col("license")))).alias("entire"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    return rows.join(found, same, "left").select(
        "doc_id",
        F.coalesce(F.size("all"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce(F.array_join("all", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.array_join("entire", ","), F.lit("")).alias("whole_license"),
    )


def oracle_sql() -> str:
    """The same in DuckDB for ``KNOWN``, comparing canonical texts instead of digests."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def canon(column: str) -> str:
        plain = rf"trim(regexp_replace(regexp_replace(lower({column}), '{COPYRIGHT}', '', 'g'), '{OTHER}', ' ', 'g'))"
        same = "MAP {" + ", ".join(f"{text(a)}: {text(b)}" for a, b in SPELLINGS.items()) + "}"
        joined = f"' ' || array_to_string([coalesce({same}[w], w) FOR w IN string_split({plain}, ' ')], ' ') || ' '"
        for several, one in PHRASES.items():
            joined = f"replace({joined}, ' {several} ', ' {one} ')"
        return f"trim({joined})"

    known = ", ".join(f"({text(name)}, {text(body)})" for name, body in KNOWN)
    return rf"""
WITH known AS (SELECT DISTINCT license, {canon("body")} AS form FROM (VALUES {known}) t(license, body)),
rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
units AS (
  SELECT r, true AS whole, text AS unit FROM rows
  UNION ALL SELECT r, false, unnest(regexp_split_to_array(text, '{PARAGRAPH}')) FROM rows
  UNION ALL SELECT r, false, unnest(string_split(text, chr(10))) FROM rows
), found AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(DISTINCT license) AS n,
         string_agg(DISTINCT license, ',' ORDER BY license) FILTER (whole) AS entire
  FROM (SELECT r, whole, {canon("unit")} AS form FROM units WHERE regexp_matches(lower(unit), '{ANCHORS}')) u
  JOIN known USING (form) GROUP BY r
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_licenses, coalesce(licenses, '') AS licenses,
       coalesce(entire, '') AS whole_license
FROM rows LEFT JOIN found USING (r)"""
