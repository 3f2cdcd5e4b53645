"""License scans by canonical digest lookup.

A text is brought to a canonical form: case, punctuation, white space, copyright lines and
spellings that mean the same are evened out. Each whole passage (the text, each paragraph, each
line) is then joined by digest to the canonical digests of known licenses and notices. Texts
without any of a few words that the known texts have are not cut into passages, and passages
whose length no known text has are not hashed. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import numbered, stored, whole_text

BROADCAST_ROWS, CUED_ROWS, CUES = 100_000, 1000, 32

# Known licenses and notices, as their authors publish them.
MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, '
    "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
    'in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
    "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "The MIT License (MIT) " + MIT, "MIT License " + MIT, "The MIT License " + MIT, MIT],
    "BSD-2-Clause": ["BSD 2-Clause License " + BSD_START + BSD_END, "The 2-Clause BSD License " + BSD_START + BSD_END, BSD_START + BSD_END],
    "BSD-3-Clause": ["BSD 3-Clause License " + BSD_START + BSD_NAMES + BSD_END, "The 3-Clause BSD License " + BSD_START + BSD_NAMES + BSD_END, BSD_START + BSD_NAMES + BSD_END],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
        "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
        'software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org/>",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not "
        "be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
        "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        'the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS '
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
        "OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "GPL-3.0-or-later": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public "
        "License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "GPL-3.0-only": ["This work is licensed under the GNU General Public License, version 3."],
    "GPL-2.0-only": ["This work is licensed under the GNU General Public License, version 2."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
}

# Spellings that mean the same, after lower-casing and removal of punctuation.
SPELLINGS = (("licence", "license"), ("organisation", "organization"), ("authorisation", "authorization"), ("favour", "favor"),
             ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
             ("merchantibility", "merchantability"), ("https", "http"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F©“”‘’–—]+"
RIGHTS = r"(?m)^ ?(?:copyright [^\n]*[0-9]{4}[^\n]*|c [0-9]{4}[^\n]*|copyright (?:c )?year [^\n]*|all rights reserved ?)$"
BLANK_LINES, SPACES = r" ?\n ?\n[ \n]*", r"[ \n]+"


def canonical(text: Column) -> Column:
    """Lower case, words parted by one space, line ends kept, copyright lines empty, one spelling."""
    c = F.regexp_replace(F.translate(text, UPPER, LOWER), PUNCTUATION, " ")
    c = F.regexp_replace(c, RIGHTS, "")
    for other, usual in SPELLINGS:
        c = F.replace(c, F.lit(other), F.lit(usual))
    return c


def whole(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACES, " "))


def passages(c: Column) -> Column:
    """The text, its paragraphs and its lines, each as one line."""
    cut = F.concat(F.split(c, BLANK_LINES), F.split(c, "\n"))
    return F.array_union(F.array(whole(c)), F.transform(cut, whole))


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, t) for k, texts in KNOWN.items() for t in texts], "license_id string, text string")


def cue_words(forms: list[str], least: int = 6) -> list[str]:
    """A few words of which each form has one, for a quick test of texts: a passage equal to a form has its words.

    The word of ``least`` letters or more that the most forms have comes first; a form without
    such a word gives its longest.
    """
    left, cues = [set(f.split(" ")) for f in forms], []
    while left:
        counts = Counter(w for words in left for w in words if len(w) >= least)
        cue = max(counts, key=lambda w: (counts[w], len(w), w)) if counts else max(left[0], key=lambda w: (len(w), w))
        cues.append(cue)
        left = [words for words in left if cue not in words]
    return cues


def scan(docs: DataFrame, licenses: DataFrame, text_col: str = "text", id_col: str = "doc_id", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``_row, doc_id, licenses, n_licenses, is_license, text_digest`` for each row.

    ``licenses`` are the ids (sorted) of known texts equal to a passage in canonical form,
    ``is_license`` says that the text as a whole is one. A null or empty text has none; known
    texts that are null or empty in canonical form match nothing, repeated ones count once.
    Repeated rows and null ids are rows like any other; an empty table gives none; other
    columns are not read.
    """
    known = licenses.select("license_id", whole(canonical(F.col("text"))).alias("form")).where("form <> '' and license_id is not null")
    known = stored(known.select("license_id", "form", F.sha2("form", 256).alias("digest"), F.length("form").alias("size")).distinct(), "licenses")
    n_known, likely = known.count(), F.lit(True)
    if 0 < n_known <= CUED_ROWS:
        cues = cue_words([r["form"] for r in known.select("form").collect()])
        likely = reduce(or_, [F.contains("c", F.lit(w)) for w in cues[:CUES]]) if len(cues) <= CUES else likely
    if n_known <= broadcast_rows:
        sizes = [r["size"] for r in known.select("size").distinct().collect()]
        known = F.broadcast(known.drop("form"))
        fits = lambda p: F.length(p).isin(sizes) if sizes else F.lit(False)
    else:
        fits = lambda p: F.length(p) > 0
    forms = numbered(docs, F.col(id_col).alias("doc_id"), canonical(whole_text(text_col)).alias("c"))
    digests = F.flatten(F.transform(F.array("c"), lambda c: F.transform(F.filter(passages(c), fits), lambda p: F.sha2(p, 256))))
    digests = F.when(likely, digests).otherwise(F.array().cast("array<string>"))
    facts = stored(forms.select("_row", "doc_id", digests.alias("digests"), F.sha2(whole(F.col("c")), 256).alias("text_digest")), "passages")
    found = facts.select("_row", "text_digest", F.explode("digests").alias("digest")).join(known.select("license_id", "digest"), "digest")
    per_row = found.groupBy("_row").agg(
        F.sort_array(F.collect_set("license_id")).alias("licenses"), F.max(F.col("digest") == F.col("text_digest")).alias("is_license")
    )
    none = F.array().cast("array<string>")
    return facts.join(per_row, "_row", "left").select(
        "_row", "doc_id", F.coalesce("licenses", none).alias("licenses"), F.coalesce(F.size("licenses"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce("is_license", F.lit(False)).alias("is_license"), "text_digest",
    )


def scan_sql() -> str:
    """The same over ``documents`` with the known texts above, for DuckDB."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def form(text: str) -> str:
        c = f"regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), {quote(PUNCTUATION)}, ' ', 'g')"
        c = f"regexp_replace({c}, {quote(RIGHTS)}, '', 'g')"
        for other, usual in SPELLINGS:
            c = f"replace({c}, '{other}', '{usual}')"
        return c

    def line(c: str) -> str:
        return f"trim(regexp_replace({c}, {quote(SPACES)}, ' ', 'g'))"

    values = ", ".join(f"({quote(k)}, {quote(t)})" for k, texts in KNOWN.items() for t in texts)
    return f"""
WITH known AS (SELECT DISTINCT id, {line(form('t'))} AS form FROM (VALUES {values}) v(id, t)),
forms AS (SELECT row_number() OVER () AS r, doc_id, {form("coalesce(text, '')")} AS c FROM documents),
parts AS (SELECT r, {line('c')} AS part FROM forms
          UNION SELECT r, {line('p')} FROM (SELECT r, unnest(list_concat(regexp_split_to_array(c, {quote(BLANK_LINES)}), string_split(c, chr(10)))) AS p FROM forms)),
hits AS (SELECT r, string_agg(DISTINCT id, ',' ORDER BY id) AS licenses, count(DISTINCT id) AS n FROM parts JOIN known ON part = form GROUP BY r)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n, 0) AS n_licenses, {line('c')} IN (SELECT form FROM known) AS is_license,
       sha256({line('c')}) AS text_digest
FROM forms LEFT JOIN hits USING (r)
"""
