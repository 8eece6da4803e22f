"""Licence scans: canonical digests of whole texts, looked up among known ones.

A text is brought to a canonical form (lower case, copyright lines out, punctuation out,
equivalent spellings made one), and the SHA-256 of that form is joined to the digests
of the known texts.  The whole document is one such text and every run of its lines another, since
notices and licences start and end with a line, wrapped or not; ``license_id`` comes from the whole text,
``notices`` from the runs.  A run is tried only where a line starts with the first words of a known text, over as
many words as that text has.  In a document that is a known licence as a whole only single lines are notices.  The known texts are given under several headings and with or without list markers.

Edge cases: null, empty and punctuation-only texts have no digest and match nothing.  Repeated
rows get equal answers; rows that share a ``doc_id`` are told apart by their text.  Of several known ids with
one canonical form the smallest is given.  Without known texts nothing matches.
Further columns are ignored.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm.common import broadcast_checked

# Spellings that count as one.
EQUIVALENT = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "acknowledgement": "acknowledgment",
    "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "calibre": "caliber", "cancelled": "canceled", "capitalisation": "capitalization", "catalogue": "catalog", "categorise": "categorize",
    "centre": "center", "colour": "color", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "modelling": "modeling",
    "noncommercial": "noncommercial", "optimise": "optimize", "organisation": "organization", "organise": "organize", "owner": "holder",
    "owners": "holders", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "wilfull",
}

COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|by )|\(c\)[ \t]*[0-9a-z]|©|all rights reserved)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}\n]+"

# Notices and short licences in full.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission."""
_BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_REST}"),
    ("ISC", f"ISC License {_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_REST}"),
    ("0BSD", f"{_ISC_GRANT}. {_ISC_REST}"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_REST}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3} {_BSD_REST}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]

# The texts beside this file are whole licences, one a file, named by id.
TEXTS = Path(__file__).with_name("licence_texts")
# Headings that short licences bear.
HEADINGS = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "Zero Clause BSD License", "BSD 0-Clause License", "0BSD"],
    "BSD-2-Clause": [
        "BSD 2-Clause License", "The BSD 2-Clause License", "2-Clause BSD License", "The 2-Clause BSD License",
        'BSD 2-Clause "Simplified" License', "Simplified BSD License", "FreeBSD License", "BSD License", "The BSD License", "BSD-2-Clause",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", "3-Clause BSD License", "The 3-Clause BSD License", "New BSD License",
        'BSD 3-Clause "New" or "Revised" License', "Modified BSD License", "Revised BSD License", "BSD License", "The BSD License", "BSD-3-Clause",
    ],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
NAMES = {
    "MIT": ["MIT License"], "ISC": ["ISC License"], "Apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License"], "MPL-2.0": ["Mozilla Public License 2.0", "MPL 2.0"],
    "GPL-2.0": ["GNU General Public License v2.0", "GPL v2"], "GPL-3.0": ["GNU General Public License v3.0", "GPL v3"],
    "LGPL-2.1": ["GNU Lesser General Public License v2.1"], "LGPL-3.0": ["GNU Lesser General Public License v3.0"],
    "AGPL-3.0": ["GNU Affero General Public License v3.0", "AGPL v3"], "EPL-2.0": ["Eclipse Public License 2.0"],
    "CC0-1.0": ["CC0 1.0"], "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License"], "Unlicense": ["Unlicense"],
}
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""
_MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
_GNU_NOTICE = """This program is free software{}you can redistribute it and/or modify it under the terms of the GNU {} General Public License as
published by the Free Software Foundation{}either version {} of the License, or (at your option) any later version."""
_MARKER = re.compile(r"(?<=[\s:.])[123]\.\s")


def _variants(license_id: str, text: str) -> list[str]:
    """A known text as it is met: with and without appendix, place holders, list markers and headings."""
    made = [text]
    end = re.search(r"END OF TERMS AND CONDITIONS", text)
    if end:
        # the sample notices after the terms are often left out, or hold a name and a year
        bare = re.sub(r"(?mi)^[ \t]*copyright[ \t]*[\[{<].*$", "", text)
        made += [bare, text[: end.end()], text[: end.start()]]
    if license_id.startswith("BSD"):
        made.append(_MARKER.sub(" ", text))
        made.append(_MARKER.sub(lambda m: f"({'abc'[int(m.group()[0]) - 1]}) ", text))
    made += [x.replace("http://", "https://") for x in made if "http://" in x] + [x.replace("https://", "http://") for x in made if "https://" in x]
    return made + [f"{h}\n{x}" for h in HEADINGS.get(license_id, []) for x in made]


def all_known() -> list[tuple[str, str]]:
    """(license_id, text) of the short list, of its variants, of the whole texts beside this file and of notices."""
    whole = [(i, t) for i, t in KNOWN if len(t) > 400] + [(p.stem, p.read_text("utf-8")) for p in sorted(TEXTS.glob("*.txt"))]
    notices = [("Apache-2.0", _APACHE_NOTICE), ("MPL-2.0", _MPL_NOTICE)]
    for kind, versions in (("", "23"), ("Lesser", ("2.1", "3")), ("Affero", "3")):
        for v in versions:
            name = f"{ {'': '', 'Lesser': 'L', 'Affero': 'A'}[kind] }GPL-{v if '.' in v else v + '.0'}"
            notices += [(name, _GNU_NOTICE.format("; ", kind, "; ", v)), ("" + name, _GNU_NOTICE.format(": ", kind, ", ", v))]
    for i, names in NAMES.items():
        notices += [(i, f"SPDX-License-Identifier: {i}")]
        if "GPL" in i:
            notices += [(i, f"SPDX-License-Identifier: {i}-{x}") for x in ("only", "or-later")]
        for n in names:
            notices += [(i, f"{how} the {n}") for how in ("Released under", "Licensed under", "This project is licensed under", "This work is licensed under")]
    notices = [(i, v) for i, t in notices for v in {t, t.replace("http://", "https://")}]
    return [*KNOWN, *[(i, v) for i, t in whole for v in _variants(i, t)], *notices]


def _spelt(line: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in sorted(EQUIVALENT.items()) for x in pair])
    words = F.transform(F.split(line, " "), lambda w: F.coalesce(F.try_element_at(pairs, w), w))
    return F.array_join(words, " ")


def canonical_lines(text: Column) -> Column:
    """The lines of a text in canonical form; a line without words is empty."""
    bare = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    spaced = F.regexp_replace(bare, NOT_WORD, " ")
    return F.transform(F.split(spaced, "\n"), lambda x: _spelt(F.trim(x)))


def canonical_text(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def digests(known: DataFrame) -> DataFrame:
    """digest, license_id of known texts (license_id, text)."""
    form = canonical_text(canonical_lines(F.col("text")))
    return (
        known.select("license_id", form.alias("form"))
        .where(F.col("form") != "")
        .groupBy(F.sha2("form", 256).alias("digest"))
        .agg(F.min("license_id").alias("license_id"))
    )


def known_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(dict.fromkeys(all_known())), "license_id string, text string")


def _beginnings(known: DataFrame) -> tuple[int, dict[str, list[int]]]:
    """How many words begin a run (as many as the shortest known text has, four at most), and by those words the lengths of known texts."""
    words = F.split(canonical_text(canonical_lines(F.col("text"))), " ")
    sized = known.select(words.alias("w")).where("w[0] <> ''").select(F.slice("w", 1, 4).alias("b"), F.size("w").alias("n")).distinct().collect()
    least = min((len(r["b"]) for r in sized), default=0)
    lengths: dict[str, set[int]] = {}
    for r in sized:
        lengths.setdefault(" ".join(r["b"][:least]), set()).add(r["n"])
    return least, {b: sorted(n) for b, n in sorted(lengths.items())}


def _run(lines: Column, at: Column, n: Column) -> Column:
    """The n words from the start of a line on, with their line breaks, if they end with a line; else null."""
    # each line has a word at least, and both forms have their characters at the same places
    broken = F.array_join(F.slice(lines, at + 1, n), "\n")
    length = F.length(F.call_function("substring_index", F.translate(broken, "\n", " "), F.lit(" "), n))
    return F.when(F.substring(broken, length + 1, F.lit(1)).isin("", "\n"), F.substring(broken, F.lit(1), length))


def runs(lines: Column, least: int, lengths: dict[str, list[int]]) -> Column:
    """Runs of lines that may be known texts; ``lines`` without empty ones."""
    if not lengths:
        return F.array().cast("array<string>")
    by = F.create_map(*[x for b, n in lengths.items() for x in (F.lit(b), F.array(*map(F.lit, n)))])
    first = sorted({b.split(" ")[0] for b in lengths})
    places = F.filter(
        F.transform(lines, lambda x, i: F.when(F.substring_index(x, " ", 1).isin(first), i)), lambda i: i.isNotNull()
    )
    begun = F.transform(
        places,
        lambda i: F.struct(
            i.alias("i"), F.substring_index(F.array_join(F.slice(lines, i + 1, F.lit(least)), " "), " ", least).alias("b")
        ),
    )
    begun = F.filter(begun, lambda x: x["b"].isin(list(lengths)))
    found = F.transform(begun, lambda x: F.transform(F.try_element_at(by, x["b"]), lambda n: _run(lines, x["i"], n)))
    return F.array_distinct(F.filter(F.flatten(found), lambda r: r.isNotNull()))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, digest, license_id, notices (sorted ids, comma-joined); known texts are license_id, text."""
    known = known if known is not None else known_licences(docs.sparkSession)
    least, lengths = _beginnings(known)
    known = digests(known)
    listed = broadcast_checked(known, F.length("digest") + F.length("license_id"))
    key = F.xxhash64("text").alias("_key")
    lines = docs.select("doc_id", key, canonical_lines(F.col("text")).alias("lines"))
    full = lines.select("doc_id", "_key", F.filter("lines", lambda x: x != "").alias("lines"))
    found = (
        full.select("doc_id", "_key", F.explode(runs(F.col("lines"), least, lengths)).alias("run"))
        .select("doc_id", "_key", F.sha2(F.translate("run", "\n", " "), 256).alias("digest"), (F.instr("run", "\n") == 0).alias("_line"))
        .join(listed, "digest")
        .groupBy(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"))
        .agg(
            F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("_all"),
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("_line"), F.col("license_id")))), ",").alias("_lines"),
        )
    )
    form = canonical_text(F.col("lines"))
    whole = lines.select("doc_id", "_key", F.when(form != "", F.sha2(form, 256)).alias("digest")).join(listed, "digest", "left")
    on = whole["doc_id"].eqNullSafe(found["_id"]) & (whole["_key"] == found["_k"])
    # a known licence as a whole is not listed again for the lines that it is made of
    notices = F.coalesce(F.when(F.col("license_id").isNull(), F.col("_all")).otherwise(F.col("_lines")), F.lit(""))
    return whole.join(found, on, "left").select("doc_id", "digest", "license_id", notices.alias("notices"))
