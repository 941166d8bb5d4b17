"""Licence recognition by sentences.

A text is cut into sentences, twice: with every line break as an end, and with lines
run on up to a line without letters and digits or a colon at a line's end, for text
that is wrapped, be it in comments or not.  Normalised sentences that are known have
identifiers; what is left of a text is its sequence of these.  A licence is present
where a sentence states its name, or where one of its rules, an ordered run of
identifiers, is in the sequence.

Only DataFrame functions are used; texts without any of the words that known
sentences contain are not cut up at all.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licences by their public short names, and the long names they are stated by.
NAMES = {
    "0BSD": ["zero clause bsd license", "bsd zero clause license"],
    "AFL-3.0": ["academic free license version 3 0"],
    "Apache-1.1": ["apache software license version 1 1"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache software license version 2 0"],
    "Artistic-2.0": ["artistic license 2 0"],
    "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license", "2 clause bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "new bsd license", "modified bsd license", "3 clause bsd license"],
    "BSL-1.0": ["boost software license version 1 0"],
    "CC0-1.0": ["cc0", "cc0 1 0 universal", "creative commons zero v1 0 universal"],
    "CDDL-1.0": ["common development and distribution license version 1 0"],
    "CECILL-2.1": ["cecill license version 2 1"],
    "EPL-1.0": ["eclipse public license version 1 0", "eclipse public license v1 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license v2 0", "eclipse public license 2 0"],
    "EUPL-1.2": ["european union public licence version 1 2", "european union public license version 1 2"],
    "ISC": ["isc license"],
    "MIT": ["mit license", "expat license"],
    "MIT-0": ["mit no attribution license"],
    "MPL-1.1": ["mozilla public license version 1 1"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0"],
    "MS-PL": ["microsoft public license"],
    "NCSA": ["university of illinois ncsa open source license"],
    "ODbL-1.0": ["open data commons open database license", "open database license version 1 0"],
    "OFL-1.1": ["sil open font license version 1 1"],
    "PostgreSQL": ["postgresql license"],
    "PSF-2.0": ["python software foundation license version 2"],
    "Unlicense": ["unlicense license"],
    "WTFPL": ["do what the fuck you want to public license"],
    "Zlib": ["zlib license"],
}
#: The public licences of one family, by the parts of their names.
GNU = {"GPL": ("general", ["1.0", "2.0", "3.0"]), "LGPL": ("lesser general", ["2.1", "3.0"]), "AGPL": ("affero general", ["3.0"])}
ELEMENTS = {"": "", "-NC": " noncommercial", "-SA": " sharealike", "-ND": " noderivatives", "-NC-SA": " noncommercial sharealike", "-NC-ND": " noncommercial noderivatives"}
PORTS = {"4.0": "international", "3.0": "unported"}
#: Known sentences of licence texts, lower-case, with one space for all that is no letter or digit.
TEXTS = {
    "a2": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "a3": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "a4": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "a5": "see the license for the specific language governing permissions and limitations under the license",
    "m4": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "m5": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "m6": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "m7": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "b1": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "b2": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "b3": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "b4": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "o1": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "p1": "this source code form is subject to the terms of the mozilla public license v",
    "p2": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "p3": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "u1": "this is free and unencumbered software released into the public domain",
    "z1": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "z2": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "zl1": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "zl2": "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
    "zl3": "this notice may not be removed or altered from any source distribution",
    "s": "all rights reserved",
}
#: A licence and the runs of sentences that show it.
RULES = [
    ("0BSD", ["z2"]), ("Apache-2.0", ["a2", "a3"]), ("Apache-2.0", ["a2", "a4", "a5"]), ("Apache-2.0", ["a4", "a5"]), ("BSD-2-Clause", ["b1", "b2", "b3"]), ("BSD-3-Clause", ["b1", "b2", "b3", "b4"]),
    ("BSL-1.0", ["o1"]), ("ISC", ["z1"]), ("MIT", ["m4", "m5"]), ("MIT", ["m5", "m6", "m7"]), ("MPL-2.0", ["p1", "p2"]), ("MPL-2.0", ["p3"]), ("Unlicense", ["u1"]), ("Zlib", ["zl1", "zl2", "zl3"]), ("all-rights-reserved", ["s"]),
]
#: A rule whose run begins another rule's run yields to it where both match at once.
YIELDS = {"BSD-2-Clause": "BSD-3-Clause"}

#: What stands before a licence's name in a sentence that states it; all of it becomes one word.
VERBS = "licensed|released|distributed|published|available|provided"
LEAD = (
    "^(?:(?:this|the) (?:work|project|software|program|library|package|file|code|source code|document|documentation|repository|module|content|text) is )?(?:dual |made )?"
    f"(?:{VERBS}) under (?:the terms (?:and conditions )?of )?(?:(?:the|a|an) )?|^spdx license identifier |^licen[cs]e "
)
#: Words of which a text with a known sentence has one, if it has none of the verbs before "under".
WORDS = ["licen", "permission", "permitted", "redistribut", "warrant", "liable", "reserved", "unencumbered", "altered", "mozilla"]


def _plain(name: str) -> str:
    return re.sub("[^a-z0-9]+", " ", name.lower()).strip()


def _long_names() -> dict[str, list[str]]:
    """The licences of ``NAMES`` and those of the two families, each with its long names."""
    names = dict(NAMES)
    for short, (kind, versions) in GNU.items():
        for version in versions:
            spoken = _plain(version.removesuffix(".0"))
            stated = [f"gnu {kind} public license version {spoken}", f"gnu {kind} public license v{spoken}", f"gnu {short.lower()} version {spoken}", f"{short.lower()}v{spoken}", _plain(f"{short} {version} only")]
            names[f"{short}-{version}"] = stated
            names[f"{short}-{version}-or-later"] = [f"{s} or later" for s in stated[:4]] + [f"{stated[0]} or at your option any later version"]
    for short, elements in ELEMENTS.items():
        for version, port in PORTS.items():
            stated = f"creative commons attribution{elements} {_plain(version)}"
            names[f"CC-BY{short}-{version}"] = [f"{stated} {port} license", f"{stated} {port}", f"{stated} license"]
    return names


def _known() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Identifiers by sentence, and all rules. A sentence that states a licence has ``@`` and its short name."""
    known = {re.sub(LEAD, "under ", sentence): name for name, sentence in TEXTS.items()}
    rules = list(RULES)
    for short, names in _long_names().items():
        known |= {f"under {name}": f"@{short}" for name in [_plain(short), *names]}
    for short, (kind, versions) in GNU.items():
        for what in ("program", "library", "software"):
            known[f"this {what} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"] = "g-hope"
            for version in versions:
                known[f"this {what} is free software you can redistribute it and or modify it under the terms of the gnu {kind} public license as published by the free software foundation either version {_plain(version.removesuffix('.0'))} of the license or at your option any later version"] = f"g-{short}-{version}"
        known[f"see the gnu {kind} public license for more details"] = f"g-{short}"
        rules += [(f"{short}-{version}-or-later", [f"g-{short}-{version}", then]) for version in versions for then in ("g-hope", f"g-{short}")]
    return known, rules


KNOWN, ALL_RULES = _known()

if any(not s.startswith("under ") and not any(word in s for word in WORDS) for s in KNOWN):
    raise AssertionError("a known sentence has none of the words that texts are searched for")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The end of a paragraph: a line without letters and digits, or a colon at a line's end.
_GAP = r"\n[^A-Za-z0-9\n]*\n|:[ \t\r]*\n"


def _normal(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[^a-z0-9]+", " "))
    return F.regexp_replace(F.regexp_replace(plain, r"\bhttps\b", "http"), LEAD, "under ")


def _may_have_any(small: Column) -> Column:
    """Whether a lower-case text has a word of a known sentence; plain searches first, the expression only where verb and "under" occur."""
    words = functools.reduce(Column.__or__, (F.contains(small, F.lit(w)) for w in WORDS))
    verbs = functools.reduce(Column.__or__, (F.contains(small, F.lit(v)) for v in VERBS.split("|")))
    return words | (F.contains(small, F.lit("under")) & verbs & small.rlike(f"(?:{VERBS})[^a-z0-9]+under"))


def _identifiers(text: Column, wrapped: bool) -> Column:
    """The identifiers of known sentences in order."""
    if wrapped:
        text = F.regexp_replace(text, _GAP, "\u0001")
        text = F.replace(F.translate(text, "\n", " "), F.lit("\u0001"), F.lit("\n"))
    sentences = F.split(F.regexp_replace(text, r"([.!?])[ \t\r\n]+", "$1\n"), "\n")
    known = F.str_to_map(F.lit(";".join(f"{s}={n}" for s, n in KNOWN.items())), F.lit(";"), F.lit("="))  # folded into one literal
    return F.coalesce(F.filter(F.transform(sentences, lambda s: F.try_element_at(known, _normal(s))), lambda n: n.isNotNull()), F.array().cast("array<string>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, licenses, n_sentences, sentences) for each row.

    ``licenses`` lists the licences found, sorted, comma-joined; ``sentences`` the
    identifiers of known sentences in order, line by line, and after these the ones that
    only lines run on give; ``n_sentences`` is their number.  Null and empty texts, and
    texts without a known sentence, have empty ones.  Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.lower(text).alias("small"))
    rows = rows.select("doc_id", F.when(_may_have_any(F.col("small")), F.col("text")).alias("text"))
    rows = rows.select("doc_id", _identifiers(F.col("text"), False).alias("by_line"), _identifiers(F.col("text"), True).alias("run_on"))
    rows = rows.withColumns({f"{c}_run": F.concat(F.lit(";"), F.array_join(c, ";"), F.lit(";")) for c in ("by_line", "run_on")})
    found: dict[str, Column] = {}
    for name, run in ALL_RULES:
        needle = f";{';'.join(run)};"
        here = F.col("by_line_run").contains(needle) | F.col("run_on_run").contains(needle)
        found[name] = found[name] | here if name in found else here
    for weak, strong in YIELDS.items():
        found[weak] = found[weak] & ~found[strong]
    stated = F.transform(F.filter(F.concat("by_line", "run_on"), lambda n: n.startswith("@")), lambda n: F.substring(n, 2, 99))
    by_rule = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in found.items())))
    sentences = F.concat("by_line", F.filter("run_on", lambda n: ~F.array_contains("by_line", n)))
    return rows.select(
        "doc_id", F.array_join(F.array_sort(F.array_distinct(F.concat(stated, by_rule))), ",").alias("licenses"), F.size(sentences).alias("n_sentences"), F.array_join(sentences, ",").alias("sentences")
    )


def oracle_sql() -> str:
    """The same scan for DuckDB."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"{quote(s)}: {quote(n)}" for s, n in KNOWN.items())
    found: dict[str, list[str]] = {}
    for name, run in ALL_RULES:
        needle = quote(f";{';'.join(run)};")
        found.setdefault(name, []).append(f"contains(by_line, {needle}) OR contains(run_on, {needle})")
    tests = {name: f"({' OR '.join(x)})" for name, x in found.items()}
    for weak, strong in YIELDS.items():
        tests[weak] = f"({tests[weak]} AND NOT {tests[strong]})"
    names = ", ".join(f"CASE WHEN {test} THEN {quote(n)} END" for n, test in tests.items())
    plain = "trim(regexp_replace(translate(s, '" + _UPPER + "', '" + _LOWER + "'), '[^a-z0-9]+', ' ', 'g'))"
    identify = (
        "list_filter(list_transform(string_split(regexp_replace({}, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)), "
        f"lambda s: known[regexp_replace(regexp_replace({plain}, '\\bhttps\\b', 'http', 'g'), '{LEAD}', 'under ')]), lambda n: n IS NOT NULL)"
    )
    wrapped = f"replace(replace(regexp_replace(t, '{_GAP}', chr(1), 'g'), chr(10), ' '), chr(1), chr(10))"
    return f"""
WITH k AS (SELECT MAP {{{known}}} AS known),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, {identify.format("t")} AS a, {identify.format(wrapped)} AS b FROM d, k),
q AS (SELECT doc_id, a, b, ';' || coalesce(array_to_string(a, ';'), '') || ';' AS by_line, ';' || coalesce(array_to_string(b, ';'), '') || ';' AS run_on, list_concat(a, list_filter(b, lambda n: NOT list_contains(a, n))) AS c FROM s),
r AS (SELECT *, list_concat(list_transform(list_filter(list_concat(a, b), lambda n: n[1] = '@'), lambda n: n[2:]), list_filter([{names}], lambda n: n IS NOT NULL)) AS l FROM q)
SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(l)), ','), '') AS licenses, len(c)::INT AS n_sentences, coalesce(array_to_string(c, ','), '') AS sentences FROM r
"""
