"""License scans by sentence rules, in DataFrame expressions within each row.

A text is cut to sentences twice: at sentence ends and blank lines, for wrapped text, and at every line end as
well. Each sentence is normalised to lower-case letters and digits and looked up among known license sentences.
A known sentence that holds a sentence end itself, as SPDX tags do, is found by its parts in a row.
The identifiers found, in order, are matched against rules: a rule names a license and the identifiers that must
follow one another. A rule that lies inside a longer rule that matched says nothing and is left out.

Defined results: NULL and empty texts have no sentences and no licenses; repeated rows are scanned each; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licenses and of notices that name them, by identifier.
SENTENCES = {
    "apache-ref": "Licensed under the Apache License, Version 2.0",
    "apache-you": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-copy-at": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "mit-ref": "Released under the MIT License",
    "mit-lic": "Licensed under the MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-ref": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    "gpl2-either": "either version 2 of the License, or (at your option) any later version",
    "gpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "mpl2-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-ref": "Licensed under CC BY 4.0",
    "cc-by-sa-ref": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-ref": "Licensed under CC BY-NC 4.0",
    "cc0-ref": "Licensed under CC0 1.0",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-or-later",
    "reserved": "All rights reserved",
}

# License and the identifiers that follow one another in it.
RULES = (
    ("Apache-2.0", "apache-ref"),
    ("Apache-2.0", "apache-you apache-comply"),
    ("Apache-2.0", "apache-you apache-comply apache-copy apache-basis apache-see"),
    ("Apache-2.0", "apache-you apache-comply apache-copy-at apache-basis apache-see"),
    ("Apache-2.0", "spdx-apache"),
    ("MIT", "mit-ref"),
    ("MIT", "mit-lic"),
    ("MIT", "mit-grant mit-notice"),
    ("MIT", "mit-grant mit-notice mit-warranty"),
    ("MIT", "spdx-mit"),
    ("ISC", "isc-grant"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-names"),
    ("BSD-3-Clause", "spdx-bsd3"),
    ("GPL-3.0-only", "gpl3-ref"),
    ("GPL-3.0-or-later", "gpl-free gpl3-terms"),
    ("GPL-3.0-or-later", "gpl-free gpl3-terms gpl-hope"),
    ("GPL-3.0-or-later", "spdx-gpl3"),
    ("GPL-2.0-or-later", "gpl-free gpl2-terms"),
    ("GPL-2.0-or-later", "gpl-free gpl-redistribute gpl2-either"),
    ("MPL-2.0", "mpl2-form"),
    ("CC-BY-4.0", "cc-by-ref"),
    ("CC-BY-4.0", "cc-by-work"),
    ("CC-BY-SA-4.0", "cc-by-sa-ref"),
    ("CC-BY-SA-4.0", "cc-by-sa-work"),
    ("CC-BY-NC-4.0", "cc-by-nc-ref"),
    ("CC0-1.0", "cc0-ref"),
    ("Unlicense", "unlicense-free"),
)

# Every known sentence holds one of these; a text with none of them is not cut at all.
# Parts of single words: what lies between two words of a sentence may be any signs and line ends.
ANCHORS = ("licen", "permission", "copyright", "warrant", "redistribut", "software", "version", "contributors", "reserved", "unencumbered")

_END = r"[.!?;:]+(?:\s+|$)"
WRAPPED = _END + r"|\n[ \t\r]*\n\s*"
LINES = _END + r"|\n+"


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def known() -> dict[str, str]:
    """Identifier by normalised sentence."""
    return {normal(text): name for name, text in SENTENCES.items()}


def cut_sentences() -> dict[tuple[str, ...], str]:
    """Identifier by normalised parts, for the known sentences that hold a sentence end themselves."""
    parts = {tuple(filter(None, map(normal, re.split(_END, text.lower())))): name for name, text in SENTENCES.items()}
    return {key: name for key, name in parts.items() if len(key) > 1}


def identifiers(text: Column, ends: str) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    literal = lambda pairs: F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    whole = literal(known())

    def names(parts: Column) -> Column:
        def name(part: Column, i: Column) -> Column:
            found = F.try_element_at(whole, part)
            for n in sorted({len(key) for key in cut_sentences()}):
                cut = {key: name for key, name in cut_sentences().items() if len(key) == n}
                joined = F.array_join(F.slice(parts, i + 1, n), "\n")
                rest = F.try_element_at(literal({"\n".join(key): name for key, name in cut.items()}), joined)
                found = F.coalesce(found, F.when(part.isin(sorted({key[0] for key in cut})), rest))
            return found

        return F.array_compact(F.transform(parts, name))

    # The array of one element binds the parts to a name, so that the text is cut once.
    parts = F.transform(F.split(F.lower(text), ends), lambda s: F.btrim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    return F.element_at(F.transform(F.array(parts), names), 1)


def matched(ids: Column) -> Column:
    """(license, rule) of the rules whose identifiers follow one another in ``ids``."""
    line = F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))
    rules = F.array(*[F.struct(F.lit(lic).alias("license"), F.lit(f" {rule} ").alias("rule")) for lic, rule in RULES])
    return F.filter(rules, lambda r: F.contains(line, r["rule"]))


def longest(hits: Column) -> Column:
    """``hits`` without the rules that lie inside a longer one."""
    return F.filter(hits, lambda r: ~F.exists(hits, lambda o: (o["rule"] != r["rule"]) & F.contains(o["rule"], r["rule"])))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, licenses, sentences (identifiers) and rules of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    low = F.lower(text)
    anchored = F.contains(low, F.lit(ANCHORS[0]))
    for anchor in ANCHORS[1:]:
        anchored = anchored | F.contains(low, F.lit(anchor))
    none = F.array().cast("array<string>")
    found = lambda ends: F.when(anchored, identifiers(text, ends)).otherwise(none)
    rows = docs.select("doc_id", found(WRAPPED).alias("wrapped"), found(LINES).alias("lines"))
    rows = rows.withColumn("all", F.array_union(matched(F.col("wrapped")), matched(F.col("lines")))).withColumn("hits", longest(F.col("all")))
    return rows.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.col("hits.license"))), ",").alias("licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.array_union("wrapped", "lines"))), ",").alias("sentences"),
        F.array_join(F.array_sort(F.transform("hits", lambda h: F.btrim(h["rule"]))), ",").alias("rules"),
    )
