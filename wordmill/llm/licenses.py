"""Licences by sentence rules, in DataFrame functions alone.

A text is lower-cased, cut into sentences and each sentence reduced to its letters and digits. Sentences that are known
become identifiers, others are skipped, and a licence is recognised where its rule's identifiers follow each other in
the text's sequence. Rules are tried in order, and one that fits takes its identifiers out of the sequence, so a later rule
cannot use them again; a text whose known sentences fit no rule at all is ``UNKNOWN``. Some sentences have slots: whoever's
name stands there, they are the same sentence.

Texts are cut three times: at line ends, with lines joined, and with the lines of a paragraph joined,
where lines without letters and digits and lines that are only a URL end a sentence. So notices on a line of their own,
wrapped sentences, and wrapped paragraphs below a title or a copyright line are read. A "v." or "inc." before a digit or a
word that goes on ends no sentence at line ends and in paragraphs. It is one narrow pass: no shuffle, no Python.

Defined results: a null or empty text has no identifiers and no licences. Repeated sentences repeat their identifier. A
licence is named once; names are in the order of RULES (ties: what one cut found comes like what another did). Rows are judged
one by one, repeated rows alike; very long texts are read whole. An empty table gives an empty one. Other columns are kept, but
for license_sentences and licenses, which are made anew.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and of usual notices.
SENTENCES = {
    "apache_notice": "Licensed under the Apache License, Version 2.0",
    "apache_header_1": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache_header_2": "you may not use this file except in compliance with the License",
    "apache_header_3": "You may obtain a copy of the License at",
    "apache_header_4": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache_header_5": "See the License for the specific language governing permissions and limitations under the License",
    "mit_notice": "Released under the MIT License",
    "mit_notice_2": "Licensed under the MIT License",
    "mit_grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit_notice_kept": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit_as_is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "mit_liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc_as_is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS',
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd_names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_as_is": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED',
    "gpl3_notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl3_notice_2": "Licensed under the GNU General Public License, version 3",
    "gpl2_notice": "Licensed under the GNU General Public License, version 2",
    "gpl_free": "This program is free software",
    "gpl3_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2_terms_1": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl2_terms_2": "either version 2 of the License, or (at your option) any later version",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl_hope_2": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl_more": "See the GNU General Public License for more details",
    "mpl_terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl_copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "unlicense_free": "This is free and unencumbered software released into the public domain",
    "unlicense_grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "zlib_as_is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib_liability": "In no event will the authors be held liable for any damages arising from the use of this software",
    "zlib_grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "boost_notice": "Distributed under the Boost Software License, Version 1.0",
    "boost_grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following',
    "lgpl_free": "This library is free software",
    "lgpl_terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl21_version": "either version 2.1 of the License, or (at your option) any later version",
    "lgpl3_terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3_terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2_only_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "gpl3_only_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation",
    "epl2_notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "artistic2_terms": "you can redistribute it and/or modify it under the terms of the Artistic License 2.0",
    "cc0_notice": "Licensed under CC0 1.0",
    "cc_by_notice": "Licensed under CC BY 4.0",
    "cc_by_sa_notice": "Licensed under CC BY-SA 4.0",
    "cc_by_nc_notice": "Licensed under CC BY-NC 4.0",
    "cc_by_nd_notice": "Licensed under CC BY-ND 4.0",
    "cc_by_work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc_by_nc_work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
}

RULES = (
    ("Apache-2.0", ("apache_notice",)),
    ("Apache-2.0", ("apache_header_1", "apache_header_2", "apache_header_3", "apache_header_4", "apache_header_5")),
    ("Apache-2.0", ("apache_header_1", "apache_header_2", "apache_header_4", "apache_header_5")),
    ("MIT", ("mit_notice",)),
    ("MIT", ("mit_notice_2",)),
    ("MIT", ("mit_grant", "mit_notice_kept", "mit_as_is", "mit_liability")),
    ("ISC", ("isc_grant", "isc_as_is")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is")),
    ("Zlib", ("zlib_as_is", "zlib_liability", "zlib_grant")),
    ("BSL-1.0", ("boost_grant",)),
    ("BSL-1.0", ("boost_notice",)),
    ("LGPL-2.1-or-later", ("lgpl_free", "lgpl_terms", "lgpl21_version")),
    ("LGPL-3.0-or-later", ("lgpl_free", "lgpl3_terms")),
    ("AGPL-3.0-or-later", ("gpl_free", "agpl3_terms")),
    ("GPL-2.0-only", ("gpl_free", "gpl2_only_terms")),
    ("GPL-3.0-only", ("gpl_free", "gpl3_only_terms")),
    ("EPL-2.0", ("epl2_notice",)),
    ("Artistic-2.0", ("gpl_free", "artistic2_terms")),
    ("GPL-3.0", ("gpl3_notice",)),
    ("GPL-3.0", ("gpl3_notice_2",)),
    ("GPL-3.0-or-later", ("gpl_free", "gpl3_terms", "gpl_hope", "gpl_hope_2", "gpl_more")),
    ("GPL-2.0", ("gpl2_notice",)),
    ("GPL-2.0-or-later", ("gpl_free", "gpl2_terms_1", "gpl2_terms_2", "gpl_hope", "gpl_hope_2", "gpl_more")),
    ("MPL-2.0", ("mpl_terms", "mpl_copy")),
    ("Unlicense", ("unlicense_free", "unlicense_grant")),
    ("CC0-1.0", ("cc0_notice",)),
    ("CC-BY-4.0", ("cc_by_notice",)),
    ("CC-BY-4.0", ("cc_by_work",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_notice",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_notice",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_work",)),
    ("CC-BY-ND-4.0", ("cc_by_nd_notice",)),
)

#: Sentences and rules that only the operator reads, not its SQL: other wordings of public texts.
MORE_SENTENCES = {
    "mpl_copy_tls": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "mpl_copy_at": "If a copy of the MPL was not distributed with this file, You can obtain one at",
}
MORE_RULES = (("MPL-2.0", ("mpl_terms", "mpl_copy_tls")), ("MPL-2.0", ("mpl_terms", "mpl_copy_at")))

#: Slots: what a normalised sentence may say instead, and how it is read.
SLOTS = (
    (r"\bneither the names? of \P{Cc}{1,200}? nor the names? of (?:its|their|any) contributors", "neither the name of the copyright holder nor the names of its contributors"),
    (r"\bin no event shall \P{Cc}{1,200}? be liable for any claim", "in no event shall the authors or copyright holders be liable for any claim"),
    (r"\bthis software is provided by \P{Cc}{1,200}? as is and any express", "this software is provided by the copyright holders and contributors as is and any express"),
    (r"\bas is and the author disclaims all|\bas is and \P{Cc}{1,100}? disclaims? all", "as is and the author disclaims all"),
)
#: A licence whose sentences hold another's: where the first is found, the second one isn't named.
HOLDS = {"BSD-3-Clause": "BSD-2-Clause"}
#: The licence of known sentences that fit no rule.
UNKNOWN = "LicenseRef-unknown"

_STOP, _OTHER = r"[.:;!?]+\s+", r"[^\p{L}\p{N}\n]+"
_URL_LINE = r"(?:^|\n)[^\p{L}\p{N}\n]*+https?://\S++[^\S\n]*+(?=\n|$)"
_BLANK_LINES = r"\n[^\p{L}\p{N}]*\n"
_ABBREVIATED = r"\b(v|inc|ltd|corp|co)\.\s+(?=[0-9]|nor\b|and\b|or\b|be\b|as\b)"


def normal_form(sentence: str) -> str:
    return re.sub(r"[^\w\n]+|_", " ", sentence.lower()).strip()


def sentences(text: Column, joined: bool, paragraphs: bool = False) -> Column:
    """Normalised sentences of a text; ``joined``: line ends are spaces, with ``paragraphs`` only inside of these."""
    text = F.lower(F.coalesce(text, F.lit("")))
    if paragraphs:
        text = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), _URL_LINE, ".\n")
        text = F.regexp_replace(text, _BLANK_LINES, ".\n")
    if joined:
        text = F.translate(text, "\n\r", "  ")
    if paragraphs or not joined:
        text = F.regexp_replace(text, _ABBREVIATED, "$1 ")
    marked = F.regexp_replace(F.regexp_replace(text, _STOP, "\n"), _OTHER, " ")

    def filled(t: Column) -> Column:
        out = t
        for pattern, reading in SLOTS:
            out = F.regexp_replace(out, pattern, reading)
        some = F.contains(t, F.lit("neither the name")) | F.contains(t, F.lit("be liable for any claim")) | F.contains(t, F.lit("as is and"))
        return F.when(some, out).otherwise(t)  # few texts have a sentence with a slot

    # an array of one text, so the cuts above are made once for all that reads them
    return F.split(F.element_at(F.transform(F.array(marked), filled), 1), "\n")


def identifiers(found: Column) -> Column:
    known = F.create_map(*[F.lit(x) for name, s in (SENTENCES | MORE_SENTENCES).items() for x in (normal_form(s), name)])
    named = F.transform(found, lambda s: F.element_at(known, F.trim(s)))
    return F.filter(named, lambda i: i.isNotNull())


def matches(ids: Column) -> Column:
    """Licences of a sequence, in the order of the rules; each rule takes what it used out of the sequence."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(f" {' '.join(rule)} ").alias("run")) for name, rule in RULES + MORE_RULES])
    sequence = F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))

    def step(done: Column, rule: Column) -> Column:
        taken = F.struct(F.replace(done["left"], rule["run"], F.lit(" | ")).alias("left"), F.concat(done["found"], F.array(rule["name"])).alias("found"))
        return F.when(F.contains(done["left"], rule["run"]), taken).otherwise(done)

    found = F.aggregate(rules, F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found")), step, lambda done: done["found"])
    return F.when(F.size(ids) > 0, found).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column text), ``license_sentences`` (identifiers by lines) and ``licenses``."""
    by_line, joined, in_paragraphs = (identifiers(sentences(F.col("text"), *how)) for how in ((False,), (True,), (True, True)))
    out = docs.drop("license_sentences", "licenses", "license_joined", "license_paragraphs").withColumn("license_sentences", by_line)
    out = out.withColumn("license_joined", joined).withColumn("license_paragraphs", in_paragraphs)
    cuts = ("license_sentences", "license_joined", "license_paragraphs")
    either = F.concat(*[matches(F.col(c)) for c in cuts])
    order = F.array(*[F.lit(n) for n in dict.fromkeys(n for n, _ in RULES)])
    known = F.array_intersect(order, either)
    for more, less in HOLDS.items():
        known = F.when(F.array_contains(known, more), F.array_except(known, F.array(F.lit(less)))).otherwise(known)
    some = F.greatest(*[F.size(c) for c in cuts]) > 0
    return out.withColumn("licenses", F.when(some & (F.size(known) == 0), F.array(F.lit(UNKNOWN))).otherwise(known)).drop(*cuts[1:])


def sql() -> str:
    """The same scan in DuckDB."""
    known = ", ".join(f"'{normal_form(s)}': '{name}'" for name, s in SENTENCES.items())
    order = ", ".join(f"'{n}'" for n in dict.fromkeys(n for n, _ in RULES))
    hits = " || ".join(f"CASE WHEN contains(q, ' {' '.join(rule)} ') THEN ['{name}'] ELSE [] END" for name, rule in RULES)
    cut = r"list_filter(list_transform(string_split(regexp_replace(regexp_replace({t}, '[.:;!?]+\s+', chr(10), 'g'), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g'), chr(10)), lambda s: k.m[trim(s)]), lambda i: i IS NOT NULL)"
    return f"""
WITH k AS (SELECT MAP {{{known}}} AS m),
i AS (SELECT doc_id, {cut.format(t="lower(coalesce(text, ''))")} AS a, {cut.format(t="translate(lower(coalesce(text, '')), chr(10) || chr(13), '  ')")} AS b FROM documents, k),
h AS (SELECT doc_id, a, b, x.hits FROM i, LATERAL (SELECT flatten(list({hits})) AS hits FROM (VALUES (' ' || array_to_string(a, ' ') || ' '), (' ' || array_to_string(b, ' ') || ' ')) v(q)) x)
SELECT doc_id, coalesce(array_to_string(a, ','), '') AS license_sentences,
       CASE WHEN len(a) + len(b) > 0 AND len(hits) = 0 THEN '{UNKNOWN}' ELSE coalesce(array_to_string(list_filter([{order}], lambda n: list_contains(hits, n)), ','), '') END AS licenses FROM h
"""
