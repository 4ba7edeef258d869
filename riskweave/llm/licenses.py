"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences in two ways: at sentence ends and every line end (for one-line
notices), and at sentence ends and blank lines (for wrapped licence texts). Sentences are
normalised (A-Z as a-z, runs of anything but letters and digits as one blank) and mapped to
identifiers of known licence sentences: fixed sentences, SPDX lines, and grants ("released
under ...") by the name they give. Licence rules are ordered sequences of identifiers; a
licence is recognised where its sequence stands without another known sentence in between.

Result: a row for each text with a known sentence: the identifiers of both cuts in order,
recognised licences (sorted, each once), and known sentences that no rule covers (most of the two
cuts). Texts without a known sentence give no row, which includes null, empty and white-space
texts; repeated rows give equal rows; rows without doc_id are reported with a null id; an empty
table gives no rows. Texts are searched whole; nothing is shuffled.
Further columns are not read, whatever their names.
"""

from __future__ import annotations

import string
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, normalised, and the sequences that make a licence.
FIXED = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including without "
    "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other "
    "liability whether in an action of contract tort or otherwise arising from out of or in connection with the "
    "software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this "
    "software including all implied warranties of merchantability and fitness",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and "
    "the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission",
    "bsd-warranty": "this software is provided by the copyright holders and contributors as is and any express or "
    "implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
    "particular purpose are disclaimed",
    "apache-compliance": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl-2-or-later": "you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-3-or-later": "you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-2.1-or-later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
    "published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-3-or-later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
    "published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-3-or-later": "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
    "published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl-2-subject": "this source code form is subject to the terms of the mozilla public license v",
    "epl-2-terms": "this program and the accompanying materials are made available under the terms of the eclipse public "
    "license 2 0 which is available at https www eclipse org legal epl 2 0",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications "
    "and to alter it and redistribute it freely subject to the following restrictions",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
    "software and accompanying documentation covered by this license the software to use reproduce display distribute "
    "execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom "
    "the software is furnished to do so all subject to the following",
    "cc0-waiver": "to the extent possible under law the person who associated cc0 with this work has waived all copyright "
    "and related or neighboring rights to this work",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "rights": "all rights reserved",
}
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("ISC", ["isc-grant", "isc-warranty"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-warranty"]),
    ("Apache-2.0", ["grant:Apache-2.0", "apache-compliance", "apache-copy"]),
    ("GPL-2.0-or-later", ["gpl-2-or-later", "gpl-warranty"]),
    ("GPL-3.0-or-later", ["gpl-3-or-later", "gpl-warranty"]),
    ("LGPL-2.1-or-later", ["lgpl-2.1-or-later", "gpl-warranty"]),
    ("LGPL-3.0-or-later", ["lgpl-3-or-later", "gpl-warranty"]),
    ("AGPL-3.0-or-later", ["agpl-3-or-later", "gpl-warranty"]),
    ("MPL-2.0", ["mpl-2-subject"]),
    ("EPL-2.0", ["epl-2-terms"]),
    ("Zlib", ["zlib-warranty", "zlib-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("CC0-1.0", ["cc0-waiver"]),
    ("Unlicense", ["unlicense"]),
]
# A header may also end its sentence before "either".
SPLIT = {
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published "
    "by the free software foundation",
    "lgpl-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
    "published by the free software foundation",
    "agpl-terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
    "published by the free software foundation",
    "lgpl-2.1-either": "either version 2 1 of the license or at your option any later version",
    "gpl-2-either": "either version 2 of the license or at your option any later version",
    "gpl-3-either": "either version 3 of the license or at your option any later version",
}
SPLIT_RULES = [
    ("GPL-2.0-or-later", ["gpl-terms", "gpl-2-either", "gpl-warranty"]),
    ("GPL-3.0-or-later", ["gpl-terms", "gpl-3-either", "gpl-warranty"]),
    ("LGPL-2.1-or-later", ["lgpl-terms", "lgpl-2.1-either", "gpl-warranty"]),
    ("LGPL-3.0-or-later", ["lgpl-terms", "gpl-3-either", "gpl-warranty"]),
    ("AGPL-3.0-or-later", ["agpl-terms", "gpl-3-either", "gpl-warranty"]),
]
#: Every fixed sentence has one of these in it.
TRIGGERS = ["licen", "permission", "redistribut", "warrant", "public domain", "liable", "rights reserved", "gpl", "spdx", "cc by", "cc-by", "neighboring rights"]
#: Or what else makes a known sentence, whatever stands between its words.
SPREAD = (
    "public[^a-z0-9]+domain|rights[^a-z0-9]+reserved|neighboring[^a-z0-9]+rights"
    "|(?:released|distributed|published|available|provided|offered|covered)[^a-z0-9]+(?:to[^a-z0-9]+you[^a-z0-9]+)?(?:under|by)[^a-z0-9]"
)
GRANT = (
    "^(?:(?:this|the) (?:work|software|project|code|source code|program|file|library|document|package|content|text|"
    "material|site) )?(?:is |are )?(?:free software |dual |also )?"
    "(?:licensed|released|distributed|published|available|made available|provided|offered|covered)"
    " (?:to you )?(?:under|by) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(.+?)(?: see .*| the license)?$"
)
SPDX = "^spdx license identifier (.+)$"
SPDX_LABEL = "spdx-license-identifier:"
SEPARATOR = "\x01"


def license_names() -> dict[str, str]:
    """Normalised name -> SPDX identifier, built from the families' rules."""
    out = {
        "mit license": "MIT", "mit": "MIT", "expat license": "MIT", "isc license": "ISC", "isc": "ISC",
        "zlib license": "Zlib", "zlib": "Zlib", "unlicense": "Unlicense", "boost software license 1 0": "BSL-1.0",
        "bsl 1 0": "BSL-1.0",
    }
    for n, word in ((2, "simplified"), (3, "new")):
        for name in (f"bsd {n} clause license", f"{n} clause bsd license", f"{word} bsd license", f"bsd {n} clause"):
            out[name] = f"BSD-{n}-Clause"
    for family, spdx, versions in (
        ("apache", "Apache", ("1.0", "1.1", "2.0")), ("mozilla public", "MPL", ("1.0", "1.1", "2.0")),
        ("eclipse public", "EPL", ("1.0", "2.0")),
    ):
        for v in versions:
            spaced = v.replace(".", " ")
            short = {spaced, v.split(".")[0]} if v.endswith(".0") else {spaced}
            for s in sorted(short):
                for name in (f"{family} license version {s}", f"{family} license {s}", f"{family} license v{s}", f"{spdx.lower()} {s}"):
                    out[name] = f"{spdx}-{v}"
            out[f"apache {spaced} license" if family == "apache" else f"{spdx.lower()} {spaced} license"] = f"{spdx}-{v}"
    for kind, spdx, versions in (
        ("general", "GPL", ("1", "2", "3")), ("lesser general", "LGPL", ("2", "2.1", "3")), ("affero general", "AGPL", ("1", "3")),
    ):
        for v in versions:
            full = v if "." in v else f"{v}.0"
            for s in sorted({v.replace(".", " "), full.replace(".", " ")}):
                for name in (
                    f"gnu {kind} public license version {s}", f"gnu {kind} public license v{s}", f"{kind} public license version {s}",
                    f"gnu {spdx.lower()} version {s}", f"gnu {spdx.lower()} v{s}", f"{spdx.lower()} version {s}",
                    f"{spdx.lower()} v{s}", f"{spdx.lower()}v{s}", f"{spdx.lower()} {s}",
                ):
                    out[name] = out[f"{name} only"] = f"{spdx}-{full}-only"
                    for later in ("or later", "or any later version", "or at your option any later version"):
                        out[f"{name} {later}"] = f"{spdx}-{full}-or-later"
    long = {"by": "attribution", "nc": "noncommercial", "sa": "sharealike", "nd": "noderivatives"}
    for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"):
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            spaced, spdx = v.replace(".", " "), f"CC-{kind.upper()}-{v}"
            short, words = kind.replace("-", " "), " ".join(long[k] for k in kind.split("-"))
            for name in (f"cc {short} {spaced}", f"creative commons {short} {spaced}", f"creative commons {words} {spaced}"):
                for end in ("", " license", " international", " international license", " unported license"):
                    out[name + end] = spdx
    for name in ("cc0 1 0", "cc0", "cc0 1 0 universal", "creative commons zero 1 0", "creative commons zero v1 0 universal"):
        out[name] = "CC0-1.0"
    return out


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, pairs)), F.array(*map(F.lit, pairs.values())))


def _has_trigger(x: Column) -> Column:
    return reduce(or_, [F.contains(x, F.lit(t)) for t in TRIGGERS]) | F.rlike(x, F.lit(SPREAD))


def _cut(text: Column) -> Column:
    """Sentences of a text whose line ends are settled."""
    return F.split(F.regexp_replace(text, "([.!?;:])[ \\t\\r\\f]+", f"$1{SEPARATOR}"), SEPARATOR)


def _identify(sentence: Column) -> Column:
    """The identifier of a sentence, or null."""
    plain = F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))
    names = _literal_map(license_names())

    def named(pattern):
        return F.concat(F.lit("grant:"), F.element_at(names, F.regexp_extract(plain, pattern, 1)))

    return F.coalesce(F.element_at(_literal_map({s: i for i, s in (FIXED | SPLIT).items()}), plain), named(GRANT), named(SPDX))


def _known(sentences: Column) -> Column:
    found = F.transform(F.filter(sentences, _has_trigger), _identify)
    return F.filter(found, lambda x: x.isNotNull())


def _between(ids: Column) -> Column:
    return F.concat(F.lit("|"), F.array_join(F.transform(ids, lambda x: F.concat(x, F.lit("|"))), "|"))


def _recognised(ids: Column) -> tuple[Column, Column]:
    """(licences of the rules that match, the identifiers that are left)."""
    rest = _between(ids)
    found = []
    for name, rule in RULES + SPLIT_RULES:
        key = "|" + "||".join(rule) + "|"
        found.append(F.when(F.contains(rest, F.lit(key)), F.lit(name)))
        rest = F.replace(rest, F.lit(key), F.lit(""))
    left = F.filter(F.split(rest, "\\|"), lambda x: x != "")
    # A grant is a rule of its own.
    grants = F.transform(F.filter(left, lambda x: x.startswith("grant:")), lambda x: F.substring(x, 7, 100))
    left = F.filter(left, lambda x: ~x.startswith("grant:") & (x != "rights"))
    return F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()), grants), left


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, line_sentences, wrapped_sentences, licenses, uncovered) of texts with known sentences."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    # The colon of an SPDX line ends no sentence.
    lowered = F.replace(lowered, F.lit(SPDX_LABEL), F.lit(SPDX_LABEL[:-1]))
    lowered = docs.select("doc_id", lowered.alias("t")).filter(_has_trigger(F.col("t")))
    lines = _cut(F.replace("t", F.lit("\n"), F.lit(SEPARATOR)))
    blank = F.regexp_replace("t", "\\n[ \\t\\r\\f]*\\n", SEPARATOR)
    wrapped = _cut(F.replace(blank, F.lit("\n"), F.lit(" ")))
    ids = lowered.select("doc_id", _known(lines).alias("a"), _known(wrapped).alias("b"))
    ids = ids.filter((F.size("a") > 0) | (F.size("b") > 0))
    (one, rest_one), (two, rest_two) = _recognised(F.col("a")), _recognised(F.col("b"))
    return ids.select(
        "doc_id",
        F.array_join("a", ",").alias("line_sentences"),
        F.array_join("b", ",").alias("wrapped_sentences"),
        F.array_join(F.sort_array(F.array_union(one, two)), ",").alias("licenses"),
        F.greatest(F.size(rest_one), F.size(rest_two)).alias("uncovered"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle() -> str:
    """The same rows in DuckDB SQL: sentences as rows, joined to tables of sentences and names."""
    fixed = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for i, s in (FIXED | SPLIT).items())
    names = ", ".join(f"({_quoted(n)}, {_quoted(i)})" for n, i in license_names().items())
    trigger = " OR ".join([*(f"contains(s, {_quoted(t)})" for t in TRIGGERS), f"regexp_matches(s, {_quoted(SPREAD)})"])
    sep = "chr(1)"

    def cut(expr):
        return f"string_split(regexp_replace({expr}, '([.!?;:])[ \\t\\r\\f]+', '\\1' || {sep}, 'g'), {sep})"

    rest, hits = "coalesce(seq, '|')", []
    for name, rule in RULES + SPLIT_RULES:
        key = _quoted("|" + "||".join(rule) + "|")
        hits.append(f"CASE WHEN contains({rest}, {key}) THEN {_quoted(name)} END")
        rest = f"replace({rest}, {key}, '')"
    return f"""
WITH fixed(s, id) AS (VALUES {fixed}), names(s, id) AS (VALUES {names}),
docs AS (SELECT row_number() OVER () AS r, doc_id,
  replace(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{SPDX_LABEL}', '{SPDX_LABEL[:-1]}') AS t
  FROM documents),
cuts AS (
  SELECT r, doc_id, 0 AS cut, {cut(f"replace(t, chr(10), {sep})")} AS parts FROM docs
  UNION ALL
  SELECT r, doc_id, 1, {cut(f"replace(regexp_replace(t, '\\n[ \\t\\r\\f]*\\n', {sep}, 'g'), chr(10), ' ')")} FROM docs),
sentences AS (SELECT r, doc_id, cut, unnest(parts) AS s, generate_subscripts(parts, 1) AS pos FROM cuts),
plain AS (SELECT r, doc_id, cut, pos, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) AS s FROM sentences WHERE {trigger}),
known AS (
  SELECT r, doc_id, cut, pos, coalesce(f.id, 'grant:' || g.id, 'grant:' || x.id) AS id
  FROM plain p LEFT JOIN fixed f ON p.s = f.s
  LEFT JOIN names g ON g.s = regexp_extract(p.s, '{GRANT}', 1)
  LEFT JOIN names x ON x.s = regexp_extract(p.s, '{SPDX}', 1)
  WHERE coalesce(f.id, g.id, x.id) IS NOT NULL),
seqs AS (SELECT r, doc_id, cut, string_agg(id, ',' ORDER BY pos) AS ids,
  '|' || string_agg(id || '|', '|' ORDER BY pos) AS seq FROM known GROUP BY ALL),
matched AS (SELECT r, doc_id, cut, ids, list_filter([{', '.join(hits)}], lambda x: x IS NOT NULL) AS found,
  list_filter(string_split({rest}, '|'), lambda x: x <> '') AS rest FROM seqs),
graded AS (SELECT *, list_concat(found, list_transform(list_filter(rest, lambda x: starts_with(x, 'grant:')), lambda x: substr(x, 7))) AS lic,
  len(list_filter(rest, lambda x: NOT starts_with(x, 'grant:') AND x <> 'rights')) AS n FROM matched)
SELECT any_value(doc_id) AS doc_id,
  coalesce(max(ids) FILTER (cut = 0), '') AS line_sentences,
  coalesce(max(ids) FILTER (cut = 1), '') AS wrapped_sentences,
  array_to_string(list_sort(list_distinct(flatten(list(lic)))), ',') AS licenses,
  CAST(max(n) AS INTEGER) AS uncovered
FROM graded GROUP BY r"""
