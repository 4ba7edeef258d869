import duckdb
import pytest

from riskweave.llm import licenses
from riskweave.llm.queries import ORACLES, op9_licenses
from tests.llm.cases import no_docs, odd_docs

COLUMNS = ["doc_id", "line_sentences", "wrapped_sentences", "licenses", "uncovered"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def sql_rows(con):
    got = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op9_licenses']})").fetchall()
    return sorted(got, key=repr)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table_matches_sql(spark, folder):
    path = f"/root/testdata/{folder}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    got = rows_of(op9_licenses(spark, path))
    assert got and got == sql_rows(con)


def wrap(text, width):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(line)
            line = w
        else:
            line = f"{line} {w}".strip()
    return "\n".join([*out, line])


def full(*ids):
    return wrap(" ".join(licenses.FIXED[i].capitalize() + "." for i in ids), 70)


GPL_2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


CASES = [
    (1, "Some words.\nReleased under the MIT License.\nMore.", "MIT"),
    (2, "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance "
        "with the License.\nYou may obtain a copy of the License at\n\n  http://x", "Apache-2.0"),
    (3, full("mit-grant", "mit-notice", "mit-warranty", "mit-liability"), "MIT"),
    (4, full("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"), "BSD-3-Clause"),
    (5, full("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-warranty"), "BSD-2-Clause"),
    (6, full("bsd-source", "bsd-redistribution"), ""),
    (7, "// SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0-or-later"),
    (8, "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.",
        "CC-BY-NC-4.0,GPL-3.0-only"),
    (9, "The licensed driver had permission to park here.", None),
    (10, "This program is released under the terms of the GNU GPL v2 or later; All rights reserved!", "GPL-2.0-or-later"),
    (11, "İ licensed under the mit license", "MIT"),
    (12, GPL_2, "GPL-2.0-or-later"),
    (13, GPL_2.replace("General", "Lesser General").replace("version 2", "version 2.1"), "LGPL-2.1-or-later"),
    (14, GPL_2.replace("General", "Affero General").replace("version 2", "version 3").replace("; either", ", either"), "AGPL-3.0-or-later"),
    (15, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not "
         "distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    (16, "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held.\n\n"
         "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it "
         "and redistribute it\nfreely, subject to the following restrictions:\n", "Zlib"),
    (17, full("boost-grant"), "BSL-1.0"),
    (18, "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or "
         "neighboring\nrights to this work.", "CC0-1.0"),
    (19, "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which "
         "is available at\nhttps://www.eclipse.org/legal/epl-2.0/.", "EPL-2.0"),
    (21, "Words.\nProvided  under\tthe ISC License.", "ISC"),
]


def test_cases(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in CASES], "doc_id long, text string, licenses string")
    got = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    assert got == {i: want for i, _, want in CASES if want is not None}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [[i, t] for i, t, _ in CASES] + [[None, CASES[0][1]], [50, None]])
    more = spark.createDataFrame([(None, CASES[0][1]), (50, None)], "doc_id long, text string")
    assert rows_of(licenses.scan(docs.select("doc_id", "text").union(more))) == sql_rows(con)


def test_every_known_sentence_has_a_trigger_and_names_are_normal():
    assert all(any(t in s for t in licenses.TRIGGERS) for s in licenses.FIXED.values())
    assert all(n == " ".join(n.lower().replace(".", " ").replace("-", " ").split()) for n in licenses.license_names())


def test_odd_rows(spark):
    assert licenses.scan(odd_docs(spark)).collect() == []
    assert licenses.scan(no_docs(spark)).collect() == []


def test_plan_has_no_python_and_no_shuffle(spark, sf):
    plan = op9_licenses(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_every_name_in_a_grant_and_sentences_over_line_ends(spark):
    verbs = ["Released under", "Distributed under the terms of", "This work is made available to you under", "Covered\r\n by", "Provided  under"]
    names = list(licenses.license_names().items())
    rows = [(i, f"Words.\n\n{verbs[i % len(verbs)]} {n.upper()}.\n\nMore words.", spdx) for i, (n, spdx) in enumerate(names)]
    more = [
        "This is free and unencumbered software released into the public\ndomain.", "This is free and unencumbered software released into the public \r\n domain.",
        GPL_2, "All rights \n reserved.",
    ]
    rows += [(len(names) + i, t, want) for i, (t, want) in enumerate(zip(more, ["Unlicense", "Unlicense", "GPL-2.0-or-later", ""], strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, want string")
    got = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    assert {i: (t, got.get(i)) for i, t, want in rows if got.get(i) != want} == {}
