import re

import duckdb
import pytest

from firnline.llm import licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software. The above copyright notice and this permission notice shall be included in all
 * copies. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED. In no event shall the authors or copyright holders be liable."""
GPL = "This program is free software; it is under the GNU General Public License as published by the Free Software Foundation, either version 3 of it. Or (at your option) any later version."
CASES = [
    (1, "Some words.\nReleased under the MIT License.\nMore words", "MIT", 1, ""),
    (2, "x | y |\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 1, ""),
    (3, "This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only", 1, ""),
    (4, MIT, "MIT", 1, ""),
    (5, GPL, "GPL-3.0-or-later", 1, ""),
    (6, MIT + "\n\nLicensed under the Apache License, Version 2.0. All rights reserved.", "MIT,Apache-2.0", 2, "<all-rights>"),
    (7, "Released under the MIT License. Released under the MIT License.", "MIT", 2, ""),
    (8, "no warranty at all", "", 0, ""),
    (9, "// SPDX-License-Identifier: MIT", "MIT", 1, ""),
    (10, "# SPDX-License-Identifier:MIT\n", "MIT", 1, ""),
    (None, None, "", 0, ""),
    (11, "", "", 0, ""),
    (12, "lorem ipsum. " * 20_000 + "Released under the MIT License.", "MIT", 1, ""),
    (12, "word " * 50_000 + "licensed under the mit license", "MIT", 1, ""),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 0) for i, t, *_ in [*CASES, CASES[0]]], "doc_id long, text string, licences string, r0 int")


def test_texts(docs):
    got = sorted(((r.doc_id, r.licences, r.n_licences, r.unmatched) for r in licences.scan(docs).collect()), key=repr)
    assert got == sorted(((c[0], *c[2:]) for c in [*CASES, CASES[0]]), key=repr)


def _same_as_sql(docs):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [tuple(r) for r in docs.select("doc_id", "text").collect()])
    want = sorted(map(repr, con.sql(licences.oracle()).fetchall()))
    assert sorted(repr(tuple(r)) for r in licences.scan(docs).collect()) == want


def test_against_sql(docs):
    _same_as_sql(docs)


def test_notices_against_sql(spark):
    texts = [t for text, _ in OFFICIAL for t in (text, text.replace("\n", "\r\n"), text.upper())]
    tags = ["MIT", "MIT-0", "mit */", "GPL-2.0+", "GPL-2.0-or-later", "GPL-3.0-only WITH x", "MPL-2.0-no", "Apache 2.0", "BSD-3-Clause.", "MIT-", "MIT-->"]
    texts += [t for t, _ in MORE]
    texts += [f"// SPDX-License-Identifier: {t}\nint x;" for t in tags] + ["MPL, v. 2.0. Mozilla Public License, v.  2.0; v. x", "gnu general public license v.2 v. 2"]
    _same_as_sql(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_empty_table(docs):
    assert licences.scan(docs.limit(0)).count() == 0


def _variants(pattern):
    """Every plain sentence that a pattern of SENTENCES stands for."""
    text = pattern.replace("( |$)", "").replace(" ?", "( )?").replace("[cs]", "(c|s)")
    m = re.search(r"\(([^()]*)\)(\??)", text)
    if m is None:
        return [text]
    return [v for part in m[1].split("|") + [""] * bool(m[2]) for v in _variants(text[: m.start()] + part + text[m.end() :])]


def test_each_identifier_alone(spark):
    rows = [(k, f"Lorem ipsum. {v.capitalize()}.", i) for i, p in licences.SENTENCES for k, v in enumerate(_variants(p))]
    df = spark.createDataFrame(rows, "doc_id long, text string, want string")
    got = df.select("text", "want", licences.identifiers(df["text"]).alias("got")).collect()
    assert len(got) > 60 and [r for r in got if f"<{r.want}>" not in r.got] == []


def test_notice_alone(spark):
    df = spark.createDataFrame([(1, "Some prose.\n\nAll rights reserved.\n"), (2, "This program is free software.")], "doc_id long, text string")
    assert sorted(tuple(r) for r in licences.scan(df).collect()) == [(1, "<all-rights>", "", 0, "<all-rights>"), (2, "<gpl-free>", "", 0, "<gpl-free>")]


GNU = """This {0} is free software; you can redistribute it and/or modify
it under the terms of the GNU {1} as published by
the Free Software Foundation; either version {2} of the License, or
(at your option) any later version.

This {0} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {1} for more details.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
OFFICIAL = [
    (GNU.format("program", "General Public License", "2"), "GPL-2.0-or-later"),
    (GNU.format("program", "General Public License", "3"), "GPL-3.0-or-later"),
    (GNU.format("library", "Lesser General Public License", "2.1"), "LGPL-2.1-or-later"),
    (GNU.format("library", "Lesser General Public License", "3"), "LGPL-3.0-or-later"),
    (GNU.format("program", "Affero General Public License", "3"), "AGPL-3.0-or-later"),
    (APACHE, "Apache-2.0"),
    (MPL, "MPL-2.0"),
    (BSD, "BSD-3-Clause"),
    ("Released under the MIT License; released under the\nMIT License; more words.", "MIT"),
]


def test_official_notices(spark):
    rows = [(k, t, licence) for k, (text, licence) in enumerate(OFFICIAL) for t in (text, text.replace("\n", "\r\n"), text.replace("\n", "\r"))]
    out = licences.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.licences) for r in out) == sorted((k, licence) for k, _, licence in rows)
    assert {r.doc_id: r.n_licences for r in out} == {k: 2 if k == 8 else 1 for k in range(9)}
    assert next(r.unmatched for r in out if r.doc_id == 0) == "<gpl-no-warranty>"


def test_spdx_identifiers_end(spark):
    want = {"MIT": "MIT", "mit */": "MIT", "MIT.": "MIT", "MIT-->": "MIT", "MIT\r\n": "MIT", "MIT-0": "", "Apache-2.0": "Apache-2.0", "Apache 2.0": "Apache-2.0", "BSD-3-Clause": "BSD-3-Clause", "BSD-3-Clause-Clear": "",
            "MPL-2.0": "MPL-2.0", "MPL-2.0-no-copyleft-exception": "", "GPL-2.0": "GPL-2.0-only", "GPL-2.0-only": "GPL-2.0-only", "GPL-2.0-or-later": "GPL-2.0-or-later", "GPL-2.0+": "GPL-2.0-or-later",
            "GPL-3.0": "GPL-3.0-only", "GPL-3.0-only": "GPL-3.0-only", "GPL-3.0-or-later": "GPL-3.0-or-later", "GPL-3.0+": "GPL-3.0-or-later", "GPL-2.0-only WITH x": "GPL-2.0-only"}
    out = licences.scan(spark.createDataFrame([(k, f"// SPDX-License-Identifier: {s}\nint x;") for k, s in enumerate(want)], "doc_id long, text string")).collect()
    assert [r.licences for r in sorted(out)] == list(want.values())


MORE = [
    ("The MIT License (MIT)\n\nCopyright (c) 2020 N. N.", "MIT"),
    ("This file is under the GNU GPL v3.", "GPL-3.0-only"),
    ("Text available under CC BY-SA 3.0.", "CC-BY-SA-3.0"),
    ("// SPDX-License-Identifier: MIT OR Apache-2.0", "MIT,Apache-2.0"),
    ("// SPDX-License-Identifier: (EPL-2.0 OR GPL-2.0-or-later WITH Classpath-exception-2.0)", "GPL-2.0-or-later,EPL-2.0"),
    ("# SPDX-License-Identifier: LGPL-2.1+ AND BSD-2-Clause", "BSD-2-Clause,LGPL-2.1-or-later"),
    # another sentence between those of a rule
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of it. All rights reserved. The above copyright notice and this permission notice shall be included in all copies.", "MIT"),
]


def test_more_notices(spark):
    out = licences.scan(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(MORE)], "doc_id long, text string")).collect()
    assert [r.licences for r in sorted(out)] == [licence for _, licence in MORE]
    last = max(out, key=lambda r: r.doc_id)
    assert last.unmatched == "<all-rights>" and last.n_licences == 1
