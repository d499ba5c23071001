"""Licence texts as people's files hold them: headers in comments, identifiers, whole files."""

from __future__ import annotations

import duckdb
import pytest

from lotflow.llm.licenses import op8_licenses, scan_licenses, templates
from lotflow.llm.queries import ORACLES

GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
MIT = f"""MIT License

Copyright (c) 2019 Jo Example and others

{GRANT}

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD2 = """Copyright (c) 2012, Example Org. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL3 = """ * Some tool of ours.
 * Copyright (C) 2020 Jo Example
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
"""
GPL2 = GPL3.replace("software:", "software;").replace("Foundation, either version 3", "Foundation; either version 2")
LGPL3 = GPL3.replace("GNU General", "GNU Lesser General")
LGPL21 = GPL2.replace("GNU General", "GNU Lesser General").replace("version 2 ", "version 2.1 ").replace("This program is", "This library is")
AGPL3 = GPL3.replace("GNU General", "GNU Affero General")
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
ISC = """Copyright (c) 2020, Jo Example

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
CODE = "\nimport os\n\n\ndef main(path):\n    for name in os.listdir(path):\n        print(name)\n"
TITLE = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007\n\n" + "Some long section of terms goes here.\n" * 400

CASES = {
    "MIT text": (MIT, "MIT"),
    "MIT in a comment": ("/*\n" + "".join(f" * {line}\n" for line in MIT.split("\n")) + " */\n" + CODE * 20, "MIT"),
    "MIT identifier": ("// SPDX-License-Identifier: MIT\n" + CODE, "MIT"),
    "Apache identifier": ("# SPDX-License-Identifier: Apache-2.0\n" + CODE, "Apache-2.0"),
    "two identifiers": ("# SPDX-License-Identifier: MIT OR Apache-2.0\n" + CODE, "Apache-2.0,MIT"),
    "unknown identifier": ("# SPDX-License-Identifier: Artistic-2.0\n" + CODE, ""),
    "later identifier": ("# SPDX-License-Identifier: GPL-3.0-or-later\n" + CODE, "GPL-3.0"),
    "GPL-3 header": ("/*\n" + GPL3 + " */\n" + CODE, "GPL-3.0"),
    "GPL-2 header": ("/*\n" + GPL2 + " */\n" + CODE, "GPL-2.0"),
    "LGPL-3 header": ("/*\n" + LGPL3 + " */\n" + CODE, "LGPL-3.0"),
    "LGPL-2.1 header": ("/*\n" + LGPL21 + " */\n" + CODE, "LGPL-2.1"),
    "AGPL-3 header": ("/*\n" + AGPL3 + " */\n" + CODE, "AGPL-3.0"),
    "Apache header": (APACHE + CODE, "Apache-2.0"),
    "Apache header, CRLF": ((APACHE + CODE).replace("\n", "\r\n"), "Apache-2.0"),
    "BSD-2 text": (BSD2, "BSD-2-Clause,Proprietary"),
    "BSD-3 text": (BSD3, "BSD-3-Clause,Proprietary"),
    "ISC text": (ISC, "ISC"),
    "GPL-3 title": (TITLE, "GPL-3.0"),
    "no licence": ("This program reads the license of a car.\nPermission to park was granted." + CODE, ""),
    "a place": ("MIT\nThe institute is in Cambridge." + CODE, ""),
}


@pytest.mark.parametrize("others", [0, 300])
def test_texts_as_files_hold_them(spark, others):
    """In a few files, and among many of plain words, which change all weights."""
    rows = [(name, text) for name, (text, _) in CASES.items()] + [(f"n{i}", f"the car number {i} is on the road of the town and the software is old. " * 3 + CODE) for i in range(others)]
    got = {r.path: r for r in scan_licenses(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {name: got[name].licenses for name in CASES} == {name: expected for name, (_, expected) in CASES.items()}
    assert not any(r.licenses for path, r in got.items() if path not in CASES)


def test_licence_files_by_share_and_by_name(spark):
    rows = [("a/LICENSE", MIT), ("a/x.py", CODE), ("b/COPYING", TITLE), ("b/src/y.c", CODE), ("c/z.py", APACHE + CODE * 50), ("c/w.py", CODE), ("d/terms.txt", TITLE), ("d/v.py", CODE)]
    got = {r.path: (r.license, r.origin, r.from_path) for r in scan_licenses(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["a/x.py"] == ("MIT", "inherited", "a/LICENSE") and got["b/src/y.c"] == ("GPL-3.0", "inherited", "b/COPYING")
    # A source file's header is its own; a long text that is not named like a licence file does not stand for others.
    assert got["c/w.py"] == (None, "none", None) and got["d/v.py"] == (None, "none", None)


def test_equals_sql_on_real_texts(spark, tmp_path):
    rows = [(i, text, "en", f"s{i % 3}", len(text)) for i, (text, _) in enumerate(CASES.values())] + [(90, None, None, "s0", None), (91, "", "en", "s1", 0), (90, MIT, "en", "s0", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    df = op8_licenses(spark, str(tmp_path))
    columns = sorted(df.columns)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op8_licenses']})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(columns).collect()))) == sorted(map(str, expected))


def test_no_python_in_the_plan(spark):
    plan = scan_licenses(spark.createDataFrame([("a", MIT)], "path string, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowTable", "")


def test_templates_hold_the_words_they_need():
    import re

    for _, name, _, _, statement, must, _ in templates():
        assert set(must.split()) <= set(re.split("[^a-z0-9]+", statement.lower())), name
