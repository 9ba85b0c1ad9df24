import odd
from tickloom.llm import licences


def test_own_and_inherited_licences(spark):
    files = [
        ("LICENSE", "Released under the MIT License."),
        ("a/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("a/x.txt", "plain text\nof a file"),
        ("a/b/c/y.txt", None),
        ("a/b/z.txt", "first line\nLicensed under the Apache License, Version 2.0.\nlast"),
        ("ab/q.txt", "license license is a word here and nothing else in this long line of other words about other things"),
        ("top.txt", ""),
        ("a/x.txt", "plain text\nof a file"),
        (None, "Licensed under CC BY-NC 4.0."),
        (None, None),
    ]
    table = odd.with_clashes(spark.createDataFrame([(p, t, "mine") for p, t in files], "path string, text string, licence string"))
    out = licences.scan(table)
    assert out.columns == [c for c in table.columns if c not in ("text", "licence")] + ["licence", "licence_score", "licence_from"]
    got = sorted(((r.path, r.licence, r.licence_from) for r in out.select("path", "licence", "licence_from").collect()), key=str)
    want = [
        ("LICENSE", "MIT", "self"), ("a/COPYING", "GPL-3.0", "self"), ("a/x.txt", "GPL-3.0", "a"), ("a/x.txt", "GPL-3.0", "a"), ("a/b/c/y.txt", "GPL-3.0", "a"),
        ("a/b/z.txt", "Apache-2.0", "self"), ("ab/q.txt", "MIT", ""), ("top.txt", "MIT", ""), (None, "CC-BY-NC-4.0", "self"), (None, None, None),
    ]
    assert got == sorted(want, key=str)
    assert licences.scan(odd.empty(table)).collect() == []


GNU = """{c} This program is free software; you can redistribute it and/or modify
{c} it under the terms of the GNU {kind} License as published by
{c} the Free Software Foundation; either version {v} of the License, or
{c} (at your option) any later version.
code of the file"""


def test_headers_over_lines_and_licence_texts(spark):
    files = [
        ("h/two.c", GNU.format(c=" *", kind="General Public", v=2), "GPL-2.0", "self"),
        ("h/three.py", GNU.format(c="#", kind="General Public", v=3), "GPL-3.0", "self"),
        ("h/lesser.c", GNU.format(c="//", kind="Lesser General Public", v=2.1), "LGPL-2.1", "self"),
        ("h/affero.c", GNU.format(c="//", kind="Affero General Public", v=3), "AGPL-3.0", "self"),
        ("two/LICENSE", "  GNU GENERAL PUBLIC LICENSE\n    Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.\n", "GPL-2.0", "self"),
        ("two/a/x.c", "no notice", "GPL-2.0", "two"),
        ("three/COPYING", "  GNU GENERAL PUBLIC LICENSE\n    Version 3, 29 June 2007\n\n13. Use with the GNU Affero General Public License.\n", "GPL-3.0", "self"),
        ("three/y.c", "no notice", "GPL-3.0", "three"),
        ("bsd/2.c", licences.HEADERS[-2][1].replace(", ", ",\n * "), "BSD-2-Clause", "self"),
        ("bsd/3.c", licences.HEADERS[-1][1].replace(", ", ",\n * "), "BSD-3-Clause", "self"),
        ("z.c", "please redistribute this with permission of the\nauthors of the words", None, None),
    ]
    got = licences.scan(spark.createDataFrame([f[:2] for f in files], "path string, text string")).collect()
    assert {(r.path, r.licence, r.licence_from) for r in got} == {(p, licence, origin) for p, _, licence, origin in files}
