import math
from collections import Counter

import pytest

from leadpanel.llm import licenses

SCHEMA = "doc_id bigint, path string, text string, license string, folder int"


def words(text):
    return ["".join(c) for line in licenses.words_by_line(text.encode()) for c in [w.decode("utf-8", "replace") for w in line]]


def brute(files, templates=licenses.TEMPLATES):
    """Best cosine of any window of lines, with plain dictionaries."""
    known = {w for _, t in templates for w in words(t)}
    seen = Counter(w for text in files for w in set(words(text or "")) & known)
    n = len(files)
    idf = {w: math.log((1 + n) / (1 + seen[w])) + 1 for w in known}
    unseen = math.log((1 + n) / 2) + 1
    vectors = []
    for name, text in templates:
        v = {w: c * idf[w] for w, c in Counter(words(text)).items()}
        vectors.append((name, v, math.sqrt(sum(x * x for x in v.values()))))
    out = []
    for text in files:
        lines, best = (text or "").split("\n"), 0.0
        for span in licenses.WINDOWS:
            for at in range(len(lines)):
                counts = Counter(words("\n".join(lines[at:at + span])))
                mine = {w: c * idf[w] for w, c in counts.items() if w in known}
                norm = math.sqrt(sum(x * x for x in mine.values()) + sum(c for w, c in counts.items() if w not in known) * unseen ** 2)
                for _, v, size in vectors:
                    if norm:
                        best = max(best, sum(x * v.get(w, 0) for w, x in mine.items()) / norm / size)
        out.append(best)
    return out


TEXTS = [
    "intro line\nReleased under the MIT License.\nmore text of the file", "no statement at all", "", None, "LICENSED UNDER CC BY-NC 4.0.",
    "licensed under the\nApache License,\nVersion 2.0.\nand the rest of it", "x " * 50_000 + "\nAll rights reserved.",
    "\n".join(f"line {i}" for i in range(5_000)) + "\nThis work is licensed under the GNU General Public License, version 3.",
    "the rights of the public", "Licensed under CC BY-SA 4.0.", "été\nAll rights reserved, for ever and a day, by some company or other.",
]


def scan(spark, rows):
    out = licenses.scan(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    return {(r["doc_id"], r["path"]): r for r in out.collect()}, out


def test_cosines_match_plain_dictionaries(spark):
    rows = [(at, f"p/{at}.txt", text) for at, text in enumerate(TEXTS)]
    got, _ = scan(spark, rows)
    for (at, path, text), score in zip(rows, brute(TEXTS)):
        assert got[at, path]["score"] == pytest.approx(score, abs=2e-6), text and text[-60:]


def test_statements_are_named(spark):
    rows = [(at, f"p{at}/{at}.txt", text) for at, text in enumerate(TEXTS)]
    got, _ = scan(spark, rows)
    named = {at: r["license"] for (at, _), r in got.items() if r["license"]}
    assert named == {0: "MIT", 4: "CC-BY-NC-4.0", 5: "Apache-2.0", 6: "LicenseRef-proprietary", 7: "GPL-3.0", 9: "CC-BY-SA-4.0"}
    assert got[0, "p0/0.txt"]["line"] == 1 and got[7, "p7/7.txt"]["line"] == 5_000


def test_every_template_finds_itself(spark):
    rows = [(at, f"p{at}/f", text) for at, (_, text) in enumerate(licenses.TEMPLATES)]
    got, _ = scan(spark, rows)
    assert [got[at, f"p{at}/f"]["license"] for at in range(len(rows))] == [name for name, _ in licenses.TEMPLATES]


def test_nearest_directory_counts(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/x.txt", "text"), (3, "a/b/c/x.txt", "text"), (4, "a/b/COPYING.txt", gpl), (5, "a/b/x.txt", "text"),
        (6, "a/bc/x.txt", "text"), (7, "b/x.txt", "text"), (8, "x.txt", "text"), (9, None, "text"), (10, "a/b/own.txt", "All rights reserved."),
        (11, "c/licence-b", gpl), (12, "c/licence-a", mit), (13, "c/x", "t"), (14, "d/LICENSE", "nothing stated"), (15, "d/x", None),
        (2, "a/x.txt", "text"), (16, "a/b", "text"),
    ]
    got, out = scan(spark, rows)
    result = {key[0]: (r["license"], r["origin"], r["license_file"]) for key, r in got.items()}
    assert result == {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a/LICENSE"), 3: ("GPL-3.0", "inherited", "a/b/COPYING.txt"),
        4: ("GPL-3.0", "own", None), 5: ("GPL-3.0", "inherited", "a/b/COPYING.txt"), 6: ("MIT", "inherited", "a/LICENSE"),
        7: (None, "none", None), 8: (None, "none", None), 9: (None, "none", None), 10: ("LicenseRef-proprietary", "own", None),
        11: ("GPL-3.0", "own", None), 12: ("MIT", "own", None), 13: ("MIT", "inherited", "c/licence-a"), 14: (None, "none", None),
        15: (None, "none", None), 16: ("MIT", "inherited", "a/LICENSE"),
    }
    assert out.count() == len(rows)


def test_empty_table(spark):
    assert scan(spark, [])[1].count() == 0


def test_paths_of_documents(spark):
    docs = spark.createDataFrame([(0, "t", "s"), (None, "t", "s"), (5, None, None)], "doc_id bigint, text string, source string")
    paths = {r["doc_id"]: r["path"] for r in licenses.with_paths(docs).collect()}
    assert paths == {0: "s/LICENSE-0", None: None, 5: "d1/d0/5.txt"}


GNU = ("This {what} is free software{mark} you can redistribute it and/or modify\nit under the terms of the GNU {kind}General Public License "
       "as published by\nthe Free Software Foundation{mark2} either version {version} of the License, or\n(at your option) any later version.\n")
BSD = ("Copyright (c) 2020, A. Person\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided "
       "that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of "
       "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of "
       "conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n")
CLAUSE = ("3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n"
          "   this software without specific prior written permission.\n\n")
END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS\nAND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.\n"
PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen "


def gnu(kind, version, what="program", mark=";", mark2=";"):
    return GNU.format(kind=kind, version=version, what=what, mark=mark, mark2=mark2)


@pytest.mark.parametrize("text, name, line", [
    (gnu("", "2"), "GPL-2.0", 0), (gnu("", "3", mark=":", mark2=","), "GPL-3.0", 0), (gnu("Affero ", "3", mark=":", mark2=","), "AGPL-3.0", 0),
    (gnu("Lesser ", "2.1", "library"), "LGPL-2.1", 0), (gnu("Lesser ", "3"), "LGPL-3.0", 0), (gnu("", "1"), "GPL-1.0", 0),
    (BSD + END, "BSD-2-Clause", None), (BSD + CLAUSE + END, "BSD-3-Clause", None),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software "
     "Foundation, Inc.\n 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA\n", "GPL-2.0", 0),
    ("# SPDX-License-Identifier: MIT\nimport os", "MIT", 0), ("a\n/* SPDX-License-Identifier: (GPL-2.0-only OR MIT) */", "(GPL-2.0-only OR MIT)", 1),
    ("first\n" + PROSE + "Licensed under the MIT License. " + PROSE, "MIT", 1), (PROSE + "and it is licensed under CC BY-SA 3.0 as " + PROSE, "CC-BY-SA-3.0", 0),
    ("x\nCopyright 2020 by " + PROSE + "Inc. All rights reserved. " + PROSE, "LicenseRef-proprietary", 1),
    ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0", 0),
])
def test_headers_texts_tags_and_sentences(spark, text, name, line):
    rows = [(0, "p0/f", text)] + [(at, f"p{at}/f", f"plain file of some words number {at}") for at in range(1, 40)]
    got, _ = scan(spark, rows)
    assert got[0, "p0/f"]["license"] == name
    assert line is None or got[0, "p0/f"]["line"] == line
    assert sum(r["license"] is not None for r in got.values()) == 1


def test_licence_at_the_root_is_inherited(spark):
    rows = [(1, "LICENSE", "Released under the MIT License."), (2, "a.py", "text"), (3, "src/b/a.py", "text"), (4, None, "text"),
            (5, "gpl/COPYING", "This work is licensed under the GNU General Public License, version 3."), (6, "gpl/a.py", "text")]
    got, _ = scan(spark, rows)
    assert {key[0]: (r["license"], r["license_file"]) for key, r in got.items()} == {
        1: ("MIT", None), 2: ("MIT", "LICENSE"), 3: ("MIT", "LICENSE"), 4: (None, None), 5: ("GPL-3.0", None), 6: ("GPL-3.0", "gpl/COPYING")}
