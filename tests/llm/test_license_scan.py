import math
import re

from clickfold.llm import license_scan as L
from tests.llm.conftest import ODD_TEXTS, prose

GPL = "This work is licensed under the GNU General Public License, version 3."
FILES = [
    ("/p/LICENSE", "Released under the MIT License."), ("/p/a.py", "code\n"), ("/p/q/b.py", None),
    ("/p/q/COPYING", GPL), ("/p/q/r/c.py", "x"), ("/p/q/r/d.py", f"# Licensed under CC BY-NC 4.0.\n{prose(1, 50)}"),
    ("/z/e.py", "about a license of some kind that nobody knows"), ("rel/f.py", ""), (None, GPL), ("LICENCE.txt", GPL),
    ("/p/NOTICE", "Licensed under the Apache License, Version 2.0. and more words of other kinds here"),
    ("g.py", "x"), ("/top.py", "y"), ("/p/q/LICENSE.md", "Copyright, all rights are kept"),
]


def brute(files):
    n = len(files)
    term = re.compile(L._TERM)
    idf = {t: math.log((1 + n) / (1 + sum(t in set(term.findall((x or "").lower())) for _, x in files))) + 1
           for t in L.vocabulary()}
    unseen = math.log(1 + n) + 1

    def vector(text):
        counts = {}
        for t in term.findall(text.lower()):
            counts[t] = counts.get(t, 0) + 1
        v = {t: (1 + math.log(c)) * idf.get(t, unseen) for t, c in counts.items()}
        return v, math.sqrt(sum(x * x for x in v.values()))

    own, given = [], {}
    cue = re.compile(L.LICENCE_WORD)
    for path, text in files:
        best = (0.0, "")
        is_file = bool(path and re.search(L.LICENCE_FILE, path))
        for seg in ([text] if is_file and text else []) + [x for x in (text or "").split("\n") if cue.search(x)]:
            if not cue.search(text):
                continue
            v, norm = vector(seg)
            for name, tpl in L.TEMPLATES:
                w, wn = vector(tpl)
                if norm and L.NAMES.get(name, next(iter(v))) in v:
                    best = max(best, (round(sum(x * w.get(t, 0) for t, x in v.items()) / norm / wn, 9), name))
        own.append(best[1] if best[0] >= L.LEAST else None)
        if is_file and own[-1]:
            folder = path.rpartition("/")[0]
            given.setdefault(folder, []).append((best[0], -len(path), own[-1], path))
    out = []
    for (path, _), mine in zip(files, own):
        found = (mine, path) if mine else (None, None)
        if not mine and path:
            at = path.rpartition("/")[0]
            while True:
                if at in given:
                    found = max(given[at])[2:]
                    break
                if not at:
                    break
                at = at.rpartition("/")[0]
        out.append((path, mine, *found))
    return sorted(out, key=repr)


def frame(spark, files):
    return spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(files)],
                                 "file_id long, path string, text string, license string")


def got(df):
    return sorted(((r["path"], r["own_license"], r["license"], r["license_path"]) for r in df.collect()), key=repr)


def test_matches_brute_force(spark):
    files = FILES + [(f"/bulk/{i}/{j}.txt", prose(i * 9 + j, 30)) for i in range(5) for j in range(8)]
    out = L.scan(frame(spark, files))
    assert got(out) == brute(files)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_cases(spark):
    files = [(f"/o/{i}.txt", t) for i, t in enumerate(ODD_TEXTS)] + [("/o/1.txt", GPL)] * 2 + [(None, None)]
    out = L.scan(frame(spark, files))
    assert out.count() == len(files)
    assert [r["license"] for r in out.where("path = '/o/1.txt' AND license IS NOT NULL").collect()] == ["GPL-3.0"] * 2
    assert L.scan(frame(spark, files).where("1 = 0")).count() == 0


MPL_HEADER = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
int x;
"""
GPL2_HEADER = """# This program is free software; you can redistribute it and/or
# modify it under the terms of the GNU General Public License
# as published by the Free Software Foundation; either version 2
# of the License, or (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""


def test_headers_over_several_lines_and_sentences(spark):
    want = {
        "/a/mpl.c": (MPL_HEADER + prose(2, 60), "MPL-2.0"),
        "/b/page.txt": (f"{prose(3, 40)}. Licensed under CC BY-NC 4.0. {prose(4, 40)}", "CC-BY-NC-4.0"),
        "/c/LICENSE": ("Apache License\nVersion 2.0, January 2004\n" + prose(5, 40), "Apache-2.0"),
        "/d/gpl.py": (GPL2_HEADER + prose(6, 60), "GPL-2.0"), "/e/COPYING": (GPL2_HEADER, "GPL-2.0"),
        "/f/COPYING": ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n" + prose(7, 40), "GPL-2.0"),
        "/g/COPYING": ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n" + prose(8, 40), "GPL-3.0"),
        "/h/none.txt": (prose(9, 60), None)}
    files = [(p, t) for p, (t, _) in want.items()] + [(f"/bulk/{i}.txt", prose(20 + i, 40)) for i in range(30)]
    found = {r["path"]: r["own_license"] for r in L.scan(frame(spark, files)).collect()}
    assert {p: found[p] for p in want} == {p: name for p, (_, name) in want.items()}


def test_spdx_lines_are_compared_as_identifiers(spark):
    want = {"MIT": "MIT", "ISC": "ISC", "Zlib": "Zlib", "EPL-2.0": "EPL-2.0", "BSD-2-Clause": "BSD-2-Clause",
            "Unlicense": "Unlicense", "GPL-2.0-or-later": "GPL-2.0", "AGPL-3.0-only": "AGPL-3.0",
            "CC-BY-SA-4.0": "CC-BY-SA-4.0", "LicenseRef-Proprietary": "LicenseRef-Proprietary",
            "gpl-3.0+": "GPL-3.0", "(Apache-2.0 OR MIT)": "Apache-2.0", "MPL-2.0.": "MPL-2.0"}
    files = [(f"/s/{i}.c", f"// SPDX-License-Identifier: {x}\n{prose(i, 30)}") for i, x in enumerate(want)]
    files += [("/t/none.c", "// SPDX-License-Identifier:\nint x;"),
              ("/t/epl.txt", "This work is licensed under the Eclipse Public License, version 2.")]
    found = {r["path"]: r["own_license"] for r in L.scan(frame(spark, files)).collect()}
    assert [found[f"/s/{i}.c"] for i in range(len(want))] == list(want.values())
    assert found["/t/none.c"] is None and found["/t/epl.txt"] is None
