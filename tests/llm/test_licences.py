import hashlib
import re
from functools import cache

from tapewright.llm import licences, queries


def canonical(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    text = re.sub(licences.COPYRIGHT_LINE, r"\1", text)
    for a, b in licences.SPELLINGS:
        text = text.replace(a, b)
    return re.sub(r"[^a-z0-9\x80-\xa8\xaa-\U0010ffff]+", " ", text).strip(" ")


@cache
def known():
    out = {}
    for name, t in licences.KNOWN + licences.full_texts():
        out[canonical(t)] = min(name, out.get(canonical(t), "~"))
    out.pop("", None)
    return out | {"all rights reserved": "LicenseRef-Proprietary"}


@cache
def inner():
    return {f for f in (canonical(t) for _, t in licences.KNOWN + licences.bodies()) if len(f.split(" ")) >= 12}


def words(line):
    for a, b in licences.SPELLINGS:
        line = line.replace(a, b)
    return re.sub(r"[^a-z0-9\x80-\xa8\xaa-\U0010ffff]+", " ", line).strip(" ")


def brute(text):
    """By hand: the whole text, its lines, what follows a copyright statement, and every place where a known text stands."""
    forms = known()
    lines = []
    # the first place from which on the rest of a line is known, or opens as a long known text does
    opens = tuple({" ".join(f.split(" ")[:6]) + " " for f in forms if len(f.split(" ")) > 40})
    rests = lambda form: [" ".join(form.split(" ")[i:]) for i in range(len(form.split(" ")))]
    behind = lambda form: next((r for r in rests(form) if (r in forms and len(r.split(" ")) <= 40) or r.startswith(opens)), "")
    for line in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split("\n"):
        form, reserved = words(line), []
        if form == "all rights reserved" or form.endswith(" all rights reserved"):
            form, reserved = form[: -len("all rights reserved")].strip(), ["all rights reserved"]
        stated = re.search(r"(copyright[ \t]*)?(\(c\)|©)[ \t]*\d{4}|copyright[ \t]*\d{4}", line)
        if re.search(licences.COPYRIGHT_LINE, line):
            parts = [behind(form)]
        elif stated:
            parts = [words(line[: stated.start()]), behind(form)]
        else:
            parts = [form]
        lines += [forms[f] for f in parts + reserved if f in forms]
    whole = canonical(text)
    inside = sorted((m.start(), forms[f]) for f in inner() if f in whole for m in re.finditer(rf"(?<![^ ])(?={re.escape(f)}(?: |$))", whole))
    return hashlib.sha256(whole.encode()).hexdigest(), forms.get(whole) if whole else None, len(lines), ",".join(lines), ",".join(dict.fromkeys(n for _, n in inside))


def test_query_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in queries.documents(spark, sf).collect()}
    rows = {r.doc_id: tuple(r)[1:] for r in queries.op8_license_scan(spark, sf).collect()}
    assert rows == {d: brute(t) for d, t in docs.items()}
    assert any(r[2] for r in rows.values())


def test_forms_of_one_licence_and_edge_cases(spark):
    mit = next(t for n, t in licences.KNOWN if n == "MIT" and len(t) > 500)
    isc = next(t for n, t in licences.KNOWN if n == "ISC")
    texts = [mit, "  " + mit.upper().replace("LICENSE", "licence") + "\n\n", mit.replace("MIT License", "MIT License\n\nCopyright (c) 2020 A. Person\n(c) 2021 B\n© 2022 C"), mit + " and more", isc.replace("\n", "\r\n\r\n"), mit.replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace(" ", "\t"), None, "", "copyright 2020 all", "x\nLicensed under CC BY-NC 4.0\nlicenced under cc by nc 4 0 !\n" + "y" * 90000]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, digest string, _key int")
    rows = {r.doc_id: tuple(r)[1:] for r in licences.scan(docs).collect()}
    assert rows == {i: brute(t) for i, t in enumerate(texts)}
    assert [rows[i][1] for i in range(10)] == ["MIT", "MIT", "MIT", None, "ISC", "MIT", None, None, None, None]
    assert rows[9][2:] == (2, "CC-BY-NC-4.0,CC-BY-NC-4.0", "")


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "Licensed under the MIT License."), (None, "Licensed under the MIT License.")], "doc_id long, text string")
    assert [(r.licence, r.n_lines, r.licences) for r in licences.scan(docs).collect()] == [("MIT", 1, "MIT")] * 2
    assert licences.scan(docs.limit(0)).collect() == []


def test_only_the_statement_of_a_copyright_line_is_left_out(spark):
    lines = ["Copyright 2020 X. Licensed under the MIT License.", "(c) 2019-2021 A. Person, Inc. All rights reserved. Licenced under CC BY 4.0", "# Copyright 2020 X", "copyright law of 1976", "  * All Rights Reserved.", "© 2020 Y. All rights reserved.", "Copyright 2020 X. Licensed under the MIT License but for the logo.", "All rights reserved by nobody"]
    docs = spark.createDataFrame([(i, "x\n" + t) for i, t in enumerate(lines)] + [(99, "y\n" + "\n".join(lines))], "doc_id long, text string")
    want = ["MIT", "CC-BY-4.0", "", "", "LicenseRef-Proprietary", "LicenseRef-Proprietary", "", ""]
    found = {r.doc_id: r.licences for r in licences.scan(docs).collect()}
    assert [found[i] for i in range(len(lines))] == want and found[99] == ",".join(w for w in want if w)
    found = {r.doc_id: r.licences for r in licences.scan(docs, rights=False).collect()}
    assert [found[i] for i in range(len(lines))] == ["MIT", "CC-BY-4.0"] + [""] * 6


def test_full_texts_with_and_without_title_and_padded_lines(spark):
    from pathlib import Path

    system = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "BSD": "BSD-3-Clause"}
    texts = [((system / f).read_text(), n) for f, n in names.items()]
    mit = next(t for n, t in licences.KNOWN if n == "MIT" and len(t) > 500)
    isc = next(t for n, t in licences.KNOWN if n == "ISC")
    bsd = (system / "BSD").read_text().replace("the University", "the copyright holder").replace("REGENTS AND", "COPYRIGHT HOLDERS AND").replace("REGENTS OR", "COPYRIGHT HOLDER OR")
    apache = (system / "Apache-2.0").read_text()
    texts += [(mit.replace("MIT License", "The MIT License (MIT)\n\nCopyright (c) 2020 A. Person"), "MIT"), (mit.split("\n\n", 1)[1], "MIT"), (isc.split("\n\n", 1)[1], "ISC")]
    texts += [("BSD 3-Clause License\n\n" + bsd, "BSD-3-Clause"), (bsd.replace(bsd[bsd.index("3. N") : bsd.index("THIS SOFT")], ""), "BSD-2-Clause")]
    texts += [(apache[: apache.index("END OF TERMS")], "Apache-2.0"), (apache[apache.index("TERMS AND") :], "Apache-2.0"), (apache + " but not for X", None)]
    texts += [("x\n" + "-" * 200000 + " Licensed under the MIT License." + " " * 9000, None)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert [rows[i].licence for i in range(len(texts))] == [n for _, n in texts]
    assert rows[len(texts) - 1].licences == "MIT"


def test_wrapping_does_not_matter_and_texts_are_found_inside_others(spark):
    """Every known full text, wrapped in other ways, on one line, and inside a longer text."""
    import textwrap

    copyright_line = re.compile(licences.COPYRIGHT_LINE)
    cases = []
    for name, text in dict(reversed(licences.bodies())).items():
        for width in (45, 100, 100_000):
            # paragraphs with a copyright line stay as they are, as wrapping would move it into a line
            parts = [p if copyright_line.search(p.lower()) else textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in re.split(r"\n{2,}", text)]
            cases.append(("\n\n".join(parts), name, True))
            cases.append(("Some words before.\n\n" + "\n\n".join(parts) + "\n\nand behind", name, False))
    mpl = next(t for _, t in licences.KNOWN if t.startswith("This Source Code Form"))
    cases += [("a\n" + textwrap.fill(mpl, 40) + "\nb", "MPL-2.0", False), ("x" + licences.MORE[0][1] + "x", "", False)]
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    rows = {r.doc_id: r for r in licences.scan(docs).collect()}
    for i, (text, name, whole) in enumerate(cases):
        assert rows[i].licence == (name if whole else None), (i, name)
        assert (name in rows[i].inside.split(",")) == (name != "" or rows[i].inside == ""), (i, name, rows[i].inside)
        assert tuple(rows[i])[1:] == brute(text)


def test_lines_of_any_length(spark):
    texts = ["Licensed under the MIT License." + "-" * n for n in (0, 60, 6000, 300_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(r.n_lines, r.licences) for r in licences.scan(docs).collect()] == [(1, "MIT")] * 4


def test_headers_of_source_files_and_identifiers(spark):
    """Headers as they stand in files, with comment signs and wrapped in other places, between a copyright line and code."""
    gpl = """# Copyright (C) 2020  Jo Bloggs
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
#
# You should have received a copy of the GNU General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>.
import x
"""
    apache = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */"""
    lesser = licences._GNU_FIRST.format(what="library", name="Lesser General Public License", version="2.1")
    texts = [gpl, gpl.split("import")[0].split("\n", 2)[2], apache, apache.split("\n", 2)[2], "x\n// SPDX-License-Identifier: MIT\ny", "SPDX-License-Identifier: GPL-2.0-or-later", "-- spdx-licence-identifier: apache-2.0 --", "SPDX-License-Identifier: Other", lesser, gpl.replace("version 3", "version 9")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: tuple(r)[1:] for r in licences.scan(docs).collect()}
    assert rows == {i: brute(t) for i, t in enumerate(texts)}
    assert [rows[i][1] for i in (0, 1, 2, 5, 6, 7, 8)] == [None, "GPL-3.0", "Apache-2.0", "GPL-2.0", "Apache-2.0", None, "LGPL-2.1"]
    assert [rows[i][4].split(",") for i in (0, 3, 8)] == [["GPL-3.0"], ["Apache-2.0"], ["LGPL-2.1"]] and rows[9][4] == ""
    assert [rows[i][3] for i in (4, 5, 6, 7)] == ["MIT", "GPL-2.0", "Apache-2.0", ""]


def test_notices_that_share_their_line(spark):
    """A reservation or a statement anywhere in a line: what stands before and behind is found too."""
    lines = [
        "Licensed under the MIT License. All rights reserved.",
        "This text (c) 2020 Jo Bloggs. Licensed under the MIT License.",
        "Copyright 2020 X. Licensed under the MIT License. All rights reserved.",
        "Licensed under CC BY 4.0. © 2021 Y",
        "Licensed under CC BY 4.0, copyright (c) 2021 Y. All rights reserved",
        "All rights reserved. Licensed under CC BY 4.0.",
        "A page of 1999 with all rights reserved.",
        "(c) is a letter, and 2020 a year",
    ]
    docs = spark.createDataFrame([(i, "x\n" + t + "\ny") for i, t in enumerate(lines)] + [(99, "\n".join(lines))], "doc_id long, text string")
    rows = {r.doc_id: tuple(r)[1:] for r in licences.scan(docs).collect()}
    own = "LicenseRef-Proprietary"
    want = [f"MIT,{own}", "MIT", f"MIT,{own}", "CC-BY-4.0", f"CC-BY-4.0,{own}", "CC-BY-4.0", own, ""]
    assert [rows[i][3] for i in range(len(lines))] == want and rows[99][3] == ",".join(w for w in want if w)
    assert rows == {**{i: brute("x\n" + t + "\ny") for i, t in enumerate(lines)}, 99: brute("\n".join(lines))}
