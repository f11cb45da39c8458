"""Licence scans by canonical digest lookup, with DataFrame functions only.

A text is made canonical in one pass: A-Z lower-cased, copyright lines left out, spellings that mean the same made one,
punctuation and white space reduced to single spaces, so that wrapping does not matter. A copyright line opens with the
word or sign followed by a year, `(c)`, the other sign or 'by', or reserves all rights. Digests meet the digests of known
licence texts, made in the same way, in a hash join. Looked up are:

* the whole text;
* each line, as notices often stand alone on a line of a longer text, SPDX identifiers among them. Of a line with a copyright
  statement (sign, years, holder) what stands before it is looked up, and what stands behind it if it opens as a known text
  does; before one that opens its line there is nothing. 'All rights reserved' at a line's end is a notice of its own,
  with `rights`, and what stands before it is looked up as if it were not there;
* every place inside a text where the first words of a known text of at least `INNER` words stand, with as many characters as
  that text has: full texts and wrapped notices within longer documents.

Only lines that are as long as a known text are digested, which loses none. The table of known texts is small and of fixed
size (some 250 rows), and its digests are broadcast. It holds notices, headers of source files and SPDX identifiers
(`KNOWN`) and full texts, with and without title (`full_texts`).

Defined cases: null texts are empty and match nothing. Repeated rows get equal results. Ids may be null. A line
that repeats is listed each time. Lines and texts of any length are looked up. Empty tables give no rows. Further columns
are not read.
"""

from __future__ import annotations

import re
from functools import cache
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Work

# Known licence texts and notices by SPDX id.
KNOWN: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    (
        "MIT",
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.",
    ),
]

# Headers of source files, by SPDX id; the first paragraph says which licence it is, and is known without the rest.
_APACHE_MAY = "You may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0"
_APACHE_UNLESS = "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
_GNU_FIRST = "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
_GNU_SECOND = "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
_GNU_THIRD = "You should have received a copy of the GNU {name} along with this {what}. If not, see <https://www.gnu.org/licenses/>."
_GNU = [("GPL-2.0", "program", "General Public License", "2"), ("GPL-3.0", "program", "General Public License", "3"), ("LGPL-2.1", "library", "Lesser General Public License", "2.1"), ("LGPL-3.0", "library", "Lesser General Public License", "3")]
HEADERS: list[tuple[str, str]] = [
    ("Apache-2.0", _APACHE_MAY),
    ("Apache-2.0", _APACHE_MAY.replace("You", "you", 1)),
    ("Apache-2.0", f"Licensed under the Apache License, Version 2.0 (the \"License\");\n{_APACHE_MAY}\n\n{_APACHE_UNLESS}"),
]
for _licence, _what, _name, _version in _GNU:
    _parts = [part.format(what=_what, name=_name, version=_version) for part in (_GNU_FIRST, _GNU_SECOND, _GNU_THIRD)]
    HEADERS += [(_licence, _parts[0]), (_licence, "\n\n".join(_parts[:2])), (_licence, "\n\n".join(_parts))]
#: Licences whose SPDX identifier is looked for, as it is and with the suffixes that newer lists have.
IDENTIFIERS = ("0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense", "Zlib")
SPDX: list[tuple[str, str]] = [(i, f"SPDX-License-Identifier: {i}{suffix}") for i in IDENTIFIERS for suffix in (("", "-only", "-or-later") if "GPL" in i else ("",))]
KNOWN += HEADERS + SPDX

# Spellings that mean the same, in lower case, and the one that stands for them.
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("share-alike", "sharealike"),
    ("non-infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("copyright holder's", "copyright holders"),
]

#: Notices that stand on copyright lines.
RIGHTS: list[tuple[str, str]] = [("LicenseRef-Proprietary", "All rights reserved.")]

#: Full texts in `licence_texts`: licence, file, and where the text begins without its title.
FULL: list[tuple[str, str, str]] = [
    ("Apache-2.0", "Apache-2.0", "TERMS AND CONDITIONS FOR USE"),
    ("CC0-1.0", "CC0-1.0", "CC0 1.0 Universal"),
    ("GPL-1.0", "GPL-1", "Everyone is permitted"),
    ("GPL-2.0", "GPL-2", "Everyone is permitted"),
    ("GPL-3.0", "GPL-3", "Everyone is permitted"),
    ("LGPL-2.0", "LGPL-2", "Everyone is permitted"),
    ("LGPL-2.1", "LGPL-2.1", "Everyone is permitted"),
    ("LGPL-3.0", "LGPL-3", "Everyone is permitted"),
    ("MPL-1.1", "MPL-1.1", "1. Definitions."),
    ("MPL-2.0", "MPL-2.0", "1. Definitions"),
]
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
# Further full texts, without titles.
MORE: list[tuple[str, str]] = [
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to <https://unlicense.org>",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\n\nThe copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]
#: Titles of short texts, which also stand without any.
TITLES: dict[str, list[str]] = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "BSD License"],
}
#: Holders that BSD texts name: in the third clause, where they provide, and where they are not liable.
BSD_HOLDERS = [
    ("the University", "REGENTS", "REGENTS"),
    ("the copyright holder", "COPYRIGHT HOLDERS", "COPYRIGHT HOLDER"),
    ("the copyright holder", "COPYRIGHT HOLDERS", "COPYRIGHT OWNER"),
    ("the copyright holder", "COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A copyright line: it opens with the word or a sign and goes on with a year, a sign or 'by', or it reserves all rights.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/-]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|by[ \t])|\(c\)[ \t]*(copyright|[0-9]{4})|©|all rights reserved)[^\n]*"
#: A copyright statement anywhere in a line: the word or a sign with a year.
STATEMENT = r"(copyright[ \t]*(\(c\)|©)?[ \t]*[0-9]{4}|\(c\)[ \t]*[0-9]{4}|©[ \t]*[0-9]{4})"
#: What reserves rights at a line's end, in canonical form.
RESERVED = "all rights reserved"
#: Runs of anything but letters, digits, line ends and signs beyond ASCII (the copyright sign aside).
SIGNS = r"[^a-z0-9\n\x{80}-\x{A8}\x{AA}-\x{10FFFF}]+"

#: Words of a known text up to which a copyright line's rest is held against all of it, words that open a longer one, and
#: words from which a known text is looked for inside others.
SHORT, OPENING, INNER = 40, 6, 12


def canonical(text: Column) -> Column:
    """The canonical form of a text column (null: empty)."""
    return _in_one_line(_in_lines(F.regexp_replace(_lower(text), COPYRIGHT_LINE, "$1")))


def _lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _in_lines(lower: Column) -> Column:
    """Spellings and signs made canonical, line ends kept."""
    for spelling, one in SPELLINGS:
        lower = F.replace(lower, F.lit(spelling), F.lit(one))
    return F.regexp_replace(lower, SIGNS, " ")


def _in_one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


@cache
def bodies() -> list[tuple[str, str]]:
    """Full licence texts without title, with and without what follows the end of the terms."""
    out = []
    for licence, name, begin in FULL:
        text = _read(name)
        out += _ends(licence, text[text.index(begin) :])
    out += [(licence, text[text.index("\n\n") :] if licence != "Zlib" else text) for licence, text in KNOWN if licence in TITLES and "\n" in text] + MORE
    bsd = _read("BSD")
    third = bsd[bsd.index("3. Neither") : bsd.index("THIS SOFTWARE")]
    for name, provides, liable in BSD_HOLDERS:
        text = bsd.replace("the University", name).replace("REGENTS AND", f"{provides} AND").replace("REGENTS OR", f"{liable} OR")
        third_of = third.replace("the University", name)
        for form in (text, re.sub(r"(?m)^[123]\. ", "* ", text)):
            plain = third_of if form is text else re.sub(r"(?m)^3\. ", "* ", third_of)
            out += [("BSD-3-Clause", form), ("BSD-2-Clause", form.replace(plain, ""))]
    return _links(out)


@cache
def full_texts() -> list[tuple[str, str]]:
    """Full licence texts with and without title."""
    out = []
    for licence, name, _ in FULL:
        out += _ends(licence, _read(name))
    for licence, text in bodies():
        out += [(licence, f"{title}\n\n{text}") for title in TITLES.get(licence, [])]
    return bodies() + _links(out)


def _read(name: str) -> str:
    return files(__package__).joinpath("licence_texts", f"{name}.txt").read_text("utf-8")


def _ends(licence: str, text: str) -> list[tuple[str, str]]:
    terms, end, _ = text.partition(END_OF_TERMS)
    return [(licence, text), *([(licence, terms + end), (licence, terms)] if end else [])]


def _links(texts: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The texts, and those that name links once more with the older form of these."""
    return texts + [(licence, text.replace("https:", "http:")) for licence, text in texts if "https:" in text]


def _forms(spark: SparkSession, texts: list[tuple[str, str]] | None, rights: bool) -> DataFrame:
    """Known texts in canonical form: licence, form, inner (looked for inside other texts). Those of `RIGHTS` keep their
    copyright line."""
    schema = "licence string, known string, body boolean"
    if texts is None:
        given = [(*x, True) for x in KNOWN + bodies()] + [(*x, False) for x in full_texts()]
    else:
        given = [(*x, True) for x in texts]
    form = canonical(F.col("known"))
    inner = F.col("body") & (F.size(F.split(form, " ")) >= INNER)
    forms = spark.createDataFrame(given, schema).select("licence", form.alias("form"), inner.alias("inner"))
    if rights:
        forms = forms.union(spark.createDataFrame([(*x, False) for x in RIGHTS], schema).select("licence", _in_one_line(_in_lines(_lower(F.col("known")))), "body"))
    return forms.where("form != ''").groupBy("form").agg(F.min("licence").alias("licence"), F.max("inner").alias("inner"))


def known(spark: SparkSession, texts: list[tuple[str, str]] | None = None, rights: bool = False) -> DataFrame:
    """Digests of known texts: (_digest, _licence), one licence for each digest."""
    return _forms(spark, texts, rights).select(F.sha2("form", 256).alias("_digest"), F.col("licence").alias("_licence"))


def rest_pattern(forms: list[str]) -> str:
    """A pattern of what may follow a copyright statement: a short form to the end, or whatever opens as a long one."""
    words = [f.split(" ") for f in forms]
    return "|".join(sorted({re.escape(" ".join(w)).replace("\\ ", " ") if len(w) <= SHORT else " ".join(w[:OPENING]) + " .*" for w in words}))


def openings(inner: list[str]) -> dict[str, list[int]]:
    """The first words of texts, and the lengths of those that begin so."""
    out: dict[str, set[int]] = {}
    for form in inner:
        out.setdefault(" ".join(form.split(" ")[:OPENING]), set()).add(len(form))
    return {o: sorted(n) for o, n in sorted(out.items())}


def _inside(whole: str, inner: list[str]) -> Column:
    """Places in a canonical text where a known one begins, with the stretches that are as long as one: array of (at, form)."""
    none = "cast(array() as array<struct<at: int, form: string>>)"
    parts = [none]
    for opening, lengths in openings(inner).items():
        size = len(opening)
        places = f"aggregate(slice(split({whole}, '{opening}', -1), 1, size(split({whole}, '{opening}', -1)) - 1), named_struct('at', 0, 'out', cast(array() as array<int>)), (acc, x) -> named_struct('at', acc.at + char_length(x) + {size}, 'out', concat(acc.out, array(acc.at + char_length(x)))), acc -> acc.out)"
        found = f"flatten(transform(filter({places}, p -> p = 0 or substr({whole}, p, 1) = ' '), p -> transform(filter(array({', '.join(map(str, lengths))}), n -> p + n <= char_length({whole}) and substr({whole}, p + n + 1, 1) in ('', ' ')), n -> named_struct('at', p, 'form', substr({whole}, p + 1, n)))))"
        parts.append(f"if(contains({whole}, '{opening}'), {found}, {none})")
    return F.expr(f"concat({', '.join(parts)})")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: list[tuple[str, str]] | None = None, rights: bool = True) -> DataFrame:
    """One row per row: id_col, digest (of the whole text), licence (of the whole text, or null), n_lines (notices found
    on lines), licences (of those, in the order of the lines, comma-joined; empty: none) and inside (licences of
    known texts anywhere in the text, each once, by first place).

    Each text is read once; what may be a known text, few and short rows, is stored under a number of its row and meets
    the broadcast table of known digests. What is found goes back to the rows by that number, so copies of one text do
    not meet in one task, and no text is moved.
    """
    spark = docs.sparkSession
    table = [(r["form"], r["inner"]) for r in _forms(spark, texts, rights).collect()]
    forms, inner = [f for f, _ in table], [f for f, i in table if i]
    lookup = F.broadcast(known(spark, texts, rights))
    lengths = F.array(*map(F.lit, sorted({len(f) for f in forms}))) if forms else F.array().cast("array<int>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_key"), _lower(text).alias("_lower"))
    rows = rows.withColumn("_stated", F.col("_lower").rlike(COPYRIGHT_LINE))
    rows = rows.withColumn("_lines", _in_lines(F.when(F.col("_stated"), F.regexp_replace("_lower", COPYRIGHT_LINE, "$1")).otherwise(F.col("_lower"))))
    rows = rows.withColumn("_whole", _in_one_line(F.col("_lines")))
    rest = rest_pattern(forms)

    def parts(line: Column) -> Column:
        """What is looked up of a line that may hold a statement or reservation: what stands before and behind it."""
        plain = F.trim(_in_lines(line))
        reserves = (plain == RESERVED) | plain.endswith(f" {RESERVED}")
        head = F.when(reserves, F.trim(F.substring(plain, F.lit(1), F.char_length(plain) - len(RESERVED)))).otherwise(plain)
        behind = F.regexp_extract(head, f"(?:^| )({rest})$", 1) if rest else F.lit("")
        before = F.trim(_in_lines(F.regexp_extract(line, f"^(.*?){STATEMENT}", 1)))
        found = F.when(line.rlike(COPYRIGHT_LINE), F.array(behind)).when(line.rlike(STATEMENT), F.array(before, behind)).otherwise(F.array(head))
        return F.concat(found, F.when(reserves, F.array(F.lit(RESERVED))).otherwise(F.array().cast("array<string>")))

    placed = lambda forms, i: F.transform(forms, lambda form, k: F.struct(i.alias("line"), k.alias("part"), form.alias("form")))
    special = F.col("_stated") | F.contains("_lower", F.lit(RESERVED)) | F.col("_lower").rlike(STATEMENT)
    by_part = F.flatten(F.transform(F.split("_lower", "\n"), lambda x, i: placed(parts(x), i)))
    by_line = F.transform(F.split("_lines", "\n"), lambda x, i: F.struct(i.alias("line"), F.lit(0).alias("part"), F.trim(x).alias("form")))
    lines = F.when(special, by_part).otherwise(by_line)
    # a line is a place, and so is each of its parts
    lines = F.transform(lines, lambda x: F.struct((x["line"].cast("long") * 4 + x["part"]).alias("at"), x["form"].alias("form")))
    fitting = F.filter(lines, lambda x: F.array_contains(lengths, F.char_length(x["form"])) & (x["form"] != ""))
    digested = lambda found, kind: F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["at"].cast("long").alias("at"), F.sha2(x["form"], 256).alias("digest")))
    made = rows.select("_id", "_key", F.sha2("_whole", 256).alias("_digest"), F.concat(digested(fitting, 0), digested(_inside("_whole", inner), 1)).alias("_places"))
    work = Work(spark)
    made = work.stored(made, "places")
    found = made.where(F.size("_places") > 0).select("_key", F.explode("_places").alias("_p")).select("_key", F.col("_p.kind").alias("_kind"), F.col("_p.at").alias("_at"), F.col("_p.digest").alias("_digest"))
    found = found.join(lookup, "_digest").select("_key", "_kind", "_at", "_licence")
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("_kind") == kind, F.struct("_at", "_licence"))))["_licence"]
    found = found.groupBy("_key").agg(of(0).alias("_found"), F.array_distinct(of(1)).alias("_inside"))
    out = made.drop("_places").join(lookup, "_digest", "left").join(found, "_key", "left")
    none = F.array().cast("array<string>")
    listed = F.coalesce("_found", none)
    return out.select(F.col("_id").alias(id_col), F.col("_digest").alias("digest"), F.col("_licence").alias("licence"), F.size(listed).cast("long").alias("n_lines"), F.array_join(listed, ",").alias("licences"), F.array_join(F.coalesce("_inside", none), ",").alias("inside"))
