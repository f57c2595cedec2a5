"""License scan by canonical digests, in built-in expressions only.

A text is brought to a canonical form, line by line: lower case, copyright lines and the marks of comments and lists out, letters
and digits only, equivalent spellings made equal. Every run of whole lines that is the entire text of a known license is found,
however its lines are wrapped: a run can begin where the first characters are those of some known text, and
as many characters as that text has, up to the end of a line, are looked up by their digest.

The built-in table has whole texts and headers of common licenses, and short notices made by a rule from lead-ins and names.
Longer texts are read from files, see ``read_texts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD = 16  # characters by which a run of lines is recognized as a candidate

# Equivalent spellings in the canonical form, which has no spaces ("sub license" is one word there).
SPELLINGS = (
    ("licence", "license"),
    ("merchantibility", "merchantability"),
    ("https", "http"),
    ("whilst", "while"),
    ("favour", "favor"),
    ("fulfill", "fulfil"),
    ("acknowledgement", "acknowledgment"),
)

# Parts of texts that several licenses share.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_MIT_END = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS {0}BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
    "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
    "OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    _MIT_GRANT + ", subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software.\n\n" + _MIT_END.format("OR COPYRIGHT HOLDERS ")
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n\n"
)
_BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the "
    "Free Software Foundation, {version}\n\nThis {what} is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more "
    "details.\n\nYou should have received a copy of the {name} along with this {what}{end}"
)
_GNU_ENDS = (
    ". If not, see <https://www.gnu.org/licenses/>.",
    "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "; if not, write to the Free Software Foundation, Inc., 59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
)
# Whole texts and headers.
_TEXTS = (
    ("0BSD", _ISC_GRANT + ".\n\n" + _ISC_END),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at\n\n"
        "http://www.apache.org/licenses/LICENSE-2.0\n\n"
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_END),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAME + _BSD_END),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and '
        "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is "
        "furnished to do so, all subject to the following:\n\nThe copyright notices in the Software and this entire statement, "
        "including the above license grant, this restriction and the following disclaimer, must be included in all copies of the "
        "Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely "
        "in the form of machine-executable object code generated by a source language processor.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide. This software is distributed without any warranty.\n\nYou should have received a "
        "copy of the CC0 Public Domain Dedication along with this software. If not, see "
        "<http://creativecommons.org/publicdomain/zero/1.0/>.",
    ),
    ("ISC", _ISC_GRANT + _ISC_KEEP),
    ("ISC", _ISC_GRANT + _ISC_KEEP + "\n\n" + _ISC_END),
    ("MIT", _MIT),
    ("MIT-0", _MIT_GRANT + ".\n\n" + _MIT_END.format("OR COPYRIGHT HOLDERS ")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
        "or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this "
        "software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the "
        "benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
        "act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
        + _MIT_END.format("")
        + "\n\nFor more information, please refer to <http://unlicense.org/>",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is "
        "not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software.\n3. This notice may not be removed or altered from any source distribution.",
    ),
)
# Names by which notices speak of a license.
_NAMES = {
    "0BSD": ("Zero-Clause BSD License", "0BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "BSL-1.0": ("Boost Software License", "Boost Software License, Version 1.0"),
    "ISC": ("ISC License",),
    "MIT": ("MIT License", "Expat License"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
}
_GNU_NAMES = (
    ("GPL", "GNU General Public License", "program", ("2", "3")),
    ("LGPL", "GNU Lesser General Public License", "library", ("2.1", "3")),
    ("AGPL", "GNU Affero General Public License", "program", ("3",)),
)
_CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
_CC_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
_CC_VERSIONS = (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International"))
_LEADS = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This software is licensed under", "This project is licensed under")


def _spdx(version: str) -> str:
    return version if "." in version else version + ".0"


def _gnu_texts() -> list[tuple[str, str]]:
    """Headers of the three families, "only" and "or later", by what they are of and where they say the text is."""
    rows = []
    for short, name, kind, versions in _GNU_NAMES:
        for version in versions:
            only, later = f"version {version} of the License.", f"either version {version} of the License, or (at your option) any later version."
            for what in {"program", kind}:
                for end in _GNU_ENDS:
                    for words, wording in ((later, "-or-later"), (only, "-only")):
                        text = _GNU.format(what=what, name=name, version=words, end=end)
                        rows.append((f"{short}-{_spdx(version)}{wording}", text))
    return rows


def _names() -> list[tuple[str, str]]:
    """Every license with each of its names."""
    rows = [(license, name) for license, names in _NAMES.items() for name in names]
    for short, name, _, versions in _GNU_NAMES:
        for version in versions:
            rows += [
                (f"{short}-{_spdx(version)}", said)
                for number in {version, _spdx(version)}
                for said in (f"{name}, version {number}", f"{name} v{number}", f"{short}v{number}", f"{short}-{number}")
            ]
    for kind in _CC_KINDS:
        full = "-".join(_CC_PARTS[p] for p in kind.split("-"))
        for version, ported in _CC_VERSIONS:
            license = f"CC-{kind}-{version}"
            rows += [(license, f"CC {kind} {version}")]
            rows += [(license, f"Creative Commons {full} {version}{more}") for more in ("", " License", f" {ported} License")]
    return rows


def _notices() -> list[tuple[str, str]]:
    rows = [(license, f"{lead} {the}{name}.") for license, name in _names() for lead in _LEADS for the in ("", "the ")]
    return rows + [(license, f"SPDX-License-Identifier: {license}") for license in {r[0] for r in (*_TEXTS, *_gnu_texts(), *_names())}]


def _distinct(rows) -> tuple[tuple[str, str], ...]:
    return tuple(sorted(set(rows)))


LICENSES = _distinct([*_TEXTS, *_gnu_texts(), *_notices()])

# At the beginning of a line, after the marks of a comment: a copyright notice up to the line's end, or the number of a list.
NOISE = r"(?m)^[^\p{L}\p{N}\n]*(?:(?:copyright\b|\(c\)|©|all rights reserved\b)[^\n]*$|[0-9]{1,2}[.)][ \t])"


def canonical_lines(text: Column) -> Column:
    """The canonical form of each line; null is one empty line."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOISE, " ")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{N}\n]+", "")
    for spelling, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(spelling), F.lit(usual))
    return F.split(plain, "\n")


def canonical(text: Column) -> Column:
    """The form in which equal licenses are equal."""
    return F.array_join(canonical_lines(text), "")


def known(spark: SparkSession) -> DataFrame:
    """The built-in table of licenses: ``license``, ``text``."""
    return spark.createDataFrame(list(LICENSES), "license string, text string")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """``license, text`` of a folder of text files, each named by its license."""
    files = spark.read.option("wholetext", True).text(path)
    return files.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.txt)?$", 1).alias("license"), F.col("value").alias("text"))


def digests(licenses: DataFrame, license: str = "license", text: str = "text") -> DataFrame:
    """``head, n, digest, license``: per different canonical text its first characters, its length, its digest, and its names joined.

    Texts with fewer than ``HEAD`` letters and digits are left out: a run of lines is not told from prose by so few.
    """
    plain = licenses.select(F.col(license).alias("license"), canonical(F.col(text)).alias("c")).where(F.length("c") >= HEAD)
    rows = plain.groupBy("c").agg(F.array_join(F.sort_array(F.collect_set("license")), "|").alias("license"))
    return rows.select(F.substring("c", 1, HEAD).alias("head"), F.length("c").alias("n"), F.sha2("c", 256).alias("digest"), "license")


def _heads(cells: Column, heads: list[str]) -> Column:
    """Places, from 1, of the lines at which a run begins with one of ``heads``."""

    def first(cell: Column, i: Column) -> Column:
        # Lines that are shorter need those after them; none is empty, so as many as there are characters will do.
        few = F.array_join(F.transform(F.slice(cells, i + 1, HEAD), lambda c: c["line"]), "")
        return F.substring(F.when(F.length(cell["line"]) >= HEAD, cell["line"]).otherwise(few), 1, HEAD)

    places = F.transform(cells, lambda cell, i: F.when(first(cell, i).isin(heads), i + 1))
    return F.filter(places, lambda place: place.isNotNull())


def matches(docs: DataFrame, licenses: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every run of lines that is a known license: ``(id, unit, place, n_lines, license)``.

    ``licenses`` is the table of ``digests``; its different heads are collected. ``unit`` is text for a whole text, else line or lines;
    ``place`` is the run's first line, counted from 0, and ``n_lines`` its lines, those that have an empty canonical form
    left out, as they are inside runs. Runs may overlap; a run of several names has one row. Null and empty texts match
    nothing; repeated rows match each; other columns are not read; an empty table gives no rows.
    """
    heads = sorted({r[0] for r in licenses.select("head").distinct().collect()})  # no more than rows of the table
    numbered = F.transform(canonical_lines(F.col(text)), lambda line, i: F.struct(i.alias("place"), line.alias("line")))
    cells = docs.select(F.col(id).alias("__id"), F.filter(numbered, lambda c: c["line"] != "").alias("cells"))
    begun = cells.withColumn("at", _heads(F.col("cells"), heads)).where(F.size("at") > 0)
    runs = begun.select("__id", "cells", F.explode("at").alias("at"))
    lines = F.transform("cells", lambda c: c["line"])
    runs = runs.select(
        "__id", "at", F.size("cells").alias("size"), F.element_at("cells", F.col("at"))["place"].alias("place"),
        F.slice(lines, F.col("at"), F.size("cells")).alias("rest"),
    )
    start = F.substring(F.array_join(F.slice("rest", 1, HEAD), ""), 1, HEAD)
    found = runs.withColumn("head", start).join(licenses, "head")
    # As many whole lines as reach the known length; no more than its characters.
    none = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("lines"))
    taken = F.aggregate(
        F.slice("rest", 1, F.col("n")), none,
        lambda sum, line: F.when(sum["chars"] >= F.col("n"), sum).otherwise(
            F.struct((sum["chars"] + F.length(line)).alias("chars"), (sum["lines"] + 1).alias("lines"))
        ),
    )
    whole = found.withColumn("taken", taken).where(F.col("taken.chars") == F.col("n"))
    equal = F.sha2(F.array_join(F.slice("rest", 1, F.col("taken.lines")), ""), 256) == F.col("digest")
    unit = F.when(F.col("taken.lines") == F.col("size"), "text").when(F.col("taken.lines") == 1, "line").otherwise("lines")
    return whole.where(equal).select(F.col("__id").alias(id), unit.alias("unit"), "place", F.col("taken.lines").alias("n_lines"), "license")
