"""License scans: normalised text against licence templates, by Dice coefficient over word bigrams."""

from __future__ import annotations

import pkgutil
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatlane.llm.common import ascii_lower, text_of, whole_row

LEAST_DICE = (8, 10)

#: Notices by which works are put under well-known licences.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction, including without limitation the rights to use,"
        " copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to"
        " whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with'
        " the License. You may obtain a copy of the License at",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
)

_FREE = "you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation"
_WARRANTY = (
    " This {1} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
    " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. You should have received a copy of"
    " the GNU {0} along with this {1}; if not, see <https://www.gnu.org/licenses/>."
)
_AS_IS = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
    " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
    " conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and"
    " the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAME = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission."
)
_BSD_AS_IS = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,'
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;"
    " LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN"
    " CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS"
    " SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    ("GPL-2.0", "program", "General Public License", ";", "; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "program", "General Public License", ";", "; version 2 of the License."),
    ("GPL-3.0", "program", "General Public License", ":", ", either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "program", "General Public License", ":", ", version 3 of the License."),
    ("LGPL-2.1", "library", "Lesser General Public License", ";", "; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "library", "Lesser General Public License", ";", "; version 2.1 of the License."),
    ("LGPL-3.0", "library", "Lesser General Public License", ":", ", either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "program", "Lesser General Public License", ":", ", either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "library", "Lesser General Public License", ":", ", version 3 of the License."),
    ("AGPL-3.0", "program", "Affero General Public License", ":", ", either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "program", "Affero General Public License", ":", ", version 3 of the License."),
)


def _gnu() -> list[tuple[str, str]]:
    """The notice that the GNU licences ask for, its first paragraph alone and whole."""
    out = []
    for name, what, title, mark, version in _GNU:
        first = f"This {what} is free software{mark} " + _FREE.format(title) + version
        out += [(name, first), (name, first + _WARRANTY.format(title, what))]
    return [x for x in out if x not in NOTICES]


def _cc() -> list[tuple[str, str]]:
    kinds = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"))
    return [
        (
            f"CC-{kind}-4.0",
            f"This work is licensed under the Creative Commons {title} 4.0 International License. To view a copy of this license, visit"
            f" http://creativecommons.org/licenses/{kind.lower()}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View,"
            " CA 94042, USA.",
        )
        for kind, title in kinds
    ]


#: Licences whose full text lies beside this module.
FULL_TEXTS = ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")
_MIT = NOTICES[2][1] + (
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_APACHE = NOTICES[4][1] + (
    ' http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under'
    ' the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the'
    " License for the specific language governing permissions and limitations under the License."
)
TEMPLATES = (
    *NOTICES, *_gnu(), *_cc(),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", _MIT), ("MIT", _MIT + _AS_IS), ("Apache-2.0", _APACHE),
    ("MPL-2.0", NOTICES[10][1] + " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD", _BSD + _BSD_AS_IS), ("BSD", _BSD + _BSD_NAME + _BSD_AS_IS),
    *((name, pkgutil.get_data(__package__, f"licenses/{name}.txt").decode()) for name in FULL_TEXTS),
)

#: ASCII characters other than a-z and 0-9, once A-Z are in lower case.
_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_bigrams(text: str) -> list[str]:
    words = [w for w in re.split(_OTHER, text.lower()) if w]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _words(c: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(c), _OTHER, -1), "")


def find_licenses(docs: DataFrame, text_col: str = "text", templates=TEMPLATES, least=LEAST_DICE) -> DataFrame:
    """Columns ``row`` (all columns but the text) and ``matches``, an array of
    (unit, pos, license, dice); one row per input row, and no shuffle.

    Units are each line, each paragraph (blocks between blank lines) of several
    lines, and the whole text if it has several paragraphs; ``pos`` counts from 0
    within the kind of unit. A unit matches a template if the Dice coefficient of
    their sets of word bigrams is at least ``least`` (a fraction); the best one
    counts, of equal ones the last name. With the least value go size bounds: a unit of n and a template of m bigrams can only reach t if
    t * m <= (2 - t) * n and t * n <= (2 - t) * m. They drop units before
    any bigram is built, as n is below the number of words and not below the
    number of different words less one; and templates per unit after that.
    Null or empty text has no matches; ids play no part.
    """
    num, den = least
    rest = 2 * den - num
    made = [(name, template_bigrams(t)) for name, t in templates]
    made = [(name, g) for name, g in made if g]
    low, high = min(len(g) for _, g in made), max(len(g) for _, g in made)
    table = F.array(
        *[F.struct(F.lit(name).alias("license"), F.lit(len(g)).alias("m"), F.split(F.lit(",".join(g)), ",").alias("grams")) for name, g in made]
    )
    text = text_of(text_col)

    def unit(kind: str):
        return lambda part, i: F.struct(F.lit(kind).alias("unit"), i.alias("pos"), _words(part).alias("words"))

    several = lambda parts, c: F.when(F.size(c) > 1, parts).otherwise(F.array().cast("array<string>"))
    split = docs.select(whole_row(docs, text_col), text.alias("text")).select(
        "row", "text", F.split("text", "\n", -1).alias("lines"), F.split("text", r"\n[\x20\x09-\x0D]*\n", -1).alias("blocks")
    )
    units = split.select(
        "row",
        F.concat(
            F.transform("lines", unit("line")),
            F.transform(F.transform("blocks", lambda b: F.when(F.contains(b, F.lit("\n")), b).otherwise(F.lit(""))), unit("paragraph")),
            F.transform(several(F.array("text"), F.col("blocks")), unit("document")),
        ).alias("units"),
    ).select(
        "row",
        F.filter(
            "units",
            lambda u: ((F.size(u["words"]) - 1) * rest >= low * num)
            & ((F.size(F.array_distinct(u["words"])) - 1) * num <= high * rest),
        ).alias("units"),
    )

    def bigrams(words: Column) -> Column:
        pairs = F.transform(words, lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1)))
        return F.array_distinct(F.array_compact(pairs))

    sized = units.select(
        "row",
        F.transform("units", lambda u: F.struct(u["unit"].alias("unit"), u["pos"].alias("pos"), bigrams(u["words"]).alias("grams"))).alias("units"),
    )

    def matches(u):
        n = F.size(u["grams"])
        common = lambda t: F.size(F.array_intersect(u["grams"], t["grams"]))
        close = F.filter(
            table,
            lambda t: (t["m"] * num <= n * rest) & (n * num <= t["m"] * rest)
            & (common(t) * (2 * den) >= (n + t["m"]) * num),
        )
        best = F.array_max(F.transform(close, lambda t: F.struct((F.lit(2.0) * common(t) / (n + t["m"])).alias("dice"), t["license"].alias("license"))))
        found = F.struct(u["unit"].alias("unit"), u["pos"].alias("pos"), best["license"].alias("license"), best["dice"].alias("dice"))
        return F.when(best.isNotNull(), found)

    return sized.select("row", F.array_compact(F.transform("units", matches)).alias("matches"))
