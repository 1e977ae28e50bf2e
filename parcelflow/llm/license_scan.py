"""Licence scan: TF-IDF cosine to templates, then inheritance down directories.

Statements are the lines, cut at ends of sentences, that hold a telling word of
any template (all their words but ``_COMMON`` ones and numbers), anywhere in a
text.  Paragraphs, the comment a file begins with and licence files as a whole
are compared too, where they hold such words.  A line or such a block, and each
template, is a sparse vector of its distinct words, weighted by tf x idf;
idf = ln((1 + N) / (1 + df)) + 1 over all statement lines of all files together
with the templates (a word no line holds has df 0).  The best cosine to a
template of at least ``ENOUGH`` whose licence's ``RULES`` the line or block keeps
names its licence: a version, variant or clause number must be there, and no
word that tells another variant may be.  A file's
licence is that of its best one.  Reservations ("All rights reserved.") stand
beside many grants and count only in files without one.

A line with an SPDX identifier is no vector: it names the licence or expression
that it spells, known or not, with score 1.

Templates are short notices, usual headers and full texts; of the long licences
(Apache, GNU, MPL, Creative Commons, Eclipse, Artistic) the notices and the titles their files begin with.

A licence file (its base name begins with LICENSE, LICENCE, UNLICENSE, COPYING, NOTICE or
COPYRIGHT, or is a licence's name and -LICENSE) speaks for its directory; of several the best score, then the
smallest path.  A file without a statement of its own takes the licence of the
nearest directory above it that has one: every directory is joined to all its
ancestors' licences, and the deepest stays; grants come before reservations here too.

Only DataFrame functions are used.  Words, and texts of statements, become 64-bit
hashes where they are cut, and only those are shuffled: once by statement (equal
ones are one vector), once by word to meet idf, and once by statement for the
length and the weights of the templates' words, which then meet the templates, a
fixed table.  Directories, not files, are joined to
ancestors, so a directory with many files costs one row.

Null and empty texts have no statement; a null path is a file in no directory.
Texts of any length and form are cut without recursion.
Repeated rows give repeated results; ties go to the smaller licence name.  An
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

ENOUGH = 0.6

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_GNU = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version. "
    "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
    "You should have received a copy of the GNU {name} along with this {what}. If not, see https://www.gnu.org/licenses/."
)
_GNU_TITLE = "GNU {name} Version {v}, {date} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."

# SPDX identifiers and the words of their usual short notices, headers and full texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 Universal license"),
    ("proprietary", "Copyright. All rights reserved. No part of this may be reproduced without permission"),
    ("proprietary", "All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
     "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS + " AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
     "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END),
    ("ISC", _ISC),
    ("ISC", _ISC + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
     "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
     "See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-2.0", _GNU.format(what="program", name="General Public License", v=2)),
    ("GPL-3.0", _GNU.format(what="program", name="General Public License", v=3)),
    ("LGPL-2.1", _GNU.format(what="library", name="Lesser General Public License", v="2.1")),
    ("LGPL-3.0", _GNU.format(what="library", name="Lesser General Public License", v=3)),
    ("AGPL-3.0", _GNU.format(what="program", name="Affero General Public License", v=3)),
    ("GPL-2.0", _GNU_TITLE.format(name="General Public License", v=2, date="June 1991")),
    ("GPL-3.0", _GNU_TITLE.format(name="General Public License", v=3, date="29 June 2007")),
    ("LGPL-2.1", _GNU_TITLE.format(name="Lesser General Public License", v="2.1", date="February 1999")),
    ("LGPL-3.0", _GNU_TITLE.format(name="Lesser General Public License", v=3, date="29 June 2007")),
    ("AGPL-3.0", _GNU_TITLE.format(name="Affero General Public License", v=3, date="19 November 2007")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License, CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License, CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License, CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License, CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License, CC BY-NC-ND 4.0"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") "
     "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"),
    ("Zlib", "Released under the zlib License"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
     "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
     "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
     "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "Released under the Unlicense"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
     "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("WTFPL", "Licensed under the WTFPL"),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."),
    ("Artistic-2.0", "Licensed under the Artistic License 2.0"),
    ("Artistic-2.0", "The Artistic License 2.0 Copyright (c) 2000-2006, The Perl Foundation. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
)
_RESERVED = "proprietary"


def _marks(*names: str) -> set[str]:
    """Words by which a licence or variant is told, alone, after "by-" or "cc-by-", and with a version."""
    return {p + n + v for n in names for p in ("", "by-", "cc-by-") for v in ("", "-4.0")}


_NC, _ND, _SA = _marks("nc", "noncommercial", "attribution-noncommercial"), _marks("nd", "noderivatives", "noderivs", "attribution-noderivatives"), _marks("sa", "sharealike", "attribution-sharealike")
_NCSA, _NCND = _marks("nc-sa", "noncommercial-sharealike", "attribution-noncommercial-sharealike"), _marks("nc-nd", "noncommercial-noderivatives", "attribution-noncommercial-noderivatives")
_CC4 = {"4.0", "cc-by-4.0", *(w for w in _NC | _ND | _SA | _NCSA | _NCND if w.endswith("-4.0"))}
_OTHER_GNU = {"lesser", "affero", "library", "lgpl", "agpl"}


def _version(v: str) -> set[str]:
    return {v, f"{v}.0", f"v{v}", f"v{v}.0", f"gplv{v}", f"lgplv{v}", f"agplv{v}", f"gpl-{v}.0", f"lgpl-{v}.0", f"agpl-{v}.0"}


# By licence: sets of words, one of each of which must be there, and words that must not.
RULES: dict[str, tuple[list[set[str]], set[str]]] = {
    "Apache-2.0": ([{"apache"}, {"2", "2.0", "v2", "v2.0", "license-2.0", "apache-2.0"}], {"1.0", "1.1"}),
    "MIT": ([{"mit", "obtaining", "sublicense"}], {"organization", "mit-0"}),
    "BSD-3-Clause": ([], {"1-clause", "2-clause", "4-clause", "0bsd", "advertising"}),
    "BSD-2-Clause": ([], {"1-clause", "3-clause", "4-clause", "0bsd", "advertising", "neither", "endorse"}),
    "GPL-2.0": ([_version("2")], _OTHER_GNU),
    "GPL-3.0": ([_version("3")], _OTHER_GNU),
    "LGPL-2.1": ([{"lesser", "lgpl", "library"}, {"2.1", "v2.1", "lgplv2.1", "lgpl-2.1"}], {"affero"}),
    "LGPL-3.0": ([{"lesser", "lgpl", "lgplv3", "lgpl-3.0"}, _version("3")], {"affero"}),
    "AGPL-3.0": ([{"affero", "agpl", "agplv3", "agpl-3.0"}, _version("3")], set()),
    "MPL-2.0": ([{"mozilla", "mpl", "mpl-2.0"}, {"2", "2.0", "v2", "v2.0", "mpl-2.0"}], set()),
    "CC-BY-4.0": ([_CC4], _NC | _ND | _SA | _NCSA | _NCND),
    "CC-BY-SA-4.0": ([_CC4, _SA], _NC | _ND | _NCSA | _NCND),
    "CC-BY-NC-4.0": ([_CC4, _NC], _ND | _SA | _NCSA | _NCND),
    "CC-BY-ND-4.0": ([_CC4, _ND], _NC | _SA | _NCSA | _NCND),
    "CC-BY-NC-SA-4.0": ([_CC4, _NC | _NCSA, _SA | _NCSA], _ND | _NCND),
    "CC-BY-NC-ND-4.0": ([_CC4, _NC | _NCND, _ND | _NCND], _SA | _NCSA),
    "CC0-1.0": ([{"cc0", "zero", "cc0-1.0"}], set()),
    "EPL-1.0": ([{"eclipse", "epl", "epl-1.0"}, {"1.0", "v1.0", "v10", "epl-v10", "epl-1.0"}], {"2.0", "v2.0"}),
    "EPL-2.0": ([{"eclipse", "epl", "epl-2.0"}, {"2.0", "v2.0", "epl-2.0"}], {"1.0", "v1.0"}),
    "BSL-1.0": ([{"boost", "organization"}], set()),
    "Zlib": ([{"zlib", "misrepresented", "as-is"}], set()),
    "Unlicense": ([{"unlicense", "unencumbered"}], set()),
    "WTFPL": ([{"wtfpl", "fuck"}], set()),
    "Artistic-2.0": ([{"artistic"}, {"2.0", "2", "v2.0"}], {"1.0"}),
}
# Words that say nothing of a licence when they stand alone ("mit" is German for "with").
_COMMON = set("a above all along also an and any appear are as at be but by can do each even for form forms from has have if in included including is it its later list may mit more must no nor not of on one or other others out part "
              "person persons see shall should so some such than that the their this to under use used version v was way whether which whom will with you your hope name names what want just do".split())  # fmt: skip
# Possessive groups: matched in a loop, so a chain of any length needs no stack.
_WORD = r"[\p{L}\p{N}]++(?:[.-][\p{L}\p{N}]++)*+"
_PARAGRAPH = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"
_SPDX = r"(?i)SPDX-License-Identifier:[ \t(]*+([A-Z0-9.+-]++(?:[ \t()]++(?:AND|OR|WITH)[ \t(]++[A-Z0-9.+-]++)*+)"
_SPDX_LINE = r"(?i)SPDX-License-Identifier:[^\n]*+"
_COMMENT_LINE = r"^\s*(?:$|#|//|/\*|\*|--|;|%|<!--)"
_COMMENT = r"^\s*(/\*[\s\S]*?\*/|<!--[\s\S]*?-->|\"\"\"[\s\S]*?\"\"\"|\'\'\'[\s\S]*?\'\'\')"
_FILE = r"(?i)^(?:un)?licen[sc]e|^copying|^notice|^copyright|^[\w.]+(?:-[\w.]+)?-licen[sc]e"


def words(text: Column) -> Column:
    """Lowered runs of letters and digits; version numbers and hyphened names stay whole."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_WORD})"), F.lit(1))


def _either(terms: set[str]) -> str:
    """A regular expression for any of ``terms``, by common beginnings."""
    heads: dict[str, set[str]] = {}
    for t in terms - {""}:
        heads.setdefault(t[0], set()).add(t[1:])
    some = "|".join(re.escape(h) + (_either(rest) if rest != {""} else "") for h, rest in sorted(heads.items()))
    return f"(?:{some})" + ("?" if "" in terms else "")


def telling() -> str:
    """Matches texts that hold a telling word of a template, alone or in a hyphened word."""
    terms = {t for _, text in TEMPLATES for t in re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())}
    terms = {t for t in terms if t not in _COMMON and not re.fullmatch(r"[\d.]+", t)} | {"license", "licence", "licensed", "licenced", "licenses", "licences", "licensing", "copyright", "copyrighted", "spdx"}
    return rf"(?i)\b{_either(terms)}\b"


def statements(files: DataFrame) -> DataFrame:
    """(file, line, n): lines with telling words (n: 1), and larger blocks with such words (n: 0, not counted for idf)."""
    speaks = telling()
    some = files.where(F.col("text").rlike(speaks)).withColumn("text", F.regexp_replace("text", _SPDX_LINE, ""))
    lines = F.split("text", r"\n|(?<=[.!?])\s+")
    rows = F.split("text", "\n")
    code = F.array_position(F.transform(rows, lambda r: ~r.rlike(_COMMENT_LINE)), True)
    head = F.array_join(F.when(code > 0, F.slice(rows, 1, F.greatest(code - 1, F.lit(0)).cast("int"))).otherwise(F.array().cast("array<string>")), "\n")
    whole = F.when(F.regexp_extract("path", r"([^/]*)$", 1).rlike(_FILE), F.col("text"))
    blocks = F.concat(F.split("text", _PARAGRAPH), F.array(head, F.regexp_extract("text", _COMMENT, 1), F.coalesce(whole, F.lit(""))))
    # A block of one line is that line.
    blocks = F.filter(F.array_distinct(F.transform(blocks, lambda b: F.trim(b))), lambda b: b.rlike(r"\n|[.!?]\s"))
    as_lines = some.select("file", F.explode(lines).alias("line"), F.lit(1).alias("n"))
    as_blocks = some.select("file", F.explode(blocks).alias("line"), F.lit(0).alias("n"))
    return as_lines.union(as_blocks).where(F.col("line").rlike(speaks)).withColumn("line", F.trim("line"))


def spelt(files: DataFrame) -> DataFrame:
    """(file, license): the identifier or expression of every SPDX line."""
    some = files.where(F.col("text").rlike(_SPDX))
    ids = some.select("file", F.explode(F.regexp_extract_all("text", F.lit(_SPDX), F.lit(1))).alias("license"))
    return ids.select("file", F.regexp_replace(F.regexp_replace("license", r"[()]", ""), r"[ \t]++", " ").alias("license"))


def _templates(spark) -> tuple[DataFrame, DataFrame]:
    """(template, term, tf) and (template, license, must, never) of the fixed table, words as hashes."""
    fixed = spark.createDataFrame([(i, lic, t) for i, (lic, t) in enumerate(TEMPLATES)], "template int, license string, line string")
    known = fixed.select("template", F.explode(words(F.col("line"))).alias("term")).groupBy("template", F.xxhash64("term").alias("term")).agg(F.count(F.lit(1)).alias("tf"))
    rules = [(lic, [sorted(m) for m in RULES.get(lic, ([], set()))[0]], sorted(RULES.get(lic, ([], set()))[1])) for lic in {x for x, _ in TEMPLATES}]
    rules = spark.createDataFrame(rules, "license string, must array<array<string>>, never array<string>")
    code = lambda ws: F.transform(ws, lambda w: F.xxhash64(w))
    return known, fixed.join(rules, "license").select("template", "license", F.transform("must", code).alias("must"), code(F.col("never")).alias("never"))


def unit_licenses(units: DataFrame) -> DataFrame:
    """(unit, license, score) of distinct lines and blocks that come near a template; ``units`` has (unit, copies, terms), the terms as hashes, with repeats."""
    spark = units.sparkSession
    known, rules = _templates(spark)
    n = units.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"] + len(TEMPLATES)
    tf = units.select("unit", "copies", F.explode("terms").alias("term")).groupBy("unit", "copies", "term").agg(F.count(F.lit(1)).alias("tf"))
    tf = written(tf, "terms")
    told = spark.createDataFrame([(w,) for must, never in RULES.values() for w in set().union(never, *must)], "word string").select(F.xxhash64("word").alias("term"), F.lit(0).cast("bigint").alias("df"), F.lit(True).alias("told"))
    of_lines = tf.where("copies > 0").groupBy("term").agg(F.sum("copies").alias("df")).withColumn("told", F.lit(False))
    of_templates = known.groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumn("told", F.lit(True))
    df = of_lines.unionByName(of_templates).unionByName(told).groupBy("term").agg(F.sum("df").alias("df"), F.bool_or("told").alias("told"))
    idf = written(df.select("term", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf"), "told"), "idf")

    b = known.join(idf.where("told"), "term").withColumn("v", F.col("tf") * F.col("idf"))
    size = b.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("size"))
    b = written(b.join(size, "template").select("template", "term", (F.col("v") / F.col("size")).alias("v")), "templates")

    plain = 1 + F.log(F.lit(1.0 + n))  # a word that only uncounted blocks hold
    w = F.col("tf") * F.coalesce("idf", plain)
    of_unit = tf.join(idf, "term", "left").groupBy("unit").agg(
        F.sqrt(F.sum(w * w)).alias("size"), F.collect_list(F.when(F.col("told"), F.struct("term", w.alias("w")))).alias("own"))
    of_unit = written(of_unit, "units")
    weights = of_unit.select("unit", "size", F.inline("own"))
    near = weights.join(F.broadcast(b), "term").groupBy("unit", "template").agg(F.round(F.sum(F.col("w") * F.col("v") / F.col("size")), 6).alias("score")).where(F.col("score") >= ENOUGH)
    near = near.join(F.broadcast(rules), "template").join(of_unit.select("unit", F.col("own.term").alias("has")), "unit")
    near = near.where(F.forall("must", lambda m: F.arrays_overlap(m, F.col("has"))) & ~F.arrays_overlap("never", "has"))
    best = near.groupBy("unit").agg(F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("best"))
    return best.select("unit", F.col("best.license").alias("license"), (-F.col("best.less")).alias("score"))


def own_licenses(files: DataFrame) -> DataFrame:
    """(file, license, score) of files with a statement of their own."""
    terms = F.transform(words(F.col("line")), lambda t: F.xxhash64(t))
    found = statements(files).select("file", F.xxhash64("line").alias("unit"), "n", terms.alias("terms"))
    found = written(found, "statements")
    units = found.groupBy("unit").agg(F.any_value("terms").alias("terms"), F.sum("n").alias("copies"))
    named = found.select("file", "unit").distinct().join(unit_licenses(units), "unit").select("file", "license", "score")
    named = named.unionByName(spelt(files).withColumn("score", F.lit(1.0)))
    best = named.groupBy("file").agg(F.min(F.struct((F.col("license") == _RESERVED).alias("reserved"), (-F.col("score")).alias("less"), "license")).alias("best"))
    return best.select("file", F.col("best.license").alias("license"), (-F.col("best.less")).alias("score"))


def ancestors(folder: Column) -> Column:
    """A directory and all above it, '' last, as (path, depth)."""
    parts = F.filter(F.split(folder, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(F.array_join(F.slice(parts, 1, n), "/").alias("above"), n.alias("depth")))


def folder_of(path: Column) -> Column:
    return F.array_join(F.filter(F.split(F.regexp_replace(path, r"[^/]*$", ""), "/"), lambda p: p != ""), "/")


def scan(files: DataFrame, path: str = "path", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, path, license, score, origin ('own', 'inherited' or 'none') and licence folder of every row of ``files``."""
    f = files.select(*keep, F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    f = f.withColumn("file", F.xxhash64("path", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))))
    own = own_licenses(f)
    rows = f.select(*keep, "path", "file").withColumn("folder", folder_of(F.col("path")))
    rows = rows.join(own, "file", "left")
    is_file = F.regexp_extract("path", r"([^/]*)$", 1).rlike(_FILE)
    spoken = rows.where(is_file & F.col("license").isNotNull()).groupBy(F.col("folder").alias("above")).agg(F.min(F.struct((F.col("license") == _RESERVED).alias("reserved"), (-F.col("score")).alias("less"), "path", "license")).alias("of"))
    spoken = spoken.select("above", F.col("of.license").alias("passed_on"))
    up = rows.where("folder is not null").select("folder").distinct().select("folder", F.inline(ancestors(F.col("folder"))))
    nearest = up.join(spoken, "above").groupBy("folder").agg(F.max(F.struct("depth", "above", "passed_on")).alias("from"))
    out = rows.join(nearest, "folder", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("from").isNotNull(), "inherited").otherwise("none")
    source = F.when(F.col("license").isNull(), F.col("from.above"))
    return out.select(*keep, "path", F.coalesce("license", "from.passed_on").alias("license"), "score", origin.alias("origin"), source.alias("from_folder"))
