"""License scan by canonical digests, in DataFrame functions alone.

A text is made canonical: A-Z in lower case, copyright lines ("Copyright (c) 2020 ...", with or without comment
signs) dropped, punctuation and white space runs to one space, equivalent spellings to one, lines joined.  The
digest of the whole canonical text is joined to the digests of the known licenses, so a document that is a
license text is found however it was wrapped, signed or spelt.  Each line is canonical by itself as well:
lines that are a known one-line notice ("Released under the MIT License.") are listed for every document.

The scan is one narrow pass; the known texts are a parameter (``TEXTS``: the usual licenses, each with and without its
title and appendix), and their digests are broadcast only while there are at most ``BROADCAST`` of them.

Defined results: null, empty or wordless text has an empty canonical text, no license and no notice; repeated
rows are scanned one by one; two known texts with one digest give the first name in order; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_texts import WHOLE

BROADCAST = 10_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Signs outside ASCII that count as white space or punctuation.
_SIGNS = "\r\u0085\u00a0\u00ab\u00bb\u2010\u2011\u2012\u2013\u2014\u2018\u2019\u201c\u201d\u2022\u2026\u2028\u2029\u3000\ufeff"
_COPYRIGHT = r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|\x{a9})[ \t]*(\(c\)|\x{a9}|by |[<\[{]|[0-9]{4})[^\n]*"
_SEPARATOR = r"[^a-z0-9\n\x{80}-\x{10FFFF}]+"
#: Equivalent spellings, applied in this order.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"), ("https", "http"), ("whilst", "while"),
    ("copyright owner", "copyright holder"), ("acknowledgement", "acknowledgment"), ("judgement", "judgment"), ("favour", "favor"), ("behaviour", "behavior"),
    ("organis", "organiz"), ("authoris", "authoriz"), ("recognis", "recogniz"), ("utilis", "utiliz"), ("artefact", "artifact"), ("catalogue", "catalog"), ("programme", "program"), ("centre", "center"),
)
RESERVED = "all rights reserved"

_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so"
)
_MIT = (
    f"{_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
    "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
#: Where the body of a long text begins after its title, and where its appendix for users begins.
_BODY = {
    "Apache-2.0": "TERMS AND CONDITIONS FOR USE", "GPL-1.0": "Preamble", "GPL-2.0": "Preamble", "GPL-3.0": "Preamble", "LGPL-2.0": "Preamble", "LGPL-2.1": "Preamble", "LGPL-3.0": "This version of the GNU Lesser",
    "MPL-1.1": "1. Definitions", "MPL-2.0": "1. Definitions", "CC0-1.0": "CC0 1.0 Universal", "Artistic-1.0": "Preamble", "GFDL-1.2": "0. PREAMBLE", "GFDL-1.3": "0. PREAMBLE",
}
_APPENDIX = re.compile(r"^[ \t]*(?:APPENDIX: How to|Appendix: How to|How to Apply These Terms|ADDENDUM: How to|EXHIBIT A -|Exhibit A - Source)", re.M)
_END = "END OF TERMS AND CONDITIONS"
_ADDRESS = re.compile(r"51 Franklin St(?:reet)?, Fifth Floor, Boston,? MA\s+02110-1301")


def _long(name: str) -> list[tuple[str, str]]:
    """A long text as it is met: with and without its title and its appendix, by the publisher's two addresses and its site."""
    text, body = WHOLE[name], WHOLE[name].find(_BODY.get(name, "\0"))
    cuts = [text]
    if m := _APPENDIX.search(text):
        cuts.append(text[: m.start()].rstrip())
        if cuts[-1].endswith(_END):
            cuts.append(cuts[-1].removesuffix(_END))
    found = cuts + [c[body:] for c in cuts if body > 0]
    found += [_ADDRESS.sub("59 Temple Place, Suite 330, Boston, MA 02111-1307", x) for x in found]
    found += [re.sub(_ADDRESS.pattern + r"\s+USA", "<https://fsf.org/>", x, count=1) for x in cuts[1:]]
    return [(name, x) for x in dict.fromkeys(found)]


_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_ENDORSE = "may be used to endorse or promote products derived from this software without specific prior written permission."
_DISCLAIMED = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _bsd() -> list[tuple[str, str]]:
    """The BSD texts: by title, with numbers or other marks before the conditions, and by whom the third condition names."""
    out = []
    for name, n in (("BSD-2-Clause", 2), ("BSD-3-Clause", 3)):
        titles = ("", f"BSD {n}-Clause License\n\n", f"The BSD {n}-Clause License\n\n", f"The {n}-Clause BSD License\n\n", "BSD License\n\n", *(("New BSD License\n\n",) if n == 3 else ("Simplified BSD License\n\n",)))
        names = ("the name of the copyright holder nor the names of its contributors", "the names of the copyright holders nor the names of its contributors", "the name of the University nor the names of its contributors") if n == 3 else ("",)
        for title in titles:
            for who in names:
                conditions = [_SOURCE, _BINARY, f"Neither {who} {_ENDORSE}"][:n]
                for mark in ("{}.", "*"):
                    listed = "\n".join(f"{mark.format(k)} {c}" for k, c in enumerate(conditions, 1))
                    out.append((name, f"{title}Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n{listed}\n\n{_DISCLAIMED}"))
    return out


#: Known license texts, name and text; a name may have several.
TEXTS = (
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "The MIT License\n\n" + _MIT),
    ("MIT", _MIT),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _AS_IS),
    *_bsd(),
    *(pair for name in WHOLE for pair in _long(name)),
    ("Zlib", "zlib License\n\n" + WHOLE["Zlib"]),
    ("Zlib", "The zlib License\n\n" + WHOLE["Zlib"]),
    ("Unlicense", "The Unlicense\n\n" + WHOLE["Unlicense"]),
)
#: Names that an SPDX line may give.
SPDX = (
    "0BSD", "AFL-3.0", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Apache-2.0 OR MIT", "Artistic-1.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT OR Apache-2.0", "MIT-0",
    "MPL-1.1", "MPL-2.0", "MS-PL", "OFL-1.1", "PSF-2.0", "PostgreSQL", "Unlicense", "WTFPL", "Zlib",
)
#: Known one-line notices.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("reserved", "All rights reserved."),
    # lines of the usual headers that name one license and version by themselves
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MPL-2.0", "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "file, You can obtain one at https://www.mozilla.org/MPL/2.0/."),
    *((name, f"SPDX-License-Identifier: {name}") for name in SPDX),
)


def canonical_lines(text):
    """The canonical lines of a text column, empty ones left out."""
    t = F.translate(F.coalesce(text, F.lit("")), _UPPER + _SIGNS, _UPPER.lower() + " " * len(_SIGNS))
    t = F.regexp_replace(F.regexp_replace(t, _COPYRIGHT, ""), _SEPARATOR, " ")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def canonical(lines):
    """The canonical text of canonical lines; lines that only reserve all rights go with the copyright lines."""
    return F.array_join(F.filter(lines, lambda x: x != RESERVED), " ")


def _listed(spark, known: Sequence[tuple[str, str]]) -> DataFrame:
    """``license`` and ``lines`` of each known text, without a Python source in the plan."""
    rows = F.array(*(F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in known))
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.license", canonical_lines(F.col("r.text")).alias("lines"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", texts: Sequence[tuple[str, str]] = TEXTS, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """``doc_id``, ``digest``, ``license`` (null where the text is none), ``notices`` (names, in order, joined by a comma), ``n_notices`` of each row."""
    spark = docs.sparkSession
    # the texts themselves stay out of the query: only their digests are in its plan
    digests = _listed(spark, texts).select(F.sha2(canonical("lines"), 256).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license")).collect() if texts else []
    rows = F.array(*(F.struct(F.lit(r.digest).alias("digest"), F.lit(r.license).alias("license")) for r in digests)) if digests else F.lit(None).cast("array<struct<digest:string,license:string>>")
    known = spark.range(1).select(F.explode(rows).alias("r")).select("r.digest", "r.license")
    if len(texts) <= BROADCAST:
        known = F.broadcast(known)
    # the notices' canonical lines are a literal map: their number is the parameter's
    of_line: Mapping[str, str] = {}
    if notices:
        for r in sorted(_listed(spark, notices).select("license", F.array_join("lines", " ").alias("line")).collect(), reverse=True):
            of_line = {**of_line, r.line: r.license}
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), canonical_lines(F.col(text).cast("string")).alias("lines"))
    digest = F.sha2(canonical("lines"), 256)
    if of_line:
        table = F.create_map(*(F.lit(x) for pair in of_line.items() for x in pair))
        found = F.transform(F.filter("lines", lambda x: x.isin(list(of_line))), lambda x: F.element_at(table, x))
    else:
        found = F.array().cast("array<string>")
    rows = rows.select("doc_id", digest.alias("digest"), found.alias("found"))
    return rows.join(known, "digest", "left").select("doc_id", "digest", "license", F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"), F.size("found").cast("long").alias("n_notices"))


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _sql() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def lines(column: str) -> str:
        t = f"translate(coalesce({column}, ''), {quoted(_UPPER + _SIGNS)}, {quoted(_UPPER.lower() + ' ' * len(_SIGNS))})"
        t = f"regexp_replace(regexp_replace({t}, {quoted(_COPYRIGHT)}, '', 'g'), {quoted(_SEPARATOR)}, ' ', 'g')"
        for a, b in SPELLINGS:
            t = f"replace({t}, {quoted(a)}, {quoted(b)})"
        return f"list_filter(list_transform(string_split({t}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"

    whole = f"array_to_string(list_filter(lines, lambda x: x <> '{RESERVED}'), ' ')"
    values = lambda known: ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in known)
    return f"""
WITH known AS (
  SELECT sha256({whole}) AS digest, min(license) AS license
  FROM (SELECT license, {lines("text")} AS lines FROM (VALUES {values(TEXTS)}) v(license, text)) GROUP BY 1
), notice AS (
  SELECT line, min(license) AS name FROM (SELECT license, array_to_string({lines("text")}, ' ') AS line FROM (VALUES {values(NOTICES)}) v(license, text)) GROUP BY 1
), docs AS (
  SELECT doc_id, {lines("text")} AS lines, row_number() OVER () AS row FROM documents
), found AS (
  SELECT row, string_agg(DISTINCT name, ',' ORDER BY name) AS notices, count(*) AS n_notices
  FROM (SELECT row, unnest(lines) AS line FROM docs) JOIN notice USING (line) GROUP BY row
)
SELECT doc_id, digest, license, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM (SELECT doc_id, row, sha256({whole}) AS digest FROM docs) d LEFT JOIN known USING (digest) LEFT JOIN found USING (row)
"""


OP7_SQL = _sql()
