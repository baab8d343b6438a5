"""Licence scan: canonical digests of whole texts and of their lines, looked up among known licences.

A text is brought to a canonical form (A-Z to lower case, copyright lines removed, all but letters and
digits one blank, equivalent spellings unified), and its digest is joined with those of known licence
texts. The same is done for each of its lines, as most files only carry a notice; a sentence that ends a
copyright line ("Copyright 2020 X. Released under the MIT License.") is looked up like a line.
The known texts pass through the same expressions, so the two sides cannot drift apart; of long licences
only the digests are kept. :func:`known` also takes a folder of licence texts.

Only DataFrame functions are used. Known digests up to BROADCAST_ROWS go to every task; the corpus is
read once, and of it only digests are joined and hits shuffled.

Defined results: null, empty and markless texts have no licence and an empty list. A doc_id that is
repeated is one document, whose lines add up and whose text is that of the largest digest. Further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import read_documents

# Words that count as the same, older or other spelling first.
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("authorise", "authorize"),
    ("authorised", "authorized"),
    ("authorisation", "authorization"),
    ("acknowledgement", "acknowledgment"),
    ("behaviour", "behavior"),
    ("judgement", "judgment"),
    ("fulfil", "fulfill"),
    ("programme", "program"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
]
#: Known digests that are broadcast at most.
BROADCAST_ROWS = 1_000_000

# Known texts, by identifier. Those with "-notice" are the lines that stand for a licence in a file.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies."
)
_ISC_WAIVER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
_BSD_WAIVER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. "
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
    "binary, for any purpose, commercial or non-commercial, and by any means. "
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
    "software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
    "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
    "software under copyright law. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
    "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
    "OR OTHER DEALINGS IN THE SOFTWARE. "
    "For more information, please refer to <https://unlicense.org>"
)
_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
    'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and '
    "to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
    "following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the "
    "following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
    "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language "
    "processor. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE "
    "DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR "
    "IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
    "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must "
    "not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an "
    "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked "
    "as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
    "distribution."
)
KNOWN = [
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License " + _MIT_GRANT),
    ("MIT", "The MIT License (MIT) " + _MIT_GRANT),
    ("ISC", _ISC_GRANT + " " + _ISC_WAIVER),
    ("ISC", "ISC License " + _ISC_GRANT + " " + _ISC_WAIVER),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_WAIVER),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_WAIVER),
    ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_GRANT + _BSD_WAIVER),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES + _BSD_WAIVER),
    ("BSD-3-Clause", "BSD 3-Clause License " + _BSD_GRANT + _BSD_NAMES + _BSD_WAIVER),
    ("Unlicense", _UNLICENSE),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003 " + _BOOST),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License " + _ZLIB),
    ("MIT-notice", "Released under the MIT License."),
    ("MIT-notice", "Licensed under the MIT License."),
    ("MIT-notice", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-notice", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-notice", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-notice", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("CC0-1.0-notice", "SPDX-License-Identifier: CC0-1.0"),
]

# Digests of the canonical forms of long public licences, by identifier, whole files as published.
DIGESTS = {
    "Apache-2.0": "8f86909a6dbf3a124c7a7d11b3aaf31f",
    "Artistic-1.0-Perl": "a8b0fb0c6e43a3b36bdc159e59dbfd1e",
    "CC0-1.0": "93a180096f6cfcf2c0dd24f75c2eec48",
    "GFDL-1.2": "c969fdb4b731dadf7173c1ffbe49a117",
    "GFDL-1.3": "eb6b86c0fad89753a5a36c484fa0ada2",
    "GPL-1.0": "738cc3b112640d95d4cd79a58967ecea",
    "GPL-2.0": "5e39ace6e62f5a7fe9c17b4da986ad8c",
    "GPL-3.0": "5eaa767cc0a56c87c3852144458a3bf1",
    "LGPL-2.0": "74cf7fcef3b29a39165a795b2cad3a3a",
    "LGPL-2.1": "f998bc436710cfece156aaa84fd26dd4",
    "LGPL-3.0": "b31b7335bc37919e8cdd79154e04d88d",
    "MPL-1.1": "9cdb0c94cb45abb55c616e067859d4ad",
    "MPL-2.0": "b5b7a0cf4994910cd0204fba4637d6ec",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks the sentence that ends a copyright line; it isn't part of the whole text.
_TAIL = "\x01"
_COPYRIGHT = r"\n[ \t]*(?:copyright[ \t]*(?:\(c\)|©|[0-9])|(?:\(c\)|©)[ \t]*[0-9]|all[ \t]+rights[ \t]+reserved)(?:[^\n]*\.[ \t]+([^\n]*)|[^\n]*)"
_MARKS = r"[^a-z0-9\n\x01\x{80}-\x{10FFFF}]+"
_TAIL_LINE = r"\n \x01[^\n]*"


def canonical(text: Column) -> Column:
    """Canonical form with the line ends kept; each line has single blanks around every word."""
    low = F.translate(F.concat(F.lit("\n"), text), _UPPER + _TAIL, _LOWER + " ")
    bare = F.regexp_replace(low, _COPYRIGHT, f"\n{_TAIL} $1")
    words = F.regexp_replace(bare, _MARKS, " ")
    spaced = F.concat(F.lit(" "), F.replace(F.replace(words, F.lit("\n"), F.lit(" \n ")), F.lit(" "), F.lit("  ")), F.lit(" "))
    for old, new in SPELLINGS:
        spaced = F.replace(spaced, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return F.regexp_replace(spaced, " +", " ")


def whole(form: Column) -> Column:
    """The canonical form as one line."""
    return F.trim(F.regexp_replace(F.regexp_replace(form, _TAIL_LINE, "\n"), r"[ \n]+", " "))


def line_forms(form: Column) -> Column:
    """The canonical lines, sentences at the end of copyright lines among them."""
    return F.transform(F.split(F.replace(form, F.lit(_TAIL), F.lit("")), "\n"), lambda line: F.trim(line))


def known(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """digest and license_id of every known text, and of the files of ``folder``, each named by its identifier."""
    rows = spark.createDataFrame(KNOWN, "license_id string, text string")
    if folder is not None:
        name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.(txt|md)$", "")
        files = spark.read.format("binaryFile").load(folder).select(name.alias("license_id"), F.decode("content", "UTF-8").alias("text"))
        rows = rows.unionByName(files)
    table = rows.select("license_id", F.md5(whole(canonical(F.col("text")))).alias("digest"))
    if DIGESTS:
        table = table.unionByName(spark.createDataFrame(list(DIGESTS.items()), "license_id string, digest string"))
    return table.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, table: DataFrame) -> DataFrame:
    """doc_id, digest, license_id of the whole text, n_license_lines and their licences, sorted and distinct."""
    forms = docs.select("doc_id", canonical(F.coalesce("text", F.lit(""))).alias("form"))
    units = forms.select(
        "doc_id",
        F.explode(
            F.concat(
                F.array(F.struct(F.lit(True).alias("is_whole"), F.md5(whole(F.col("form"))).alias("digest"))),
                F.transform(line_forms(F.col("form")), lambda line: F.struct(F.lit(False).alias("is_whole"), F.md5(line).alias("digest"))),
            )
        ).alias("u"),
    ).select("doc_id", "u.*")
    few = F.broadcast(table) if table.count() <= BROADCAST_ROWS else table
    found = units.join(few, "digest", "left").where("is_whole or license_id is not null")
    line_id = F.when(~F.col("is_whole"), F.col("license_id"))
    return (
        found.groupBy("doc_id")
        .agg(
            F.max(F.when(F.col("is_whole"), F.struct("digest", "license_id"))).alias("one"),
            F.count(line_id).alias("n_license_lines"),
            F.array_join(F.array_sort(F.collect_set(line_id)), ",").alias("line_licenses"),
        )
        .select("doc_id", "one.digest", "one.license_id", "n_license_lines", "line_licenses")
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_documents(spark, sf_dir), known(spark))


def _sql_form(text: str) -> str:
    out = f"regexp_replace(translate(chr(10) || {text}, '{_UPPER}' || chr(1), '{_LOWER} '), '{_COPYRIGHT}', chr(10) || chr(1) || ' \\1', 'g')"
    out = f"regexp_replace({out}, '{_MARKS}', ' ', 'g')"
    out = f"' ' || replace(replace({out}, chr(10), ' ' || chr(10) || ' '), ' ', '  ') || ' '"
    for old, new in SPELLINGS:
        out = f"replace({out}, ' {old.replace(' ', '  ')} ', ' {new.replace(' ', '  ')} ')"
    return f"regexp_replace({out}, ' +', ' ', 'g')"


def _sql_whole(form: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({form}, '{_TAIL_LINE}', chr(10), 'g'), '[ \n]+', ' ', 'g'))"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


OP3_SQL = rf"""
WITH known AS (
  SELECT digest, min(license_id) AS license_id FROM (
    SELECT md5({_sql_whole(_sql_form("text"))}) AS digest, license_id FROM (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in KNOWN)}) k(license_id, text)
    {"".join(f"UNION ALL SELECT {_quoted(d)}, {_quoted(i)} " for i, d in DIGESTS.items())}
  ) t GROUP BY digest
), f AS (SELECT doc_id, {_sql_form("coalesce(text, '')")} AS form FROM documents),
u AS (
  SELECT doc_id, TRUE AS is_whole, md5({_sql_whole("form")}) AS digest FROM f
  UNION ALL SELECT doc_id, FALSE, md5(trim(unnest(string_split(replace(form, chr(1), ''), chr(10))))) FROM f
)
SELECT doc_id, max(CASE WHEN is_whole THEN u.digest END) AS digest, max(CASE WHEN is_whole THEN license_id END) AS license_id,
  count(CASE WHEN NOT is_whole THEN license_id END) AS n_license_lines,
  coalesce(string_agg(DISTINCT CASE WHEN NOT is_whole THEN license_id END, ',' ORDER BY CASE WHEN NOT is_whole THEN license_id END), '') AS line_licenses
FROM u LEFT JOIN known ON u.digest = known.digest GROUP BY doc_id
"""
