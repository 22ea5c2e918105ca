"""Licence scan by digests of canonical texts, with DataFrame functions only.

A text is canonical after A-Z are in lower case, lines that are a copyright notice or a licence's title are gone, equivalent
spellings are one, and every run of other characters than letters and digits is a space. Whole documents and
whole lines are looked up by SHA-256 among the known licences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, fold_case

#: Equivalent spellings, applied in this order to lower-case text.
SPELLINGS = (
    ("licence", "license"), ("licenc", "licens"), ("organis", "organiz"), ("authoris", "authoriz"), ("favour", "favor"),
    ("merchantib", "merchantab"), ("non-infring", "noninfring"), ("sub-license", "sublicense"), ("http://", "https://"), ("&", " and "),
)

#: Known statements and licence texts.
KNOWN = (
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""),
)
#: A notice names a year or an owner after the word or sign; a sentence that is wrapped before "copyright" does not.
NOTICE = r"(?m)^[^a-z0-9\n]*(copyright[^a-z0-9\n]*(c\)|©|by |year|yyyy|[0-9])|\(c\)[^a-z0-9\n]*[0-9]|©)[^\n]*$"
TITLE = r"(?m)^[^a-z0-9\n]*((the )?(mit|expat|isc|zlib|(2|3|two|three)-clause bsd|bsd (2|3)-clause)( \"[a-z]+\"| or \"[a-z]+\")? licen[sc]e( \([a-z0-9 -]+\))?|all rights reserved)[^a-z0-9\n]*$"
GAP = r"[^\p{L}\p{N}\n]+"
MOST_KNOWN = 100_000


def canonical(text: Column) -> Column:
    """The canonical form, its lines still apart; null gives an empty text."""
    out = F.regexp_replace(F.regexp_replace(fold_case(F.coalesce(text, F.lit(""))), NOTICE, ""), TITLE, "")
    for variant, usual in SPELLINGS:
        out = F.replace(out, F.lit(variant), F.lit(usual))
    return F.regexp_replace(F.regexp_replace(out, GAP, " "), r"(?m)^ +| +$", "")


def one_line(canon: Column) -> Column:
    return F.btrim(F.regexp_replace(canon, r"\n+", " "), F.lit(" "))


def known_digests(df: DataFrame, known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """digest, license_id and length of the known licences' canonical texts; at most MOST_KNOWN of them."""
    if len(known) > MOST_KNOWN:
        raise ValueError(f"{len(known)} known licences; they are broadcast, so at most {MOST_KNOWN} can be given")
    rows = df.sparkSession.createDataFrame(list(known), "license_id string, text string")
    texts = rows.select("license_id", one_line(canonical(F.col("text"))).alias("_canon"))
    return texts.groupBy(F.sha2("_canon", 256).alias("digest")).agg(F.min("license_id").alias("license_id"), F.max(F.length("_canon")).alias("length"))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """One row per input row: ``key``, text_digest, license_id, n_license_lines and line_licenses.

    license_id is the licence that the whole document is, null if none; line_licenses names those that whole
    lines of it are, sorted and joined by commas, empty if none. Repeated rows give repeated results; null and
    empty texts have the digest of an empty text and no licence. Texts of any length are read whole; other columns are not
    read, whatever their names.
    """
    digests = known_digests(df, known)
    lengths = [r["length"] for r in digests.select("length").distinct().collect()]  # no more than there are known licences
    canon = df.select(F.col(key).alias("_k"), F.monotonically_increasing_id().alias("_row"), canonical(F.col(text)).alias("_c"))
    units = canon.select("_k", "_row", F.posexplode(F.concat(F.array(one_line(F.col("_c"))), F.split("_c", "\n"))).alias("_unit", "_u"))
    digest = F.when((F.col("_unit") == 0) | F.length("_u").isin(lengths), F.sha2("_u", 256))
    looked_up = units.select("_k", "_row", "_unit", digest.alias("_d")).where("_d IS NOT NULL").join(
        F.broadcast(digests.select(F.col("digest").alias("_d"), "license_id").where("digest <> sha2('', 256)")), "_d", "left"
    )
    whole, line = F.col("_unit") == 0, F.col("_unit") > 0
    found = looked_up.groupBy("_k", "_row").agg(
        F.max(F.when(whole, F.col("_d"))).alias("text_digest"), F.max(F.when(whole, F.col("license_id"))).alias("license_id"),
        F.count(F.when(line, F.col("license_id"))).alias("n_license_lines"),
        F.array_join(F.array_sort(F.collect_set(F.when(line, F.col("license_id")))), ",").alias("line_licenses"),
    )
    return found.select(F.col("_k").alias(key), "text_digest", "license_id", "n_license_lines", "line_licenses")


def scan_sql(known: Sequence[tuple[str, str]] = KNOWN) -> str:
    """The scan of ``documents`` in DuckDB's SQL."""

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def canon(column: str) -> str:
        out = f"regexp_replace(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), {quoted(NOTICE)}, '', 'g')"
        out = f"regexp_replace({out}, {quoted(TITLE)}, '', 'g')"
        for variant, usual in SPELLINGS:
            out = f"replace({out}, {quoted(variant)}, {quoted(usual)})"
        return f"regexp_replace(regexp_replace({out}, {quoted(GAP)}, ' ', 'g'), '(?m)^ +| +$', '', 'g')"

    rows = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in known)
    flat = r"trim(regexp_replace(c, '\n+', ' ', 'g'), ' ')"
    return rf"""WITH known AS (SELECT sha256({flat}) AS d, min(i) AS license_id FROM (SELECT i, {canon("t")} AS c FROM (VALUES {rows}) AS v(i, t)) GROUP BY 1),
    docs AS (SELECT doc_id, {canon("text")} AS c FROM documents),
    whole AS (SELECT doc_id, sha256({flat}) AS text_digest FROM docs),
    lines AS (SELECT doc_id, license_id FROM (SELECT doc_id, unnest(string_split(c, chr(10))) AS u FROM docs) JOIN known ON d = sha256(u)),
    per AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS names FROM lines GROUP BY 1)
    SELECT doc_id, text_digest, license_id, coalesce(n, 0) AS n_license_lines, coalesce(names, '') AS line_licenses
    FROM whole LEFT JOIN known ON d = text_digest LEFT JOIN per USING (doc_id)"""
