"""Licence scans by canonical digest lookup.

A text is brought to a canonical form: case, punctuation, white space,
copyright lines and spellings that count as equal are normalised away.  The
digest of the whole canonical text is looked up among the digests of known
licences.  A document that carries a notice among other things is met line by
line: each line is a text of its own, looked up the same way.

A table of known digests of a checked size is broadcast, so texts are not moved.
A larger one is joined by hash with ids and digests alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .stages import read_table, staged

# Spellings that count as equal (after SPDX's matching guidelines), left made right.
EQUAL = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("behaviour", "behavior"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("copyright holder", "copyright owner"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("licence", "license"),
    ("noncommercial", "non commercial"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("sub license", "sublicense"),
    ("whilst", "while"),
    ("wilful", "willful"),
)

# Parts that two licences share.
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Known texts and one-line notices, public, by SPDX id.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This file is licensed under the GNU General Public License, version 3 or later."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "MIT License\n"
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_TWO + _BSD_END),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_TWO + _BSD_NAMES + _BSD_END),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n"
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. "
        "If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n"
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Boost Software License - Version 1.0 - August 17th, 2003\n"
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") "
        "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\n"
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, "
        "and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. '
        "IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\n"
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n"
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
        "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n"
        "For more information, please refer to <https://unlicense.org/>",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n'
        "http://www.apache.org/licenses/LICENSE-2.0\n"
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
)
#: The same text under the other titles in use.
KNOWN += tuple(("MIT", f"{title}\n{body}") for title in ("The MIT License (MIT)", "The MIT License") for i, body in KNOWN if i == "MIT" and body.startswith("Permission"))
#: Rows of known digests that are broadcast (some 10 MB), and known lines that become part of the plan.
BROADCAST_ROWS, PLAN_LINES = 100_000, 64
#: A line of copyright: the word or a sign at its start, and a sign, a year, "by" or a slot for a name right after it.  Other lines that begin with the word stay.
COPYRIGHT = r"(?m)^[^\na-z0-9©(]*(?:(?:copyright|©|\(c\))[ :,]*(?:©|\(c\)|[0-9]{4}|by |<|\[)|©|\(c\))[^\n]*$"


def spelled(t: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), EQUAL, t)


def bare_lines(text: Column) -> Column:
    """Lower case, copyright lines and punctuation dropped; single blanks within a line, none at its ends."""
    t = F.regexp_replace(F.lower(text), COPYRIGHT, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", " "), r" ?\n ?", "\n"))


def canonical(text: Column) -> Column:
    """The whole text as one line, equal spellings made one."""
    return spelled(F.trim(F.regexp_replace(bare_lines(text), r"\s+", " ")))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] | DataFrame = KNOWN) -> DataFrame:
    """(digest, license_id, line, size), one row a digest: the least id names texts that two licences share.

    ``line``: whether a text of one line has it; ``size``: the length of its canonical form.
    """
    table = known if isinstance(known, DataFrame) else spark.createDataFrame([*known], "license_id string, text string")
    told = table.where(F.col("text").isNotNull()).select("license_id", canonical(F.col("text")).alias("plain"), (~F.contains(F.trim("text"), F.lit("\n"))).alias("line"))
    return told.where(F.length("plain") > 0).groupBy(F.sha2("plain", 256).alias("digest")).agg(F.min("license_id").alias("license_id"), F.max("line").alias("line"), F.max(F.length("plain")).alias("size"))


def scan(docs: DataFrame, known: tuple[tuple[str, str], ...] | DataFrame = KNOWN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, digest of the whole canonical text, license_id (null: unknown) and the licences that its lines name (line_licenses, comma-joined, "" for none).

    ``known``: (license_id, text) of known texts; those of one line are looked up line by line too.

    Cases: null and empty texts, and texts of punctuation and copyright lines
    only, have the digest of the empty text and no licence.  Repeated rows each
    get a row.  Texts may be of any length.  A known text that is null or empty
    is left out.  Other columns are not read, whatever their names; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    table = staged(known_digests(spark, known), "known-licences")
    n, n_lines = table.count(), table.where("line").count()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = docs.select(F.col(id_col).alias("__id"), bare_lines(text).alias("__bare"))
    lines = F.split(spelled(F.col("__bare")), "\n")
    whole = spelled(F.trim(F.regexp_replace("__bare", r"\s+", " ")))
    if n_lines <= PLAN_LINES:
        rows = table.where("line").collect()  # bounded by PLAN_LINES
        sizes, names = sorted({r["size"] for r in rows}), F.create_map(*[F.lit(x) for r in sorted(rows) for x in (r["digest"], r["license_id"])]) if rows else None
        hit = F.transform(F.filter(lines, lambda x: F.length(x).isin(*sizes)), lambda x: F.try_element_at(names, F.sha2(x, 256))) if rows else F.array().cast("array<string>")
        told = bare.select("__id", F.sha2(whole, 256).alias("digest"), F.array_join(F.array_sort(F.array_distinct(F.filter(hit, lambda x: x.isNotNull()))), ",").alias("line_licenses"))
    else:  # digests of lines, joined by row
        marked = staged(bare.select("__id", F.sha2(whole, 256).alias("digest"), F.array_distinct(F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.sha2(x, 256))).alias("lines"), F.monotonically_increasing_id().alias("__row")), "licence-lines")
        wanted = table.where("line").select(F.col("digest").alias("of"), "license_id")
        found = marked.select("__row", F.explode("lines").alias("of")).join(F.broadcast(wanted) if n_lines <= BROADCAST_ROWS else wanted, "of").groupBy("__row").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("line_licenses"))
        told = marked.drop("lines").join(found, "__row", "left").select("__id", "digest", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"))
    table = table.select("digest", "license_id")
    if n <= BROADCAST_ROWS:
        out = told.join(F.broadcast(table), "digest", "left")
    else:  # empty texts, which may be many, have nothing to find
        none = F.col("digest") == F.sha2(F.lit(""), 256)
        out = told.where(~none).join(table, "digest", "left").unionByName(told.where(none).withColumn("license_id", F.lit(None).cast("string")))
    return out.select(F.col("__id").alias(id_col), "digest", "license_id", "line_licenses")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def _spelled_sql(t: str) -> str:
    for a, b in EQUAL:
        t = f"replace({t}, '{a}', '{b}')"
    return t


def _bare_sql(x: str) -> str:
    t = f"regexp_replace(lower({x}), '{COPYRIGHT}', ' ', 'g')"
    return f"trim(regexp_replace(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}\n]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'))"


def _whole_sql(bare: str) -> str:
    return f"sha256({_spelled_sql(f"trim(regexp_replace({bare}, '[ \n]+', ' ', 'g'))")})"


_VALUES = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
_LINES = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN if "\n" not in t)
ORACLE = f"""
WITH k AS (SELECT {_whole_sql(_bare_sql("t"))} AS digest, min(i) AS license_id FROM (VALUES {_VALUES}) v(i, t) GROUP BY 1),
n AS (SELECT {_whole_sql(_bare_sql("t"))} AS digest, min(i) AS license_id FROM (VALUES {_LINES}) v(i, t) GROUP BY 1),
d AS MATERIALIZED (SELECT row_number() OVER () AS row_id, doc_id, {_bare_sql("coalesce(text, '')")} AS bare FROM documents),
l AS (SELECT row_id, unnest(string_split({_spelled_sql("bare")}, chr(10))) AS line FROM d),
m AS (SELECT row_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS line_licenses
      FROM (SELECT row_id, sha256(line) AS digest FROM l) x JOIN n USING (digest) GROUP BY row_id)
SELECT doc_id, digest, license_id, coalesce(line_licenses, '') AS line_licenses
FROM (SELECT row_id, doc_id, {_whole_sql("bare")} AS digest FROM d) x LEFT JOIN k USING (digest) LEFT JOIN m USING (row_id)
"""
