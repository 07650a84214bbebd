"""Licence scans by canonical digest lookup (native expressions only).

A text is brought to a canonical form: lower case, copyright lines removed,
equivalent spellings unified, punctuation and white space reduced to single
blanks.  Its SHA-256 is joined with the digests of known licence texts, as a
whole; each of its lines is looked up in the same way among known notices.

Defined results: a null or empty text, and one whose canonical form is empty,
matches nothing; a text matches only as a whole (a licence inside a longer
text is not a whole match, a notice is a whole line); if two known texts have
one canonical form, the smaller identifier is reported; repeated documents are
reported each; other columns are ignored; an empty table gives no row.
"""
from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small

# --- fixed values: spellings taken as equal (in the order of application) ---
EQUIVALENT = [
    ("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sub licensed", "sublicensed"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("favour", "favor"), ("honour", "honor"), ("judgement", "judgment"), ("merchantibility", "merchantability"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("whilst", "while"), ("owner", "holder"),
    ("percent", "per cent"), ("ver", "version"), ("v2 0", "version 2 0"), ("v3", "version 3"),
]

# --- fixed values: public notices and licence texts ---
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]
TEXTS = [
    ("MIT", """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
]
TERMS_END = "END OF TERMS AND CONDITIONS"


#: Lines that copies of a text have before it or not.
OPENINGS = {"BSD-2-Clause": ["BSD 2-Clause License", "All rights reserved."], "BSD-3-Clause": ["BSD 3-Clause License", "All rights reserved."]}


def _forms(name: str, text: str) -> list[str]:
    """A text as it is handed out: with its line breaks and with one line a
    paragraph (a line break before "copyright" makes a copyright line), each
    also without what follows the terms."""
    whole = re.sub(r"(?<=\S)[^\S\n]*\n(?=[^\S\n]*\S)", " ", text)
    ended = [x[:x.index(TERMS_END) + len(TERMS_END)] for x in (text, whole) if TERMS_END in x]
    forms = [text, whole, *ended]
    for line in reversed(OPENINGS.get(name, [])):
        forms += [f"{line}\n\n{x}" for x in forms]
    return list(dict.fromkeys(forms))


#: Longer texts, one file an identifier.
TEXTS += [(p.stem, form) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt")) for form in _forms(p.stem, p.read_text(encoding="utf-8"))]

COPYRIGHT_LINE = r"(?m)^[^a-z\n]*(copyright|\(c\)|©)[^\n]*$"
NOT_WORD = r"[^a-z0-9]+"


def _blanks(words: str) -> str:
    """Words with two blanks between and one around, so neighbours share none."""
    return " " + words.replace(" ", "  ") + " "


def canonical(text: Column) -> Column:
    """The canonical form: words of a-z and 0-9, each between blanks."""
    body = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    body = F.concat(F.lit(" "), F.trim(F.regexp_replace(body, NOT_WORD, "  ")), F.lit(" "))
    for other, kept in EQUIVALENT:
        body = F.replace(body, F.lit(_blanks(other)), F.lit(_blanks(kept)))
    return body


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form (known texts are never empty, so an empty
    form matches nothing)."""
    return F.sha2(canonical(text), 256)


def known(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    """(license_id, digest) of known texts, one row a digest."""
    rows = spark.createDataFrame(pairs, "license_id string, text string")
    return rows.where(canonical(F.col("text")) != "  ").select("license_id", digest(F.col("text")).alias("digest")).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, texts: DataFrame, notices: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, license_id, notices, n_notice_lines).

    ``license_id`` is the licence that the whole text is, ``notices`` the
    sorted identifiers of notices that are lines of it (';' between).  The
    known tables are broadcast where their counted rows allow it and joined by
    shuffled digest otherwise.  Only digests and doc_ids meet in a join, never
    texts."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"))
    # The whole text's digest is made below the explode, once a document.
    rows = rows.withColumn("whole", digest(F.col("text")))
    lines = rows.select("_row", "doc_id", "whole", F.explode(F.split("text", "\n")).alias("line")).select("_row", "doc_id", "whole", digest(F.col("line")).alias("digest"))
    texts = small(texts.select(F.col("digest").alias("whole"), "license_id"))
    notices = small(notices.select("digest", F.col("license_id").alias("notice")))
    per_row = lines.join(notices, "digest", "left").groupBy("_row", "doc_id", "whole").agg(
        F.array_join(F.array_sort(F.collect_set("notice")), ";").alias("notices"), F.count("notice").alias("n_notice_lines"))
    return per_row.join(texts, "whole", "left").select("doc_id", "license_id", "notices", "n_notice_lines")


def _sql_canonical(text: str) -> str:
    body = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '', 'g')"
    body = f"concat(' ', trim(regexp_replace({body}, '{NOT_WORD}', '  ', 'g')), ' ')"
    for other, kept in EQUIVALENT:
        body = f"replace({body}, '{_blanks(other)}', '{_blanks(kept)}')"
    return body


def oracle() -> str:
    """The same scan over ``documents`` for DuckDB."""
    values = lambda pairs: ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in pairs)
    table = lambda name, pairs: f"{name} AS (SELECT c, min(i) AS i FROM (SELECT i, {_sql_canonical('t')} AS c FROM (VALUES {values(pairs)}) v(i, t)) WHERE c <> '  ' GROUP BY c)"
    return f"""WITH {table('texts', TEXTS)}, {table('notices', NOTICES)},
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
hits AS (SELECT l.doc_id, array_to_string(list_sort(list_distinct(list(n.i))), ';') AS notices, count(*) AS n
         FROM lines l JOIN notices n ON n.c = {_sql_canonical('l.line')} GROUP BY l.doc_id)
SELECT d.doc_id, t.i AS license_id, coalesce(h.notices, '') AS notices, coalesce(h.n, 0)::BIGINT AS n_notice_lines
FROM documents d LEFT JOIN texts t ON t.c = {_sql_canonical("coalesce(d.text, '')")} LEFT JOIN hits h ON h.doc_id = d.doc_id"""
