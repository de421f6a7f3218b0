"""Licence texts by canonical digest (operator 8), in DataFrame functions only.

A text is made canonical: A-Z lower-cased, lines that start with a copyright notice dropped, everything but letters and
digits turned into single spaces, and equivalent spellings made one. Its SHA-256 is looked up among the digests of known
licences, made canonical the same way: whole texts agree or they don't, there is no nearness. Known are the texts of
KNOWN and the published ones in ``licences/``, with and without usual headings, "All rights reserved", numbers of a short
list, and the appendix that says how to apply the licence. The table of known
licences is a parameter; where it is small Spark sends it to the documents, else both sides are dealt by digest, so a
licence that a third of all documents hold costs its rows once and AQE splits them.

Null text has no digest and no licence. Texts that are empty when made canonical (nothing but a copyright line) match
no licence. If several known licences share a digest, the least name is given. Repeated doc_ids are separate rows. An
empty table gives no rows.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import load

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(?:^|\n)[ \t*#/;]*(?:copyright|\(c\)|©)[^\n]*"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Equivalent spellings, as whole words after lower-casing (fixed values, after the SPDX matching guidelines).
SPELLINGS = {
    "acknowledgment": "acknowledgement", "analog": "analogue", "analyze": "analyse", "artifact": "artefact", "authorization": "authorisation",
    "authorized": "authorised", "caliber": "calibre", "canceled": "cancelled", "capitalizations": "capitalisations", "catalog": "catalogue",
    "categorize": "categorise", "center": "centre", "emphasized": "emphasised", "favor": "favour", "favorite": "favourite", "fulfill": "fulfil",
    "fulfillment": "fulfilment", "initialize": "initialise", "judgment": "judgement", "labeling": "labelling", "labor": "labour", "license": "licence",
    "maximize": "maximise", "modeled": "modelled", "modeling": "modelling", "offense": "offence", "optimize": "optimise", "organization": "organisation",
    "organize": "organise", "practice": "practise", "program": "programme", "realize": "realise", "recognize": "recognise", "signaling": "signalling",
    "utilization": "utilisation", "while": "whilst", "wilfull": "wilful", "noncommercial": "non commercial", "sublicense": "sublicence",
    "https": "http", "owner": "holder", "sub license": "sublicence", "non infringement": "noninfringement", "merchantibility": "merchantability",
}

#: Known licences: short notices and licence texts that are published for general use.
KNOWN = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
}

PUBLISHED = Path(__file__).parent / "licences"
#: Lines that stand above a licence whose text has no heading of its own.
HEADINGS = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "Modified BSD License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
APPENDIX = r"(?i)\n[ \t]*(?:appendix: )?how to apply [^\n]* to your [^\n]*"
END_OF_TERMS = r"\n[ \t]*END OF TERMS AND CONDITIONS"


def licence_texts() -> list[tuple[str, str]]:
    """(name, text) of KNOWN and of the published texts, in the variants in which they are usually found."""
    published = {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8") for f in sorted(PUBLISHED.glob("*.txt"))}
    rows = list(KNOWN.items()) + list(published.items())
    for name, text in list(rows):
        if name in published:
            rows += [(name, re.split(x, text, maxsplit=1)[0]) for x in (APPENDIX, END_OF_TERMS) if re.search(x, text)]
        if name in HEADINGS:
            bodies = {text, re.sub(r"(?<!\S)[123]\. (?=Re|Ne)", "", text)}
            rows += [(name, f"{h}\n{a}\n{b}") for h in ("", *HEADINGS[name]) for a in ("", "All rights reserved.") for b in bodies]
    return rows


def canonical(text: Column) -> Column:
    """The canonical form of a text, words between single spaces; null stays null."""
    low = F.translate(text, UPPER, LOWER)
    # as whole words between two spaces, so that neighbours don't share one
    plain = F.regexp_replace(F.regexp_replace(low, COPYRIGHT_LINE, ""), NOT_WORD, "  ")
    plain = F.concat(F.lit(" "), plain, F.lit(" "))
    for a, b in SPELLINGS.items():
        if a != b:
            plain = F.replace(plain, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(plain, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_licences(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """licence, digest of known texts (name to text); by default licence_texts()."""
    rows = spark.createDataFrame(list(texts.items()) if texts is not None else licence_texts(), "licence string, text string")
    return rows.where(canonical(F.col("text")) != "").groupBy(digest(F.col("text")).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest and the licence (null for none) of every row of docs (doc_id, text)."""
    own = docs.select("doc_id", digest(F.col("text")).alias("digest"))
    return own.join(known, "digest", "left").select("doc_id", "digest", "licence")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(load(spark, sf_dir, "documents"), known_licences(spark))


def _sql() -> str:
    def form(text: str) -> str:
        out = f"' ' || regexp_replace(regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), '{COPYRIGHT_LINE}', '', 'g'), '{NOT_WORD}', '  ', 'g') || ' '"
        for a, b in SPELLINGS.items():
            if a != b:
                out = f"replace({out}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
        return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"

    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in KNOWN.items())
    return f"""
with k as (select min(licence) as licence, sha256({form('text')}) as digest from (values {rows}) as t(licence, text) group by 2),
d as (select doc_id, sha256({form('text')}) as digest from documents)
select doc_id, d.digest, licence from d left join k on d.digest = k.digest"""


ORACLE = _sql()
