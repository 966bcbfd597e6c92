"""Licence scan: digests of canonical texts joined with those of known licences and notices."""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import count_up_to, staged

#: The digest of an empty text.
NOTHING = "d41d8cd98f00b204e9800998ecf8427e"
#: Known tables of at most so many rows are broadcast.
BROADCAST_KNOWN = 100_000

# Spellings that count as equal (published licence matching guidelines), fixed values.
EQUIVALENT = [
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"),
    ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("noncommercial", "non-commercial"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https", "http"),
]

# Texts of known licences and notices, fixed values.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
KNOWN = [
    ("MIT", MIT), ("MIT", "MIT License\n\n" + MIT), ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", ISC), ("ISC", "ISC License\n\n" + ISC),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."), ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."), ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."), ("CC0-1.0", "Released under CC0 1.0."),
]


#: Full texts, one file for each id in `license_texts`; where they come from is in README.
TEXTS = files(__package__) / "license_texts"
# Addresses of the Free Software Foundation in printings of its licences, and lines that stand before
# a text or not, fixed values.
ADDRESSES = [
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA", "675 Mass Ave, Cambridge, MA 02139, USA",
]
TITLES = {
    "BSD-2-Clause": ["BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License", "New BSD License", "BSD License"],
    "BSL-1.0": ["Boost Software License"], "Unlicense": ["The Unlicense", "Unlicense"], "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
}
RESERVED = "All rights reserved."


def full_texts() -> list[tuple[str, str]]:
    """(license_id, text) of the texts in `license_texts`, in the forms in which they are handed on."""
    out = []
    for file in sorted(TEXTS.iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        forms = [text]
        head, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        if end:  # the advice on how to apply the terms is no part of them
            forms += [head, head + end]
        if name.startswith(("GPL", "LGPL", "GFDL")):
            given = next((x for x in ADDRESSES if x in " ".join(text.split())), None)
            if given:
                forms = [" ".join(x.split()).replace(given, y) for x in forms for y in ADDRESSES] + forms
        if name.startswith("BSD"):
            bare = text
            for mark in ("1. ", "2. ", "3. "):
                bare = bare.replace("\n" + mark, "\n", 1)
            forms.append(bare)
        if name == "Unlicense":
            forms += [text.replace("https://unlicense.org", "http://unlicense.org/"), text[: text.index("For more information")]]
        forms += [f"{title}\n\n{x}" for title in TITLES.get(name, []) for x in list(forms)]
        if name.startswith("BSD"):
            forms += [f"{title}\n\n{RESERVED}\n\n{x}" for title in ["", *TITLES[name]] for x in (text, bare)]
        out += [(name, x) for x in forms]
    return out + [(i, f"{title}{RESERVED}\n\n{x}") for i, x in (("MIT", MIT), ("ISC", ISC)) for title in ("", f"{i} License\n\n")]


# A line that names who holds the copyright: the word and a year, a mark or an open place, or the word
# and a name. Lines of a licence's own prose begin with such words as well: "copyright notice, this
# list", "COPYRIGHT HOLDERS BE LIABLE", "(c) You must retain".
PROSE = (
    "notices?|holders?|owners?|laws?|licen[cs]es?|licen[cs]ed|statements?|interests?|rights?|protection|in|on|of|or|and|is|are|to|for|as|"
    "treaty|treaties|acts?|disclaimers?|material|status|claims?|infringement|permission|with|that|which|information|works?|terms|"
    "this|these|any|all|patent|trademark|will|may|must|shall|can|does|exists?|only|under|applies"
)
COPYRIGHT = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:"
    r"(?i:copyright|copr|\(c\)|©)[^\n]{0,12}[0-9]{4}"
    r"|©|(?i:copyright|copr\.?)[\x20\t:,]*(?:(?i:\(c\))|©|[<\[{])"
    r"|\((?i:c)\)[\x20\t]*(?:(?i:copyright)|[<\[{])"
    rf"|(?i:copyright|copr\.?)[\x20\t:,]+(?!(?i:{PROSE})\b)\p{{Lu}}"
    r")[^\n]*$"
)
# Whole words, with what may be put before and after them.
BEFORE, AFTER = r"(?<![\p{L}\p{N}])((?:sub|re|un|dis)?)", r"((?:s|d|r|rs|ed|ing|able|ably)?)(?![\p{L}\p{N}])"
SPELLED = BEFORE + f"(?:{'|'.join(given for given, _ in EQUIVALENT)})" + AFTER


def canonical(text: Column) -> Column:
    """Letters and digits of a text in lower case, without copyright lines, in one spelling.

    White space is one space while spellings are replaced, and only whole words are. Texts without
    such a word, which are most, are looked through once instead of once for each spelling.
    """
    out = F.lower(F.regexp_replace(text, COPYRIGHT, ""))
    out = F.regexp_replace(out, r"[\s\x{a0}]+", " ")
    one_spelling = out
    for given, one in EQUIVALENT:
        one_spelling = F.regexp_replace(one_spelling, BEFORE + given + AFTER, f"$1{one}$2")
    out = F.when(out.rlike(SPELLED), one_spelling).otherwise(out)
    return F.regexp_replace(out, r"[^\p{L}\p{N}]+", "")


def digest(text: Column) -> Column:
    """Digest of the canonical text; null for a text that has no letter or digit left."""
    plain = canonical(text)
    return F.when(plain != "", F.md5(plain.cast("binary")))


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN + full_texts(), "license_id string, text string")


def scan_licenses(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, digest, license_id, notices) of each row of `docs`.

    `license_id` names the known licence that the entire text is, else null; `notices` lists, sorted
    and joined by commas, the known licences that single lines of the text are, or is null. `known`
    has license_id and text; of several licences with one digest the smallest id counts, rows with a
    null in either column do not. Null and empty texts match nothing. Other columns are ignored.
    """
    known = known.where("license_id IS NOT NULL").select(digest(F.col("text")).alias("digest"), "license_id")
    known = known.where("digest IS NOT NULL").groupBy("digest").agg(F.min("license_id").alias("license_id"))
    if count_up_to(known, BROADCAST_KNOWN) <= BROADCAST_KNOWN:
        known = F.broadcast(known)
    text = F.col(f"`{text_column}`").cast("string")
    read = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("doc_id"),
        canonical(text).alias("plain"), _line_digests(text).alias("lines"),
    )
    whole = F.when(F.col("plain") != "", F.md5(F.col("plain").cast("binary")))
    read = staged(read.select("row", "doc_id", whole.alias("digest"), "lines"), "licences")
    hits = read.select("row", F.explode("lines").alias("digest")).join(known, "digest")
    notices = hits.groupBy("row").agg(F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("notices"))
    whole = read.drop("lines").join(known, "digest", "left")
    return whole.join(notices, "row", "left").select("doc_id", "digest", "license_id", "notices")


def _line_digests(text: Column) -> Column:
    """Digests of the lines that have a letter or digit. Each line is put into its form once."""
    parts = F.array_distinct(F.split(text, "\n"))
    return F.array_remove(F.transform(parts, lambda x: F.md5(canonical(x).cast("binary"))), NOTHING)
