"""Scalar text operators as column expressions: JVM functions only, but for the Unicode composition of ``compose``."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Inline and block tags.
INLINE = "span|em|i|b|strong|small|sup|sub|a|u|cite|abbr"
BLOCK = "p|div|h[1-6]|blockquote|li"


def flatten_inline(html: Column) -> Column:
    """Inline tags go without a gap, so that they don't split words."""
    return F.regexp_replace(html, rf"(?i)</?(?:{INLINE})(?:\s[^>]*)?/?>", "")


def mark_blocks(html: Column, mark: str = "\u0001") -> Column:
    return F.regexp_replace(html, rf"(?i)</(?:{BLOCK})\s*>", mark)


def paragraphs(html: Column) -> Column:
    """Clean paragraphs of a page, joined by blank lines."""
    body = F.regexp_replace(html, r"(?is)<(script|style|head)\b.*?</(script|style|head)>|<!--.*?-->", "")
    text = F.regexp_replace(mark_blocks(flatten_inline(body)), r"<[^>]*>", " ")
    parts = F.transform(F.split(normalise(text), "\u0001"), lambda p: F.trim(p))
    return F.array_join(F.filter(parts, lambda p: p != ""), "\n\n")


# Ligatures and their letters; apostrophe-like characters.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
APOSTROPHES = "\u02bb\u2019\u2018\u02bc\u2032\uff07"


@F.pandas_udf(StringType())
def compose(text: pd.Series) -> pd.Series:
    """Unicode composition (NFC), which Spark has no function for."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def normalise(text: Column) -> Column:
    """Composed; ligatures, apostrophes, guillemets and odd spaces become plain; runs of white space become one space."""
    out = compose(text)
    for odd, plain in LIGATURES.items():
        out = F.replace(out, F.lit(odd), F.lit(plain))
    out = F.translate(out, APOSTROPHES + "«»\u00a0\u202f\r\n", "'" * len(APOSTROPHES) + '""' + "    ")
    return F.regexp_replace(out, r"[ \t]{2,}", " ")


def slug(name: Column) -> Column:
    out = F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when((out == "") | out.isNull(), F.lit("unnamed")).otherwise(out)


def fold(text: Column) -> Column:
    """Quotes, dashes, ellipses and white space made plain, lower case."""
    plain = F.translate(text, "’‘“”«»–—", "''\"\"\"\"--")
    return F.lower(F.trim(F.regexp_replace(F.replace(plain, F.lit("…"), F.lit("...")), r"\s+", " ")))


def tokens(text: Column) -> Column:
    """Lower-case words; everything but letters, digits and _ separates."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "), " "), lambda w: w != "")


def sentences(text: Column) -> Column:
    """Split after . ! or ? and white space; blanks go."""
    parts = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), r"(?<=[.!?])\s+")
    return F.filter(parts, lambda s: s != "")


def contains_run(text: Column, phrase: Column) -> Column:
    """Whole-token containment."""
    return F.concat(F.lit(" "), text, F.lit(" ")).contains(F.concat(F.lit(" "), phrase, F.lit(" ")))


def mask_short_quotes(text: Column, words: int = 5) -> Column:
    return F.regexp_replace(text, r'"(?:[^"\s]+\s*){0,%d}"' % words, "QMASK")


def first_number(key: Column) -> Column:
    return F.expr("int(null)") if key is None else F.regexp_extract(key, r"\d+", 0).try_cast("int")


def page_filename(name: Column) -> Column:
    return F.translate(name, " /", "__")


def md_to_wiki(text: Column) -> Column:
    """Headings of four levels, bold and italic; a quoted line becomes an empty one."""

    def inline(s: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(s, r"\*\*(.+?)\*\*", "'''$1'''"), r"\*(.+?)\*", "''$1''")

    def line(s: Column) -> Column:
        out = F.when(s.startswith(">"), F.lit(""))
        for level in (4, 3, 2, 1):
            mark = F.lit("=" * level)
            out = out.when(s.startswith("#" * level + " "), F.concat_ws(" ", mark, inline(F.substr(s, F.lit(level + 2))), mark))
        return out.otherwise(inline(s))

    return F.array_join(F.transform(F.split(text, "\n"), line), "\n")


def wiki_to_text(text: Column) -> Column:
    out = F.regexp_replace(text, r"(?s)<ref[^>]*>.*?</ref>|\[\[(?:Category|File):[^\]]*\]\]|\{\{[^{}]*\}\}", "")
    return F.trim(F.regexp_replace(out, r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1"))


def pack_chunks(text: Column, limit: int) -> Column:
    """Paragraphs (between blank lines) packed until the next one would overflow ``limit``; none is ever split."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def step(acc: Column, p: Column) -> Column:
        over = (acc["now"] != "") & (F.length(acc["now"]) + F.length(p) > limit)
        return (
            F.when(over, F.struct(F.array_append(acc["done"], acc["now"]).alias("done"), p.alias("now")))
            .when(acc["now"] == "", F.struct(acc["done"].alias("done"), p.alias("now")))
            .otherwise(F.struct(acc["done"].alias("done"), F.concat(acc["now"], F.lit("\n\n"), p).alias("now")))
        )

    return F.aggregate(F.split(text, "\n\n"), start, step, lambda acc: F.when(acc["now"] == "", acc["done"]).otherwise(F.array_append(acc["done"], acc["now"])))


def overlap_free(spans: Column) -> Column:
    """Of spans (start, end) the longest first, then the earliest, without overlaps; in text order."""
    ordered = F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct((s["start"] - s["end"]).alias("k"), s["start"].alias("start"), s["end"].alias("end")))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
    )
    kept = F.aggregate(
        ordered,
        F.slice(ordered, 1, 0),
        lambda acc, s: F.when(F.exists(acc, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"])), acc).otherwise(F.array_append(acc, s)),
    )
    return F.array_sort(kept)
