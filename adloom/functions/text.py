"""Scalar text functions as Column expressions; none needs Python at run time.

Null in gives null out unless a function says otherwise. Spellings are folded
by a translation table generated from Unicode decompositions, so patterns run
on plain ASCII and read the same in any regex dialect.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: runs of white space of any kind
SPACE = r"[\s\p{Z}]+"


def _tables() -> tuple[str, str]:
    """Letters with one-letter decompositions, and their base letters."""
    src, dst = [], []
    for code in range(0x80, min(sys.maxunicode, 0x1FFFF)):
        ch = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    marks = [chr(c) for c in range(0x300, 0x370) if unicodedata.combining(chr(c))]
    return "".join(src + marks), "".join(dst)


_SRC, _DST = _tables()


def clean(x: Column) -> Column:
    """Runs of white space to one blank, trimmed; null and "nan" give ''."""
    t = F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), SPACE, " "))
    return F.when(F.lower(t) == "nan", F.lit("")).otherwise(t)


def missing(x: Column) -> Column:
    """Whether a value says nothing: null, blank, or a word for nothing."""
    return F.lower(clean(x)).isin("", "n/a", "na", "none", "null", "nan")


def strip_accents(x: Column) -> Column:
    return F.translate(x, _SRC, _DST)


def fold(x: Column) -> Column:
    """Lower case without accents; marks stay."""
    return F.replace(strip_accents(F.lower(clean(x))), F.lit("ß"), F.lit("ss"))


def normalise(x: Column, keep: str = "+#") -> Column:
    """Folded words parted by single blanks: "&" reads "and", characters other
    than letters, digits and ``keep`` part words."""
    spelled = F.replace(fold(x), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(spelled, f"[^a-z0-9{keep}]+", " "))


def title_key(x: Column) -> Column:
    """Key under which spellings of one title meet: case and blanks don't count."""
    return F.lower(clean(x))


def first_nonempty(*xs: Column) -> Column:
    """First value that isn't blank, else ''."""
    return F.coalesce(*(F.when(clean(x) != "", clean(x)) for x in xs), F.lit(""))


def join_unique(xs: Column, sep: str) -> Column:
    """Non-blank items in order, each once."""
    return F.array_join(F.array_distinct(F.filter(F.transform(xs, clean), lambda v: v != "")), sep)


def split_multi(x: Column, marks: str = r"[|;]") -> Column:
    """Trimmed non-blank items of a delimited text."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), marks), lambda v: F.trim(v)), lambda v: v != "")


def labels(pairs: list[tuple[Column, str]]) -> Column:
    """Array of the labels whose condition holds, in the given order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(v)) for c, v in pairs)))


def snippet(x: Column, start: Column, length: Column, around: int = 115) -> Column:
    """Text around a match, with "…" where it was cut; '' without a match."""
    size = F.length(x)
    a, b = F.greatest(start - around, F.lit(1)), F.least(start + length + around - 1, size)
    body = F.regexp_replace(F.substring(x, a, b - a + 1), r"^[ ,.;:\-]+|[ ,.;:\-]+$", "")
    return F.when(start > 0, F.concat(F.when(a > 1, "…").otherwise(""), body, F.when(b < size, "…").otherwise(""))).otherwise("")


def field_evidence(name: str, x: Column, most: int = 300) -> Column:
    """"Name: text", capped; '' for a blank text."""
    t = clean(x)
    whole = F.concat(F.lit(f"{name}: "), t)
    return F.when(t == "", "").when(F.length(whole) > most, F.concat(F.substring(whole, 1, most - 1), F.lit("…"))).otherwise(whole)


def truncate(x: Column, most: int) -> Column:
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most - 1), F.lit("…"))).otherwise(x)


def leading_number(x: Column) -> Column:
    """First number of a text as a double, comma or point as decimal mark."""
    return F.regexp_extract(F.replace(x, F.lit(","), F.lit(".")), r"-?\d+(?:\.\d+)?", 0).try_cast("double")


def selected_grade(x: Column) -> Column:
    """"1" or "2" of a grade written as number or "1 - words"; else null."""
    t = clean(x)
    number = t.try_cast("double")
    return F.when(number.isin(1.0, 2.0), F.format_string("%.0f", number)).when(t.rlike(r"^[12] -"), F.substring(t, 1, 1))


def percent(x: Column) -> Column:
    """Confidence with two decimals."""
    return F.format_string("%.2f", x)


def meaningful(x: Column, letters: int = 30, words: int = 6) -> Column:
    """Whether a text is long enough to be a description."""
    return (F.length(F.regexp_replace(x, r"[^\p{L}]", "")) >= letters) & (F.regexp_count(x, F.lit(r"[\p{L}\p{N}]+")) >= words)


def cut_title(x: Column, company: Column, marks: str = r"\s[|–·]\s") -> Column:
    """A page title without the company in front and the site's tail."""
    t = clean(x)
    rest = F.when((clean(company) != "") & F.lower(t).startswith(F.concat(F.lower(clean(company)), F.lit(" "))), F.substring(t, F.length(clean(company)) + 1, F.length(t))).otherwise(t)
    return F.trim(F.regexp_replace(F.regexp_replace(rest, f"{marks}.*$", ""), r"^[\s#:–\-]+", ""))


def html_text(x: Column) -> Column:
    """Visible text of markup: no scripts and styles, a line per block."""
    t = F.regexp_replace(x, r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</?(?:p|li|div|h[1-6]|ul|ol|tr|table|section|article)\b[^>]*>", "\n")
    t = F.regexp_replace(t, r"<[a-zA-Z/!][^<>]*>", "")
    for mark, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(mark), F.lit(ch))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"[^\S\n]+", " "), r" ?\n[ \n]*", "\n"), r"^\s+|\s+$", "")
