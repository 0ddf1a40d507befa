"""Foldings of names and their comparison keys.

Native expressions come first: letters with marks of the Latin and Vietnamese blocks are folded by ``translate``
with a table made from the Unicode database. Where a name can hold anything at all, the ``*_exact`` functions fold
by the database itself, Arrow batch by Arrow batch.
"""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType


def _latin() -> tuple[str, str]:
    """Letters that are one ASCII letter with marks, and those letters."""
    marked, plain = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            marked.append(chr(code))
            plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _latin()
_MARKS = r"\p{M}+"
# Letters and signs that the foldings treat alike.
HAMZAS, ALIF = "أإآ", "ا"
YA, YA_DOTTED, TA, HA, SHADDA, TATWEEL = "ى", "ي", "ة", "ه", "ّ", "ـ"
HARAKAT = "ًٌٍَُِّْٰ"
EASTERN_DIGITS, WESTERN_DIGITS = "٠١٢٣٤٥٦٧٨٩", "0123456789"


def unmarked(s: Column) -> Column:
    """Without marks, for Latin letters and loose combining marks."""
    return F.regexp_replace(F.translate(s, _MARKED, _PLAIN), _MARKS, "")


def slug(s: Column) -> Column:
    """ASCII, lower case, words joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(unmarked(s)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def loose_latin(s: Column) -> Column:
    """Without marks and capitals, one shape of apostrophe, sharp s as two letters."""
    return F.replace(F.lower(unmarked(F.replace(s, F.lit("’"), F.lit("'")))), F.lit("ß"), F.lit("ss"))


def loose_arabic(s: Column) -> Column:
    """Alifs without hamza."""
    return F.translate(s, HAMZAS, ALIF * 3)


def latin_key(s: Column) -> Column:
    """What two Latin spellings of a name have in common; null if nothing is left."""
    return F.nullif(F.regexp_replace(loose_latin(s), r"[-' ,]", ""), F.lit(""))


def arabic_key(s: Column) -> Column:
    """What two Arabic spellings of a name have in common; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.translate(loose_arabic(s), YA + TA, YA_DOTTED + HA), f"[ ،{SHADDA}]", ""), F.lit(""))


def spelling_key(s: Column) -> Column:
    """Equal for spellings that differ in capitals and the shape of the apostrophe only."""
    return F.replace(F.lower(F.replace(s, F.lit("’"), F.lit("'"))), F.lit("ß"), F.lit("ss"))


def letters_only(s: Column, latin: bool) -> Column:
    return F.regexp_replace(loose_latin(s), "[^a-z]", "") if latin else F.regexp_replace(loose_arabic(s), r"[^\p{L}]", "")


def western_digits(s: Column) -> Column:
    return F.translate(s, EASTERN_DIGITS, WESTERN_DIGITS)


def without_harakat(s: Column) -> Column:
    return F.regexp_replace(s, f"[{HARAKAT}]", "")


def cleaned(s: Column) -> Column:
    """One space between words, no tatweel, one shape of apostrophe."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.replace(s, F.lit("'"), F.lit("’")), TATWEEL, ""), r"\s+", " "))


def cleaned_item(s: Column) -> Column:
    """A name of a table without the dash ahead of it and without tatweel, one space between words."""
    return F.trim(F.regexp_replace(F.replace(F.regexp_replace(s, r"^\s*[-–—]\s*", ""), F.lit("ـ"), F.lit("")), r"\s+", " "))


def cleaned_tail(s: Column) -> Column:
    """A name as it was read, without the marks that a scan leaves behind it."""
    return cleaned(F.regexp_replace(s, r"[\s»«*؛؟()]+$", ""))


def squeezed(s: Column) -> Column:
    return F.regexp_replace(s, r"\s+", "")


def arabic_only(s: Column) -> Column:
    """A line without the Latin letters, digits and marks that a reader has run into it."""
    return F.trim(F.regexp_replace(F.translate(s, "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'’.()|-", " " * 70), r"\s+", " "))


def words(s: Column) -> Column:
    return F.filter(F.split(s, r"\s+"), lambda w: w != "")


def capital_share(s: Column) -> Column:
    """Capitals among the letters; null without letters."""
    kept = F.length(F.regexp_replace(s, r"[^\p{L}]", ""))
    return F.when(kept > 0, F.length(F.regexp_replace(s, r"[^\p{Lu}]", "")) / kept)


def in_capitals(s: Column, share: float = 0.8) -> Column:
    """At least two letters, and so many of them capitals."""
    return F.coalesce((F.length(F.regexp_replace(s, r"[^\p{L}]", "")) >= 2) & (capital_share(s) >= share), F.lit(False))


def split_list(s: Column) -> Column:
    """Names of a running list: commas, semicolons and the two conjunctions part them."""
    return F.filter(F.transform(F.split(s, r",\s*|;\s*|\s+et\s+|\s+و(?=\S)"), lambda x: F.trim(x)), lambda x: x != "")


def zero_padded(s: Column, width: int = 2) -> Column:
    return F.lpad(s.cast("string"), width, "0")


def article_key(s: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(s, r"\s+", " ")))


def mirrored(s: Column) -> Column:
    """Text in display order, right to left, back in reading order: digits stay together, brackets turn."""
    turned = F.translate(F.reverse(s), "()[]«»", ")(][»«")
    runs = F.regexp_extract_all(turned, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike("^[0-9]"), F.reverse(r)).otherwise(r)), "")


def mirrored_exact(s: Column) -> Column:
    """``mirrored`` with the letters' own forms in place of those that print chooses (NFKC), and single spaces."""
    return F.trim(F.regexp_replace(F.replace(nfkc(mirrored(s)), F.lit("ـ"), F.lit("")), r"\s+", " "))


def check_code(read: Column, expected: Column, known_gap: Column) -> Column:
    """How two readings of a name compare: '' equal, 'spaces', 'order' of letters, 'gap' allowed, or 'differs'."""
    bare = lambda c: squeezed(without_harakat(c))
    ordered = lambda c: F.array_sort(F.split(bare(c), ""))
    return (
        F.when(read == expected, "").when(bare(read) == bare(expected), "spaces").when(ordered(read) == ordered(expected), "order").when(known_gap, "gap").otherwise("differs")
    )


def _by_database(form: str, fold):
    @F.pandas_udf(StringType())
    def udf(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else fold(unicodedata.normalize(form, x)))

    return udf


def _bare(x: str) -> str:
    return "".join(c for c in x if not unicodedata.combining(c))


def _hyphened(x: str) -> str:
    return "-".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in _bare(x).lower()).split())


nfc = _by_database("NFC", lambda x: x)
nfkc = _by_database("NFKC", lambda x: x)
unmarked_exact = _by_database("NFKD", _bare)
casefolded = _by_database("NFC", str.casefold)
slug_exact = _by_database("NFKD", _hyphened)
loose_latin_exact = _by_database("NFKD", lambda x: _bare(x.replace("’", "'")).casefold())
capitals_exact = _by_database("NFKD", lambda x: _bare(x).upper())


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching blocks' share of both strings (Ratcliff and Obershelp, as difflib computes it); null if one is null."""
    matcher = difflib.SequenceMatcher()

    def ratio(x, y):
        if x is None or y is None:
            return None
        matcher.set_seqs(x, y)
        return matcher.ratio()

    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def at_least_similar(cutoff: float):
    """Whether the ``similarity`` of two strings reaches ``cutoff``; upper bounds of it are looked at first."""

    @F.pandas_udf(BooleanType())
    def reaches(a: pd.Series, b: pd.Series) -> pd.Series:
        matcher = difflib.SequenceMatcher()

        def one(x, y):
            if x is None or y is None:
                return False
            if x == y:
                return cutoff <= 1
            matcher.set_seqs(x, y)
            return matcher.real_quick_ratio() >= cutoff and matcher.quick_ratio() >= cutoff and matcher.ratio() >= cutoff

        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="bool")

    return reaches
