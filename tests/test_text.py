from __future__ import annotations

import difflib
import unicodedata

from pyspark.sql import functions as F

from cadastra.functions import text as T

NAMES = ["Aïn Defla", "AIN DEFLA", "M’Sila", "M'Sila", "Bordj-El-Bahri", "Bordj El Bahri", "", None, "Straße", "École, Nº 2", "éàüñç", "áb", "Œuvre", "Ấp Bắc", "--x--"]
ARABIC = ["أفلو", "آفلو", "أم البواقى", "أم البواقي", "قسنطينة", "قسنطينه", "عنّابة", "", None]


def column(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string").select("i", expression(F.col("s")).alias("x"))
    return [r.x for r in sorted(frame.collect(), key=lambda r: r.i)]


def bare(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def test_native_foldings_are_those_of_the_database(spark):
    usual = [n for n in NAMES if n != "École, Nº 2"]
    assert column(spark, usual, T.slug) == column(spark, usual, T.slug_exact)
    assert column(spark, usual, T.loose_latin) == [None if n is None else bare(n.replace("’", "'")).casefold() for n in usual]
    assert column(spark, usual, T.loose_latin) == column(spark, usual, T.loose_latin_exact)
    assert column(spark, NAMES[:1], T.slug) == ["ain-defla"] and column(spark, ["M’Sila"], T.slug) == ["m-sila"]


def test_every_marked_letter(spark):
    letters = [chr(c) for c in range(0xC0, 0x250) if chr(c).isalpha() and bare(chr(c)).isascii() and len(bare(chr(c))) == 1]
    assert column(spark, letters, T.unmarked) == [bare(c) for c in letters]


def test_keys(spark):
    keys = column(spark, NAMES, T.latin_key)
    assert keys[0] == keys[1] == "aindefla" and keys[2] == keys[3] == "msila" and keys[4] == keys[5] and keys[6] is keys[7] is None
    keys = column(spark, ARABIC, T.arabic_key)
    assert keys[0] == keys[1] and keys[2] == keys[3] and keys[4] == keys[5] and keys[6] == "عنابه" and keys[7] is keys[8] is None
    assert column(spark, ["M’SILA", "m'sila", "STRASSE", "straße", "Aïn"], T.spelling_key) == ["m'sila", "m'sila", "strasse", "strasse", "aïn"]


def test_small_functions(spark):
    assert column(spark, ["٢٠٢٦/١"], T.western_digits) == ["2026/1"]
    assert column(spark, ["عَيْن"], T.without_harakat) == ["عين"]
    assert column(spark, [" a ـ  b' "], T.cleaned) == ["a b’"]
    assert column(spark, ["AIN Defla", "AIN DEFLa", "a", "A", "12", None], T.in_capitals) == [False, True, False, False, False, False]
    assert column(spark, ["Adrar, Reggane et Timimoun; Aoulef", "أدرار ورقان"], T.split_list) == [["Adrar", "Reggane", "Timimoun", "Aoulef"], ["أدرار", "رقان"]]
    assert column(spark, ["3", "12"], T.zero_padded) == ["03", "12"]
    assert column(spark, ["(ab) 12"], T.mirrored) == ["12 (ba)"]
    assert column(spark, [" 52  Bis 1 "], T.article_key) == ["52 bis 1"]
    assert column(spark, ["á"], T.nfc) == ["á"] and column(spark, ["ﬁ"], T.nfkc) == ["fi"] and column(spark, ["é"], T.capitals_exact) == ["E"]


def test_check_codes(spark):
    rows = [("ab", "ab"), ("a b", "ab"), ("ba", "ab"), ("ax", "ab")]
    frame = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in frame.select(T.check_code(F.col("a"), F.col("b"), F.lit(False))).collect()] == ["", "spaces", "order", "differs"]
    assert frame.where("a = 'ax'").select(T.check_code(F.col("a"), F.col("b"), F.lit(True))).first()[0] == "gap"


def test_similarity(spark):
    pairs = [("abcd", "bcde"), ("", ""), ("x" * 300 + "ab", "ab" + "x" * 300), (None, "a")]
    frame = spark.createDataFrame(pairs, "a string, b string")
    found = [r[0] for r in frame.select(T.similarity("a", "b")).collect()]
    assert found[:3] == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs[:3]] and found[3] is None
