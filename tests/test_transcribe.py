from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadastra.operators import transcribe as T
from cadastra.operators.checks import IntegrityError


def characters(spark, lines):
    rows, i = [], 0
    for page, y, parts in lines:
        for x, text in parts:
            for k, c in enumerate(text):
                if c != " ":
                    rows.append((page, i, x + k * 0.01, y + (i % 3) * 0.001, 0.01, 0.01, c))
                    i += 1
    return spark.createDataFrame(rows + rows[:1], "page int, i int, x double, y double, w double, h double, c string").withColumn("doc", F.lit("d"))


CODES = {"by": ["doc"], "furniture": "suite|Commune", "foot": 0.9, "line": 0.006, "gap": 0.003}


def test_code_rows(spark):
    lines = [(1, 0.1, [(0.1, "Wilaya"), (0.4, "1")]), (1, 0.2, [(0.1, "AIN DEFLA"), (0.5, "0101"), (0.7, "أب")]), (1, 0.3, [(0.1, "suite"), (0.5, "0109")]), (2, 0.1, [(0.1, "B"), (0.5, "0102"), (0.7, "ج")]), (2, 0.95, [(0.1, "foot"), (0.5, "9999")])]
    found = [(r.code, r.fr, r.ar) for r in T.code_rows(characters(spark, lines), **CODES).orderBy("code").collect()]
    assert found == [("0101", "AIN DEFLA", "بأ"), ("0102", "B", "ج")]
    with pytest.raises(IntegrityError, match="another province"):
        T.code_rows(characters(spark, [*lines, (3, 0.1, [(0.5, "0201")])]), **CODES)
    with pytest.raises(IntegrityError, match="twice"):
        T.code_rows(characters(spark, [*lines, (3, 0.1, [(0.5, "0101")])]), **CODES)


def test_numbered_items(spark):
    frame = spark.createDataFrame([("a", "1. Laghouat ; 2 Ksar El Hirane ; x ; 12. Hadj Mechri. Art. 3")], "article string, body string")
    items = T.numbered_items(frame, "body")
    assert [(r.number, r.name) for r in items.collect()] == [(1, "Laghouat"), (2, "Ksar El Hirane"), (12, "Hadj Mechri")]
    more = ["1. A ; 2. B. ; 3. C", "1 A ; 2 Bir El Arch » . 3 C", "10. X;11 Y 2 ;", None, "", "1. A ; 222. B ; 3. ; 4 D.E ; 5 F"]
    found = T.numbered_items(spark.createDataFrame(list(enumerate(more)), "k int, body string"), "body")
    assert sorted((r.k, r.number, r.name) for r in found.collect()) == [(0, 1, "A"), (0, 2, "B"), (1, 1, "A"), (1, 2, "Bir El Arch »"), (2, 10, "X"), (2, 11, "Y 2"), (5, 1, "A"), (5, 4, "D.E"), (5, 5, "F")]
    lists = spark.createDataFrame([("a", 3), ("b", 0), ("c", 1)], "article string, announced int")
    assert [tuple(r) for r in T.incomplete(items, lists, ["article"]).orderBy("article").collect()] == [("a", 3, 3), ("c", 1, 0)]


def test_reconciled(spark):
    lists = spark.createDataFrame([("d", 1, 5), ("d", 2, 1)], "doc string, list int, announced int")
    read = spark.createDataFrame([("d", 1, 0, 1, "أدرار"), ("d", 1, 1, 2, "ت امست"), ("d", 1, 2, 4, "x"), ("d", 2, 3, 1, "z")], "doc string, list int, place int, number int, name string")
    exact = spark.createDataFrame([("d", 0, 1, "أدرار"), ("d", 1, 2, "تامست"), ("d", 2, 3, "فنوغيل"), ("d", 3, 4, "y")], "doc string, place int, number int, name string")
    pairs = spark.createDataFrame([("d", 0, 0), ("d", 1, 1), ("d", 2, 3)], "doc string, l_order int, r_order int")
    rows = lambda **o: [(r.list, r.number, r.name, r.check) for r in T.reconciled(lists, read, exact, pairs, **o).orderBy("list", "number").collect()]
    assert rows() == [(1, 1, "أدرار", ""), (1, 2, "تامست", ""), (1, 3, "فنوغيل", "pdf"), (1, 4, "y", "differs"), (1, 5, "", "missing"), (2, 1, "z", "ocr")]
    assert rows(keep_spaces=False)[1] == (1, 2, "تامست", "spaces")


def test_small(spark):
    frame = spark.createDataFrame([(["Aïn", "Defla"], ["AIN-DEFLA", "x"]), ([], ["x"]), (["a"], []), (["a"], ["b"])], "seat array<string>, members array<string>")
    assert [r[0] for r in frame.select(T.doubt(F.col("seat"), F.col("members"), True)).collect()] == [None, "no seat", "no members", "the seat is not the first member"]
    checks = spark.createDataFrame([(["", "eye"],), (["eye", "ocr"],), ([""],)], "c array<string>")
    assert [r[0] for r in checks.select(T.worst_check(F.col("c"))).collect()] == ["eye", "ocr", ""]
    ids = spark.createDataFrame([("law-26-06", "52 bis 10", "5/seat", "ar")], "a string, b string, c string, d string")
    assert ids.select(T.reading_id(*map(F.col, "abcd"))).first()[0] == "law-26-06-52-bis-10-5-seat-ar"
    words = spark.createDataFrame([("أفلو",), ("باب ارا",), ("إدا",)], "s string")
    assert [r[0] for r in words.select(T.standing_alifs(F.col("s"))).collect()] == [["أ"], ["ا", "ا"], ["إ", "ا"]]
    titles = spark.createDataFrame([("feat: x",), ("docs: x",), ("docs!: x",), ("fix(api): y",), ("nothing",), ("feat:x",)], "t string")
    assert [r[0] for r in titles.select(T.releases(F.col("t"))).collect()] == [True, False, True, True, False, False]
    rows = spark.createDataFrame([("p", 1), ("p", 2), ("p", 3)], "page string, n int")
    assert [(r.before, r.after) for r in T.neighbourhoods(rows, ["page"], "n", "n").orderBy("n").collect()] == [(None, 2), (1, 3), (2, None)]
