from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from cadastra.functions import text as T
from cadastra.operators import lists

LAW = [
    "JOURNAL OFFICIEL N° 3",
    "Art. 2. — Les dispositions de l'article 5 sont modifiées :",
    "« Art. 7. — Les trois (3)",
    "communes suivantes constituent une wilaya : 1. Laghouat ; 2. Ksar El",
    "Hirane ; 3. Hadj Mechri. »",
    None,
    "« Art. 52 bis 10. — Les deux (2) communes suivantes constituent une wilaya : 1 A ; 2. B.",
    "Art. 3. — L'intitulé du chapitre 4 ; 9. Nobody.",
    "Art. 34 Bis. — La wilaya de X est constituée des une (1) communes suivantes : 1. Seule.",
    "Art. 9. — La présente loi.",
]


def test_latin_lists(spark):
    rows = [("a", k, t) for k, t in enumerate(LAW)] + [("b", 0, "Art. 1. — Nothing is listed."), ("c", 0, None)]
    found, items = lists.latin_lists(spark.createDataFrame(rows, "doc string, place int, text string"), ["doc"], noise="^JOURNAL")
    assert sorted(tuple(r) for r in found.collect()) == [("a", 0, "7", "2", 3), ("a", 1, "52 bis 10", "2", 2), ("a", 2, "34 bis", "3", 1)]
    assert sorted(tuple(r) for r in items.collect()) == [("a", 0, 1, "Laghouat"), ("a", 0, 2, "Ksar El Hirane"), ("a", 0, 3, "Hadj Mechri"), ("a", 1, 1, "A"), ("a", 1, 2, "B"), ("a", 2, 1, "Seule")]


def test_arabic_lists(spark):
    lines = [
        "1. قبل", "المادة 52 مكرر 10 : تتشكل ولاية من", "الاثنتي عشرة (3) بلدية الآتية:", "1. أدرار،", "كلام", "3- تامست.", "2. فنوغيل", "4. زائد", "المادّة 8 : شيء آخر", "1. لا أحد",
        "المادة 9 : تتشكل ولاية من البلديتين", "1. سابق", "الاثنتين (2) الآتيتين:", "2. لاحق", "المادة 7 : تتشكل ولاية من بلدية (1) الآتية", "1 - عين",
    ]
    frame = spark.createDataFrame([("d", k, t) for k, t in enumerate(lines)] + [("d", 99, None), ("e", 0, "1. x")], "doc string, place int, text string")
    found, items, dropped = lists.arabic_lists(frame, ["doc"])
    assert sorted((r.article, r.announced) for r in found.collect()) == [("52 bis 10", 3), ("7", 1)]
    assert sorted((r.place, r.number, r.name) for r in items.collect()) == [(3, 1, "أدرار"), (5, 3, "تامست"), (15, 1, "عين")]
    assert sorted((r.place, r.number) for r in dropped.collect()) == [(6, 2), (7, 4)]


def plain_arabic(lines):
    """A reader that goes from line to line and remembers where it is."""
    out, head, current, last = [], None, None, 0
    for place, text in lines:
        item = re.match(lists.ARABIC.item, text)
        if re.match(lists.ARABIC.article, text):
            head, current = text, None
        elif head is not None and not item:
            head += " " + text
        if head is not None and not item and (m := re.search(lists.ARABIC.header, head)):
            current, last, head = (place, int(m[2])), 0, None
        elif item:
            head = None
            if current and last < int(item[1]) <= current[1]:
                last = int(item[1])
                out.append((place, last, item[2].strip()))
    return out


def test_arabic_lists_against_a_reader(spark):
    rng = random.Random(12)
    pieces = ["المادة 5 : تتشكل ولاية من كذا (4) بلدية", "المادة 6 مكرر : تتشكل ولاية", "من كذا (3) بلدية الآتية", "المادة 7 : لا شيء", "كلام"]
    docs = {d: [(k, rng.choice([*pieces, *(f"{rng.randrange(1, 6)}. اسم {'ا' * rng.randrange(1, 4)}" for _ in range(8))])) for k in range(60)] for d in range(25)}
    frame = spark.createDataFrame([(d, k, t) for d, ls in docs.items() for k, t in ls], "doc int, place int, text string")
    _, items, _ = lists.arabic_lists(frame, ["doc"])
    wanted = sorted((d, *i) for d, ls in docs.items() for i in plain_arabic(ls))
    assert sorted((r.doc, r.place, r.number, r.name) for r in items.collect()) == wanted and len(wanted) > 60


def test_two_readings(spark):
    starts, entry = r"^\d* ?- wilaya", r"wilaya de (.+?) avec chef-lieu (.+)$"
    one = ["1 - wilaya de Adrar avec", "chef-lieu Adrar »", "2 - wilaya de Chlef avec chef-lieu El Asnam", "- wilaya gone", "4 - wilaya de X avec chef-lieu Y"]
    two = ["1 - wilaya de Adrar avec chef-lieu  Adrar", "wilaya", "2 - wilaya de Chlef avec chef-lieu ElAsnam", "3 - wilaya de Z avec chef-lieu W", "4 - wilaya de X avec chef-lieu V", "- wilaya de N avec chef-lieu M"]
    read = lambda lines: lists.read_entries(spark.createDataFrame([("d", k, t) for k, t in enumerate(lines)], "doc string, place int, text string"), ["doc"], starts=starts, entry=entry)
    rows = {r.entry: (r.name, r.seat, r.source, r.check) for r in lists.merged_readings(read(one), read([t for t in two if t != "wilaya"]), ["doc"]).collect()}
    assert rows == {1: ("Adrar", "Adrar", "both", ""), 2: ("Chlef", "El Asnam", "1", "spaces"), 3: ("Z", "W", "2", "differs"), 4: ("X", "Y", "1", "differs"), 5: ("N", "M", "2", "single")}


def test_worklist(spark):
    rows = [("d", 1, k, c, y, 0.01) for k, (c, y) in enumerate([("", 0.1), ("ocr", 0.115), ("missing", None), ("", 0.14), ("spaces", 0.5), ("odd", 0.9)])] + [("d", 2, 0, "missing", None, None), ("e", 1, 0, None, 0.1, 0.1)]
    found = {(r.page, r.place): r for r in lists.worklist(spark.createDataFrame(rows, "doc string, page int, place int, check string, y double, h double"), ["doc", "page"], "place").collect()}
    assert [k for k, _ in sorted(found.items(), key=lambda kv: kv[1]["rank"])] == [(1, 2), (2, 0), (1, 1), (1, 4), (1, 5)]
    near = lambda key: tuple(None if v is None else round(v, 6) for v in (found[key].top, found[key].bottom))
    assert near((1, 1)) == (0.09, 0.147) and near((1, 2)) == (0.105, 0.16) and near((1, 4)) == (0.49, 0.52) and near((1, 5)) == (0.89, 0.932) and found[2, 0].tier == 0


def test_readings_of_rows(spark):
    rng = random.Random(3)
    rows = [(p, i, rng.random()) for p in range(3) for i in range(20)]
    lines = [(p, 100 + i, rng.random(), rng.choice([0.1, 0.5, rng.random()]), rng.choice(["", None, f"t{i}"])) for p in range(4) for i in range(60)]
    found = lists.row_readings(spark.createDataFrame([(p, p * 100 + i, y) for p, i, y in rows], "page int, id int, at double"), spark.createDataFrame([(p, p * 1000 + i, y, x, t) for p, i, y, x, t in lines], "page int, id int, at double, x double, text string"), ["page"], 0.02)
    wanted = {}
    for p, i, y in rows:
        near = sorted((-x, p * 1000 + j, t) for q, j, at, x, t in lines if q == p and t and abs(at - y) < 0.02)
        if near:
            wanted[p * 100 + i] = " ".join(t for _, _, t in near)
    assert {r.id: r.reading for r in found.collect()} == wanted


def test_small_texts(spark):
    frame = spark.createDataFrame([("12 أدرار-Adrar (x) تامست",), ("A, B ; C et D",), (None,)], "s string")
    assert [r[0] for r in frame.select(T.arabic_only(F.col("s"))).collect()][0] == "أدرار تامست"
    assert [r[0] for r in frame.select(T.split_list(F.col("s"))).collect()][1] == ["A", "B", "C", "D"]


def test_a_piece_has_its_own_header_alone(spark):
    """All headers of a text beside each of its pieces grew with the square of the text."""
    lines = spark.createDataFrame([("d", i, f"Art. {i + 1}. — Les quelques ({i % 3 + 1}) communes suivantes constituent une wilaya : 1. name ;") for i in range(40)], "doc string, place int, text string")
    heads, items = lists.latin_lists(lines, ["doc"])
    assert [(r.list, r.article, r.announced) for r in heads.orderBy("list").collect()] == [(i, str(i + 1), i % 3 + 1) for i in range(40)]
    above = heads._jdf.queryExecution().optimizedPlan().toString().split("Generate posexplode")[0]
    assert "heads#" not in above and items.count() == 40
