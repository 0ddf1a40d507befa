from __future__ import annotations

import random
from bisect import bisect_right

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadastra.operators import checks, joins, layout, nest, schema, sequence


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_either_key_and_exactly_one(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, "y"), (4, None, None), (5, "a", "y")], "l int, fr string, ar string")
    right = spark.createDataFrame([(10, "a", "x"), (20, "b", "y"), (30, None, None)], "r int, fr string, ar string")
    keys = [("fr", "fr"), ("ar", "ar")]
    pairs = joins.either_key(left, right, "l", "r", keys)
    assert rows(pairs) == [(1, 10), (2, 20), (3, 20), (5, 10), (5, 20)]
    assert rows(joins.match_counts(left, right, "l", "r", keys)) == [(1, 1, 10), (2, 1, 20), (3, 1, 20), (4, 0, None), (5, 2, None)]
    assert "NestedLoop" not in pairs._jdf.queryExecution().toString() and "Cartesian" not in pairs._jdf.queryExecution().toString()
    for bad in ("l = 4", "l = 5"):
        with pytest.raises(checks.IntegrityError):
            joins.exactly_one(left.where(bad), right, "l", "r", keys, "x")
    assert rows(joins.exactly_one(left.where("l < 4"), right, "l", "r", keys, "x")) == [(1, 10), (2, 20), (3, 20)]
    with pytest.raises(checks.IntegrityError, match="share"):
        joins.bijection(left.where("l IN (2, 3)"), right, "l", "r", keys, "x")
    with pytest.raises(checks.IntegrityError, match="left over"):
        joins.bijection(left.where("l IN (1, 2)"), right, "l", "r", keys, "x")


def test_last_wins_and_overrides(spark):
    moves = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, o int, v string")
    assert rows(joins.last_wins(moves, ["k"], ["o"])) == [("a", 3, "z"), ("b", 1, None)]
    frame = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, name string")
    readings = spark.createDataFrame([("a", "eins"), ("b", ""), ("d", "x")], "k string, seen string")
    assert rows(joins.overridden(frame, readings, ["k"], "name", "seen")) == [("a", "eins", "eye"), ("b", "2", ""), ("c", "3", "")]
    assert ("b", "", "eye") in rows(joins.overridden(frame, readings, ["k"], "name", "seen", blank_counts=True))
    assert [r[0] for r in frame.select(joins.respelled(F.col("name"), {"1": "one"})).collect()] == ["one", "2", "3"]


def test_as_of_and_bands_against_bisect(spark):
    rng = random.Random(1)
    marks = [(p, rng.randrange(100)) for p in range(3) for _ in range(8)]
    places = [(i, rng.randrange(4), rng.randrange(100)) for i in range(200)]
    right = spark.createDataFrame([(p, y, y * 10) for p, y in marks], "page int, y int, v int")
    left = spark.createDataFrame(places, "id int, page int, y int")
    found = {r.id: r.v_as_of for r in joins.as_of(left, right, "y", ["page"], ["v"]).collect()}
    for i, p, y in places:
        ys = sorted(v for q, v in marks if q == p)
        k = bisect_right(ys, y)
        assert found[i] == (ys[k - 1] * 10 if k else None)
    rules = spark.createDataFrame([(1, 0.2), (1, 0.205), (1, 0.6)], "page int, y double")
    cut = joins.bands(rules, ["page"], "y", low=0.0, high=1.0, least=0.012)
    assert [(r.band, r.top, r.bottom) for r in cut.orderBy("top").collect()] == [(0, 0.0, 0.2), (2, 0.205, 0.6), (3, 0.6, 1.0)]
    boxes = spark.createDataFrame([(1, 1, 0.1), (2, 1, 0.2), (3, 1, 0.3), (4, 1, 0.99), (5, 2, 0.5)], "id int, page int, y double")
    assert rows(joins.into_bands(boxes, cut, ["page"], "y").select("id", "band")) == [(1, 0), (2, None), (3, 2), (4, 3), (5, None)]


def test_boxes_and_nearest_against_all_pairs(spark):
    rng = random.Random(2)
    boxes = [(i, i % 2, rng.random(), rng.random(), 0.02 + rng.random() / 5, 0.01 + rng.random() / 8) for i in range(120)]
    frame = spark.createDataFrame(boxes, "id int, page int, x double, y double, w double, h double")
    wanted = []
    for a in boxes:
        for b in boxes:
            dy = min(a[3] + a[5], b[3] + b[5]) - max(a[3], b[3])
            dx = min(a[2] + a[4], b[2] + b[4]) - max(a[2], b[2])
            if a[1] == b[1] and dy > 0.5 * min(a[5], b[5]) and dx > 0.3 * min(a[4], b[4]):
                wanted.append((a[1], a[0], b[0]))
    assert rows(joins.overlapping(frame, frame, ["page"])) == sorted(wanted, key=repr)
    near = [(a[1], a[0], b[0]) for a in boxes for b in boxes if a[1] == b[1] and abs(a[3] - b[3]) < 0.03]
    assert rows(joins.nearest_within(frame, frame, ["page"], "y", 0.03)) == sorted(near, key=repr)
    one = spark.createDataFrame([((0.1, 0.1, 0.1, 0.05), (0.098, 0.1, 0.2, 0.1)), ((0.1, 0.1, 0.3, 0.05), (0.1, 0.1, 0.2, 0.1)), ((0.2, 0.1, 0.3, 0.05), (0.1, 0.1, 0.2, 0.1))], "a struct<x:double,y:double,w:double,h:double>, b struct<x:double,y:double,w:double,h:double>")
    assert [r[0] for r in one.select(joins.within(F.col("a"), F.col("b"))).collect()] == [True, True, False]  # the middle counts, not the sides


def test_positions_and_gaps(spark):
    a = spark.createDataFrame([("w", 2, "B"), ("w", 1, "A")], "k string, o int, fr string")
    b = spark.createDataFrame([("w", 1, "x"), ("w", 5, "y")], "k string, p int, ar string")
    assert rows(joins.positional(a, b, ["k"], ["o"], ["p"]).select("position", "fr", "ar")) == [(1, "A", "x"), (2, "B", "y")]
    with pytest.raises(checks.IntegrityError):
        joins.positional(a, b.limit(1), ["k"], ["o"], ["p"])
    short = spark.createDataFrame([("w", 1, "a"), ("w", 2, "b"), ("w", 3, "c")], "k string, position int, v string")
    gaps = spark.createDataFrame([("w", 2), ("w", 3)], "k string, position int")
    assert rows(joins.with_gaps(short, gaps, ["k"], "position").select("position", "v")) == sorted([(1, "a"), (2, None), (3, None), (4, "b"), (5, "c")], key=repr)


def test_most_similar_and_prefix(spark):
    left = spark.createDataFrame([(1, "p", "Adrar"), (2, "p", "Zzz"), (3, "q", "Adrar")], "id int, page string, name string")
    right = spark.createDataFrame([(9, "p", "Adrrar"), (8, "p", "Adraar"), (7, "q", "x")], "id int, page string, other string")
    found = {r.id: (r.r_id, r.score) for r in joins.most_similar(left, right, ["page"], "name", "other", 0.5).collect()}
    assert found[1][0] == 8 and found[2] == (None, None) and found[3] == (None, None)
    codes = spark.createDataFrame([("12",), ("1",)], "code string")
    entries = spark.createDataFrame([("12 Adrar",), ("12 Aoulef",), ("123 x",)], "line string")
    assert rows(joins.prefixed(codes, entries, "code", "line")) == [("1", None), ("12", "12 Adrar")]


def test_clusters_against_loops(spark):
    rng = random.Random(3)
    values = [(p, round(rng.random() * 3, 4)) for p in range(5) for _ in range(60)]
    frame = spark.createDataFrame(values, "page int, y double").repartition(4)
    for rule in ("first", "mean"):
        wanted = []
        for p in range(5):
            number, group = -1, []
            for y in sorted(v for q, v in values if q == p):
                base = None if not group else group[0] if rule == "first" else sum(group) / len(group)
                if base is None or abs(y - base) >= 0.05:
                    number, group = number + 1, []
                group.append(y)
                wanted.append((p, y, number))
        assert rows(sequence.clustered(frame, ["page"], "y", 0.05, rule)) == sorted(wanted, key=repr)
    assert sequence.clustered(frame.limit(0), ["page"], "y", 0.05, "mean").count() == 0


def test_sequences(spark):
    lines = spark.createDataFrame([("p", 1, "1 Adrar"), ("p", 2, "et Aoulef"), ("p", 3, "2 Chlef"), ("p", 4, "END"), ("p", 5, "3 x")], "page string, n int, text string")
    starts = F.col("text").rlike("^[0-9]")
    assert rows(sequence.continued(lines.where("n < 4"), ["page"], "n", "text", starts)) == [("p", 1, "1 Adrar et Aoulef"), ("p", 2, "2 Chlef")]
    assert rows(sequence.until_marker(lines, ["page"], "n", F.col("text") == "END").select("n")) == [(1,), (2,), (3,)]
    marked = lines.withColumn("mark", F.when(starts, F.col("n")))
    filled = marked.select("n", sequence.filled_forward(marked, ["page"], ["n"], "mark", F.col("text") == "END").alias("m"))
    assert rows(filled) == [(1, 1), (2, 1), (3, 3), (4, None), (5, 5)]
    numbers = spark.createDataFrame([("p", i, v) for i, v in enumerate([1, 9, 2, 2, 3, 7, 4])], "page string, i int, v int")
    assert rows(sequence.rising(numbers, ["page"], "i", "v", F.lit(5)).select("v")) == [(1,), (2,), (3,), (4,)]
    assert rows(sequence.islands(numbers, ["page"], "v")) == [("p", 1, 4, 4), ("p", 7, 7, 1), ("p", 9, 9, 1)]
    chars = spark.createDataFrame([("l", 0.0, 0.01, "a"), ("l", 0.011, 0.01, "b"), ("l", 0.03, 0.01, "c")], "line string, x double, w double, c string")
    assert rows(sequence.spaced(chars, ["line"], "x", "w", "c", 0.003)) == [("l", "ab c")]
    votes = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", "x"), ("c", None), ("d", "q")], "k string, v string")
    assert rows(sequence.unanimous(votes, ["k"], F.col("v"), spark.createDataFrame([("x",)], "v string"))) == [("a", "x")]


def test_alignment(spark):
    left = spark.createDataFrame([("d", 1, 1, "Adrar"), ("d", 2, 2, "Chlef"), ("d", 3, 3, "Batna"), ("e", 1, 1, "x")], "doc string, o int, number int, t string")
    right = spark.createDataFrame([("d", 1, 1, "Adrrar"), ("d", 2, 3, "Batna"), ("d", 3, 2, "Chlef")], "doc string, o int, number int, t string")
    found = rows(sequence.aligned(left, right, ["doc"], "o", "t", cutoff=0.8))
    assert found == [("d", 1, 1), ("d", 2, 3)]
    blanks = left.withColumn("t", F.concat(F.lit(" "), F.col("t"), F.lit("\t ")))
    assert rows(sequence.aligned(blanks, right, ["doc"], "o", "t", cutoff=0.8)) == found
    assert rows(sequence.aligned(left.limit(0), right, ["doc"], "o", "t", cutoff=0.8)) == []


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=14))
def test_longest_chain(pairs):
    best = [()]
    for p in sorted(set(pairs)):
        best += [c + (p,) for c in best if not c or (p[0] > c[-1][0] and p[1] > c[-1][1])]
    most = max(map(len, best))
    assert tuple(sequence.longest_chain(pairs)) == min(c for c in best if len(c) == most)


def test_checks(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert rows(checks.multiset_difference(a, b)) == [(1, "left", 1), (3, "right", 1)]
    with pytest.raises(checks.IntegrityError):
        checks.require_same(a, b, "same")
    with pytest.raises(checks.IntegrityError):
        checks.require_unique(a, ["x"], "unique")
    checks.require_same(a, a, "same")
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "path string, body string")
    new = spark.createDataFrame([("b", "3"), ("c", None), ("d", "4")], "path string, body string")
    assert rows(checks.dataset_difference(old, new, ["path"], "body")) == [("a", "removed"), ("b", "changed"), ("d", "added")]


def test_documents(spark, tmp_path):
    items = spark.createDataFrame([("01", "Adrar", 'a, "b"'), ("01", "Aoulef", None), ("02", "Chlef", "")], "code string, name string, note string")
    docs = nest.csv_documents(items, ["code"], F.concat("code", F.lit("/list.csv")), ["name", "note"], ["name"])
    assert nest.lookup(docs, "/v1/01/list.csv", "/v1").first().body == 'name,note\nAdrar,"a, ""b"""\nAoulef,\n'
    assert nest.lookup(docs, "/nothing").count() == 0
    (tmp_path / "old.csv").write_text("stale")
    assert nest.published(docs, str(tmp_path)) == 2 and (tmp_path / "old.csv").exists()
    assert nest.published(docs, str(tmp_path), wipe=True) == 2 and not (tmp_path / "old.csv").exists()
    asked = spark.createDataFrame([("GET", "/v1/01/list.csv"), ("HEAD", "/v1/01/list.csv"), ("GET", "/v1"), ("GET", "/v1/none"), ("POST", "/v1/01/list.csv"), (None, None), ("GET", "/v1/")], "method string, path string")
    given = nest.answered(asked, docs, base="/v1").collect()
    assert sorted((r.method or "", r.path or "", r.status, r.location, r.body is not None) for r in given) == sorted([("GET", "/v1/01/list.csv", 200, None, True), ("HEAD", "/v1/01/list.csv", 200, None, False), ("GET", "/v1", 302, "/v1/", False), ("GET", "/v1/none", 404, None, False), ("POST", "/v1/01/list.csv", 405, None, False), ("", "", 405, None, False), ("GET", "/v1/", 404, None, False)])
    assert nest.published(docs, str(tmp_path)) == 2 and (tmp_path / "02/list.csv").read_text() == "name,note\nChlef,\n"
    shown = items.select(nest.json_object({"name": F.col("name"), "note": F.col("note")}, {"by": nest.cite(F.lit("t"), F.lit("1"), F.lit(""))}).alias("j")).where("name = 'Aoulef'")
    assert shown.first().j == '{"name":"Aoulef","note":null,"by":{"text":"t","article":"1"}}'
    parents = spark.createDataFrame([("01",), ("16",)], "c string")
    nested = {r.c: [x.name for x in r.items] for r in nest.with_children(parents, items, "c", "code", ["name"], F.struct("name"), "items").collect()}
    assert nested == {"01": ["Adrar", "Aoulef"], "16": []}
    assert rows(nest.counted(parents, items, "c", "code", "n")) == [("01", 2), ("16", 0)]


def test_layout(spark):
    bitmaps = spark.createDataFrame([(1, ["#..#", ".#..", "...#", "...#"]), (2, []), (3, None)], "id long, rows array<string>")
    assert rows(layout.components(bitmaps)) == [(1, 0, 2, 0, 0, 2, 2), (1, 1, 1, 3, 0, 1, 1), (1, 2, 2, 3, 2, 1, 2)]
    assert rows(layout.profile(bitmaps)) == [(1, 0, 4), (1, 1, 1), (1, 2, 1), (1, 3, 1)]
    stem = spark.createDataFrame([(1, ["..###.."] * 30), (2, ["#######"] * 5)], "id long, rows array<string>")
    assert {r.id: r.stem for r in layout.stem_like(layout.profile(stem)).collect()} == {1: 3.0, 2: None}
    boxes = spark.createDataFrame([(1, 0.05, 0.4), (1, 0.54, 0.4), (1, 0.0, 1.0)], "page int, x double, w double")
    assert layout.gutter(boxes, ["page"]).first().gutter == 0.495
    assert layout.gutter(boxes.limit(0), ["page"]).count() == 0
    # the run nearest the centre, not the widest, and edges don't cover
    apart = spark.createDataFrame([(1, 0.0, 0.495), (1, 0.505, 0.045)], "page int, x double, w double")
    assert layout.gutter(apart, ["page"]).first().gutter == 0.5
    first = spark.createDataFrame([(1, 1, 0.1, 0.1, 0.2, 0.02, "Adrar")], "page int, id int, x double, y double, w double, h double, text string")
    second = spark.createDataFrame([(1, 2, 0.1, 0.1, 0.2, 0.02, "Adrer"), (1, 3, 0.1, 0.5, 0.2, 0.02, "Chlef")], first.schema)
    assert rows(layout.merged_passes([first, second], ["page"], False).select("text", "alt")) == [("Adrar", ["Adrer"]), ("Chlef", [])]
    tall = spark.createDataFrame([(1, 1, 0.1, 0.1, 0.2, 0.05, "two lines"), (1, 5, 0.6, 0.1, 0.2, 0.05, "kept")], first.schema)
    parts = spark.createDataFrame([(1, 2, 0.1, 0.1, 0.19, 0.02, "two"), (1, 3, 0.1, 0.13, 0.19, 0.02, "lines"), (1, 4, 0.1, 0.4, 0.2, 0.02, "Çİ·O"), (1, 6, 0.6, 0.11, 0.1, 0.02, "one")], first.schema)
    assert rows(layout.merged_passes([tall, parts], ["page"], False).select("text", "alt")) == [("kept", ["one"]), ("lines", []), ("two", [])]
    lines = spark.createDataFrame([(1, 0.05), (1, 0.3), (1, 0.7)], "page int, y double")
    starts = spark.createDataFrame([(1, 0.1, "a"), (1, 0.6, "b")], "page int, y double, entry string")
    assert rows(layout.owners(lines, starts, ["page"], "y")) == [(1, 0.05, "a"), (1, 0.3, "a"), (1, 0.7, "b")]
    texts = spark.createDataFrame([("Adrar", 0.01), ("A", 0.01), ("أدرار", 0.01), ("Adrar", 0.001), ("Çİ·O", 0.01), ("Œu 3", 0.01)], "t string, h double")
    assert [r[0] for r in texts.select(layout.plausible(F.col("t"), F.col("h"), False)).collect()] == [True, False, False, False, False, True]
    assert [r[0] for r in texts.select(layout.plausible(F.col("t"), F.col("h"), True)).collect()] == [False, False, True, False, False, False]


def test_schemas(spark):
    names = {"name": {"type": "object", "required": ["fr"], "additionalProperties": False, "properties": {"fr": {"type": "string", "minLength": 1}, "code": {"type": ["string", "null"], "pattern": "^[0-9]{2}$"}}}}
    names |= {"list": schema.array_of("name"), "unused": {"type": "string"}}
    root = schema.with_definitions(names, {"type": "object", "properties": {"items": {"$ref": "#/$defs/list"}}, "additionalProperties": {"type": "integer", "minimum": 1}})
    assert sorted(root["$defs"]) == ["list", "name"]
    check = lambda v: schema.violations(v, root, names)
    assert check({"items": [{"fr": "x", "code": None}], "n": 1}) == []
    assert len(check({"items": [{"fr": "", "code": "1"}, {"x": 1}], "n": 0})) == 5
    docs = spark.createDataFrame([("a", "list", '[{"fr":"x"}]'), ("b", "list", "[{}]"), ("c", "other", "1")], "path string, kind string, body string")
    assert rows(schema.invalid(docs, {"list": names["list"]}, names)) == [("b", "$[0]: lacks fr")]
    described = schema.openapi("t", "1.0.0", {"/list.json": "list", "/list/{code}.json": "name"}, names)
    assert described["components"]["schemas"]["list"]["items"]["$ref"] == "#/components/schemas/name"
    assert schema.edges_of(names) == [("list", "name")]
    frame = spark.createDataFrame([(n,) for n in (1, 48, 49, 50)], "n int")
    assert [r[0] for r in frame.select(schema.article_of(F.col("n"))).collect()] == ["5", "52", "52 bis", "52 bis 1"]


@pytest.mark.parametrize("apart", [True, False])
def test_either_key_counts_against_all_pairs(spark, apart):
    rng = random.Random(9)
    rows = lambda n: [(rng.randrange(60) if rng.random() < 0.3 else 100 + i, rng.choice([None, "p", "q", "r"]), rng.choice([None, 1, 2, 3, 4])) for i in range(n)]
    left, right = rows(60), rows(60)
    right += left[:20]
    pairs = {(i, j) for i, a, c in left for j, b, d in right if (a is not None and a == b) or (c is not None and c == d)}
    wanted = {}
    for i, j in pairs:
        if not (apart and i == j):
            wanted.setdefault(i, set()).add(j)
    frame = lambda r, name: spark.createDataFrame(r, f"{name} long, fr string, ar int")
    out = joins.either_key_counts(frame(left, "a_id"), frame(right, "b_id"), "a_id", "b_id", [("fr", "fr"), ("ar", "ar")], apart=apart).collect()
    assert len(out) == len(wanted) and {r.a_id: (r.matches, r.least) for r in out} == {i: (len(v), min(v)) for i, v in wanted.items()}


def test_large_groups_make_no_pairs(spark):
    """30,000 rows of one key have 900 million pairs."""
    side = lambda name: spark.range(30_000).select(F.col("id").alias(name), F.lit("k").alias("fr"), (F.col("id") % 2).alias("ar"))
    out = joins.either_key_counts(side("a_id"), side("b_id"), "a_id", "b_id", [("fr", "fr"), ("ar", "ar")], apart=True)
    assert [tuple(r) for r in out.groupBy("matches", "least").count().orderBy("least").collect()] == [(29_999, 0, 29_999), (29_999, 1, 1)]
