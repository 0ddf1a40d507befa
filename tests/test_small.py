from __future__ import annotations

import json

from pyspark.sql import functions as F

from cadastra.functions import text as T
from cadastra.operators import checks, sequence
from cadastra.sources import readers


def test_grouped_json_and_rules(spark, tmp_path):
    rows = [{"page": 1, "side": "left", "y": 0.5}, {"page": 2, "side": "left", "y": 0.3}, {"page": 1, "side": "left", "y": 0.2}, {"page": 1, "side": "right", "y": None}]
    (tmp_path / "rules.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n\n")
    path = str(tmp_path / "rules.jsonl")
    assert sorted(tuple(r) for r in readers.rules_by_column(spark, path).collect()) == [(1, "left", [0.2, 0.5]), (2, "left", [0.3])]
    found = {r.page: [(x.side, x.y) for x in r.rows] for r in readers.grouped_json(spark, path, "page int, side string, y double", "page").collect()}
    assert found == {1: [("left", 0.5), ("left", 0.2), ("right", None)], 2: [("left", 0.3)]}


def test_new_and_old(spark):
    new, old = readers.new_and_old(spark.createDataFrame([("52 bis 10",), ("52",), (None,), ("7",)], "article string"), "article")
    assert [r.article for r in new.collect()] == ["52 bis 10"] and old.count() == 3


def test_newest_entry(spark):
    text = spark.createDataFrame([("## [1.10.0](x) (2026-02-01)\nb\n## 1.9.0 - 2026-01-01\na",)], "value string")
    assert [(r.version, r.entry) for r in readers.newest_entry(readers.changelog(text)).collect()] == [("1.10.0", "b")]
    assert readers.newest_entry(readers.changelog(text.limit(0))).count() == 0


def test_cleaners(spark):
    frame = spark.createDataFrame([(" –  Aïn  Defla",), ("أد ـرار »؛",), (None,)], "s string")
    assert [r[0] for r in frame.select(T.cleaned_item(F.col("s"))).collect()] == ["Aïn Defla", "أد رار »؛", None]
    assert [r[0] for r in frame.select(T.cleaned_tail(F.col("s"))).collect()][1:] == ["أد رار", None]
    shown = spark.createDataFrame([("(12) ﺏﺍﺏ",)], "s string")  # as a page shows it: forms of print, right to left
    assert shown.select(T.mirrored_exact(F.col("s"))).first()[0] == "باب (12)"


def test_kinds_and_unions(spark):
    frame = spark.createDataFrame([("m", 2), ("x", 1), ("p", 3), ("m", 1), (None, 0)], "kind string, code int")
    assert [tuple(r) for r in sequence.kinds_in_order(frame, "kind", ["p", "d", "m"], ["code"]).collect()] == [("p", 3), ("m", 1), ("m", 2), (None, 0), ("x", 1)]
    assert checks.united([frame, frame.limit(2), frame]).count() == 5


def test_clusters_with_nulls(spark):
    rows = [(None, 1.0), (None, 100.0), (None, 101.0), (1, None), (1, 1.0), (1, 3.0), (1, float("nan")), (1, 500.0), (2, None)]
    for rule in ("first", "mean"):
        found = sequence.clustered(spark.createDataFrame(rows, "page int, y double"), ["page"], "y", 5.0, rule).collect()
        assert sorted(((r.page, repr(r.y), r.cluster) for r in found), key=repr) == sorted([(None, "1.0", 0), (None, "100.0", 1), (None, "101.0", 1), (1, "None", None), (1, "1.0", 0), (1, "3.0", 0), (1, "nan", None), (1, "500.0", 1), (2, "None", None)], key=repr)


def test_markers_by_several_columns(spark):
    rows = [("a", 1, 5, 0), ("a", 1, 9, 1), ("a", 2, 1, 0), ("a", 1, 2, 0), ("b", 1, 1, 0)]
    frame = spark.createDataFrame(rows, "doc string, page int, y int, mark int")
    assert sorted(tuple(r)[:3] for r in sequence.until_marker(frame, ["doc"], ["page", "y"], F.col("mark") == 1).collect()) == [("a", 1, 2), ("a", 1, 5), ("b", 1, 1)]
