"""Operators on null keys and values, empty tables, repeated rows and columns named like their own temporaries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadastra.operators import joins, layout, nest, sequence

SHAPE = "k string, o int, v int, _row string, _key string, _at int, _end int, _before int, _run int, _c string, _max int, _side int, _reading string"
ROWS = [("a", 1, 5), ("a", 1, 5), ("a", 2, None), ("a", 3, 4), (None, 1, 7), (None, 2, 6), ("b", None, 1), ("b", 2, 1), ("c", 9, None)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, "x", "y", 1, 1, 1, 1, "z", 1, 1, "r") for r in ROWS], SHAPE)


def found(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows.collect()), key=repr)


def same(a, b):
    assert a == sorted(b, key=repr)


CALLS = {
    "last_wins": lambda f: joins.last_wins(f, ["k"], ["o"]),
    "first_of_each": lambda f: sequence.first_of_each(f, ["k"], ["o"]),
    "as_of": lambda f: joins.as_of(f, f.select("k", "o", "v"), "o", ["k"], ["v"]),
    "until_marker": lambda f: sequence.until_marker(f, ["k"], "o", F.col("v") == 4),
    "rising": lambda f: sequence.rising(f, ["k"], "o", "v"),
    "islands": lambda f: sequence.islands(f, ["k"], "o"),
    "continued": lambda f: sequence.continued(f, ["k"], "o", "_row", F.col("v") > 4),
    "spaced": lambda f: sequence.spaced(f, ["k"], "o", "v", "_c", 1),
    "unanimous": lambda f: sequence.unanimous(f, ["k"], F.col("v")),
    "clustered": lambda f: sequence.clustered(f, ["k"], "o", 2, "first"),
    "overridden": lambda f: joins.overridden(f, f.select("k", F.col("_reading").alias("seen")), ["k"], "_row", "seen"),
    "either_key": lambda f: joins.either_key(f.select("o", "k", "v"), f.select(F.col("o").alias("p"), "k", "v"), "o", "p", [("k", "k"), ("v", "v")]),
    "bands": lambda f: joins.bands(f, ["k"], "o", low=0.0, high=10.0, least=0),
    "sections": lambda f: sequence.sections(f, ["k"], "o"),
    "collected": lambda f: nest.collected(f, ["k"], ["o"], F.col("v"), "vs"),
    "hull": lambda f: layout.hull(f.select("k", F.col("o").alias("x"), F.col("v").alias("y"), F.lit(1).alias("w"), F.lit(1).alias("h")), ["k"]),
}


@pytest.mark.parametrize("name", sorted(CALLS))
def test_empty_tables_and_clashing_names(frame, name):
    assert CALLS[name](frame.limit(0)).count() == 0
    assert CALLS[name](frame).count() > 0


def test_keys_and_orders(frame):
    same(found(CALLS["last_wins"](frame), "k", "o", "v"), [("a", 3, 4), (None, 2, 6), ("b", 2, 1), ("c", 9, None)])
    same(found(CALLS["first_of_each"](frame), "k", "o", "v"), [("a", 1, 5), (None, 1, 7), ("b", None, 1), ("c", 9, None)])


def test_as_of(frame):
    last = {("a", 1): 5, ("a", 2): None, ("a", 3): 4, (None, 1): 7, (None, 2): 6, ("b", None): None, ("b", 2): 1, ("c", 9): None}
    same(found(CALLS["as_of"](frame), "k", "o", "v_as_of"), [(k, o, last[k, o]) for k, o, _ in ROWS])


def test_markers_and_numbers(frame):
    same(found(CALLS["until_marker"](frame), "k", "o"), [("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 2), ("b", None), ("b", 2), ("c", 9)])
    same(found(CALLS["rising"](frame), "k", "o", "v"), [("a", 1, 5), (None, 1, 7), ("b", None, 1)])
    same(found(CALLS["islands"](frame), "k", "first", "last", "size"), [("a", 1, 3, 3), (None, 1, 2, 2), ("b", 2, 2, 1), ("c", 9, 9, 1)])


def test_lines(frame):
    same(found(CALLS["continued"](frame), "k", "entry", "_row"), [("a", 1, "x"), ("a", 2, "x x x"), (None, 1, "x"), (None, 2, "x"), ("b", 0, "x x"), ("c", 0, "x")])
    same(found(CALLS["unanimous"](frame), "k", "agreed"), [("b", 1)])
    same(found(CALLS["clustered"](frame), "k", "o", "cluster"), [("a", 1, 0), ("a", 1, 0), ("a", 2, 0), ("a", 3, 1), (None, 1, 0), (None, 2, 0), ("b", None, None), ("b", 2, 0), ("c", 9, 0)])


def test_joins(frame):
    pairs = {(o, p) for k, o, v in ROWS for m, p, w in ROWS if (k == m and k is not None) or (v == w and v is not None)}
    same(found(CALLS["either_key"](frame), "o", "p"), pairs)
    same(found(CALLS["overridden"](frame), "k", "_row", "check"), [(k, "r" if k else "x", "eye" if k else "") for k, _, _ in ROWS])
    same(found(CALLS["bands"](frame).where("k = 'a'"), "band", "top", "bottom"), [(0, 0.0, 1.0), (2, 1.0, 2.0), (3, 2.0, 3.0), (4, 3.0, 10.0)])
