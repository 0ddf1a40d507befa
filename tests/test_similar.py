from __future__ import annotations

import difflib
import random

import pytest

from cadastra.operators import similar
from cadastra.plans import registry

FOLDER = "/root/testdata/sf0.001"


def ratio(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio()


def texts(rng, n, letters="abcé", most=14):
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, most))) for _ in range(n // 3)]
    out = set(base)
    while len(out) < n:
        w = list(rng.choice(base))
        for _ in range(rng.randrange(1, 3)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randrange(2)] = rng.choice(["", *letters])
        out.add("".join(w))
    return sorted(out)


@pytest.mark.parametrize("cutoff", [0.5, 0.7, 0.85, 0.9, 1.0])
def test_pairs_against_all(spark, cutoff):
    rng = random.Random(int(cutoff * 100))
    a, b = texts(rng, 150), texts(rng, 150)
    b = sorted({*b, *a[:30]})
    frame = lambda ts: spark.createDataFrame([(t, "p") for t in ts], "text string, page string")
    found = {(r.a, r.b): r.score for r in similar.similar_pairs(frame(a), frame(b), ["page"], cutoff).collect()}
    assert found == {(x, y): ratio(x, y) for x in a for y in b if x and y and ratio(x, y) >= cutoff}


def test_few_candidates(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    names = sorted({" ".join(rng.sample(words, 2)) for _ in range(600)})
    frame = spark.createDataFrame([(n, "p") for n in names], "text string, page string")
    pairs = {(r.a, r.b) for r in similar.candidates(frame, frame, ["page"], 0.9).collect()}
    alike = {(a, b) for a in names for b in names if ratio(a, b) >= 0.9}
    assert alike <= pairs and len(pairs) < len(names) ** 2 / 50


def plain_best(left, right, enough):
    """Of each left row (id, page, number, text) the first of the highest ratio, row against row."""
    out = {}
    for i, page, number, text in left:
        best, score = None, 0.0
        for j, other, m, t in sorted(right, key=lambda r: r[0]):
            if page == other and text and t and page is not None:
                r = ratio(text, t)
                if enough(r, number is not None and number == m) and r > score:
                    best, score = j, r
        out[i] = (best, score if best is not None else None)
    return out


def test_tiers_against_all(spark):
    rng = random.Random(3)
    pool = texts(rng, 90, "abcdef", 9)
    make = lambda n, start: [(start + i, rng.choice(["p", "q", None]), rng.choice([1, 2, 3, None]), rng.choice([None, *pool])) for i in range(n)]
    left, right = make(120, 0), make(120, 1000)
    x = spark.createDataFrame(left, "id long, page string, number int, name string")
    y = spark.createDataFrame(right, "id long, page string, number int, other string")
    found = {r.id: (r.r_id, r.score) for r in similar.best_matches(x, y, ["page"], "name", "other", 0.7, number="number", other=0.9).collect()}
    wanted = plain_best(left, right, lambda r, same: r >= 0.9 or (same and r >= 0.7))
    assert {k: (found[k], wanted[k]) for k in wanted if found[k] != wanted[k]} == {} and sum(v[0] is not None for v in wanted.values()) > 20
    assert similar.best_matches(x.limit(0), y, ["page"], "name", "other", 0.7).count() == 0
    assert [r.r_id for r in similar.best_matches(x.limit(3), y.limit(0), ["page"], "name", "other", 0.7).collect()] == [None] * 3


@pytest.mark.parametrize("name", ["similar_names", "numbered_names"])
def test_queries_against_all(spark, name):
    misread, printed = registry._misread(spark, FOLDER)
    left, right = [(r.id, r.p_brand, r.p_size, r.name) for r in misread.collect()], [(r.id, r.p_brand, r.p_size, r.other) for r in printed.collect()]
    enough = (lambda r, same: r >= 0.7) if name == "similar_names" else (lambda r, same: r >= 0.9 or (same and r >= 0.7))
    wanted = plain_best(left, right, enough)
    found = {r.id: (r.r_id, r.score) for r in registry.QUERIES[name](spark, FOLDER).collect()}
    assert found == wanted and len({v for v, _ in wanted.values()}) > 10


def test_the_plan_is_small(spark):
    """Cut texts and best partners are kept between the steps: a single plan of both tiers took more memory than a driver has."""
    frame = registry.QUERIES["numbered_names"](spark, FOLDER)
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 2
