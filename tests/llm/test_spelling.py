from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from cadastra.llm import queries, spelling


def one_edit(a: str, b: str) -> bool:
    """Whether b is a with one code point replaced, or one of the two is the other without one."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, least_length=6, least_count=5, times=5):
    """All of ``variants`` by comparing every word with every other."""
    n = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}
    near = {a: [b for b in n if one_edit(a, b)] for a in n}
    best = {a: min(bs, key=lambda b: (-n[b], b)) for a, bs in near.items() if bs}
    form = {a: b for a, b in best.items() if n[b] >= times * n[a]}

    def root(a):
        return root(form[a]) if a in form else a

    return {(a, form.get(a), root(a), n[a], len(near[a]), n.get(form.get(a))) for a in n}


def found(frame):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


@pytest.mark.parametrize("most", [0, 3, spelling.MOST_PAIRS])
def test_pairs_against_all(spark, most):
    rng = random.Random(most)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(700)}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    rows = [(r.a, r.b) for r in spelling.near_pairs(frame, most_pairs=most).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_variants_against_all(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeèÿÀ") for _ in range(rng.randrange(5, 10))) for _ in range(60)]
    rows = []
    for i in range(400):
        text = []
        for _ in range(40):
            w = rng.choice(base[: 1 + int(60 * rng.random() ** 2)])
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + "b" + w[k:], w[:k] + "c" + w[k + 1 :]])
            text.append(rng.choice([w, w.upper(), w.title()]))
        rows.append((rng.choice([i, i, i, None, 7]), rng.choice([" ", ",", "1", "\n", "Ω"]).join(text)))
    rows += [(9, "qwertyq " * 6), (9, "qwertya " * 40), (9, "qwerbya " * 250)]  # a chain: the first and the last are two edits apart
    rows += [(1, None), (2, ""), (3, "a" * 50_000 + " " + "wörter " * 9), (3, "a" * 50_000 + " " + "wörter " * 9)]
    frame = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, Word string")
    wanted = plain(rows)
    assert any(r[1] and r[2] != r[1] for r in wanted) and any(r[1] is None and r[4] for r in wanted)
    assert found(spelling.variants(frame)) == wanted
    assert spelling.variants(frame).count() == len(wanted)


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")).count() == 0


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert found(queries.op11_spelling(spark, folder)) == plain(rows)


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    plan = spelling.variants(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
