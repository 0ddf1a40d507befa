from __future__ import annotations

import math
import random
import zlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from cadastra.llm import queries, toxicity


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    plain = ["w%s" % "".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(800)]
    plain = [p.translate(str.maketrans("0123456789", "abcdefghij")) for p in plain] + ["the", "of", "and"]
    bad = ["idiot", "scumbag", "vequance", "vequille", "vequoir"]
    rows = []
    for i in range(n):
        toxic = int(i % 8 == 0)
        words = [rng.choice(plain) for _ in range(rng.randint(20, 150))]
        for _ in range(rng.randint(3, 6) if toxic else rng.choice((0, 0, 0, 0, 1)) * (i % 3 == 0)):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy(spark, tmp_path):
    rows = corpus()
    texts = [(i, t) for i, t, _ in rows] + [(None, "idiot"), (5001, None), (5002, ""), (5003, "long idiot " * 60_000), (5004, "x"), (5004, "y")]
    spark.createDataFrame([(*r, 7.0) for r in texts], "doc_id long, text string, SCORE double").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, 1, None), (9999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.op3_toxicity(spark, str(tmp_path)).collect()
    assert len(found) == len(texts)
    truth = {i: y for i, _, y in rows}
    held = [r for r in found if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    right = [r.predicted == truth[r.doc_id] for r in held]
    assert len(held) > 200 and sum(right) / len(right) > 0.95
    ranks = np.argsort(np.argsort([r.score for r in held]))
    toxic = np.array([truth[r.doc_id] for r in held]) == 1
    assert (ranks[toxic].sum() - toxic.sum() * (toxic.sum() - 1) / 2) / (toxic.sum() * (~toxic).sum()) > 0.97


def test_few_or_no_labels(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus(30)], "doc_id long, text string")
    for labels in ([], [(1, 0), (2, 0)], [(0, 1)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert len({round(r.score, 9) for r in toxicity.score(docs, model).collect()}) == 1
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_features_see_each_text_alone():
    lexicon = toxicity.Lexicon({int(h): 2.0 for h in toxicity._hashes(["idiot"])})
    second = toxicity._hashes(toxicity.SECOND_PERSON.split())
    texts = ["You IDIOT!!", "idiot", "", "you", "1d10t soooo b@d", "A?b"]
    raw = [t.encode() for t in texts]
    x = toxicity.dense(b"".join(raw), np.cumsum([0, *map(len, raw)]), lexicon, second)
    alone = [toxicity.dense(r, np.array([0, len(r)]), lexicon, second)[0] for r in raw]
    assert np.allclose(x, alone)
    at = toxicity.FEATURES.index
    assert x[0, at("near_second_share")] == 1 and x[1, at("near_second_share")] == 0
    assert x[4, at("swapped_hits")] > 0 and x[4, at("drawn_out")] > 0 and x[0, at("exclaims")] > 0


@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(0, 1)), min_size=1, max_size=60))
def test_isotonic(pairs):
    x, y = (np.array(c, float) for c in zip(*pairs))
    values = toxicity.Isotonic(x, y)(np.linspace(-6, 6, 50))
    assert (np.diff(values) >= -1e-12).all() and values.min() >= 0 and values.max() <= 1


def test_trees_fit():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    assert (((toxicity.Trees(x, y)(x) > 0) == y).mean()) > 0.97


@given(st.lists(st.integers(0, 1), min_size=1, max_size=25), st.integers(0, 10**6))
def test_isotonic_against_its_definition(y, seed):
    """The best rising fit at a place is the largest, over starts before it, of the least mean to an end behind it."""
    x = np.sort(np.random.default_rng(seed).choice(1000, len(y), replace=False)).astype(float)
    n = len(y)
    best = [max(min(np.mean(y[a : b + 1]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
    fit = toxicity.Isotonic(x, np.array(y, float))
    places = {}
    for at, value in zip(x, best):
        places.setdefault(round(value, 9), []).append(at)
    assert np.allclose(sorted(places), fit.y) and np.allclose([np.mean(places[v]) for v in sorted(places)], fit.x)


def plain_boosting(x, y, rounds, depth, rate, ridge):
    """Boosting row by row: every split between neighbouring values tried by its sums, leaves by their rows."""
    score = [math.log((sum(y) + 1) / (len(y) + 2) / (1 - (sum(y) + 1) / (len(y) + 2)))] * len(y)

    def grow(rows, level):
        if level == depth:
            value = rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + ridge)
            for i in rows:
                step[i] = value
            return
        G, H, best = sum(g[i] for i in rows), sum(h[i] for i in rows), (1e-6, None)
        for f in range(len(x[0])):
            values = sorted({r[f] for r in x})
            for cut in values[:-1]:
                low = [i for i in rows if x[i][f] <= cut]
                a, b = sum(g[i] for i in low), sum(h[i] for i in low)
                if b >= 0.5 and H - b >= 0.5:
                    gain = a * a / (b + ridge) + (G - a) ** 2 / (H - b + ridge) - G * G / (H + ridge)
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, cut))
        inside = (lambda i: x[i][best[1][0]] <= best[1][1]) if best[1] else (lambda i: True)
        grow([i for i in rows if inside(i)], level + 1)
        grow([i for i in rows if not inside(i)], level + 1)

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g, h = [a - b for a, b in zip(y, p)], [q * (1 - q) for q in p]
        step = [0.0] * len(y)
        grow(range(len(y)), 0)
        score = [a + b for a, b in zip(score, step)]
    return score


def test_trees_against_plain_boosting():
    rng = np.random.default_rng(3)
    x = rng.permutation(np.arange(40.0))[:, None] * [[1.0, 0.0]] + rng.permutation(np.arange(40.0))[:, None] * [[0.0, 1.0]]
    y = ((x[:, 0] > 18) ^ (x[:, 1] > 25) ^ (rng.random(40) < 0.1)).astype(float)
    # as many cuts as there are values: quantiles of 40 values in 39 parts are the values
    found = toxicity.Trees(x, y, rounds=6, depth=2, rate=0.3, bins=39, ridge=1.0, least=0.5)(x)
    assert np.allclose(found, plain_boosting(x.tolist(), y.tolist(), 6, 2, 0.3, 1.0))
