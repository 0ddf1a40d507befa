from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest

from cadastra.llm import minhash
from cadastra.llm.common import SPACED, shingle_sets, words_of


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text: str | None, n: int) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows: list[tuple], n: int, percent: int) -> dict:
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def corpus(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)] + ["É", "straße", "ΑΒ", "A.B,"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 160))] for _ in range(12)]
    rows = []
    for i in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 4))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i * 3 + 1, rng.choice((" ", "  ", "\n")).join(words).upper() if i % 5 == 0 else " ".join(words)))
    return [*rows, (1000, None), (1001, ""), (1002, " \t\r\n"), (1003, "One"), (1004, "one"), (1005, "one two"), (1006, "x y z"), (1007, "x y z")]


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, n, percent):
    rows = corpus(n)
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int").repartition(5)
    found = {r.doc_id: r for r in minhash.near_duplicates(frame, n=n, percent=percent, bands=36, rows=5).collect()}
    wanted = brute(rows, n, percent)
    assert {i: r.component_id for i, r in found.items()} == wanted
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(shingles(t, n)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())
    kept = {r.doc_id for r in minhash.drop_near_duplicates(frame, n=n, percent=percent).collect()}
    assert kept == {i for i, root in wanted.items() if i == root}


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "GROUP_SHINGLES", 300)
    rows = corpus(8)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame, n=3, percent=85, bands=36, rows=5).collect()}
    assert found == brute(rows, 3, 85)


def test_null_and_repeated_ids_and_empty(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "q r s t"), (7, "q r s t"), (9, "a b c d"), (9, "a b c d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(frame, n=3, percent=85, bands=8, rows=4).collect()), key=str)
    assert found == sorted([(None, None, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (9, 5, False)], key=str)
    assert minhash.near_duplicates(frame.limit(0), n=3, percent=85, bands=8, rows=4).count() == 0


def test_long_text_and_signature():
    text = " ".join(f"v{i % 5000}" for i in range(400_000)).encode()
    (found,) = shingle_sets(words_of(text, np.array([0, len(text)]), SPACED), 3)
    assert len(found) == 5000
    assert len(minhash.signature([found, np.empty(0, np.uint64)], 8)) == 2


def test_linked_against_all_pairs_and_many_small_sets():
    rng = random.Random(8)
    for _ in range(300):
        sets = [np.unique(np.array(rng.choices(range(14), k=rng.randint(1, 12)), np.uint64)) for _ in range(rng.randint(2, 14))]
        percent = rng.choice([50, 80, 85, 100])
        like = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j and 100 * len(set(a.tolist()) & set(b.tolist())) >= percent * len(set(a.tolist()) | set(b.tolist()))}
        root = list(range(len(sets)))
        for i, j in minhash.linked(list(range(len(sets))), sets, percent):
            assert (i, j) in like
            root = [root[i] if r == root[j] else r for r in root]
        assert all(root[i] == root[j] for i, j in like)
    numbers = np.random.default_rng(1)
    small = [np.unique(np.append(numbers.integers(10, 1 << 40, 2), 5)).astype(np.uint64) for _ in range(64_000)]
    began = time.perf_counter()
    assert list(minhash.linked(list(range(len(small))), small, 85)) == []
    assert time.perf_counter() - began < 20  # quadratic: minutes
