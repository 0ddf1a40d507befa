from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import xxhash

from cadastra.llm import sharding

TREE = sharding.balanced(8)


def frame(spark, n=4000):
    rows = [(i, None if i % 50 == 0 else "é" * (i % 9), 1) for i in range(n)]
    rows += [(None, "x", 1)] * 30 + [(7, "again", 1)] * 30
    return spark.createDataFrame(rows, "doc_id long, text string, SHARD int").repartition(6)


def test_rows_slots_and_growth(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 100)
    rows = sharding.sharded(frame(spark), TREE, sharding.grown(TREE, 8)).collect()
    assert len(rows) == 4060
    slots, places = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        places[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 8)
        if r.doc_id is not None and r.doc_id != 7:
            text = ("" if r.doc_id % 50 == 0 else "é" * (r.doc_id % 9)).encode()
            assert (r.size, r.text_crc32, r.law) == (len(text) + 1, zlib.crc32(text), "key")
    assert sorted(slots) == list(range(8))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in places.values())
    assert all(380 < len(v) < 640 for v in slots.values())
    assert 300 < Counter(r.grown_shard for r in rows)[8] < 600


def test_movement_stays_in_changed_subtrees(spark):
    ids = spark.range(6000)
    heavier = {r: {k: dict(s) for k, s in racks.items()} for r, racks in TREE.items()}
    heavier["r0"]["k1"][2] = 3.0
    moved = ids.select(sharding.shard_of(ids.id, TREE).alias("a"), sharding.shard_of(ids.id, heavier).alias("b")).where("a <> b").distinct().collect()
    region, rack = (lambda s: s // 4), (lambda s: s // 2)
    for r in moved:  # into region 0 from elsewhere; in it, into rack 1; in that, into shard 2
        assert region(r.b) == 0
        if region(r.a) == 0:
            assert rack(r.b) == 1
            if rack(r.a) == 1:
                assert r.b == 2


def descended(key: str, node, path="") -> int:
    """The shard of a key, child by child, with the hash of (key, path) that Spark's xxhash64 gives."""
    draws = []
    for child, below in node.items():
        weight = total(below)
        if weight > 0:
            where = f"{path}/{child}"
            bits = xxhash.xxh64_intdigest(where.encode(), xxhash.xxh64_intdigest(key.encode(), 42)) >> 12
            draws.append((-math.log((bits + 0.5) / (1 << 52)) / weight, len(draws), child, below, where))
    _, _, child, below, where = min(draws, key=lambda d: d[:2])
    return descended(key, below, where) if isinstance(below, dict) else child


def total(node) -> float:
    return sum(map(total, node.values())) if isinstance(node, dict) else node


def test_descent_against_plain_hashes(spark):
    lopsided = {"a": {"x": {0: 1.0, 1: 0.0, 2: 2.5}, "y": {3: 0.5}}, "b": {"z": {4: 7.0, 5: 1.0}}, "c": {"w": {6: 0.0}}}
    ids = spark.range(-500, 2500)
    for tree in (TREE, sharding.grown(TREE, 8), lopsided):
        found = {r[0]: r[1] for r in ids.select("id", sharding.shard_of(ids.id, tree)).collect()}
        assert found == {i: descended(str(i), tree) for i in range(-500, 2500)}


def test_the_query_against_plain_hashes(spark):
    from cadastra.llm.queries import op4_hash_tree

    rows = op4_hash_tree(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all((r.shard, r.grown_shard) == (descended(str(r.doc_id), TREE), descended(str(r.doc_id), sharding.grown(TREE, 8))) for r in rows)


def test_weights_and_empty(spark):
    ids = spark.range(20_000)
    tree = {"a": {"x": {0: 1.0, 1: 0.0}, "y": {2: 2.0}}, "b": {"x": {3: 1.0}}}
    share = Counter(r[0] for r in ids.select(sharding.shard_of(ids.id, tree)).collect())
    assert set(share) == {0, 2, 3} and abs(share[2] / 20_000 - 0.5) < 0.02 and abs(share[0] / 20_000 - 0.25) < 0.02
    assert sharding.sharded(frame(spark).limit(0), TREE, sharding.grown(TREE, 8)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = sharding.sharded(frame(spark), TREE, sharding.grown(TREE, 8))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
