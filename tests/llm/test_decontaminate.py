from __future__ import annotations

import hashlib
import random
import re

import pytest

from cadastra.llm import decontaminate


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)]


def brute(docs, items, n=10):
    out = {}
    for key, text in docs:
        found = [w[0] for w in words(text)]
        hit, names = set(), set()
        for name, item in items:
            known = [w[0] for w in words(item)]
            m = min(n, len(known))
            for j in range(len(known) - m + 1) if m else ():
                for i in range(len(found) - m + 1):
                    if found[i : i + m] == known[j : j + m]:
                        hit.update(range(i, i + m))
                        names.add(name)
        out[key] = (len(found), len(hit), sorted(str(x) for x in names if x is not None))
    return out


def corpus():
    rng = random.Random(5)
    vocabulary = ["a", "B", "c3", "é", "ÀB", "x", "ß", "zz"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice((" ", ", ", "-", "\n", "_ ")) for _ in range(n))
    items = [(i, text(rng.randint(8, 25))) for i in range(12)] + [(12, "solo"), (13, None), (14, " - "), (None, text(12)), (15, "two words"), (11, text(15))]
    docs = []
    for i in range(60):
        t = text(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            t += rng.choice(items)[1] or ""
            t += rng.choice((" solo ", "!", " TWO WORDS "))
        docs.append((i, t))
    return [*docs, (100, None), (101, ""), (102, "...")], items


@pytest.mark.parametrize("limit", [1 << 24, 0])
def test_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    docs, items = corpus()
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, items string, N_HIT int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(frame, bench, n=10)
    assert found.columns == ["doc_id", "text", "items", "N_HIT", "n_words", "n_hit_", "items_", "spans", "clean_text"]
    rows = {r.doc_id: r for r in found.collect()}
    assert {k: (r.n_words, r.n_hit_, r.items_) for k, r in rows.items()} == brute(docs, items)
    for r in rows.values():
        raw = (r.text or "").encode()
        assert sum(len(words(raw[s.begin : s.end].decode())) for s in r.spans) == r.n_hit_
        assert (r.clean_text is None) == (r.n_hit_ == 0)


def test_removals(spark):
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = decontaminate.remove_spans(frame, bench).collect()
    assert len(clean) == len(docs)
    assert not any(hit for _, hit, _ in brute([(r.doc_id, r.text) for r in clean], items).values())
    left = {r.doc_id for r in decontaminate.remove_documents(frame, bench).collect()}
    assert left == {k for k, (_, hit, _) in brute(docs, items).items() if not hit}


@pytest.mark.parametrize("limit", [1 << 24, 0])
def test_windows_that_removals_form(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    k = [f"k{i}" for i in range(10)]
    nested = [*k[:5], *k[:3], *k, *k[3:], *k[5:], "tail"]
    frame = spark.createDataFrame([(1, " ".join(nested)), (2, "a b"), (3, " ".join([*k, "end"])), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(k))], "item_id long, text string")
    left = {r.doc_id: r.text and r.text.split() for r in decontaminate.remove_spans(frame, bench).collect()}
    assert left == {1: ["tail"], 2: ["a", "b"], 3: ["end"], 4: None}


def test_empty_tables(spark):
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(frame.limit(0), bench).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate.contamination(frame, bench.limit(0)).collect())


def test_query_on_fixture(spark, tmp_path):
    from cadastra.llm import queries

    docs, items = corpus()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    wanted = brute(docs, items)
    for r in queries.op7_decontaminate(spark, str(tmp_path)).collect():
        n, hit, names = wanted[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(names), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
