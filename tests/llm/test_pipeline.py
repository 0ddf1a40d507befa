from __future__ import annotations

import re
from collections import defaultdict

import corpus_pipeline
from cadastra.llm import queries

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = docs.collect()
        seen[name] = (before, after)
        if stage is not corpus_pipeline.into_windows:
            assert docs.columns == columns
            assert {r.doc_id for r in after} <= set(before)
            assert all(r.n_chars == len(r.text) for r in after)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}

    before, after = seen["quality classifier"]
    kept = {r.doc_id for r in after}
    good = [i in kept for i in before if labels.get(i) == 1]
    bad = [i in kept for i in before if labels.get(i) == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) < 0.5 * len(bad)

    before, after = seen["near-duplicate documents"]
    sets = {i: shingles(r.text) for i, r in before.items()}
    root = {i: i for i in before}
    for i in sorted(before):
        for j in sorted(before):
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = i, j
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                root[max(a, b)] = min(a, b)
    assert {r.doc_id for r in after} == {i for i in root if root[i] == i}

    before, after = seen["repeated passages"]
    held = defaultdict(set)  # no fifty words in a row stand in two documents
    for r in after:
        words = (r.text or "").lower().split()
        for k in range(len(words) - 49):
            held[tuple(words[k : k + 50])].add(r.doc_id)
    assert not [w for w, ids in held.items() if len(ids) > 1]

    before, after = seen["benchmark decontamination"]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))}
    for r in after:
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        assert not windows & {tuple(w[k : k + 10]) for k in range(len(w) - 9)}

    before, after = seen["packing"]
    assert {r.doc_id for r in after} == set(before)
    assert all(len(r.ids) == r.length for r in after)


def test_run(spark):
    assert queries.queries()["pipeline"](spark, FOLDER).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None
