from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cadastra.llm import packing
from cadastra.llm.common import tokenizer_file

ENCODER = packing.Encoder(tokenizer_file())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Zé'1,.\n\t  s日😀<|>")) | st.text(), max_size=6))
def test_ids_are_those_of_whole_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ENCODER(texts) == [ENCODER.whole(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 256), min_size=1, max_size=400))
def test_near_equal(sizes):
    windows = packing.near_equal(np.array(sizes), 1024)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) <= 1024
    if len(windows) > 1:
        assert max(sums) - min(sums) <= 256


def check(rows, docs, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    for name, text in docs:
        ids = ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by_doc[name], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return sum(r.length for r in rows) / (capacity * len(by_sequence))


def test_pack(spark):
    docs = [(i, " ".join(f"w{(i * j) % 97} the" for j in range(i * 7 % 900))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "a  b\n c "), (1003, "long " * 30_000), (1004, "x" * 50_000)]
    frame = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, offset int").repartition(4)
    rows = packing.pack(frame, tokenizer=tokenizer_file()).collect()
    assert check(rows, docs, 1024) > 0.97
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack(frame.limit(0), tokenizer=tokenizer_file()).count() == 0
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "c"), (3, "c")], "doc_id long, text string")
    assert sum(r.length for r in packing.pack(twice, tokenizer=tokenizer_file()).collect()) == 10


def test_other_files_go_through_the_library(tmp_path):
    import json

    with open(tokenizer_file(), encoding="utf-8") as file:
        described = json.load(file)
    described["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(described), encoding="utf-8")
    other = packing.Encoder(str(tmp_path / "other.json"))
    assert other.ranks is None and ENCODER.ranks is not None
    assert other(["the cat"]) == [ENCODER.whole(" the cat")]
