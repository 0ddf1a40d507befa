from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from cadastra.llm import warc


@given(st.lists(st.lists(st.integers(0, 30), max_size=20), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(r) for r in runs]
    tree = warc.LoserTree([[(x, i) for x in r] for i, r in enumerate(runs)])
    assert [x for x, _ in tree] == sorted(x for r in runs for x in r)


def test_url_key():
    assert warc.url_key("https://user@WWW.Example.com:80/A?b#c") == "com:80,example)/a?b"
    assert warc.url_key("http://a.b") == "b,a)/"
    assert warc.url_key("nothing") == "nothing" and warc.url_key("") == ""


def pages():
    rng = random.Random(2)
    bodies = ["x" * 999, "y" * 1000, "é" * 500, "WARC/1.1\r\n\r\n\r\nContent-Length: 5\r\n\r\n" * 60, "", None, "\r\n\r\n", "small"]
    rows = [(i, rng.choice([f"http://h{i % 7}.org/{i % 3}", "http://hot.org/", None, "odd url\r\nX: y", ""]), rng.choice(bodies)) for i in range(400)]
    return [*rows, (None, "http://n.org", "y" * 1000), (None, None, "w" * 2000), (None, None, "w" * 2000), (399, "http://twice.org", "y" * 1000), (500, "http://a.org", "z" * 5000)]


def wanted(rows):
    best = {}
    for i, _, body in rows:
        raw = (body or "").encode()
        if len(raw) >= 1000 and i is not None:
            best[raw] = max(best.get(raw, i), i)
    out = []
    for i, _, body in rows:
        raw = (body or "").encode()
        first = best.get(raw) if len(raw) >= 1000 else None
        revisit = first is not None and first != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [16_384, 7])
def test_archives_and_history(spark, monkeypatch, most):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", most)
    rows = pages()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, DIGEST string").repartition(5)
    found = warc.archived(frame).collect()
    assert sorted(((r.id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in found), key=str) == wanted(rows)
    found.sort(key=lambda r: (r["range"], r.seq))
    keys = [(r.urlkey, r.taken, r.id is not None, r.id or 0) for r in found]
    assert keys == sorted(keys)


def test_records_are_read_back_whole(spark, tmp_path):
    frame = spark.createDataFrame([(1, "http://a.b/é", 1_600_000_000, "é\r\n\r\nb")], "id long, url string, taken long, payload string")
    warc.write_archives(frame, f"{tmp_path}/w")
    (file,) = (tmp_path / "w").glob("part-*")
    raw = warc.unpacked(file.read_bytes())
    (record,) = warc.parse(raw)
    assert record["payload"].decode() == "é\r\n\r\nb" and record["length"] == len(raw)
    assert record["headers"]["warc-target-uri"] == "http://a.b/é" and record["headers"]["warc-date"] == "2020-09-13T12:26:40Z"
    with pytest.raises(ValueError):
        list(warc.parse(raw[:-3]))
    with pytest.raises(ValueError):
        warc.unpacked(file.read_bytes()[:-3])
    assert warc.unpacked(file.read_bytes() * 2) == raw * 2 and warc.unpacked(raw) == raw


def test_empty(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(frame).count() == 0
