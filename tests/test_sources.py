from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadastra.sources import readers


def test_csv_is_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text('text,item,name\nt,1/1,"Aïn, Defla"\nt,02,\n"t","say ""x""",أ\n', encoding="utf-8")
    found = readers.source_text(spark, str(tmp_path), "t", ["text", "item", "name"]).collect()
    assert [tuple(r) for r in found] == [("t", "1/1", "Aïn, Defla"), ("t", "02", None), ("t", 'say "x"', "أ")]
    assert readers.readings(spark, str(tmp_path / "none.csv"), ["text", "name"], "t").count() == 0
    assert readers.readings(spark, str(tmp_path / "t.csv"), ["text", "item", "name"], "t").count() == 3


def test_lists_keep_their_order(spark):
    rows = spark.createDataFrame([("7", "10", "j"), ("7", "2", "b"), ("52 bis", "1", "a")], "article string, item string, name string")
    found = {r.article: [x.name for x in r.rows] for r in readers.grouped_lists(rows, "article", "item").collect()}
    assert found == {"7": ["b", "j"], "52 bis": ["a"]}


def test_json_lines_and_labels(spark, tmp_path):
    (tmp_path / "o.jsonl").write_text('{"page":1,"x":0.7,"y":0.2,"w":0.1,"h":0.01,"text":"b","alt":["c"]}\n{"page":1,"x":0.1,"y":0.3,"w":0.1,"h":0.01,"text":"a"}\n{"page":1,"x":0.1,"y":0.01,"w":0.1,"h":0.01,"text":"head"}\n')
    lines = readers.json_lines(spark, str(tmp_path / "o.jsonl"), "page int, x double, y double, w double, h double, text string, alt array<string>")
    order = lambda rtl: [r.text for r in readers.reading_order(lines, head=0.05, rtl=rtl).orderBy("place").collect()]
    assert order(False) == ["a", "b"] and order(True) == ["b", "a"]
    (tmp_path / "l.json").write_text('{"results":{"bindings":[{"kind":{"value":"label"},"lang":{"value":"fr"},"label":{"value":"Adrar"}},{"kind":{"value":"label"},"lang":{"value":"fr"},"label":{"value":"Adrar"}}]}}')
    assert [tuple(r) for r in readers.known_labels(spark, str(tmp_path / "l.json")).collect()] == [("label", "fr", "Adrar")]


def test_page_markers(spark, tmp_path):
    (tmp_path / "c.txt").write_text("ahead\n=== page 3 ===\na\n\nb\n=== page 4 ===\nc\n")
    found = readers.marked_lines(spark, str(tmp_path / "c.txt"), r"^=== page (\d+) ===$").orderBy("line").collect()
    assert [(r.page, r.text) for r in found] == [(None, "ahead"), (3, "a"), (3, "b"), (4, "c")]


def test_changelog_and_versions(spark):
    text = "# Changes\n\n## [1.10.0](https://x) (2026-04-05)\n\n* b\n\n## 1.9.2 - 2026-01-02\n* a\n"
    found = readers.changelog(spark.createDataFrame([(text,)], "value string")).orderBy("place").collect()
    assert [(r.version, r.date, r.entry) for r in found] == [("1.10.0", "2026-04-05", "* b"), ("1.9.2", "2026-01-02", "* a")]
    newest = spark.createDataFrame(found).select(F.max_by("version", readers.version_key(F.col("version")))).first()[0]
    assert newest == "1.10.0"
    texts = spark.createDataFrame([("a", "2026-04-05")], "id string, jo_date string")
    lists = spark.createDataFrame([("b", "2021-06")], "id string, published string")
    assert sorted(tuple(r) for r in readers.publication_dates(texts, lists).collect()) == [("a", "2026-04-05"), ("b", "2021-06")]


def test_entry_without_the_optional_part(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("missing", [True])
def test_entry_imports_without_it(tmp_path, missing):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "cadastra", tmp_path / "cadastra", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "cadastra/llm/__pycache__").mkdir(parents=True)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split()[1] == "False" and int(done.stdout.split()[0]) > 40
