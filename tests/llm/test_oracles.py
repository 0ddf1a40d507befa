from __future__ import annotations

import sys
from pathlib import Path

import pytest

from cadastra.llm import queries

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, name):
    assert compare(spark, queries.queries()[name], queries.ORACLES[name], FOLDER) > 0
