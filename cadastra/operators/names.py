"""Names of temporary columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(taken: list[str] | DataFrame, *wanted: str) -> list[str]:
    """``wanted``, each with underscores added until no column in ``taken`` (case ignored) and none before it has the name."""
    used = {c.lower() for c in (taken.columns if isinstance(taken, DataFrame) else taken)}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
