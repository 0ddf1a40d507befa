"""Integrity: conditions that must hold before anything is written, as typed failures with the rows at fault."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class IntegrityError(ValueError):
    """Rows broke a rule. ``rows`` holds the first of them."""

    def __init__(self, rule: str, rows: list):
        super().__init__(f"{rule}: {rows}")
        self.rule, self.rows = rule, rows


def require_none(offending: DataFrame, rule: str, shown: int = 5) -> None:
    """Eagerly: lazily checked columns may be pruned from a plan and never fail."""
    if rows := offending.limit(shown).collect():
        raise IntegrityError(rule, rows)


def require_unique(frame: DataFrame, keys: list[str], rule: str) -> None:
    require_none(frame.groupBy(*keys).count().where("count > 1"), rule)


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other has less often, with ``side`` left or right and ``n`` the surplus."""
    names = a.columns
    both = a.select(*names, F.lit(1).alias("_n")).unionByName(b.select(*names, F.lit(-1).alias("_n")))
    counted = both.groupBy(*names).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return counted.select(*names, F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), F.abs("_n").alias("n"))


def require_same(a: DataFrame, b: DataFrame, rule: str) -> None:
    require_none(multiset_difference(a, b), rule)


def united(frames: list[DataFrame]) -> DataFrame:
    """The rows of any of ``frames``, each once; null equals null."""
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out.distinct()


def dataset_difference(old: DataFrame, new: DataFrame, keys: list[str], body: str) -> DataFrame:
    """keys and ``change`` added, removed or changed, by the SHA-256 of ``body``; equal rows have none."""
    digest = lambda f, name: f.select(*keys, F.sha2(F.coalesce(F.col(body), F.lit("")), 256).alias(name), F.lit(True).alias(f"has_{name}"))
    joined = digest(old, "a").join(digest(new, "b"), keys, "full_outer")
    change = F.when(F.col("has_a").isNull(), "added").when(F.col("has_b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return joined.select(*keys, change.alias("change")).where("change IS NOT NULL")


def flagged(frame: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``frame`` with ``broken``: the names of the rules (SQL conditions) that a row breaks, nulls break none."""
    broken = F.array(*(F.when(~F.expr(f"({condition})"), F.lit(name)) for name, condition in rules.items()))
    return frame.withColumn("broken", F.array_compact(broken))
