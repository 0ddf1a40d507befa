"""Connected components of a graph whose edges lie in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.operators.storage import kept

#: More rounds than any graph needs that fits a cluster; the count grows with the logarithm of its diameter.
MOST_ROUNDS = 60


def _lowest(pairs: DataFrame, over: str) -> DataFrame:
    """Of each node ``a``, the least of itself and its neighbours ``b``; for the star steps."""
    return pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias(over))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b: long): the least node that can be reached from it.

    Large-star and small-star steps alternate until nothing changes. Each is one aggregation with a minimum,
    so a node with very many neighbours costs its task one row from every other task, and one join.
    Rows with a null end are left out; loops count as a node without neighbours. No edges give no rows.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a IS NOT NULL AND b IS NOT NULL")
    nodes = kept(edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct())
    loops = nodes.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    stars = nodes.where("a <> b").select("a", "b")
    last = None
    for _ in range(MOST_ROUNDS):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_lowest(both, "low"), "a").where("b > a AND b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        small = large.join(large.groupBy("a").agg(F.min("b").alias("low")), "a")
        stars = small.select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.a", "e.b")
        stars = kept(stars.where("a <> b").distinct())
        now = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"no end after {MOST_ROUNDS} rounds")
    found = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return found.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("root").alias("root"))
