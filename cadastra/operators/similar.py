"""Similarity joins of short texts by shared grams: prefix and length filters, then the exact ratio.

The ratio is twice the matching characters over both lengths, in matching blocks of their order. Texts with a ratio of c share at
least c / 2 of their characters, and blocks break only at characters that don't match, which bounds the pairs of
neighbours that they share as well. So texts meet only in the rarest few of their grams, and few of those that meet are
compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.text import similarity
from cadastra.operators.storage import kept

#: From this cutoff on, texts share pairs of neighbours in any case; below they meet by single characters.
PAIRS_FROM = 0.85
_EPS = 1e-9


def grams(text: Column, q: int) -> Column:
    """The grams of ``q`` characters of a text, each with the number of its occurrence, so that all are different.
    A text shorter than q is one gram."""
    n = F.length(text)
    every = F.when(n < q, F.array(text)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - q + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(q))))
    numbered = lambda a: F.transform(a, lambda g, i: F.concat(g, F.lit("\u0000"), (i - F.array_position(a, g)).cast("string")))
    return F.transform(F.array(F.array_sort(every)), numbered)[0]


def _shared(total: Column, cutoff: float, q: int) -> Column:
    """The least number of grams that two texts of ``total`` characters share if their ratio is ``cutoff`` or more."""
    if q == 1:
        return F.ceil(total * (cutoff / 2) - _EPS)
    # m matching characters in at most (total - 2m + 1) blocks, each a pair less than characters
    return F.greatest(F.ceil(total * (1.5 * cutoff - 1) - 1 - _EPS), F.lit(1))


def _prefixes(texts: DataFrame, by: list[str], cutoff: float, q: int) -> DataFrame:
    """``texts`` (by, text, in_left, in_right) with length, ``grams`` from the rarest on, and ``gram``: the rarest so many that
    texts that are alike share one. Of grams that are equally rare, the order is that of the grams."""
    texts = texts.where(F.length("text") > 0).withColumn("length", F.length("text"))
    other = F.ceil(F.col("length") * (cutoff / (2 - cutoff)) - _EPS)  # the least length of a text that is alike
    spread = texts.withColumn("gram", F.explode(grams(F.col("text"), q)))
    frequency = spread.groupBy(*by, "gram").agg(F.count(F.lit(1)).alias("often"))
    ranked = spread.join(frequency, [*by, "gram"]).groupBy(*by, "text", "length", "in_left", "in_right").agg(F.array_sort(F.collect_list(F.struct("often", "gram"))).alias("ranked"))
    ranked = ranked.withColumn("grams", F.transform("ranked", lambda r: r["gram"])).drop("ranked")
    take = F.greatest(F.size("grams") - _shared(F.col("length") + other, cutoff, q) + 1, F.lit(1)).cast("int")
    return ranked.withColumn("gram", F.explode(F.slice("grams", 1, take)))


def candidates(left: DataFrame, right: DataFrame, by: list[str], cutoff: float) -> DataFrame:
    """(by, a, b): pairs of texts of ``left`` and ``right`` (by, text; distinct) that may have a ratio of ``cutoff``.

    None that has is left out: filters by rarest grams, by length and by the number of shared grams only drop what
    can't reach it. Empty texts meet nothing. A text of both sides is cut once, and the cut texts are kept in a table
    that both sides of the join read.
    """
    q = 2 if cutoff >= PAIRS_FROM else 1
    side = lambda frame, in_left: frame.select(*by, "text", F.lit(in_left).alias("in_left"), F.lit(not in_left).alias("in_right"))
    texts = side(left, True).unionByName(side(right, False)).groupBy(*by, "text").agg(*(F.max(c).alias(c) for c in ("in_left", "in_right")))
    cut = kept(_prefixes(texts, by, cutoff, q))
    a = cut.where("in_left").select(*by, "gram", F.col("text").alias("a"), F.col("length").alias("la"), F.col("grams").alias("ga"))
    b = cut.where("in_right").select(*by, "gram", F.col("text").alias("b"), F.col("length").alias("lb"), F.col("grams").alias("gb"))
    total = F.col("la") + F.col("lb")
    met = a.join(b, [*by, "gram"]).where(2 * F.least("la", "lb") >= cutoff * total - _EPS)
    if q == 2:  # a single character is like itself alone, and has no pair to share with a longer text
        met = met.where((F.least("la", "lb") > 1) | (F.col("a") == F.col("b")))
    return met.where(F.size(F.array_intersect("ga", "gb")) >= _shared(total, cutoff, q)).select(*by, "a", "b").distinct()


def similar_pairs(left: DataFrame, right: DataFrame, by: list[str], cutoff: float) -> DataFrame:
    """(by, a, b, score) of the pairs of distinct texts whose ratio is at least ``cutoff``."""
    scored = candidates(left, right, by, cutoff).withColumn("score", similarity(F.col("a"), F.col("b")))
    return scored.where(F.col("score") >= cutoff)


def best_matches(left: DataFrame, right: DataFrame, by: list[str], text_left: str, text_right: str, cutoff: float, *, number: str | None = None, other: float | None = None) -> DataFrame:
    """``left`` with r_id and score of the most similar row of ``right`` in its group, if any is similar enough.

    Enough is ``cutoff``; with ``number`` (a column of both) it is ``cutoff`` among rows of the same number and ``other``, which is
    higher, among the rest. Of equal scores the least r_id, the first of the input, wins. Equal texts are compared once, and
    each text of ``right`` stands for its least id. Null or empty texts and null keys match nothing; a null number
    equals none. Rows of ``left`` that repeat an id have a match each. Columns r_id, score and id are those of the result.
    """
    rows = left.withColumn("_text", F.col(text_left))
    tiers = [(cutoff, [*by, number])] + ([(other, by)] if other is not None else []) if number is not None else [(cutoff, by)]
    best = []
    for i, (least, keys) in enumerate(tiers):
        x = rows.select(*keys, F.col("_text").alias("text")).distinct()
        r = right.where(F.col(text_right) != "").groupBy(*keys, F.col(text_right).alias("text")).agg(F.min("id").alias("r_id"))
        pairs = similar_pairs(x, r.select(*keys, "text"), keys, least)
        pairs = pairs.join(r.withColumnRenamed("text", "b"), [*keys, "b"]).select(*keys, F.col("a").alias("_text"), "r_id", "score")
        found = kept(pairs.groupBy(*keys, "_text").agg(F.max(F.struct("score", (-F.col("r_id")).alias("less"))).alias(f"_best{i}")))
        rows = rows.join(found, [*keys, "_text"], "left")  # a null number has matches by text alone
        best.append(f"_best{i}")
    top = F.greatest(*best) if len(best) > 1 else F.col(best[0])
    return rows.select(*left.columns, (-top["less"]).alias("r_id"), top["score"].alias("score"))
