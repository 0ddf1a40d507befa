"""Operators over ordered rows: fills, sessions, clusters, islands, monotone selections, continuations."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.names import fresh


def filled_forward(frame: DataFrame, by: list[str], order: list, column: str, closed: Column | None = None) -> Column:
    """The last value seen; rows where ``closed`` holds end its reach."""
    value = F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("v")))
    if closed is not None:
        value = F.when(closed, F.struct(F.lit(None).cast(frame.schema[column].dataType).alias("v"))).otherwise(value)
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))["v"]


def until_marker(frame: DataFrame, by: list[str], order: str | list[str], marker: Column) -> DataFrame:
    """Rows ahead of a group's first marker; all rows where there is none. ``order`` may be several columns: the first is the
    least row of them. A null marker is none; a marker without a place is none either. Where there is one, rows without a place
    are left out. Null keys are a group whose markers end nothing, as null equals no null in a join."""
    (end,) = fresh(frame, "_end")
    columns = [order] if isinstance(order, str) else order
    place = F.struct(*columns)
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    first = frame.where(marker & known).groupBy(*by).agg(F.min(place).alias(end))
    return frame.join(first, by, "left").where(F.col(end).isNull() | (known & (place < F.col(end)))).drop(end)


def sessions(by: list[str], order: str, gap) -> Column:
    """Number of a row's session: a step of more than ``gap`` since the row before begins one."""
    w = Window.partitionBy(*by).orderBy(order)
    begins = F.coalesce((F.col(order) - F.lag(order).over(w)) > gap, F.lit(True))
    return F.sum(begins.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))


def clustered(frame: DataFrame, by: list[str], at: str, tolerance: float, rule: str) -> DataFrame:
    """``frame`` with ``cluster``, from 0 along ``at``: a row joins the current cluster if it lies within
    ``tolerance`` of its ``first`` row or of the ``mean`` of its rows.

    The rules depend on the cluster so far, so rows stream through Python in order; only a running mean is kept, and
    a group of any size takes no memory. Null keys are a group like others. A row whose ``at`` is null or not a number
    has no place and no cluster (null), and the rows around it don't see it. Equal places share a cluster.
    """
    if rule not in ("first", "mean"):
        raise ValueError(rule)
    if "cluster" in (c.lower() for c in frame.columns):
        raise ValueError("there is a column cluster already")
    schema = frame.withColumn("cluster", F.lit(None).cast("long")).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, base, count, number = None, 0.0, 0, -1
        for batch in batches:
            out = []
            places = batch.column(at).cast(pa.float64(), safe=False).to_pylist()
            for group, value in zip(zip(*(map(_comparable, batch.column(c).to_pylist()) for c in by)), places):
                if value is None or value != value:
                    out.append(None)
                    continue
                if group != key:
                    key, number, count = group, 0, 0
                elif abs(value - base) >= tolerance:
                    number, count = number + 1, 0
                count += 1
                base = value if count == 1 else base + (value - base) / count if rule == "mean" else base
                out.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "cluster"])

    dealt = frame.repartition(*by).sortWithinPartitions(*by, at)
    return dealt.mapInArrow(scan, schema)


def _comparable(value):
    """A key's value by which equal keys are equal: not a number is one value, lists are tuples."""
    if isinstance(value, float) and value != value:
        return "NaN"
    return tuple(map(_comparable, value)) if isinstance(value, list) else value


def rising(frame: DataFrame, by: list[str], order: str, number: str, announced: Column | None = None) -> DataFrame:
    """Rows whose number exceeds every kept one before; numbers above ``announced`` are dropped first. Rows without a number are
    dropped; null keys are a group like others."""
    (before,) = fresh(frame, "_before")
    rows = frame.where(F.col(number).isNotNull()) if announced is None else frame.where(F.col(number) <= announced)
    most = F.max(number).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn(before, most).where(F.col(before).isNull() | (F.col(number) > F.col(before))).drop(before)


def islands(frame: DataFrame, by: list[str], at: str) -> DataFrame:
    """Runs of consecutive whole numbers: by, first, last, size. Numbers that repeat count once, nulls are in no run."""
    (run,) = fresh([*by, at], "_run")
    rows = frame.where(F.col(at).isNotNull()).select(*by, at).distinct()
    runs = rows.withColumn(run, F.col(at) - F.row_number().over(Window.partitionBy(*by).orderBy(at)))
    return runs.groupBy(*by, run).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("size")).drop(run)


def continued(frame: DataFrame, by: list[str], order: str, text: str, begins: Column, glue: str = " ") -> DataFrame:
    """Lines that don't begin an entry are added to the entry before: by, entry, text. Lines ahead of the first entry are entry 0;
    a null ``begins`` begins none, a null text adds nothing."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = frame.withColumn("entry", F.sum(F.coalesce(begins, F.lit(False)).cast("int")).over(w))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), glue)
    return rows.groupBy(*by, "entry").agg(joined.alias(text))


def spaced(frame: DataFrame, by: list[str], x: str, w: str, character: str, gap: float) -> DataFrame:
    """Characters of a line joined along ``x``, a space where they lie more than ``gap`` apart: by, text. Characters without a
    place come first; a null character adds nothing."""
    (piece,) = fresh(frame, "_c")
    order = Window.partitionBy(*by).orderBy(x)
    apart = F.coalesce(F.col(x) - F.lag(F.col(x) + F.col(w)).over(order) > gap, F.lit(False))
    rows = frame.withColumn(piece, F.concat(F.when(apart, " ").otherwise(""), F.col(character)))
    return rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(x, piece))), lambda r: r[piece]), "").alias("text"))


def sections(headers: DataFrame, by: list[str], at: str) -> DataFrame:
    """Each header's section: it ends where the next begins, the last is open (null)."""
    return headers.withColumn("end", F.lead(at).over(Window.partitionBy(*by).orderBy(at)))


def first_of_each(frame: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key, in the order of first occurrence. Null keys are one key; a null order is first."""
    rest, (row,) = [c for c in frame.columns if c not in keys], fresh(frame, "_row")
    best = frame.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order, *rest)).alias(row))
    return best.select(*keys, *(F.col(f"{row}.`{c}`").alias(c) for c in rest))


def kinds_in_order(frame: DataFrame, kind: str, kinds: list[str], order: list[str]) -> DataFrame:
    """``frame`` sorted by the place of its kind in ``kinds``, unknown kinds last, then by ``order``."""
    rank = F.coalesce(*(F.when(F.col(kind) == k, F.lit(i)) for i, k in enumerate(kinds)), F.lit(len(kinds)))
    return frame.orderBy(rank, kind, *order)


def unanimous(frame: DataFrame, by: list[str], value: Column, known: DataFrame | None = None) -> DataFrame:
    """by and ``agreed``: the value on which all rows of a group agree, if ``known`` (one column) has it. A null vote agrees with
    nothing."""
    most, rows, votes = fresh(by, "_max", "_rows", "_votes")
    counted = frame.groupBy(*by).agg(F.min(value).alias("agreed"), F.max(value).alias(most), F.count(F.lit(1)).alias(rows), F.count(value).alias(votes))
    agreed = counted.where((F.col("agreed") == F.col(most)) & (F.col(rows) == F.col(votes))).select(*by, "agreed")
    return agreed if known is None else agreed.join(known.select(F.col(known.columns[0]).alias("agreed")), "agreed", "left_semi").select(*by, "agreed")


def longest_chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of ``pairs`` as many as rise in both numbers; of chains as long, the one whose pairs come first.

    Patience from the last pair back: ``tails[k]`` has the largest second number that begins a chain of k + 1 pairs.
    """
    tails: list[int] = []  # negated, so that they rise
    length: dict[tuple[int, int], int] = {}
    for l, r in sorted(set(pairs), key=lambda p: (-p[0], p[1])):
        k = bisect.bisect_left(tails, -r)
        tails[k : k + 1] = [-r]
        length[l, r] = k + 1
    chain: list[tuple[int, int]] = []
    for l, r in sorted(length):
        if length[l, r] == len(tails) - len(chain) and (not chain or (l > chain[-1][0] and r > chain[-1][1])):
            chain.append((l, r))
    return chain


def aligned(left: DataFrame, right: DataFrame, by: list[str], order: str, text: str, *, cutoff: float) -> DataFrame:
    """by, l_order, r_order: the longest alignment in order of rows with an equal ``number`` whose texts, blanks left
    out, have a ratio of at least ``cutoff``.

    Rows meet in a join by group and number, those whose lengths rule the ratio out are dropped before they are
    compared, and each group's longest chain is found over the pairs that are left, by patience. A null text is
    empty, two empty ones are alike; rows with a null number or order are left out. No pairs give no rows.
    """
    from cadastra.functions.text import at_least_similar

    def side(frame: DataFrame, name: str) -> DataFrame:
        bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", "")
        return frame.where(F.col(order).isNotNull()).select(*by, "number", F.col(order).cast("long").alias(f"{name}_order"), bare.alias(f"_{name}"))

    met = side(left, "l").join(side(right, "r"), [*by, "number"])
    a, b = F.length("_l"), F.length("_r")
    near = met.where((a + b == 0) | (2 * F.least(a, b) >= cutoff * (a + b)))
    alike = near.where(at_least_similar(cutoff)(F.col("_l"), F.col("_r")))
    pairs = alike.select(*by, "l_order", "r_order").distinct()
    schema = pairs.schema

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        kept = longest_chain(list(zip(pdf["l_order"].tolist(), pdf["r_order"].tolist())))
        return pd.DataFrame([(*pdf[by].iloc[0], l, r) for l, r in kept], columns=[*by, "l_order", "r_order"])

    return pairs.groupBy(*by).applyInPandas(chain, schema)
