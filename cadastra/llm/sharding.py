"""Shards by a hierarchical weighted hash tree, in DataFrame functions only.

A document descends region, rack and shard. At each node every child draws -ln(u) / weight with u from a hash of
the document's id and the child's path, and the least draw wins; the weight of an inner node is the sum of its
shards'. A draw depends on nothing but its own child, so a changed weight moves documents only into or out of
that child: all movement stays in the subtrees whose weights change. A further shard comes as a region of its
own; then it takes documents only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import checkpoint

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]
#: Documents of one shard that are numbered in one task, on average.
SLOT_ROWS = 100_000


def balanced(shards: int, per_rack: int = 2, racks: int = 2) -> Tree:
    """Shards 0 to ``shards`` - 1 of weight 1, ``per_rack`` in a rack and ``racks`` in a region."""
    tree: Tree = {}
    for s in range(shards):
        rack = s // per_rack
        tree.setdefault(f"r{rack // racks}", {}).setdefault(f"k{rack % racks}", {})[s] = 1.0
    return tree


def grown(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """``tree`` with one more shard, in a new region."""
    return tree | {f"r{len(tree)}": {"k0": {shard: weight}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else node


def _descend(node, key: Column, path: str) -> Column:
    """The shard below ``node`` that ``key`` comes to."""
    draws = []
    for child, below in node.items():
        weight = _weight(below)
        if weight > 0:
            where = f"{path}/{child}"
            bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(where)), 12)
            u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
            draws.append((child, below, where, -F.log(u) / F.lit(weight)))
    if not draws:
        raise ValueError(f"no weight below {path or 'the root'}")
    if len(draws) == 1:
        child, below, where, _ = draws[0]
        return _descend(below, key, where) if isinstance(below, dict) else F.lit(child).cast("int")
    least = F.array_min(F.array(*(F.struct(d.alias("draw"), F.lit(k).alias("k")) for k, (_, _, _, d) in enumerate(draws))))["k"]
    out = None
    for k, (child, below, where, _) in enumerate(draws):
        value = _descend(below, key, where) if isinstance(below, dict) else F.lit(child).cast("int")
        out = F.when(least == k, value) if out is None else out.when(least == k, value)
    return out


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of ``key``, an int column. A null key is a key like any other."""
    return _descend(tree, F.coalesce(key.cast("string"), F.lit("\u0000null")), "")


def sharded(documents: DataFrame, tree: Tree, more: Tree, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row for each row of ``documents``.

    ``size`` is the text's UTF-8 bytes plus 1, a null text having none; its crc32 is that of no bytes, 0.
    ``slot`` numbers a shard's rows from 0 without gaps; it follows the table's layout. ``grown_shard`` is the
    shard under ``more``. Rows that repeat an id share a shard and have slots of their own; null ids are one key.
    An empty table gives no rows. Extra columns are not looked at.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.col(id_col)
    placed = documents.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        shard_of(key, tree).alias("shard"),
        shard_of(key, more).alias("grown_shard"),
        F.monotonically_increasing_id().alias("at"),
    )
    placed = checkpoint(placed)
    rows = placed.count()
    parts = max(1, -(-rows // (SLOT_ROWS * 8)))
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("at"), F.lit(parts)))
    counts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    slot = F.row_number().over(Window.partitionBy("shard", "part").orderBy("at")) - 1
    return (
        dealt.withColumn("slot", slot)
        .join(before, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("slot") + F.col("before")).cast("long").alias("slot"), "grown_shard")
    )
