"""Hard negatives by a vector-approximation file.

Rows are dealt into blocks of bounded size. Over its block a task cuts each dimension into equal cells and keeps, for
each row, the cells' numbers, two dimensions to a byte: the approximations. An anchor's products with the lower
ends of all cells make a table, and a row's lower bound is the sum of what its bytes look up; as cells are equally wide,
its upper bound lies a fixed distance above. Exact scores are computed only for rows whose bounds let them
enter the result: the nearest rows of the anchor's label, then for each of them the window of scores below it.

A block's rows stay in one task and the anchors stream past them, batch by batch; each block answers with the best few for an
anchor, and a window over those finds the best of all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import written

#: Rows of a block, on average.
BLOCK_ROWS = 16_384
#: Cells of a dimension; two dimensions share a byte.
CELLS = 16
#: Anchors whose bounds are looked up together.
ANCHORS_AT_ONCE = 32
#: Components beyond this could overflow a score.
MOST = 1 << 26


def quantised(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", relabel: int = 7, labels: int = 10, scale: int = 256) -> DataFrame:
    """(vec_id, label, v: array of long) of the rows that take part: with a label, a vector and finite components."""
    x = F.col(vector_col)
    usable = F.col(label_col).isNotNull() & x.isNotNull() & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    label = F.when(F.col(id_col) % relabel == 0, (F.col(label_col) + 1) % labels).otherwise(F.col(label_col))
    rows = vectors.where(usable & F.col(id_col).isNotNull())
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    width = len(column[0].as_py()) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


class Block:
    """The rows of a block with their approximations."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        if rows.size and np.abs(rows).max() > MOST:
            raise ValueError(f"components beyond {MOST} could overflow a score")
        self.ids, self.labels, self.rows = ids, labels, rows
        self.low = rows.min(axis=0)
        self.width = np.maximum(1, -(-(rows.max(axis=0) - self.low + 1) // CELLS))
        cells = ((rows - self.low) // self.width).astype(np.uint8)
        if cells.shape[1] % 2:
            cells = np.hstack([cells, np.zeros((len(cells), 1), np.uint8)])
        self.codes = np.ascontiguousarray((cells[:, ::2] * CELLS + cells[:, 1::2]).T).astype(np.intp)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower bounds of all rows for each anchor, distance of the upper bounds)."""
        ends = self.low[:, None] + np.arange(CELLS) * self.width[:, None]
        # the least product within a cell: at its lower end for a positive component, at its upper one for a negative
        table = np.where(anchors[:, :, None] >= 0, anchors[:, :, None] * ends, anchors[:, :, None] * (ends + self.width[:, None] - 1))
        if table.shape[1] % 2:
            table = np.concatenate([table, np.zeros((len(table), 1, CELLS), np.int64)], axis=1)
        both = (table[:, ::2, :, None] + table[:, 1::2, None, :]).reshape(len(anchors), -1, CELLS * CELLS)
        lower = np.zeros((self.codes.shape[1], len(anchors)), np.int64)
        for k, codes in enumerate(self.codes):
            lower += np.ascontiguousarray(both[:, k].T)[codes]
        return np.ascontiguousarray(lower.T), np.abs(anchors) @ (self.width - 1)

    def best(self, anchor: np.ndarray, at: np.ndarray, lower: np.ndarray, spread: int, most: int, least: int | None = None, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the first ``most`` rows among ``at`` with scores in [least, limit], ties by id."""
        if least is not None:
            inside = (lower[at] + spread >= least) & (lower[at] <= limit)
            at = at[inside]
            sure = lower[at][(lower[at] >= least) & (lower[at] + spread <= limit)]
        else:
            sure = lower[at]
        if len(sure) >= most:
            # so many rows surely have this score or more
            at = at[lower[at] + spread >= np.partition(sure, len(sure) - most)[len(sure) - most]]
        scores = self.rows[at] @ anchor
        if least is not None:
            inside = (scores >= least) & (scores <= limit)
            at, scores = at[inside], scores[inside]
        order = np.lexsort((self.ids[at], -scores))[:most]
        return self.ids[at][order], scores[order]


Answer = Callable[[Block, pa.RecordBatch], Iterator[pa.RecordBatch]]


def _over_blocks(rows: DataFrame, anchors: DataFrame, answer: Answer, schema: str, block_rows: int) -> DataFrame:
    """``answer(block, batch of anchors)`` for every block of ``rows`` and all ``anchors``.

    Rows of a block come first in their task, anchors follow in batches. Blocks are dealt by a number of the row, not by
    its id or vector, so copies don't gather; ``rows`` is a written table, whose numbers don't change.
    """
    blocks = max(1, -(-rows.count() // block_rows))
    extra = [c for c in anchors.columns if c not in rows.columns]
    null = lambda c: F.lit(None).cast(anchors.schema[c].dataType).alias(c)
    held = rows.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("side"), *rows.columns, *map(null, extra))
    sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("side"), *rows.columns, *extra)
    # vectors of other lengths have no product with each other and lie in blocks of their own
    dealt = held.unionByName(sent).withColumn("width", F.size("v"))
    dealt = dealt.repartition(blocks, "block", "width").sortWithinPartitions("block", "width", "side")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, block = None, [], None
        for batch in batches:
            key = batch.column("block").to_numpy().astype(np.int64) * (1 << 32) + batch.column("width").to_numpy()
            side = batch.column("side").to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (side[1:] != side[:-1])) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if key[a] != now:
                    now, parts, block = key[a], [], None
                piece = batch.slice(a, b - a)
                if side[a] == 0:
                    parts.append((piece.column("vec_id").to_numpy(), piece.column("label").to_numpy(), _matrix(piece.column("v"))))
                elif parts or block:
                    if block is None:
                        block, parts = Block(*(np.concatenate(x) for x in zip(*parts))), []
                    for k in range(0, len(piece), ANCHORS_AT_ONCE):
                        yield from answer(block, piece.slice(k, ANCHORS_AT_ONCE))

    return dealt.mapInArrow(kernel, schema)


def hard_negatives(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows whose id is divisible by ``every``; scores are integer inner products of the quantised vectors. An
    anchor's positives are its first ``positives`` other rows of the same label by score, ties by smaller id. For each,
    the first ``negatives`` rows of other labels with low * positive_score <= 100 * score <= high * positive_score.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part. Vectors of different
    lengths don't meet. Rows that repeat an id count each and are no others of one another; anchors that share an id, but not label
    and vector, are answered each. Components beyond ``MOST`` could overflow a score and are an error. An empty table gives no rows; extra columns are not looked at.
    """
    rows = written(quantised(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col))
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("anchor", F.xxhash64("vec_id", "label", "v")).distinct()

    def answered(names: list[str], rows_of) -> Answer:
        def answer(block: Block, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            mine, anchor, ids, labels = _matrix(batch.column("v")), *(batch.column(c).to_numpy() for c in ("anchor", "vec_id", "label"))
            lower, spread = block.bounds(mine)
            out = []
            for k in range(len(ids)):
                for columns in rows_of(block, batch, k, mine[k], ids[k], labels[k], lower[k], spread[k]):
                    n = max(map(np.size, columns))
                    out.append([np.broadcast_to(np.asarray(c, np.int64), n) for c in (anchor[k], ids[k], *columns)])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)

        return answer

    def nearest(block, batch, k, vector, own, label, lower, spread):
        at = np.flatnonzero((block.labels == label) & (block.ids != own))
        found, scores = block.best(vector, at, lower, spread, positives)
        if len(found):
            yield found, scores

    def windowed(block, batch, k, vector, own, label, lower, spread):
        at = np.flatnonzero(block.labels != label)
        for p in batch.column("chosen")[k].as_py():
            score = p["positive_score"]
            found, scores = block.best(vector, at, lower, spread, negatives, -(-low * score // 100), high * score // 100)
            if len(found):
                yield p["positive_id"], score, found, scores

    def first(frame: DataFrame, by: list[str], score: str, id_: str, most: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc(score), id_)
        return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    def over(asked: DataFrame, names: list[str], rows_of) -> DataFrame:
        return _over_blocks(rows, asked, answered(names, rows_of), ", ".join(f"{n} long" for n in names), block_rows)

    near = first(over(anchors, ["anchor", "anchor_id", "positive_id", "positive_score"], nearest), ["anchor", "anchor_id"], "positive_score", "positive_id", positives)
    chosen = near.groupBy("anchor", F.col("anchor_id").alias("vec_id")).agg(F.collect_set(F.struct("positive_id", "positive_score")).alias("chosen"))
    asked = anchors.join(chosen, ["anchor", "vec_id"])
    found = over(asked, ["anchor", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"], windowed)
    ranked = first(found, ["anchor", "anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
