"""Near-duplicate documents by circulant MinHash, banding and an exact check.

Two permutations of the 32-bit integers make every signature coordinate: the first scatters a shingle's hash,
the second is applied after adding k, so coordinate k is the least value under the second permutation shifted
circularly by k. Signatures are cut into bands; texts that agree in a band are candidates.

The exact check needs no list of pairs. Candidates that hang together are brought into one group as texts; within
it the links are searched breadth first over an inverted index of shingles, and a text that has been reached is
not compared again. A group beyond ``GROUP_SHINGLES`` is dealt into blocks by hash, and every two blocks meet in
a task of bounded size, so that no link is lost; what such a group reads grows with its number of blocks.
Texts with equal shingle sets are one class from the start and are checked once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import SPACED, checkpoint, fresh, mix32, shingle_sets, text_slices, words_of, written
from cadastra.llm.graph import components

#: Shingles of the texts that one task of the exact check may hold.
GROUP_SHINGLES = 4_000_000
#: Elements of a signature's work array; it stays in the processor's cache.
_BLOCK = 1 << 15
_SEED = np.uint32(0x51ED270B)


def signature(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """(sets, coordinates) uint32. Empty sets get the largest value everywhere."""
    out = np.full((len(sets), coordinates), 0xFFFFFFFF, np.uint32)
    at = 0
    while at < len(sets):
        to, size = at + 1, len(sets[at])
        while to < len(sets) and size + len(sets[to]) <= _BLOCK:
            size += len(sets[to])
            to += 1
        full = [i for i in range(at, to) if len(sets[i])]
        if full:
            every = np.concatenate([sets[i] for i in full])
            starts = np.cumsum([0, *(len(sets[i]) for i in full[:-1])])
            scattered = mix32((every ^ (every >> np.uint64(32))).astype(np.uint32) ^ _SEED)
            for k in range(coordinates):
                out[full, k] = np.minimum.reduceat(mix32(scattered + np.uint32(k)), starts)
        at = to
    return out


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) int64; the number of the band goes into its hash."""
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows).astype(np.uint64)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), parts.shape[:2]).copy()
    for r in range(rows):
        total = (total ^ parts[:, :, r]) * np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


def _signed(n: int, bands: int, rows: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_slices(batch.column(1)):
                sets = shingle_sets(words_of(data, offsets, SPACED), n)
                hashed = band_hashes(signature(sets, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([h.tolist() if len(s) else None for s, h in zip(sets, hashed)], pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    return kernel, "doc_id long, n_shingles long, print binary, bands array<long>"


def linked(ids: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Edges of a forest with the components of the graph in which sets are linked that have
    100 * intersection >= percent * union.

    Breadth first; a set is compared with those not yet reached that share one of its rarest tokens. Linked sets
    share so many tokens that both have one in common among their first ``size - least common + 1`` by rarity.
    """
    sizes = np.array([len(s) for s in sets])
    _, tokens, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(times), np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens = rank[tokens]
    tokens = tokens[np.lexsort((tokens, owner))]  # each set's tokens, the rarest first
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    heads = sizes - -(-percent * sizes // 100) + 1
    ahead = np.arange(len(tokens)) - bounds[owner] < heads[owner]
    open_, marked = np.ones(len(sets), bool), np.zeros(len(times), bool)
    left, indexed = len(sets), 0
    queue: list[int] = []
    nxt = 0
    while left:
        if not queue:
            while not open_[nxt]:
                nxt += 1
            queue.append(nxt)
            open_[nxt] = False
            left -= 1
        if not left:
            break
        if not indexed or left < indexed // 2:  # the index holds the sets not yet reached
            keep = np.flatnonzero(ahead & open_[owner])
            order = np.argsort(tokens[keep], kind="stable")
            by_token, holder = tokens[keep][order], owner[keep][order]
            posting = np.searchsorted(by_token, np.arange(len(times) + 1))
            indexed = left
        node = queue.pop()
        mine = tokens[bounds[node] : bounds[node + 1]]
        some = np.concatenate([holder[posting[t] : posting[t + 1]] for t in mine[: heads[node]].tolist()])
        some = np.unique(some[open_[some]])
        some = some[100 * np.minimum(sizes[some], len(mine)) >= percent * np.maximum(sizes[some], len(mine))]
        if not len(some):
            continue
        marked[mine] = True
        for low in range(0, len(some), 4096):
            part = some[low : low + 4096]
            many = sizes[part]
            starts = np.cumsum(many) - many
            common = np.add.reduceat(marked[tokens[np.repeat(bounds[part] - starts, many) + np.arange(int(many.sum()))]], starts, dtype=np.int64)
            reached = part[100 * common >= percent * (len(mine) + many - common)]
            open_[reached] = False
            left -= len(reached)
            queue.extend(reached.tolist())
            for other in reached.tolist():
                yield ids[node], ids[other]
        marked[mine] = False


def _checked(n: int, percent: int):
    """Rows (task, doc_id, text), a task's rows in a row; out come verified edges."""

    def solve(ids: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        return list(linked(ids, sets, percent)) if len(ids) > 1 else []

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, sets = None, [], []
        for batch in batches:
            tasks, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            edges = []
            for at, data, offsets in text_slices(batch.column(2)):
                for i, s in enumerate(shingle_sets(words_of(data, offsets, SPACED), n)):
                    if tasks[at + i] != task:
                        edges += solve(ids, sets)
                        task, ids, sets = tasks[at + i], [], []
                    if len(s):
                        ids.append(names[at + i])
                        sets.append(s)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], names=["a", "b"])
        if edges := solve(ids, sets):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], names=["a", "b"])

    return kernel


def near_duplicates(documents: DataFrame, *, n: int, percent: int, bands: int, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``documents``.

    Linked are texts whose sets of n-word shingles have 100 * intersection >= percent * union. ``component_id``
    is the least id that can be reached, the own one included; ``kept`` says that it is the own one.
    A null, empty or blank text has an empty set and is linked with nothing. A row with a null id takes no part:
    its component is null and it is kept. Rows that repeat an id are one node with the links of all its texts.
    Extra columns are not looked at. An empty table gives an empty result.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = written(docs.mapInArrow(*_signed(n, bands, rows)))
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = usable.groupBy("print").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    same = usable.select("doc_id", "print").join(classes.select("print", "rep"), "print").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    buckets = classes.select("rep", F.explode("bands").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub <> last").select("bucket", "hub")
    near = buckets.join(hubs, "bucket").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    groups = checkpoint(components(near))

    sized = groups.join(classes.select(F.col("rep").alias("node"), "n"), "node")
    blocks = sized.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(GROUP_SHINGLES / 2)).alias("blocks"), F.sum("n").alias("total"))
    dealt = groups.join(blocks, "root").withColumn("blocks", F.when(F.col("total") <= GROUP_SHINGLES, 1).otherwise(F.greatest(F.lit(2), "blocks")).cast("int"))
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    pairs = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != mine), lambda k: F.least(mine, k).cast("long") * F.col("blocks") + F.greatest(mine, k))
    )
    tasks = dealt.select(F.col("node").alias("doc_id"), F.explode(pairs).alias("pair"), "root").select("doc_id", F.xxhash64("root", "pair").alias("task"))
    gathered = tasks.join(docs.where("doc_id IS NOT NULL"), "doc_id").select("task", "doc_id", "text")
    parts = gathered.repartition("task").sortWithinPartitions("task", "doc_id")
    edges = parts.mapInArrow(_checked(n, percent), "a long, b long")

    every = components(same.unionByName(edges))
    left = signed.select("doc_id", "n_shingles")
    return left.join(every, left.doc_id == every.node, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNull(), True).otherwise(F.coalesce("root", "doc_id") == F.col("doc_id")).alias("kept"),
    )


def drop_near_duplicates(documents: DataFrame, *, n: int = 5, percent: int = 80, bands: int = 36, rows: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with one document of each group; all columns stay. Rows with a null id stay.

    Rows that repeat a kept id all stay, as they are one document to the graph.
    """
    found = near_duplicates(documents, n=n, percent=percent, bands=bands, rows=rows, id_col=id_col, text_col=text_col)
    gone = fresh(documents.columns, "gone_id")
    drop = found.where("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    return documents.join(drop, documents[id_col].cast("long") == drop[gone], "left_anti")
