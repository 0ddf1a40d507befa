"""Near-duplicate passages by compact windows.

Tokens are runs of five words. Under one hash function the Cartesian tree over a text's token hashes has a node
for each position c, whose range [l, r] is where c holds the least hash: all subsequences i to j with
l <= i <= c <= j <= r share that min-hash. Nodes with a range of at least a passage's tokens are compact windows;
they are found without building the tree's other nodes, from sliding minima and nearest smaller values.

Windows of equal hash nominate pairs of texts in two phases, and their ends in a third:

1. Within a hash's group each text meets the one of the least id. A pair's windows are joined as intervals over
   all hash functions and give the ranges to look at, if ``ENOUGH`` functions agree; there, the texts' tokens are
   aligned, and a passage counts if its token sets reach the similarity. Most copies are explained that way.
2. A window that no verified passage covers, or that is covered by passages of another class than a member of its
   group, meets all members of its group, narrowed by a second token ``ASIDE`` tokens away. Members come with their
   tokens around the window, and a task compares the others by their numbers of common tokens
   before it aligns them. Groups beyond ``BLOCK`` members are dealt into blocks of which every two meet. Those of many
   blocks first lose members that share too few tokens with the rest, as partial quotes do, which changes nothing but
   their cost. No group is cut.

3. Where a verified passage of a text ends, others may go on with it: texts that have the same token across the end of
   theirs are sorted by what follows there (or precedes), and neighbours in that order are aligned. A text's longest
   common continuation is with a neighbour, so a passage that two texts share beyond what a third has is found whole.

Two passages with the same tokens have the same windows, so they meet for certain in phase 2 at the latest. One of
fifty words with a changed word is missed if no function has its window and the token aside within what is alike, in
under one of a hundred cases; longer ones hold more windows.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import SLICE_BYTES, SPACED, Words, checkpoint, discard, fresh, grams, mix32, mix64, release, squeezed, text_slices, unsqueezed, words_of, written
from cadastra.llm.graph import components

#: Hash functions, and how many must nominate a pair in the first phase.
HASHES, ENOUGH = 5, 2
#: Tokens from a window's least one to those that narrow its key.
ASIDE = 22
#: Diagonals that neighbours of an alignment may lie apart, unless more than one token follows there.
GAP = 14
#: Members of a group that one task compares with the least text.
TASK_MEMBERS = 64
#: Members of a narrowed group that one task compares with each other, and pairs of them that it holds at once.
BLOCK, PAIRS = 2048, 1 << 20
#: Blocks of a group from which on members without a partner are looked for ahead of it.
MANY_BLOCKS = 16


def _doubled(values: np.ndarray, most: int, pick) -> list[np.ndarray]:
    """``pick`` (minimum or maximum) over each run of 1, 2, 4 ... values, up to 2 ** ``most``."""
    levels = [values]
    while len(levels) <= most and len(levels[-1]) > 1 << (len(levels) - 1):
        half = 1 << (len(levels) - 1)
        levels.append(pick(levels[-1][:-half], levels[-1][half:]))
    return levels


def _sliding(levels: list[np.ndarray], size: int, pick) -> np.ndarray:
    """``pick`` over each run of ``size`` values: two runs of a power of two that overlap."""
    k = size.bit_length() - 1
    over = size - (1 << k)
    return pick(levels[k][: len(levels[k]) - over], levels[k][over:])


def _centres(levels: list[np.ndarray], owner: np.ndarray, least: int) -> np.ndarray:
    """Places that hold the least value of a run of ``least`` tokens of their text; of equal values all."""
    values, lowest = levels[0], _sliding(levels, least, np.minimum)
    lowest[owner[: len(lowest)] != owner[least - 1 :]] = 0  # such a run belongs to no text
    pad = np.zeros(least - 1, values.dtype)
    highest = _doubled(np.concatenate([pad, lowest, pad]), least.bit_length() - 1, np.maximum)
    return np.flatnonzero(values == _sliding(highest, least, np.maximum))


def compact_windows(values: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of the nodes with at least ``least`` tokens in the Cartesian trees of texts end to end.

    Of equal values the first is the upper node. ``values`` are unsigned and above 0. The nearest smaller value beside
    such a node is least in a run that reaches over the node's range, so ranges follow from the centres alone.
    """
    empty = (np.empty(0, np.int64),) * 3
    if len(values) < least:
        return empty
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    centre = _centres(_doubled(values, least.bit_length() - 1, np.minimum), owner, least)
    if not len(centre):
        return empty
    of, own = owner[centre], values[centre]
    texts = np.searchsorted(of, np.arange(len(bounds)))
    low, high = texts[of], texts[of + 1]  # each text's centres
    levels = _doubled(own, int(np.diff(texts).max()).bit_length(), np.minimum)
    left, right = np.arange(len(centre)), np.arange(len(centre))
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        ok = left - step >= low
        ok[ok] = levels[k][left[ok] - step] > own[ok]
        left[ok] -= step
        ok = right + step < high
        ok[ok] = levels[k][right[ok] + 1] >= own[ok]
        right[ok] += step
    l = np.where(left > low, centre[np.maximum(left, 1) - 1] + 1, bounds[of])
    r = np.where(right + 1 < high, centre[np.minimum(right + 1, len(centre) - 1)] - 1, bounds[of + 1] - 1)
    wide = r - l + 1 >= least
    return l[wide], centre[wide], r[wide]


def tokens_of(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the runs of n words within each text, bounds of the texts among them)."""
    every = grams(words.hashes, n)
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    inside = owner[: len(every)] == owner[n - 1 :] if len(every) else np.empty(0, bool)
    return every[inside], np.concatenate([[0], np.cumsum(np.maximum(np.diff(words.first) - n + 1, 0))])


def _hashed(tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each hash function's values of the tokens."""
    folded = (tokens ^ (tokens >> np.uint64(32))).astype(np.uint32)
    for k in range(HASHES):
        yield k, np.maximum(mix32(folded + np.uint32(0x1B873593 * (k + 1) & 0xFFFFFFFF)), 1)


def _keyed(tokens: np.ndarray, k) -> np.ndarray:
    """Keys of the tokens under hash function k (one, or one for each); its number is in the lowest bits."""
    return (mix64(tokens + np.asarray(k, np.uint64)) & ~np.uint64(7) | np.asarray(k, np.uint64)).view(np.int64)


def _keys(n: int, least: int):
    """(id, text) -> (key, id) of all compact windows, once for each text: what is needed to find shared keys."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, data, offsets in text_slices(batch.column(1)):
                tokens, bounds = tokens_of(words_of(data, offsets, SPACED), n)
                if len(tokens) < least:
                    continue
                owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                for k, values in _hashed(tokens):
                    c = _centres(_doubled(values, least.bit_length() - 1, np.minimum), owner, least)
                    c = c[np.sort(_first_of_runs(owner[c], tokens[c], c, least)[0])]
                    if len(c):
                        yield pa.RecordBatch.from_arrays([pa.array(_keyed(tokens[c], k)), pa.array(ids[row + owner[c]])], names=["key", "id"])

    return kernel, "key long, id long"


def _first_of_runs(owner: np.ndarray, tokens: np.ndarray, c: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, run): where a token recurs in a text at steps of at most ``reach``, the windows of one run are as one.
    ``order`` has the first window of each run; ``run`` has the number of the run of each window."""
    order = np.lexsort((c, tokens, owner))
    if not len(order):
        return order, order
    o, t, at = owner[order], tokens[order], c[order]
    begins = np.ones(len(order), bool)
    begins[1:] = (o[1:] != o[:-1]) | (t[1:] != t[:-1]) | (at[1:] - at[:-1] > reach)
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(begins) - 1
    return order[begins], run


def _windows(n: int, least: int):
    """(id, text) -> key, id, c, l, r, left, right: the last two are hashes of tokens aside, 0 beyond the text.

    A token that recurs at short steps, as in a text that repeats a word, gives one row: its first c, all their range.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, data, offsets in text_slices(batch.column(1)):
                tokens, bounds = tokens_of(words_of(data, offsets, SPACED), n)
                folded = (tokens ^ (tokens >> np.uint64(32))).astype(np.uint32)
                for k, values in _hashed(tokens):
                    l, c, r = compact_windows(values, bounds, least)
                    if not len(c):
                        continue
                    owner = np.searchsorted(bounds, c, "right") - 1
                    kept, run = _first_of_runs(owner, tokens[c], c, least)
                    low, high = np.full(len(kept), np.iinfo(np.int64).max), np.zeros(len(kept), np.int64)
                    np.minimum.at(low, run, l)
                    np.maximum.at(high, run, r)
                    c, owner = c[kept], owner[kept]
                    begin = bounds[owner]
                    sides = []
                    for side in (-ASIDE, ASIDE):
                        inside = (c + side >= begin) & (c + side < bounds[owner + 1])
                        sides.append(np.where(inside, folded[np.clip(c + side, 0, len(folded) - 1)], 0).view(np.int32))
                    columns = [_keyed(tokens[c], k), ids[row + owner], *((x - begin).astype(np.int32) for x in (c, low, high)), *sides]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "id", "c", "l", "r", "left", "right"])

    return kernel, "key long, id long, c int, l int, r int, left int, right int"


def shared_passages(a: np.ndarray, b: np.ndarray, least: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(begin, end, begin, end) in tokens of ``a`` and ``b``, ends excluded: stretches of ``b`` of at least ``least``
    tokens that are like such a stretch of ``a``: 100 * intersection >= percent * union of their token sets."""
    known, first = np.unique(a, return_index=True)
    if not len(known) or len(b) < least:
        return []
    near = np.minimum(np.searchsorted(known, b), len(known) - 1)
    at = np.flatnonzero(known[near] == b)
    if not len(at):
        return []
    place = first[near[at]]
    if len(known) == len(a):
        return _aligned(a, b, at, place, least, percent)
    place = _continued(a, b, at, place)
    found = _aligned(a, b, at, place, least, percent)
    if np.any(np.diff(place) < 0):
        # a token that recurs more often in one text leads the places astray; from the other end they meet again
        last = len(a) - 1 - np.unique(a[::-1], return_index=True)[1]
        back = len(a) - 1 - _continued(a[::-1], b[::-1], len(b) - 1 - at[::-1], len(a) - 1 - last[near[at]][::-1])[::-1]
        found += [x for x in _aligned(a, b, at, back, least, percent) if x not in found]
    return found


def _aligned(a: np.ndarray, b: np.ndarray, at: np.ndarray, place: np.ndarray, least: int, percent: int) -> list[tuple[int, int, int, int]]:
    """``shared_passages`` where the tokens of ``b`` at ``at`` are those of ``a`` at ``place``."""
    diagonal = place - at
    if len(at) > 2:  # a token by itself on a far diagonal is no part of what is around it
        jump = np.ones(len(at) + 1, bool)
        jump[1:-1] = np.abs(diagonal[1:] - diagonal[:-1]) > GAP
        near = ~(jump[1:] & jump[:-1])
        at, place = at[near], place[near]
    cut = np.flatnonzero(np.diff(place) < 0) + 1
    out: list[tuple[int, int, int, int]] = []
    parts = list(zip([0, *cut.tolist()], [*cut.tolist(), len(at)]))
    while parts:
        i, j = parts.pop()
        if j - i < 2:
            continue
        x, y, begin, end = int(place[i]), int(place[j - 1]) + 1, int(at[i]), int(at[j - 1]) + 1
        if end - begin >= least and y - x >= least and _alike(a[x:y], b[begin:end], percent):
            out.append((x, y, begin, end))
            continue
        # matches u to v reach the similarity if score[v] >= score[u] + percent - 100; of each v the first such u
        score = (100 + percent) * np.arange(j - i) - percent * (place[i:j] + at[i:j])
        u = np.searchsorted(-np.minimum.accumulate(score), -(score + 100 - percent))
        v = int(np.argmax(np.arange(j - i) - u))
        u, v = i + int(u[v]), i + v
        x, y = _widened(int(place[u]), int(place[v]) + 1, least, len(a))
        begin, end = _widened(int(at[u]), int(at[v]) + 1, least, len(b))
        if end - begin < least:
            continue
        if _alike(a[x:y], b[begin:end], percent):
            out.append((x, y, begin, end))
            parts += [(i, u), (v + 1, j)]
        else:
            out += _by_windows(a, b, at, place, i, j, least, percent)
    return out


def _by_windows(a, b, at, place, i: int, j: int, least: int, percent: int) -> list[tuple[int, int, int, int]]:
    """The passages of ``least`` tokens among matches i to j, adjoining ones as one: where tokens recur, positions that
    match are no measure of sets that do."""
    begin, end = int(at[i]), int(at[j - 1]) + 1
    starts = np.arange(begin, end - least + 1)
    low, high = np.searchsorted(at[i:j], starts) + i, np.searchsorted(at[i:j], starts + least) + i
    common = high - low
    span = np.maximum(place[np.maximum(high, 1) - 1] - place[np.minimum(low, len(at) - 1)] + 1, least)
    guess = starts[(common > 0) & ((100 + percent) * common >= percent * (least + span))]
    out = []
    for p, q in _merged(guess, least):
        for p_, q_ in [(p, q)] if _check(a, b, at, place, i, j, p, q, least, percent) else _merged(
            np.array([k for k in range(p, q - least + 1) if _check(a, b, at, place, i, j, k, k + least, least, percent)], np.int64), least
        ):
            inner = np.searchsorted(at[i:j], [p_, q_]) + i
            u, v = _widened(int(place[inner[0]]), int(place[inner[1] - 1]) + 1, least, len(a))
            out.append((u, v, p_, q_))
    return out


def _continued(a: np.ndarray, b: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of a's places of each token of b that a has, the one that goes on from the place before, if it is there."""
    source, wanted, places = a.tolist(), b[at].tolist(), at.tolist()
    out, last, before = place.tolist(), None, 0
    for k, token in enumerate(wanted):
        if last is not None:
            on = last + places[k] - before
            if on < len(source) and source[on] == token:
                out[k] = on
        last, before = out[k], places[k]
    return np.array(out, np.int64)


def _merged(starts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """The stretches that windows of ``least`` tokens from ``starts`` cover, overlapping ones as one."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > least) + 1
    firsts, lasts = np.concatenate([[0], cut]), np.concatenate([cut, [len(starts)]]) - 1
    return [(int(starts[p]), int(starts[q]) + least) for p, q in zip(firsts, lasts)]


def _check(a, b, at, place, i: int, j: int, begin: int, end: int, least: int, percent: int) -> bool:
    low, high = np.searchsorted(at[i:j], [begin, end]) + i
    if low >= high:
        return False
    u, v = _widened(int(place[low]), int(place[high - 1]) + 1, least, len(a))
    return _alike(a[u:v], b[begin:end], percent)


def _widened(begin: int, end: int, least: int, size: int) -> tuple[int, int]:
    """At least ``least`` tokens, where the text has so many: both stretches are passages."""
    if end - begin < least:
        end = min(size, begin + least)
        begin = max(0, end - least)
    return begin, end


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    a, b = _distinct(a), _distinct(b)
    both = np.concatenate([a, b])
    both.sort()
    common = np.count_nonzero(both[1:] == both[:-1])
    return 100 * common >= percent * (len(a) + len(b) - common)


def _distinct(tokens: np.ndarray) -> np.ndarray:
    """The distinct tokens of a stretch, sorted: for a few hundred, ``np.unique`` takes longer."""
    ordered = np.sort(tokens)
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return ordered[new]


_SPAN = pa.schema([("hub", pa.int64()), ("id", pa.int64()), ("text_hash", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("first", pa.bool_())])


def _cut(n: int):
    """(task, role, hub, id, text_hash, from, to, squeezed text) -> the same with the words of tokens from to to."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            out = []
            for raw, begin, end in zip(unsqueezed(batch.column(7)), batch.column(5).to_pylist(), batch.column(6).to_pylist()):
                if begin or end < len(raw) // 2:
                    lowered = raw.translate(SPACED).split(None, end + n)
                    raw = b" ".join(lowered[begin : end + n])
                out.append(pack(raw))
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(out, pa.binary())], names=batch.schema.names)

    return kernel, "task long, role int, hub long, id long, text_hash long, from int, to int, text binary"


def _verified(n: int, least: int, percent: int):
    """What ``_cut`` gives, a task's rows in a row and its hub (role 0) ahead, to passages in words."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, hubs = None, []
        for batch in batches:
            tasks, roles, hub_ids, ids, prints, begins = (batch.column(k).to_pylist() for k in range(6))
            out = []
            for i, own in enumerate(_batched(unsqueezed(batch.column(7)), n)):
                if tasks[i] != task:
                    task, hubs = tasks[i], []
                if roles[i] == 0:
                    hubs.append((prints[i], begins[i], own.copy()))
                    continue
                for print_, at, hub in hubs:
                    for x, y, begin, end in shared_passages(hub, own, least, percent):
                        out.append((hub_ids[i], ids[i], prints[i], begin + begins[i], end + begins[i] + n - 1, False))
                        out.append((hub_ids[i], hub_ids[i], print_, x + at, y + at + n - 1, True))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SPAN)], schema=_SPAN)

    return kernel, "hub long, id long, text_hash long, begin long, end long, first boolean"


def _batched(texts: Iterator[bytes], n: int) -> Iterator[np.ndarray]:
    """The tokens of each text, found for many texts at once."""
    held: list[bytes] = []
    size = 0
    for raw in texts:
        held.append(raw)
        size += len(raw)
        if size >= SLICE_BYTES:
            yield from _cut_up(held, n)
            held, size = [], 0
    if held:
        yield from _cut_up(held, n)


def _cut_up(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    tokens, bounds = tokens_of(words_of(b"".join(texts), np.cumsum([0, *map(len, texts)]), SPACED), n)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield tokens[a:b]


def _several(rows: DataFrame) -> DataFrame:
    """(key) of those that windows of different texts have."""
    return rows.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("last")).where("least <> last").select("key")


def passages(documents: DataFrame, *, n: int = 5, words: int = 50, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(hub, id, text_hash, begin, end, first): verified passages in words, two rows for each pair that shares one.

    A passage has at least ``words`` words. ``first`` rows are those of the text with the lesser id. Null, empty and
    short texts have no passages, and rows with a null id take no part. Rows that repeat an id are told apart by
    ``text_hash``, and what they share among themselves doesn't count. Extra columns are not looked at.
    """
    spark, least = documents.sparkSession, words - n + 1
    docs = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keys = written(_several(docs.mapInArrow(*_keys(n, least))))
    release(spark)
    rows = written(docs.mapInArrow(*_windows(n, least)).join(keys, "key"))
    discard(keys)
    release(spark)
    # the least id of a key is its hub
    heads = rows.groupBy("key").agg(F.min(F.struct("id", "l")).alias("low"), F.min(F.struct("id", -F.col("r"))).alias("high"))
    heads = written(heads.select("key", F.col("low.id").alias("hub"), F.col("low.l").alias("hub_l"), (-F.col("high").getField("col2")).alias("hub_r")))
    met = rows.join(heads, "key").where("id > hub")
    # the interval join: what the windows of all hash functions say about a pair
    function = F.col("key").bitwiseAND(F.lit(7)).cast("int")
    pairs = met.groupBy("hub", "id").agg(
        F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), function))).alias("hashes"), F.min("l").alias("from"), F.max("r").alias("to"), F.min("hub_l").alias("hub_from"), F.max("hub_r").alias("hub_to")
    )
    pairs = checkpoint(pairs.where(F.col("hashes") >= ENOUGH))
    held = written(squeezed(docs.withColumn("text_hash", F.xxhash64("text")), "text"))
    spans = _paired(pairs, held, n, least, percent)
    more = _second_phase(held, rows, heads, spans, n, least, percent)
    found = spans.unionByName(more)
    return found.unionByName(_extended(held, found, n, least, percent)).distinct()


def _paired(pairs: DataFrame, held: DataFrame, n: int, least: int, percent: int) -> DataFrame:
    """Spans of ``pairs`` (hub, id, from, to, hub_from, hub_to: tokens to look at), some members of a hub to a task."""
    parts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / TASK_MEMBERS).alias("parts"))
    tasks = checkpoint(pairs.join(parts, "hub").withColumn("task", F.xxhash64("hub", F.pmod(F.xxhash64("id", F.lit(5)), F.col("parts")))))
    ids = written(tasks.select("id").unionByName(tasks.select(F.col("hub").alias("id"))).distinct())
    texts = written(held.join(ids, "id", "left_semi"))
    release(held.sparkSession)
    members = tasks.join(texts, "id").select("task", F.lit(1).alias("role"), "hub", "id", "text_hash", "from", "to", "text")
    ahead = tasks.groupBy("task", "hub").agg(F.min("hub_from").alias("from"), F.max("hub_to").alias("to")).join(texts.withColumnRenamed("id", "hub"), "hub")
    ahead = ahead.select("task", F.lit(0).alias("role"), "hub", F.col("hub").alias("id"), "text_hash", "from", "to", "text")
    dealt = members.unionByName(ahead).mapInArrow(*_cut(n)).repartition("task").sortWithinPartitions("task", "role", "hub", "id")
    spans = written(dealt.mapInArrow(*_verified(n, least, percent)))
    discard(ids, texts)
    release(held.sparkSession)
    return spans


def _extended(held: DataFrame, found: DataFrame, n: int, least: int, percent: int) -> DataFrame:
    """Spans of texts that go on alike where spans in ``found`` end, in pairs that it has not.

    Ends with the same token across them are sorted by the tokens that follow, away from the span, and each is paired
    with the one before it. A pair is aligned from two passages' lengths ahead of the end on.
    """
    lists = found.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    ends = held.join(lists, ["id", "text_hash"]).select("id", "text", "spans").mapInArrow(*_ends(n, least))
    ends = written(ends)
    shared = ends.groupBy("edge").agg(F.min("id").alias("least"), F.max("id").alias("last")).where("least <> last").select("edge")
    rows = ends.join(shared, "edge")
    order = Window.partitionBy("edge").orderBy("onward", "id", "from", "to")
    before = F.lag(F.struct("id", "from", "to")).over(order)
    near = rows.select("id", "from", "to", before.alias("before")).where("before IS NOT NULL AND before.id <> id")
    first, second = F.struct("id", "from", "to"), F.col("before")
    low, high = F.when(F.col("before.id") < F.col("id"), second).otherwise(first), F.when(F.col("before.id") < F.col("id"), first).otherwise(second)
    near = near.select(low.alias("a"), high.alias("b"))
    pairs = near.groupBy(F.col("a.id").alias("hub"), F.col("b.id").alias("id")).agg(F.min("b.from").alias("from"), F.max("b.to").alias("to"), F.min("a.from").alias("hub_from"), F.max("a.to").alias("hub_to"))
    known = found.where("NOT first").select("hub", "id").distinct()
    pairs = checkpoint(pairs.join(known, ["hub", "id"], "left_anti"))
    spans = _paired(pairs, held, n, least, percent)
    discard(ends)
    return spans


def _ends(n: int, least: int):
    """(id, squeezed text, spans) -> edge, id, from, to, onward: for each end of a span, unless another one covers it and a passage
    beyond, the n words across it with its side, the tokens to look at, and the words from there on, away from the span, as many as a passage has tokens."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spans = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out = []
            for i, raw in enumerate(unsqueezed(batch.column(1))):
                words = raw.translate(SPACED).split()
                last = len(words) - n  # the last token
                begins = [s["begin"] for s in spans[i]]
                reach = list(itertools.accumulate((s["end"] for s in spans[i]), max))  # of the spans up to each, they go by begin

                def open_(begin: int, end: int, begins=begins, reach=reach) -> bool:
                    k = bisect.bisect_right(begins, begin)
                    return not k or reach[k - 1] < end

                for at in {s["begin"] - 1 for s in spans[i] if 0 < s["begin"] <= last + 1 and open_(s["begin"] - 1 - least, s["begin"] - 1 + n)}:
                    onward = words[max(0, at - least + 1) : at + 1]
                    out.append((_edge(words[at : at + n], 0), ids[i], 0, min(last, at + 2 * least), onward[::-1]))
                for at in {s["end"] - n + 1 for s in spans[i] if n <= s["end"] <= last + n - 1 and open_(s["end"] - n + 1, s["end"] + 1 + least)}:
                    out.append((_edge(words[at : at + n], 1), ids[i], max(0, at - 2 * least), last, words[at + n : at + n + least]))
            for low in range(0, len(out), 8192):
                *columns, onward = zip(*out[low : low + 8192])
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, onward)], dtype=np.int32), pa.array([zlib.crc32(w) for ws in onward for w in ws], pa.int64()).cast(pa.int32(), safe=False))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns, _END)), lists], schema=_END)

    return kernel, "edge long, id long, from int, to int, onward array<int>"


_END = pa.schema([("edge", pa.int64()), ("id", pa.int64()), ("from", pa.int32()), ("to", pa.int32()), ("onward", pa.list_(pa.int32()))])


def _edge(words: list[bytes], side: int) -> int:
    """The words across an end and the side of the span that it is, as a signed number."""
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), side)).view(np.int64))


def _second_phase(held: DataFrame, rows: DataFrame, heads: DataFrame, spans: DataFrame, n: int, least: int, percent: int) -> DataFrame:
    """Spans of the pairs of texts in a narrowed group that ``spans`` leaves open: a window of one is in no span, or
    the texts belong to different classes."""
    spark = held.sparkSession
    # a text's class is known by the least text it leads to in a few steps; two names for one class cost comparisons only
    texts = spans.where("NOT first").groupBy("id").agg(F.min("hub").alias("root"), F.collect_set(F.struct("begin", "end")).alias("spans"))
    for _ in range(2):
        up = texts.select(F.col("id").alias("root"), F.col("root").alias("above"))
        texts = checkpoint(texts.join(up, "root", "left").select("id", F.coalesce("above", "root").alias("root"), "spans"))
    inside = F.coalesce(F.exists("spans", lambda s: (F.col("c") >= s["begin"]) & (F.col("c") < s["end"])), F.lit(False))
    flagged = rows.join(heads.select("key", "hub"), "key").join(texts, "id", "left")
    flagged = first = written(flagged.select("key", "id", "c", "left", "right", (inside | (F.col("id") == F.col("hub"))).alias("known"), F.coalesce("root", "id").alias("root")))

    def open_(by: str, frame: DataFrame) -> DataFrame:
        groups = frame.groupBy(by).agg(F.count(F.lit(1)).alias("size"), F.bool_and("known").alias("all_known"), *(f(x).alias(f"{x}_{k}") for x in ("id", "root") for k, f in enumerate((F.min, F.max))))
        return groups.where("id_0 <> id_1 AND (NOT all_known OR root_0 <> root_1)").select(by, "size")

    flagged = flagged.join(open_("key", flagged).select("key"), "key")
    sides = F.array(*(F.when(F.col(s) != 0, F.struct(F.xxhash64("key", F.lit(s), s).alias("sub"), F.lit(s == "right").alias("after"))) for s in ("left", "right")))
    flagged = flagged.select("key", "id", "c", "known", "root", F.explode(F.array_compact(sides)).alias("side"))
    flagged = written(flagged.select("side.sub", "side.after", "key", "id", "c", "known", "root"))
    discard(first, rows, heads)
    groups = open_("sub", flagged).select("sub", F.ceil(F.col("size") / BLOCK).alias("parts"))
    live = written(flagged.join(groups, "sub"))
    discard(flagged)
    texts = written(held.join(live.select("id").distinct(), "id", "left_semi"))
    release(spark)

    def contexts(asked: DataFrame) -> DataFrame:
        lists = asked.groupBy("id").agg(F.collect_list(F.struct("sub", "after", "key", "c", "known", "root", "parts")).alias("asked"))
        return texts.join(lists, "id").select("id", "text_hash", "text", "asked").mapInArrow(*_contexts(n, least))

    dealt = _blocks(contexts(live.where(F.col("parts") <= MANY_BLOCKS)))
    if not (large := live.where(F.col("parts") > MANY_BLOCKS)).isEmpty():
        dealt = dealt.unionByName(_blocks(_able(written(contexts(large)), percent)))
    dealt = dealt.select("task", "sub", "id", "text_hash", "at", "known", "root", "tokens").repartition("task").sortWithinPartitions("task", "sub", "id", "at")
    found = written(dealt.mapInArrow(*_resolved(n, least, percent)))
    discard(live, texts)
    release(spark)
    return found


def _blocks(rows: DataFrame) -> DataFrame:
    """Members of groups in tasks: a group of one block is one, else every two blocks of it."""
    own = F.pmod(F.xxhash64("id", "at"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts").cast("int") - 1), lambda k: F.xxhash64("sub", F.least(own, k), F.greatest(own, k)))
    return rows.withColumn("task", F.explode(F.when(F.col("parts") == 1, F.array("sub")).otherwise(pairs)))


def _able(rows: DataFrame, percent: int) -> DataFrame:
    """Members of large groups that share as many tokens with the rest of their group as a passage asks for."""
    member = ["sub", "id", "at", "text_hash"]
    each = rows.select(*member, F.explode(F.array_distinct(F.filter("tokens", lambda x: x != 0))).alias("token"))
    common = each.groupBy("sub", "token").agg(F.min("id").alias("least_id"), F.max("id").alias("last_id")).where("least_id <> last_id").select("sub", "token")
    shared = each.join(common, ["sub", "token"]).groupBy(*member).agg(F.count(F.lit(1)).alias("shared"))
    kept = rows.join(shared, member).where(F.col("shared") * 100 >= F.col("fewest") * percent).drop("shared")
    return kept.drop("parts").join(kept.groupBy("sub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts")), "sub").select(*rows.columns)


def _folded(tokens: np.ndarray) -> np.ndarray:
    """Tokens in 32 bits, above 0."""
    return np.maximum((tokens ^ (tokens >> np.uint64(32))).astype(np.uint32), 1)


def _repeating(contexts: np.ndarray) -> np.ndarray:
    """The rows that have a token twice."""
    ordered = np.sort(contexts, axis=1)
    return np.flatnonzero(((ordered[:, 1:] == ordered[:, :-1]) & (ordered[:, 1:] != 0)).any(axis=1))


def _fewest(contexts: np.ndarray, least: int, some: np.ndarray) -> np.ndarray:
    """Of each row: the least number of distinct tokens in ``least`` tokens in a row that lie in the text. ``some`` are
    the rows that have a token twice; they are counted all at once, as templates make many of them."""
    out = np.full(len(contexts), least, np.int32)
    for low in range(0, len(some), 1 << 11):
        of = some[low : low + (1 << 11)]
        tokens = contexts[of]
        order = np.argsort(tokens, 1, kind="stable")
        own = np.take_along_axis(tokens, order, 1)
        before = np.full(tokens.shape, -1)  # the place of the same token ahead of each, which is new to a stretch that begins after it
        np.put_along_axis(before, order[:, 1:], np.where(own[:, 1:] == own[:, :-1], order[:, :-1], -1), 1)
        fewest = np.full(len(of), least + 1)
        for k in range(tokens.shape[1] - least + 1):
            within = (tokens[:, k] != 0) & (tokens[:, k + least - 1] != 0)
            fewest = np.where(within, np.minimum(fewest, (before[:, k : k + least] < k).sum(1)), fewest)
        out[of] = np.where(fewest > least, ((before < 0) & (tokens != 0)).sum(1), fewest)
    return out


def _contexts(n: int, least: int):
    """(id, text_hash, squeezed text, asked windows) -> a row for each window with the tokens around it.

    A window narrowed by the token after it looks at the passages that hold both. ``at`` is the place of the first token,
    0 stands for places beyond the text, ``fewest`` for the distinct tokens that a passage there has at least.
    """
    reach, width = least - 1, 2 * least - 1 - ASIDE
    names = ["sub", "id", "text_hash", "at", "known", "root", "parts", "fewest", "tokens"]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(3)
            bounds = asked.offsets.to_numpy()
            fields = {f.name: asked.values.field(f.name).to_numpy(zero_copy_only=False) for f in asked.type.value_type}
            some, first, tokens_, print_ = [], [], [], []
            prints = batch.column(1).to_numpy()
            for i, tokens in enumerate(_batched(unsqueezed(batch.column(2)), n)):
                ask = np.arange(bounds[i], bounds[i + 1])
                c, key = fields["c"][ask].astype(np.int64), fields["key"][ask]
                inside = np.minimum(c, len(tokens) - 1)
                if not len(tokens):
                    continue
                number = (key & 7).astype(np.uint64)
                good = (c < len(tokens)) & (_keyed(tokens[inside], number) == key)  # else it is a window of another text with this id
                ask, c = ask[good], c[good]
                begin = np.where(fields["after"][ask], c + ASIDE - reach, c - reach)
                padded = np.concatenate([np.zeros(reach, np.uint32), _folded(tokens), np.zeros(reach, np.uint32)])
                some.append(ask)
                first.append(begin)
                tokens_.append(padded[begin[:, None] + (np.arange(width) + reach)])
                print_.append(np.full(len(ask), prints[i]))
            if not some:
                continue
            rows, contexts = np.concatenate(some), np.concatenate(tokens_)
            ids = np.repeat(batch.column(0).to_numpy(), np.diff(bounds))[rows - bounds[0]]
            columns = [fields["sub"][rows], ids, np.concatenate(print_), np.concatenate(first).astype(np.int32), *(fields[f][rows] for f in ("known", "root", "parts")), _fewest(contexts, least, _repeating(contexts))]
            for low in range(0, len(rows), 8192):
                part = contexts[low : low + 8192]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, part.size + 1, width, dtype=np.int32)), pa.array(part.reshape(-1).view(np.int32)))
                yield pa.RecordBatch.from_arrays([*(pa.array(x[low : low + 8192]) for x in columns), lists], names=names)

    return kernel, "sub long, id long, text_hash long, at int, known boolean, root long, parts long, fewest int, tokens array<int>"


def _resolved(n: int, least: int, percent: int):
    """Rows of ``_contexts`` with their task, a task's rows in a row, to passages in words."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                if sum(map(len, held)) < 8192:
                    continue
            if not held:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            tasks = rows.column(0).to_numpy()
            whole = len(rows) if batch is None else int(np.flatnonzero(np.diff(tasks, prepend=tasks[0] ^ 1))[-1])  # the last task may go on
            held = [rows.slice(whole)]
            if whole and (out := _compared(rows.slice(0, whole), n, least, percent)):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SPAN)], schema=_SPAN)

    return kernel, "hub long, id long, text_hash long, begin long, end long, first boolean"


def _compared(rows: pa.RecordBatch, n: int, least: int, percent: int) -> list[tuple]:
    """The passages that members of a group (task) share: for each open pair, unless others link the two already and
    cover their windows. Pairs with most in common come first, so that few are aligned in vain."""
    ids, prints, at, known, root = (rows.column(k).to_numpy(zero_copy_only=False) for k in range(2, 7))
    contexts = rows.column(7).flatten().to_numpy().view(np.uint32).reshape(len(ids), -1)
    tasks = rows.column(0).to_numpy()
    begins = np.concatenate([[0], np.flatnonzero(np.diff(tasks)) + 1])
    group = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(tasks)))
    following = np.append(begins[1:], len(tasks))[group] - np.arange(len(tasks)) - 1
    can = _Contexts(contexts, group, len(begins), least, percent)
    kept = []
    totals = np.concatenate([[0], np.cumsum(following)])
    row = 0
    while row < len(tasks):  # some rows at a time, with those after them in their group
        to = max(row + 1, int(np.searchsorted(totals, totals[row] + PAIRS, "right")) - 1)
        many = following[row:to]
        a = np.repeat(np.arange(row, to), many)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
        keep = (ids[a] != ids[b]) & ~(known[a] & known[b] & (root[a] == root[b]))
        a, b = a[keep], b[keep]
        for _ in range(2):
            fits, common = can.hold(a, b)
            a, b, common = b[fits], a[fits], common[fits]
        kept.append((a, b, common))
        row = to
    a, b, common = (np.concatenate(x) for x in zip(*kept))
    parent: dict[tuple, tuple] = {}

    def top(x: tuple) -> tuple:
        while (y := parent.get(x, x)) != x:
            parent[x] = parent.get(y, y)
            x = y
        return x

    out: list[tuple] = []
    covered, roots, names, groups = known.tolist(), root.tolist(), ids.tolist(), group.tolist()
    for k in np.argsort(-common, kind="stable").tolist():
        i, j = sorted((int(a[k]), int(b[k])), key=names.__getitem__)
        one, two = top((groups[i], roots[i])), top((groups[j], roots[j]))
        if covered[i] and covered[j] and one == two:
            continue
        x, y = np.flatnonzero(contexts[i]), np.flatnonzero(contexts[j])
        found = shared_passages(contexts[i][x], contexts[j][y], least, percent)
        for p, q, begin, end in found:
            for m, first, low, high, is_first in ((i, x, p, q, True), (j, y, begin, end, False)):
                shift = int(at[m]) + int(first[0])
                out.append((names[i], names[m], int(prints[m]), low + shift, high + shift + n - 1, is_first))
        if found:
            covered[i] = covered[j] = True
            parent[max(one, two)] = min(one, two)
    return out


class _Contexts:
    """Which tokens each member has, to tell what two members of a group have in common."""

    def __init__(self, contexts: np.ndarray, group: np.ndarray, groups: int, least: int, percent: int):
        self.least, self.percent, self.width = least, percent, contexts.shape[1]
        values, codes = np.unique(group.astype(np.uint64)[:, None] << np.uint64(32) | contexts, return_inverse=True)
        lows = np.searchsorted(values, np.arange(groups + 1, dtype=np.uint64) << np.uint64(32))
        self.codes = codes.reshape(contexts.shape) - lows[group][:, None]  # a group's tokens are numbered from 0
        sizes = np.diff(lows)[group]
        self.base = np.cumsum(sizes) - sizes
        self.has = np.zeros(int(sizes.sum()), bool)
        self.has[(self.base[:, None] + self.codes)[contexts != 0]] = True
        some = _repeating(contexts)
        self.fewest = _fewest(contexts, least, some)
        self.first = np.ones(contexts.shape, bool)  # of equal tokens of a member, one counts
        codes, of = self.codes[some], np.ones((len(some), self.width), bool)
        order = np.argsort(codes, 1, kind="stable")
        np.put_along_axis(of, order[:, 1:], np.diff(np.take_along_axis(codes, order, 1), axis=1) != 0, 1)
        self.first[some] = of
        self.starts, self.ends = np.array([(i, j) for i in range(self.width + 1) for j in range(i + least, self.width + 1)]).T
        self.enough = -(-2 * percent * (self.ends - self.starts) // (100 + percent))

    def hold(self, one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of members: whether they can have a passage, and how many distinct tokens of ``other`` ``one`` has.

        They can if ``other`` has a stretch of ``least`` tokens or more of which enough are anywhere in ``one``; where a member has
        a token twice, if they have enough in common at all.
        """
        least, width, part = self.least, self.width, 100 + self.percent
        spare = width * (100 - self.percent) // part + 1  # what the longest stretch may have of its own
        fits, total = np.zeros(len(one), bool), np.zeros(len(one), np.int64)
        for low in range(0, len(one), 1 << 14):
            of = slice(low, low + (1 << 14))
            sums = np.zeros((len(one[of]), width + 1), np.int16)
            inside = self.has[self.base[one[of]][:, None] + self.codes[other[of]]]
            np.cumsum(inside, 1, out=sums[:, 1:])
            total[of] = (inside & self.first[other[of]]).sum(1)
            some = np.flatnonzero((sums[:, least:] - sums[:, : width + 1 - least]).max(1) >= least - spare)
            fits[low + some] = (sums[some][:, self.ends] - sums[some][:, self.starts] >= self.enough).any(1)
        fewest = self.fewest
        simple = (fewest[one] == least) & (fewest[other] == least)
        return np.where(simple, fits, part * total >= self.percent * (fewest[one] + fewest[other])), total


def _covered(spans):
    """Of an array of (begin, end): words in their union."""
    fold = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(F.greatest(s["to"], x["end"]).alias("to"), (s["n"] + F.greatest(x["end"] - F.greatest(s["to"], x["begin"]), F.lit(0).cast("long"))).alias("n")),
    )
    return fold["n"]


def repeated(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, n_links, n_passages, n_repeated), a row for each document with a repeated passage.

    ``class_id`` is the least id reached over shared passages, ``n_links`` the number of documents with which a
    passage was verified, ``n_repeated`` the words in such passages. Options are those of ``passages``.
    """
    found = checkpoint(passages(documents, **options))
    pairs = found.where("NOT first").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    classes = components(pairs)
    links = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.count(F.lit(1)).alias("n_links"))
    texts = found.groupBy("id", "text_hash").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    totals = texts.groupBy("id").agg(F.sum(F.size("spans")).alias("n_passages"), F.sum(_covered(F.col("spans"))).alias("n_repeated"))
    return totals.join(classes, totals["id"] == classes["node"]).join(links, F.col("id") == F.col("a")).select(F.col("id").alias("doc_id"), F.col("root").alias("class_id"), "n_links", "n_passages", "n_repeated")


def remove_repeats(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``documents`` in which a repeated passage stays only in the document of the least id; rows and columns stay."""
    found = passages(documents, id_col=id_col, text_col=text_col, **options)
    ours = {x: fresh(documents.columns, x) for x in ("cut_id", "cut_hash", "cut_spans")}
    cuts = found.where("NOT first").groupBy(F.col("id").alias(ours["cut_id"]), F.col("text_hash").alias(ours["cut_hash"])).agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias(ours["cut_spans"]))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined = documents.join(cuts, (documents[id_col].cast("long") == cuts[ours["cut_id"]]) & (F.xxhash64(text) == cuts[ours["cut_hash"]]), "left").drop(ours["cut_id"], ours["cut_hash"])
    width, text_at, schema = len(documents.columns), documents.columns.index(text_col), documents.schema

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(width).to_pylist()
            texts = batch.column(text_at).to_pylist()
            for i, cut in enumerate(spans):
                if cut:
                    raw = texts[i].encode()
                    words = words_of(raw, np.array([0, len(raw)]), SPACED)
                    out, at = [], 0
                    for s in cut:
                        if s["end"] - 1 < len(words.start):
                            out.append(raw[at : max(at, words.start[s["begin"]])])
                            at = max(at, int(words.end[s["end"] - 1]))
                    texts[i] = b"".join([*out, raw[at:]]).decode()
            columns = list(batch.columns[:width])
            columns[text_at] = pa.array(texts, columns[text_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:width])

    return joined.mapInArrow(kernel, schema)
