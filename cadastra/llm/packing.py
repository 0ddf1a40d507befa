"""Packing of tokenized documents into windows by Karmarkar-Karp multiway differencing.

A task tokenizes its documents as they stream by. Full windows are cut off at once; what remains of each document
is cut into pieces and waits with others until ``GROUP_PIECES`` have gathered, then they are packed and handed
out, so a task holds a bounded number of pieces and nothing is shuffled. Differencing keeps partial partitions of
the group: at first each holds one piece for each window, largest pieces together; the two with the largest
imbalance are merged again and again, the fullest windows of one with the emptiest of the other. If a window then
exceeds its capacity, the window count rises and the group is partitioned anew.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import text_slices

#: Pieces that are packed together.
GROUP_PIECES = 4096
#: Tokens of a piece at most, unless it fills a window.
PIECE_TOKENS = 256
#: Fixed value: how byte-level tokenizers split a text before merging.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of texts, as bytes of little-endian unsigned 32-bit integers.

    The ids are those of the tokenizer file. Most of the time that its library takes goes into splitting a text
    and describing tokens, not into merging. So where the file is a plain byte-level vocabulary whose ids follow
    its merges, the same merges run in an engine that knows nothing but ids; texts that hold one of the file's
    added tokens, and all texts of other files, go through the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.added = [t["content"] for t in described["added_tokens"]]
        self.ranks = _ranks(described)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.ranks is None:
            return [self.whole(t) for t in texts]
        by_rank = self.ranks.encode_to_numpy
        return [self.whole(t) if any(a in t for a in self.added) else by_rank(t, disallowed_special=()).astype("<u4", copy=False).tobytes() for t in texts]


def _ranks(described: dict):
    """An engine with the merges of a tokenizer file, or None if their order doesn't say all about it."""
    split, model = described["pre_tokenizer"] or {}, described["model"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not described["normalizer"] and model["type"] == "BPE"
    if not plain or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in {a["content"] for a in described["added_tokens"]}}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if len(vocabulary) != 256 + len(merges) or any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    # the format's letters: printable bytes stand for themselves, the others follow from 256 on
    letters = {chr(b): b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b}
    letters |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(letters.values())))}
    return tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks={bytes(letters[c] for c in t): i for t, i in vocabulary.items()}, special_tokens={})


def differenced(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums of the windows, members: a row of piece numbers for each window, -1 where there is none)."""
    order = np.argsort(-sizes, kind="stable")
    order = np.concatenate([order, np.full(-len(order) % windows, -1)]).reshape(-1, windows)
    heap = []
    for k, layer in enumerate(order):
        sums = np.where(layer >= 0, sizes[layer], 0)
        heap.append((-int(sums.max() - sums.min()), k, sums, layer[:, None]))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, others, more = heapq.heappop(heap)
        fullest, emptiest = np.argsort(-sums, kind="stable"), np.argsort(others, kind="stable")
        sums = sums[fullest] + others[emptiest]
        members = np.hstack([members[fullest], more[emptiest]])
        heapq.heappush(heap, (-int(sums.max() - sums.min()), serial, sums, members))
        serial += 1
    return heap[0][2], heap[0][3]


def near_equal(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Piece numbers of each window; no window exceeds ``capacity``, and no piece may."""
    if not len(sizes):
        return []
    windows = -(-int(sizes.sum()) // capacity)
    while True:
        sums, members = differenced(sizes, windows)
        if sums.max() <= capacity:
            return [[i for i in row if i >= 0] for row in members.tolist()]
        windows += 1


def _kernel(path: str, capacity: int, end_id: int, with_ids: bool):
    types = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})
    schema = pa.schema(list(types.items()))
    end = np.array([end_id], "<u4").tobytes()

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        sequence = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []
        done: list[tuple] = []

        def pack() -> None:
            nonlocal sequence
            for window in near_equal(np.array([p[2] for p in waiting], np.int64), capacity):
                at = 0
                for i in window:
                    done.append((*waiting[i], sequence, at))
                    at += waiting[i][2]
                sequence += 1
            waiting.clear()

        def table() -> pa.RecordBatch:
            columns = [list(x) for x in zip(*done)]
            crcs = [zlib.crc32(x) for x in columns[3]]
            out = [pa.array(x, pa.int64()) for x in (columns[0], columns[1], columns[2], crcs, columns[4], columns[5], columns[6])]
            if with_ids:
                values = np.frombuffer(b"".join(columns[3]), "<u4").view(np.int32)
                out.append(pa.ListArray.from_arrays(np.cumsum([0, *columns[2]]).astype(np.int32), values))
            done.clear()
            return pa.RecordBatch.from_arrays(out, schema=schema)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, data, offsets in text_slices(batch.column(1)):
                bounds = offsets.tolist()
                texts = [data[a:b].decode() for a, b in zip(bounds, bounds[1:])]
                for name, raw in zip(names[row:], encode(texts)):
                    raw += end
                    total = len(raw) // 4
                    full = total - total % capacity
                    for at in range(0, full, capacity):
                        done.append((name, at, capacity, raw[4 * at : 4 * (at + capacity)], total, sequence, 0))
                        sequence += 1
                    for at in range(full, total, PIECE_TOKENS):
                        size = min(PIECE_TOKENS, total - at)
                        waiting.append((name, at, size, raw[4 * at : 4 * (at + size)], total))
                    if len(waiting) >= GROUP_PIECES:
                        pack()
                    if len(done) >= 20_000:
                        yield table()
            if done:
                yield table()
        pack()
        if done:
            yield table()

    return kernel, ", ".join(f"{k} {'array<int>' if k == 'ids' else 'long'}" for k in types)


def pack(documents: DataFrame, *, tokenizer: str, capacity: int = 1024, end_id: int = 0, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked, ids.

    ``tokenizer`` is a file of the tokenizers library with a byte-level vocabulary, found at that path on every
    executor; ``end_id`` follows each document's ids. Every id lies in one piece, and no sequence exceeds
    ``capacity``. A null or empty text is its end id alone. Null and repeated doc_ids are packed like others.
    An empty table gives no rows. Extra columns are not looked at.
    """
    if capacity < PIECE_TOKENS:
        raise ValueError(f"a window holds {PIECE_TOKENS} tokens at least")
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(*_kernel(tokenizer, capacity, end_id, with_ids))
