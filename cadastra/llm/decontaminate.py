"""Benchmark decontamination: a broadcast set of hashed test n-grams is looked up for every training window.

The set is broadcast only where the benchmark's texts stay under ``BROADCAST_BYTES``. A larger benchmark is joined
by window hash instead (``_joined``); the answers are the same. A looked-up window is compared word by word, so
an accidental hash never counts in the broadcast form; the join compares 128 bits of hash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import ALPHANUMERIC, Words, fresh, mix64, text_slices, words_of, written

#: UTF-8 bytes of benchmark text up to which its windows are collected and broadcast.
BROADCAST_BYTES = 16 << 20
_BASE = np.uint64(0xD6E8FEB86659FD93)
_FILTER_BITS = 22
#: The columns that ``contamination`` adds.
ADDED = {"n_words": "long", "n_hit": "long", "items": "array<string>", "spans": "array<struct<begin:long,end:long>>", "clean_text": "string"}


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of n words, whatever text they belong to."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total *= _BASE
        total += hashes[k : len(hashes) - n + 1 + k]
    return mix64(total + np.uint64(n))


def inside(words: Words, n: int) -> np.ndarray:
    """Of every run of n words: whether it lies in one text."""
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    return owner[: len(owner) - n + 1] == owner[n - 1 :] if len(owner) >= n else np.empty(0, bool)


class TestSet:
    """Windows of test items: by length a sorted array of hashes, and the items of each window's words."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int):
        self.items_of: dict[bytes, tuple] = {}
        found, hashed = defaultdict(set), defaultdict(set)
        for name, text in items:
            raw = (text or "").encode()
            words = words_of(raw, np.array([0, len(raw)]), ALPHANUMERIC)
            size = min(n, len(words.hashes))
            if size:
                hashed[size].update(rolling(words.hashes, size).tolist())
                for i in range(len(words.hashes) - size + 1):
                    found[words.text(i, i + size)].add(name)
        self.items_of = {k: tuple(v) for k, v in found.items()}
        self.hashes = {m: np.array(sorted(v), np.uint64) for m, v in hashed.items()}
        self.maybe = {}
        for m, v in self.hashes.items():
            self.maybe[m] = np.zeros(1 << _FILTER_BITS, bool)
            self.maybe[m][v >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, words: Words) -> Iterator[tuple[int, int, tuple]]:
        """(first word, words, items) of every window that occurs."""
        for m, known in self.hashes.items():
            every = rolling(words.hashes, m)
            at = np.flatnonzero(self.maybe[m][every >> np.uint64(64 - _FILTER_BITS)])
            at = at[inside(words, m)[at]]
            near = np.minimum(np.searchsorted(known, every[at]), len(known) - 1)
            for i in at[known[near] == every[at]].tolist():
                if (items := self.items_of.get(words.text(i, i + m))) is not None:
                    yield i, m, items


def _results(words: Words, offsets: np.ndarray, hits) -> tuple[np.ndarray, np.ndarray, dict, dict]:
    """Of each text: words, hit words, items; of those with hits the byte spans, from the text's start."""
    marks = np.zeros(len(words.hashes) + 1, np.int64)
    items = defaultdict(set)
    for i, m, names in hits:
        marks[i] += 1
        marks[i + m] -= 1
        items[int(np.searchsorted(words.first, i, "right")) - 1].update(names)
    hit = np.cumsum(marks[:-1]) > 0
    sums = np.concatenate([[0], np.cumsum(hit)])
    spans = {}
    for d in items:
        at = np.flatnonzero(hit[words.first[d] : words.first[d + 1]]) + words.first[d]
        cut = np.flatnonzero(np.diff(at) > 1)
        ends = [*at[cut].tolist(), int(at[-1])]
        begins = [int(at[0]), *at[cut + 1].tolist()]
        spans[d] = [(int(words.start[a] - offsets[d]), int(words.end[b] - offsets[d])) for a, b in zip(begins, ends)]
    return np.diff(words.first), sums[words.first[1:]] - sums[words.first[:-1]], items, spans


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def _kernel(shared, text_at: int, schema: pa.Schema, clean: bool):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests: TestSet = shared.value
        for batch in batches:
            added = [[], [], [], [], []]
            for _, data, offsets in text_slices(batch.column(text_at)):
                words = words_of(data, offsets, ALPHANUMERIC)
                n_words, n_hit, items, spans = _results(words, offsets, tests.hits(words))
                added[0] += n_words.tolist()
                added[1] += n_hit.tolist()
                for d in range(len(n_words)):
                    added[2].append(sorted(x for x in items[d] if x is not None) if d in items else [])
                    added[3].append([{"begin": a, "end": b} for a, b in spans.get(d, [])])
                    text = None
                    if clean and d in spans:
                        raw, cut = data[offsets[d] : offsets[d + 1]], spans[d]
                        while cut:  # what a removal brings together may be a window again
                            raw = without(raw, cut)
                            ends = np.array([0, len(raw)])
                            again = words_of(raw, ends, ALPHANUMERIC)
                            cut = _results(again, ends, tests.hits(again))[3].get(0, [])
                        text = raw.decode()
                    added[4].append(text)
            columns = [pa.array(x, schema.field(i - 5).type) for i, x in zip(range(5), added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *schema.names[-5:]])

    return kernel


def contamination(documents: DataFrame, benchmark: DataFrame, *, n: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", clean: bool = True) -> DataFrame:
    """``documents`` with n_words, n_hit, items, spans (bytes of the UTF-8 text) and clean_text.

    Words are runs of ASCII letters and digits and of other characters, A-Z lower-cased. A window is n consecutive
    words of an item, or all words of a shorter one; a word inside any occurrence is hit. ``items`` are the
    distinct item ids, sorted as strings; an item with a null id hits, but is not listed. ``clean_text`` is the
    text without its spans, and null where nothing is hit. Null and blank texts have no words and no hits;
    blank items have no windows. The names of the added columns get underscores where ``documents`` has them.
    """
    spark = documents.sparkSession
    names = [fresh(documents.columns, x) for x in ADDED]
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    if size[0] + 64 * size[1] > BROADCAST_BYTES:
        return _joined(documents, items, n, text_col, names, clean)
    tests = TestSet([(r.item, r.text) for r in items.collect()], n)
    frame = documents
    for name, kind in zip(names, ADDED.values()):
        frame = frame.withColumn(name, F.lit(None).cast(kind))
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(frame.schema)
    kernel = _kernel(spark.sparkContext.broadcast(tests), documents.columns.index(text_col), schema, clean)
    return documents.mapInArrow(kernel, frame.schema)


def _windows(n: int, shorter: bool, lengths: list[int]):
    """(key, text) -> (key, hash, check, at, size); of items only the own length, of documents all ``lengths``."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1)):
                words = words_of(data, offsets, ALPHANUMERIC)
                other = mix64(words.hashes ^ np.uint64(0x5851F42D4C957F2D))
                count = np.diff(words.first)
                for m in lengths:
                    at = np.flatnonzero(inside(words, m))
                    owner = np.searchsorted(words.first, at, "right") - 1
                    if shorter:
                        at, owner = (x[np.minimum(count[owner], n) == m] for x in (at, owner))
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(row + owner)), *(pa.array(x[at].view(np.int64)) for x in (rolling(words.hashes, m), rolling(other, m))), pa.array(at - words.first[owner]), pa.array(np.full(len(at), m))],
                            names=["key", "hash", "other", "at", "size"],
                        )

    return kernel


def _answered(texts: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """(key_, text) -> key_, words, hit words, items, spans and the text without its spans, null where nothing is hit."""
    shape = "string, hash long, other long, at long, size long"
    found = texts.mapInArrow(_windows(n, False, list(range(1, n + 1))), f"key {shape}").join(known, ["hash", "other", "size"])
    hits = found.groupBy("key").agg(F.collect_set(F.struct("at", "size")).alias("at"), F.array_sort(F.collect_set("item")).alias("items"))
    every = texts.join(hits, texts["key_"] == hits["key"], "left").select("key_", "text", "at", F.coalesce("items", F.array().cast("array<string>")).alias("items"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts_, at, named = (c.to_pylist() for c in batch.columns)
            for k, text, places, items_ in zip(keys, texts_, at, named):
                raw = text.encode()
                ends = np.array([0, len(raw)])
                words = words_of(raw, ends, ALPHANUMERIC)
                n_words, n_hit, _, spans = _results(words, ends, [(p["at"], p["size"], ()) for p in places or []])
                cut = spans.get(0, [])
                yield pa.RecordBatch.from_pylist(
                    [{"key_": k, "w": int(n_words[0]), "h": int(n_hit[0]), "i": items_, "s": [{"begin": a, "end": b} for a, b in cut], "t": without(raw, cut).decode() if cut else None}],
                    schema=pa.schema([("key_", pa.string()), ("w", pa.int64()), ("h", pa.int64()), ("i", pa.list_(pa.string())), ("s", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("t", pa.string())]),
                )

    return every.mapInArrow(kernel, "key_ string, w long, h long, i array<string>, s array<struct<begin:long,end:long>>, t string")


def _joined(documents: DataFrame, items: DataFrame, n: int, text_col: str, names: list[str], clean: bool) -> DataFrame:
    """The same columns for a benchmark of any size: windows meet in a join by hash, answers by text."""
    shape = "string, hash long, other long, at long, size long"
    lengths = list(range(1, n + 1))
    key = fresh(documents.columns, "text_key")
    keyed = documents.withColumn(key, F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
    texts = keyed.groupBy(key).agg(F.first(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"))
    known = items.mapInArrow(_windows(n, True, lengths), f"key {shape}").select(F.col("key").alias("item"), "hash", "other", "size").distinct()
    texts = texts.select(F.col(key).alias("key_"), "text")
    if not clean:
        answers = _answered(texts, known, n).withColumn("t", F.lit(None).cast("string"))
    else:
        known = written(known)
        answers = written(_answered(texts, known, n))
        cuts = [answers.where("t IS NOT NULL").select("key_", "t", F.lit(0).alias("round"))]
        while not cuts[-1].isEmpty():  # what a removal brings together may be a window again
            again = _answered(cuts[-1].select("key_", F.col("t").alias("text")), known, n).where("t IS NOT NULL")
            cuts.append(written(again.select("key_", "t", F.lit(len(cuts)).alias("round"))))
        last = reduce(DataFrame.unionByName, cuts).groupBy("key_").agg(F.max_by("t", "round").alias("t"))
        answers = answers.drop("t").join(last, "key_", "left").select("key_", *"whist")
    joined = keyed.join(answers, keyed[key] == answers["key_"])
    return joined.select(*(keyed[f"`{c}`"] for c in documents.columns), *(F.col(a).alias(b) for a, b in zip("whist", names)))


def remove_spans(documents: DataFrame, benchmark: DataFrame, *, n: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``documents`` without the passages of the benchmark; rows and columns stay."""
    found = contamination(documents, benchmark, n=n, text_col=text_col, item_col=item_col, item_text_col=item_text_col)
    clean = found.columns[-1]
    return found.select(*(F.coalesce(clean, f"`{c}`").alias(c) if c == text_col else F.col(f"`{c}`") for c in documents.columns))


def remove_documents(documents: DataFrame, benchmark: DataFrame, *, n: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``documents`` without those in which any word is hit."""
    found = contamination(documents, benchmark, n=n, text_col=text_col, item_col=item_col, item_text_col=item_text_col, clean=False)
    return found.where(F.col(found.columns[-4]) == 0).select(*(f"`{c}`" for c in documents.columns))
