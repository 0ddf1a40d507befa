"""What several operators share: reading tables, cutting lineage, and words of many texts at once.

Texts reach Python as Arrow columns. ``text_slices`` hands out the UTF-8 bytes of a few texts at a time, and
``words_of`` finds and hashes all their words with array operations, so no Python object is made for a word.
"""

from __future__ import annotations

import gc
import os
import time
import uuid
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, StructField, StructType

from cadastra.operators.storage import shared_folder
from cadastra.session import guarded

#: Bytes of text that a kernel holds in arrays at once; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Bytes that one pass of the word hash covers.
_SPAN = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of ``folder``. Workers started from now on find this package where the driver has found it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return guarded(spark).read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file() -> str:
    """The byte-level vocabulary installed beside the public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it; unset, one of this machine (local masters only)."""
    made = shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else made


def checkpoint(frame: DataFrame) -> DataFrame:
    """``frame``, computed once and kept in the shared folder; its lineage ends here."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


def written(frame: DataFrame) -> DataFrame:
    """``frame`` as a Parquet table in the shared folder: for wide rows, smaller than a checkpoint."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table.table_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` has made, once all that reads them is a table itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(table.table_path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished phases now. It does so when the driver collects garbage,
    which a driver with much memory may put off until the disks are full. Spark refers to its last job until the next
    one, and learns of Python's garbage a little later, so a small job and a pause come first."""
    spark.range(1).count()
    gc.collect()
    time.sleep(0.2)
    spark.sparkContext._jvm.System.gc()


def squeezed(frame: DataFrame, text_col: str) -> DataFrame:
    """``frame`` with its texts as zstd frames, for shuffles of whole texts; nulls are empty texts."""
    at = frame.columns.index(text_col)
    schema = StructType([StructField(f.name, BinaryType()) if k == at else f for k, f in enumerate(frame.schema)])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            out = []
            for _, data, offsets in text_slices(batch.column(at)):
                bounds = offsets.tolist()
                out += [pack(data[a:b]) for a, b in zip(bounds, bounds[1:])]
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return frame.mapInArrow(kernel, schema)


def unsqueezed(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 texts of a column that ``squeezed`` has made."""
    unpack = zstandard.ZstdDecompressor().decompress
    for x in column:
        yield unpack(x.as_py())


def fresh(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column in ``taken`` (case ignored) has the name."""
    lower = {x.lower() for x in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 64-bit integers that spreads every input bit (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix32(x: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 32-bit integers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def text_slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive texts, about ``most`` bytes at a time; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"")
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, bytes(data[offsets[at] : offsets[to]]), offsets[at : to + 1] - offsets[at]
        at = to


def class_table(is_word) -> bytes:
    """A table for bytes.translate: A-Z lower-cased, bytes outside words made spaces."""
    return bytes(ord(chr(b).lower()) if 65 <= b <= 90 else b if is_word(b) else 32 for b in range(256))


#: Words are runs of bytes other than space and \t \n \v \f \r; lower case for A-Z alone.
SPACED = class_table(lambda b: b != 32 and not 9 <= b <= 13)
#: Words are runs of ASCII letters, digits and all bytes of other characters.
ALPHANUMERIC = class_table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90)


class Words(NamedTuple):
    data: bytes
    first: np.ndarray  # of each text and one more: the index of its first word
    start: np.ndarray  # of each word: its first byte
    end: np.ndarray
    hashes: np.ndarray  # of each word, uint64

    def text(self, i: int, j: int) -> bytes:
        """Words i to j - 1, a space between."""
        return b" ".join(self.data[a:b] for a, b in zip(self.start[i:j], self.end[i:j]))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of the word hash, and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, _SPAN + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base & _MASK, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def words_of(data: bytes, offsets: np.ndarray, table: bytes = SPACED) -> Words:
    """The words of texts that lie end to end in ``data``. No word goes past the end of its text."""
    data = data.translate(table)
    array = np.frombuffer(data, np.uint8)
    inside = array != 32
    begins, ends = inside.copy(), inside.copy()
    edge = np.zeros(len(array) + 1, bool)
    edge[offsets] = True
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + _SPAN, "right")))
        low, high = start[at], end[to - 1]
        up, down = powers(int(high - low) + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((array[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        hashes[at:to] = (sums[end[at:to] - low] - sums[start[at:to] - low]) * down[start[at:to] - low]
        at = to
    return Words(data, np.searchsorted(start, offsets), start, end, mix64(hashes))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Of each run of n words: a hash that depends on the words, their order and n."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    total = np.full(len(hashes) - n + 1, n, np.uint64)
    for k in range(n):
        total = mix64(total * np.uint64(_BASE) + hashes[k : len(hashes) - n + 1 + k])
    return total


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Of each text: the sorted distinct hashes of its runs of n words; fewer words, but some, are one run."""
    every = grams(words.hashes, n)
    first = words.first
    out = []
    for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
        if j - i >= n:
            out.append(np.unique(every[i : j - n + 1]))
        else:
            out.append(grams(words.hashes[i:j], j - i) if j > i else np.empty(0, np.uint64))
    return out
