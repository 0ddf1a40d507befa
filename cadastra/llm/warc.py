"""WARC archives and an external merge of their index.

Archives are gzipped WARC 1.1 files that Spark writes to the shared folder as UTF-8 text, records ended by an empty
line as the format asks. Offsets and lengths in the index are those of the unpacked archive. Reading an archive gives its capture records, sorted: a run. Runs are dealt out by ranges
of (URL key, timestamp, id), so that even one URL's captures spread over tasks, and each task merges its slices of
all runs by a loser tree. Ranges in order, and rows in a range in order, are the global capture history.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import shared_dir, written

#: Payloads with fewer bytes are always stored anew.
REVISIT_BYTES = 1000
#: Records of one archive at most, and the bytes of payload that its records have on average at most.
ARCHIVE_RECORDS, ARCHIVE_BYTES = 16_384, 1 << 26
#: Captures that one task merges, on average.
RANGE_ROWS = 50_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = 1_577_836_800  # 2020-01-01T00:00:00Z


class LoserTree:
    """Merges sorted runs; each step costs one comparison for each level of a binary tree over the runs."""

    def __init__(self, runs: Iterable[Iterable[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.size = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.tree = [-1] * max(1, self.size)  # tree[0]: the winner; inner nodes: the loser of their match
        winners = [-1] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            won, lost = (b, a) if self._after(a, b) else (a, b)
            winners[node], self.tree[node] = won, lost
        if self.size:
            self.tree[0] = winners[1] if self.size > 1 else 0

    def _after(self, a: int, b: int) -> bool:
        """Whether run a's head comes after run b's; a run that has ended comes last."""
        x, y = self.heads[a], self.heads[b]
        return x is None or (y is not None and (y, b) < (x, a))

    def __iter__(self) -> Iterator[tuple]:
        while self.size and (head := self.heads[won := self.tree[0]]) is not None:
            yield head
            self.heads[won] = next(self.runs[won], None)
            node = (won + self.size) // 2
            while node:
                if self._after(won, self.tree[node]):
                    won, self.tree[node] = self.tree[node], won
                node //= 2
            self.tree[0] = won


def url_key(url: str) -> str:
    """The sort-friendly form of a URL: host labels reversed, lower case; without scheme, ``www.`` and fragment."""
    m = re.match(r"(?s)[^:/?#]*://([^/?#]*)([^#]*)", url)
    if not m:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", m[1].rsplit("@", 1)[-1].lower())
    return ",".join(reversed(host.split("."))) + ")" + (m[2].lower() or "/")


def _header_safe(text: Column) -> Column:
    """A URL as a header's value: control characters and spaces percent-encoded."""
    out = text
    for code in (*range(32), 32, 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def records(captures: DataFrame) -> DataFrame:
    """(value): the WARC record of each row of ``captures`` (id, url, taken, payload), without its last empty line.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` bytes, those with the largest id are responses and
    the others revisit it. Only payloads that occur again are joined back, and Spark splits a hot one's rows.
    """
    rows = captures.select("id", "url", "taken", F.coalesce("payload", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    again = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.max("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first_id IS NOT NULL").drop("n")
    rows = rows.join(again, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    urn = lambda c: F.concat(F.lit("<urn:capture:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit("\r\n\r\n"))
    block_size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    value = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("id")),
        F.lit("\r\nWARC-Date: "), F.date_format(F.timestamp_seconds("taken"), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("\r\nWARC-Target-URI: "), _header_safe(F.col("url")))).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: "), urn(F.col("first_id")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), block_size,
        F.lit("\r\n\r\n"), http, F.when(revisit, "").otherwise(F.col("payload")),
    )
    return rows.select(value.alias("value"))


def write_archives(captures: DataFrame, path: str) -> None:
    mean = captures.agg(F.avg(F.coalesce(F.octet_length("payload"), F.lit(0)))).first()[0] or 0
    most = max(1, min(ARCHIVE_RECORDS, int(ARCHIVE_BYTES // max(1, mean))))
    records(captures).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", most).option("compression", "gzip").text(path)


def unpacked(archive: bytes) -> bytes:
    """An archive's bytes, whatever number of gzip members they come in; plain archives stay as they are."""
    out = []
    while archive[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(archive))
        if not member.eof:
            raise ValueError("a gzip member is cut short")
        archive = member.unused_data
    return b"".join([*out, archive])


def parse(archive: bytes) -> Iterator[dict]:
    """The records of an archive: offset, length, headers (names in lower case), http headers and payload.

    Content-Length alone says where a block ends; whatever the payload holds is payload.
    """
    at = 0
    while at < len(archive):
        ends = archive.index(b"\r\n\r\n", at)
        first, *lines = archive[at:ends].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin = ends + 4
        end = begin + int(headers["content-length"])
        block = archive[begin:end]
        if len(block) < end - begin or archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut short")
        http, _, payload = block.partition(b"\r\n\r\n")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
        yield {"offset": at, "length": end + 4 - at, "headers": headers, "http": fields, "payload": payload}
        at = end + 4


_FIELDS = [("urlkey", "string"), ("taken", "string"), ("id", "long"), ("seq", "long"), ("archive", "string"), ("offset", "long"), ("length", "long"), ("url", "string"), ("record_type", "string"), ("refers_to", "long"), ("payload_bytes", "long"), ("digest", "string")]
_ARROW = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in _FIELDS])


def _id(urn: str | None) -> int | None:
    tail = urn.removeprefix("<urn:capture:").removesuffix(">") if urn else "none"
    return None if tail == "none" else int(tail)


def _key(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives (path, content) to their index rows; an archive's rows are sorted. Payload digests are checked."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            name, rows = path.as_py(), []
            for r in parse(unpacked(content.as_py())):
                h = r["headers"]
                digest = h["warc-payload-digest"].removeprefix("sha1:")
                if h["warc-type"] == "response" and hashlib.sha1(r["payload"]).hexdigest() != digest:
                    raise ValueError(f"{name}: the payload at byte {r['offset']} is not what its digest says")
                url = h.get("warc-target-uri")
                rows.append((url_key(url or ""), h["warc-date"], _id(h["warc-record-id"]), 0, name, r["offset"], r["length"], url, h["warc-type"], _id(h.get("warc-refers-to")), int(r["http"]["content-length"]), digest))
            rows.sort(key=_key)
            if rows:
                yield _table([(*r[:3], k, *r[4:]) for k, r in enumerate(rows)], _ARROW)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's rows of all runs, merged; ``seq`` becomes the place in the range, and the range's number follows."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    # a run's rows come in pieces; within a piece they are in order, so each piece is a run
    pieces: dict[str, list[list[tuple]]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            own = pieces.setdefault(row[4], [])
            if not own or row[3] < own[-1][-1][3]:
                own.append([])
            own[-1].append(row)
    schema = _ARROW.append(pa.field("range", pa.int64()))
    out = []
    tree = LoserTree([((_key(r), r[3], r) for r in rows) for _, own in sorted(pieces.items()) for rows in sorted(own, key=lambda rows: rows[0][3])])
    for place, (_, _, r) in enumerate(tree):
        out.append((*r[:3], place, *r[4:], part))
        if len(out) == 10_000:
            yield _table(out, schema)
            out = []
    if out:
        yield _table(out, schema)


def capture_history(spark, path: str) -> DataFrame:
    """The index of all archives under ``path`` in global order: by ``range``, in it by ``seq``.

    Columns: urlkey, taken, id, seq, archive, offset, length, url, record_type, refers_to, payload_bytes, digest,
    range. The runs are a table in the shared folder. No archives give no rows.
    """
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    shape = ", ".join(f"{n} {t}" for n, t in _FIELDS)
    runs = written(archives.mapInArrow(_runs, shape))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // RANGE_ROWS))
    dealt = runs.repartitionByRange(ranges, F.col("urlkey"), F.col("taken"), F.col("id").asc_nulls_first())
    return dealt.mapInArrow(_merged, f"{shape}, range long")


def in_order(history: DataFrame) -> DataFrame:
    """``history`` with ``position``, its rows' numbers in the global order from 0: those of the ranges ahead, and ``seq``.

    The merged index is a table in the shared folder; what is summed over ranges is a row for each.
    """
    held = written(history)
    sizes = held.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    ahead = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("ahead"))
    return held.join(ahead, "range").withColumn("position", F.col("ahead") + F.col("seq")).drop("ahead")


def archived(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and returns their ``capture_history``.

    A null payload is empty, and a null URL has no target header and an empty key. A row's time follows its id,
    as pages have none. Rows that repeat the largest id of equal payloads are all responses. A null id is
    written as such; payloads that only null ids have are never revisited. An empty table gives no rows.
    Extra columns are not looked at.
    """
    spark = pages.sparkSession
    identity = F.col(id_col).cast("long")
    captures = pages.select(
        identity.alias("id"),
        F.col(url_col).cast("string").alias("url"),
        (F.lit(_EPOCH) + F.pmod(F.coalesce(identity, F.lit(0)), F.lit(1 << 30))).alias("taken"),
        F.col(payload_col).cast("string").alias("payload"),
    )
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(captures, path)
    return capture_history(spark, path)
