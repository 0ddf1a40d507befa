"""TIFF as a column: a writer for 8-bit pages, and a reader that walks image directories and emits pages.

The reader takes either byte order, strips and tiles, chunky and planar samples of 8, 16 and 32 bits, no
compression, LZW, deflate (both codes) and PackBits, and undoes the horizontal predictor.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import fresh, text_slices

# Fixed values of the format: tags, compression codes, bytes of each field type, LZW's reserved codes.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES = 322, 323, 324, 325
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
TYPE_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}
CLEAR, END = 256, 257


class Page(NamedTuple):
    number: int
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    pixels: bytes  # rows from the top, samples together, little-endian


def packbits(raw: bytes) -> bytes:
    """Runs of three and more equal bytes as runs, all else literally."""
    array = np.frombuffer(raw, np.uint8)
    if not len(array):
        return b""
    edges = np.flatnonzero(np.diff(array)) + 1
    begins, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(array)]])
    long_ = ends - begins >= 3
    out, at = [], 0

    def literal(a: int, b: int) -> None:
        for k in range(a, b, 128):
            part = raw[k : min(k + 128, b)]
            out.append(bytes([len(part) - 1]) + part)

    for a, b in zip(begins[long_].tolist(), ends[long_].tolist()):
        literal(at, a)
        for k in range(a, b, 128):
            n = min(128, b - k)
            out.append(bytes([257 - n if n > 1 else 0, raw[k]]))
        at = b
    literal(at, len(raw))
    return b"".join(out)


def unpackbits(data: bytes, size: int) -> bytes:
    out, at, have = [], 0, 0
    while have < size:
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + n + 2])
            at += n + 2
            have += n + 1
        elif n > 128:
            out.append(data[at + 1 : at + 2] * (257 - n))
            at += 2
            have += 257 - n
        else:
            at += 1
    return b"".join(out)[:size]


#: Bits of each code after a CLEAR: they grow one entry early, as TIFF has it. A full table has 12 until the next CLEAR.
_WIDTHS = np.minimum(np.array([(258 + i).bit_length() for i in range(4096)]), 12)
#: Codes between two CLEARs that the writer uses; the table is cleared before it is full.
_CODES = 4094 - 258
_SINGLE = [bytes([i]) for i in range(256)] + [b"", b""]


def lzw(raw: bytes) -> bytes:
    """Codes of 9 to 12 bits, the most significant bit first."""
    codes, widths = [CLEAR], [np.array([9])]
    begin, at = 1, 0
    while at < len(raw):
        table: dict[int, int] = {}
        get, put, free, full = table.get, codes.append, 258, 258 + _CODES
        prefix = raw[at]
        for at in range(at + 1, len(raw)):  # noqa: B020
            pair = prefix << 8 | raw[at]
            known = get(pair)
            if known is None:
                put(prefix)
                table[pair] = free
                free += 1
                prefix = raw[at]
                if free == full:
                    put(CLEAR)
                    break
            else:
                prefix = known
        else:
            put(prefix)
            at = len(raw)
        widths.append(_WIDTHS[: len(codes) - begin])
        begin = len(codes)
    codes.append(END)
    # the END after a full row of codes counts on
    last = len(widths[-1]) if len(widths) > 1 else 0
    widths.append(_WIDTHS[last : last + 1])
    size = np.concatenate(widths)
    places = np.arange(11, -1, -1)
    bits = (np.array(codes)[:, None] >> places & 1).astype(np.uint8)
    return np.packbits(bits[places < size[:, None]]).tobytes()


def unlzw(data: bytes, size: int) -> bytes:
    """At most ``size`` bytes; a code that is not known yet raises an error."""
    bits, padded = 8 * len(data), np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.int64)
    out, have, at = [], 0, 0
    while have < size and bits - at >= 9:
        widths = _WIDTHS
        ends = at + np.cumsum(widths)
        ends = ends[: np.searchsorted(ends, bits, "right")]
        widths = widths[: len(ends)]
        begins = ends - widths
        byte = begins >> 3
        codes = (padded[byte] << 16 | padded[byte + 1] << 8 | padded[byte + 2]) >> (24 - (begins & 7) - widths) & ((1 << widths) - 1)
        stop = np.flatnonzero((codes == CLEAR) | (codes == END))
        count = int(stop[0]) if len(stop) else len(codes)
        table = list(_SINGLE)
        last = b""
        for code in codes[:count].tolist():
            if code < len(table):
                entry = table[code]
            elif code == len(table) and last:
                entry = last + last[:1]
            else:
                raise ValueError("an LZW code that is not known yet")
            if last:
                table.append(last + entry[:1])
            out.append(entry)
            have += len(entry)
            last = entry
            if have >= size:
                break
        if not len(stop) or codes[count] == END:
            break
        at = int(ends[count])
    return b"".join(out)[:size]


def _inflate(data: bytes, size: int) -> bytes:
    return zlib.decompressobj().decompress(data, size)


_PACK = {NONE: bytes, LZW: lzw, DEFLATE: lambda raw: zlib.compress(raw, 3), PACKBITS: packbits}
_UNPACK = {NONE: lambda d, n: bytes(d), LZW: unlzw, DEFLATE: _inflate, OLD_DEFLATE: _inflate, PACKBITS: unpackbits}


def write(pages: list[np.ndarray], compression: int, *, predictor: int = 1, tile: tuple[int, int] | None = None, strip_rows: int = 1024) -> bytes:
    """A little-endian TIFF of 8-bit grey ``pages`` (height, width), in strips, or in tiles (height, width)."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for page in pages:
        height, width = page.shape
        if tile:
            high, wide = tile
            full = np.zeros((-(-height // high) * high, -(-width // wide) * wide), np.uint8)
            full[:height, :width] = page
            blocks = [full[y : y + high, x : x + wide] for y in range(0, len(full), high) for x in range(0, full.shape[1], wide)]
        else:
            blocks = [page[y : y + strip_rows] for y in range(0, height, strip_rows)]
        offsets, sizes = [], []
        for b in blocks:
            if predictor == 2:
                b = np.diff(b, axis=1, prepend=np.zeros((len(b), 1), np.uint8))
            packed = _PACK[compression](b.tobytes())
            offsets.append(len(out))
            sizes.append(len(packed))
            out += packed
        out += b"\0" * (len(out) % 2)
        entries = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [8]), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [1]), (SAMPLES, 3, [1]), (PREDICTOR, 3, [predictor])]
        entries += [(TILE_WIDTH, 4, [tile[1]]), (TILE_HEIGHT, 4, [tile[0]]), (TILE_OFFSETS, 4, offsets), (TILE_BYTES, 4, sizes)] if tile else [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [strip_rows]), (STRIP_BYTES, 4, sizes)]
        fields = b""
        for tag, kind, values in sorted(entries):
            value = struct.pack(f"<{len(values)}{TYPE_CODES[kind]}", *values)
            if len(value) > 4:
                at = len(out)
                out += value
                value = struct.pack("<I", at)
            fields += struct.pack("<HHI", tag, kind, len(values)) + value.ljust(4, b"\0")
        out[link : link + 4] = struct.pack("<I", len(out))
        out += struct.pack("<H", len(entries)) + fields
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _directory(data: bytes, order: str, at: int) -> tuple[dict[int, tuple], int]:
    (count,) = struct.unpack_from(f"{order}H", data, at)
    tags = {}
    for k in range(count):
        place = at + 2 + 12 * k
        tag, kind, n = struct.unpack_from(f"{order}HHI", data, place)
        if kind in TYPE_CODES:
            place += 8
            if TYPE_BYTES[kind] * n > 4:
                (place,) = struct.unpack_from(f"{order}I", data, place)
            tags[tag] = struct.unpack_from(f"{order}{n}{TYPE_CODES[kind]}", data, place)
    return tags, struct.unpack_from(f"{order}I", data, at + 2 + 12 * count)[0]


#: More than any of the codings unpacks a byte to.
MOST_RATIO = 4096


def image_bytes(width: int, height: int, wide: int, high: int, samples: int, bits: int) -> int:
    """Bytes of a page with its last strips or tiles filled up."""
    return -(-width // wide) * wide * -(-height // high) * high * samples * bits // 8


def read(data: bytes) -> Iterator[Page]:
    """The pages of a TIFF, in the order of its directories. A damaged file raises an error."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if not order or struct.unpack_from(f"{order}H", data, 2)[0] != 42:
        raise ValueError("not a TIFF")
    (at,) = struct.unpack_from(f"{order}I", data, 4)
    seen: set[int] = set()
    number = 0
    while at:
        if at in seen:
            raise ValueError("image directories in a circle")
        seen.add(at)
        tags, at = _directory(data, order, at)
        one = lambda tag, default=None: tags.get(tag, (default,))[0]
        width, height, samples, bits = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), one(BITS, 1)
        compression, predictor, planar = one(COMPRESSION, NONE), one(PREDICTOR, 1), one(PLANAR, 1)
        if bits not in (8, 16, 32) or compression not in _UNPACK or predictor not in (1, 2):
            raise ValueError(f"{bits} bits, compression {compression}, predictor {predictor}: not known")
        tiled = TILE_WIDTH in tags
        wide, high = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(ROWS_PER_STRIP, height), height))
        offsets, sizes = tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], tags[TILE_BYTES if tiled else STRIP_BYTES]
        together = samples if planar == 1 else 1
        kind = np.dtype(f"{order}u{bits // 8}")
        if not (wide and high) or image_bytes(width, height, wide, high, samples, bits) > MOST_RATIO * (len(data) + 64):
            raise ValueError("a page that is too large for its bytes")
        image = np.zeros((height, width, samples), kind.newbyteorder("<"))
        across, down = -(-width // wide), -(-height // high)
        for k, (a, n) in enumerate(zip(offsets, sizes)):
            plane, rest = divmod(k, across * down) if planar == 2 else (0, k)
            y, x = rest // across * high, rest % across * wide
            rows = high if tiled else min(high, height - y)
            raw = _UNPACK[compression](data[a : a + n], rows * wide * together * kind.itemsize)
            block = np.frombuffer(raw, kind, rows * wide * together).reshape(rows, wide, together)
            if predictor == 2:
                block = np.cumsum(block, axis=1, dtype=block.dtype.newbyteorder("="))
            part = image[y : y + rows, x : x + wide, plane : plane + together] if planar == 2 else image[y : y + rows, x : x + wide]
            part[...] = block[: part.shape[0], : part.shape[1]]
        yield Page(number, width, height, samples, bits, compression, image.tobytes())
        number += 1


#: Columns and rows of a stored page, and of a tile.
STORED_WIDTH, STORED_ROWS, TILE = 64, 4096, (16, 64)
#: Codings of stored payloads, chosen by the payload's CRC like tiles and predictor, at every size.
CODINGS = (LZW, PACKBITS, DEFLATE)


def stored(payload: bytes) -> bytes:
    """``payload``, a positive multiple of 64 bytes, as a TIFF; the form depends on the payload alone."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, STORED_WIDTH)
    pages = [rows[y : y + STORED_ROWS] for y in range(0, len(rows), STORED_ROWS)]
    rest, coding = divmod(zlib.crc32(payload), len(CODINGS))
    return write(pages, CODINGS[coding], predictor=1 + rest % 2, tile=TILE if rest // 2 % 2 else None)


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in text_slices(batch.column(1)):
            bounds = offsets.tolist()
            media = []
            for a, b in zip(bounds, bounds[1:]):
                media.append(stored(data[a:b] + b"\0" * (-(b - a) % 64 or 64 * (a == b))))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(media)), pa.array([b - a for a, b in zip(bounds, bounds[1:])], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def store_texts(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text's UTF-8 bytes, zeros to a positive multiple of 64, as a TIFF.

    A null text is empty. Ids of any type stay as they are; null and repeated ones are rows like others. Extra columns
    are not looked at. An empty table gives no rows.
    """
    docs = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_store, f"doc_id {kind}, n_bytes long, media binary")


_PAGE = pa.schema([("page", pa.int64()), ("width", pa.int64()), ("height", pa.int64()), ("samples", pa.int64()), ("bits", pa.int64()), ("compression", pa.int64()), ("pixels", pa.binary()), ("error", pa.string())])
#: Bytes of pixels that a batch of pages holds.
_BATCH_BYTES = 1 << 20


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns to carry along and then the media -> the same columns and a row for each page."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple]]:
        for i, media in enumerate(batch.column(batch.num_columns - 1)):
            count = 0
            try:
                if not media.is_valid:
                    raise ValueError("no bytes")
                for page in read(media.as_py()):
                    yield i, (*page, None)
                    count += 1
            except (ValueError, LookupError, TypeError, OverflowError, ArithmeticError, struct.error, zlib.error) as e:
                yield i, (count, None, None, None, None, None, None, f"{type(e).__name__}: {e}")

    def packed(batch: pa.RecordBatch, held: list[tuple[int, tuple]]) -> pa.RecordBatch:
        carried = [batch.column(k).take(pa.array([i for i, _ in held])) for k in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays([*carried, *(pa.array(c, f.type) for c, f in zip(zip(*(page for _, page in held)), _PAGE))], names=[*batch.schema.names[:-1], *_PAGE.names])

    for batch in batches:
        held, size = [], 0
        for row in rows(batch):
            held.append(row)
            size += len(row[1][6] or b"") + 64
            if size >= _BATCH_BYTES:
                yield packed(batch, held)
                held, size = [], 0
        if held:
            yield packed(batch, held)


def pages(media: DataFrame, *, media_col: str = "media") -> DataFrame:
    """A row for each page of each TIFF, in order: the other columns, then page, width, height, samples, bits,
    compression, pixels, error.

    What is null, no TIFF, damaged or of a kind not known ends in a row with ``error`` after its good pages; ``page`` has
    the number of the page that could not be read. The names of the added columns get underscores where they are taken.
    An empty table gives no rows.
    """
    others = [c for c in media.columns if c != media_col]
    rows = media.select(*(F.col(f"`{c}`") for c in [*others, media_col]))
    schema = rows.drop(media_col).schema
    for name, kind in zip(_PAGE.names, ("long",) * 6 + ("binary", "string")):
        schema = schema.add(fresh(schema.names, name), kind)
    return rows.mapInArrow(_pages, schema)


_FEATURES = pa.schema([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("feature", pa.string())])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Page rows, a document's in a row and from page 0, after four columns to carry along -> a row for each document."""
    held: tuple | None = None
    out: list[tuple] = []

    def end() -> None:
        carried, digest, size, tail, levels, number, height, coding, good = held
        if not good:
            out.append((*carried, None, None, None, None))
            return
        mean = int(levels @ np.arange(256)) * 1000 // max(1, size)
        feature = f"pages={number};rows={height};codec={coding};mean={mean};levels={np.count_nonzero(levels)};mode={int(levels.argmax())}"
        out.append((*carried, size, digest.hexdigest(), zlib.crc32(tail), feature))

    def packed(schema: pa.Schema) -> pa.RecordBatch:
        fields = [*(schema.field(k) for k in range(4)), *_FEATURES]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), fields)], names=[f.name for f in fields])

    schema = None
    for batch in batches:
        schema = batch.schema
        columns = [batch.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 6, 9, 11)]
        for i, (*carried, page, height, coding, error) in enumerate(zip(*columns)):
            if page == 0:
                if held:
                    end()
                held = (carried, hashlib.sha256(), 0, b"", np.zeros(256, np.int64), 0, 0, None, True)
            _, digest, size, tail, levels, number, rows, first, good = held
            if error is None:
                pixels = batch.column(10)[i].as_buffer()
                digest.update(pixels)
                levels = levels + np.bincount(np.frombuffer(pixels, np.uint8), minlength=256)
                tail = (tail + bytes(pixels[max(0, pixels.size - 64) :]))[-64:]
                held = (held[0], digest, size + pixels.size, tail, levels, number + 1, rows + height, first or coding, good)
            else:
                held = (*held[:-1], False)
        if out:
            yield packed(schema)
            out.clear()
    if held:
        end()
        yield packed(schema)


def features(stored_texts: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media_bytes, media_sha256, payload_bytes, payload_sha256, tail_crc32, feature): what the TIFFs of
    ``store_texts`` hold when ``pages`` reads them, a row for each row.

    Pages stream from one operator to the other in the order of rows, so that no page is shuffled and only one is held.
    Where a TIFF is null or damaged, what follows ``media_sha256`` is null (of a null, that and ``media_bytes`` as well).
    """
    rows = stored_texts.select("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return pages(rows).mapInArrow(_features, f"doc_id {kind}, n_bytes long, media_bytes long, media_sha256 string, payload_bytes long, payload_sha256 string, tail_crc32 long, feature string")
