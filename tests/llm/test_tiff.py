from __future__ import annotations

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadastra.llm import tiff


def codes(data: bytes, widths: list[int]) -> list[int]:
    bits = "".join(f"{b:08b}" for b in data)
    out = []
    for w in widths:
        out.append(int(bits[:w], 2))
        bits = bits[w:]
    return out


def test_lzw_example():
    raw = bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    assert codes(tiff.lzw(raw), [9] * 9) == [256, 7, 258, 8, 8, 258, 6, 6, 257]
    assert tiff.unlzw(tiff.lzw(raw), 9) == raw


def test_lzw_widths():
    """256 literals without a repeat: the 255th code after the first clear has 10 bits."""
    raw = bytes(range(256))
    assert codes(tiff.lzw(raw), [9] * 255 + [10, 10, 10]) == [256, *range(256), 257]


def test_packbits_example():
    packed = bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA])
    raw = bytes([0xAA] * 3 + [0x80, 0, 0x2A] + [0xAA] * 4 + [0x80, 0, 0x2A, 0x22] + [0xAA] * 10)
    assert tiff.packbits(raw) == packed and tiff.unpackbits(packed, len(raw)) == raw


@settings(max_examples=100, deadline=None)
@given(st.one_of(st.binary(max_size=6000), st.lists(st.sampled_from([b"aaaaaa", b"ab", b"the ", bytes(200)]), max_size=900).map(b"".join)))
def test_round_trips(raw):
    assert tiff.unlzw(tiff.lzw(raw), len(raw)) == raw
    assert tiff.unpackbits(tiff.packbits(raw), len(raw)) == raw


def test_long_lzw():
    rng = random.Random(1)
    raw = bytes(rng.randrange(256) for _ in range(60_000)) + b"abc" * 40_000
    assert tiff.unlzw(tiff.lzw(raw), len(raw)) == raw


@pytest.mark.parametrize("compression", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor,tile", [(1, None), (2, None), (1, (16, 16)), (2, (16, 32))])
def test_pages(compression, predictor, tile):
    rng = np.random.default_rng(3)
    pages = [rng.integers(0, 9, (h, w), np.uint8) for h, w in ((1, 1), (70, 33), (40, 64))]
    found = list(tiff.read(tiff.write(pages, compression, predictor=predictor, tile=tile, strip_rows=16)))
    assert [(p.number, p.height, p.width) for p in found] == [(0, 1, 1), (1, 70, 33), (2, 40, 64)]
    assert [p.pixels for p in found] == [p.tobytes() for p in pages]


@pytest.mark.parametrize("planar", [1, 2])
def test_big_endian_16_bit_samples_with_predictor(planar):
    image = np.random.default_rng(4).integers(0, 60_000, (3, 5, 2), np.uint16)
    delta = image.copy()
    delta[:, 1:] -= image[:, :-1]
    raw = [zlib.compress(x.astype(">u2").tobytes()) for x in ([delta] if planar == 1 else [delta[..., 0], delta[..., 1]])]
    out = bytearray(b"MM\0*\0\0\0\0")
    offsets = []
    for r in raw:
        offsets.append(len(out))
        out += r
    spread = len(out)
    out += struct.pack(">2I2I2H", *(offsets * 2)[:2], *([len(r) for r in raw] * 2)[:2], 16, 16)
    many = len(raw)
    entries = [(256, 4, 1, 5), (257, 4, 1, 3), (258, 3, 2, 16 << 16 | 16), (259, 3, 1, 8 << 16), (273, 4, many, spread if many > 1 else offsets[0]), (277, 3, 1, 2 << 16), (278, 4, 1, 3)]
    entries += [(279, 4, many, spread + 8 if many > 1 else len(raw[0])), (284, 3, 1, planar << 16), (317, 3, 1, 2 << 16)]
    struct.pack_into(">I", out, 4, len(out))
    out += struct.pack(">H", len(entries)) + b"".join(struct.pack(">HHII", *e) for e in entries) + b"\0\0\0\0"
    (page,) = tiff.read(bytes(out))
    assert (page.samples, page.bits) == (2, 16) and page.pixels == image.astype("<u2").tobytes()


def test_bad_files():
    good = tiff.write([np.zeros((4, 4), np.uint8)], tiff.NONE)
    circle = bytearray(good)
    circle[-4:] = good[4:8]
    for bad in (b"", b"II*", b"GIF89a--", bytes(circle), good[:-10]):
        with pytest.raises((ValueError, struct.error)):
            list(tiff.read(bad))


def plain_payload(data: bytes) -> tuple[bytes, int]:
    """An independent reader of little-endian 8-bit grey TIFFs, by the format's description, a bit at a time for LZW."""

    def unpack(raw, coding):
        if coding == 8:
            return zlib.decompress(raw)
        out = bytearray()
        if coding == 32773:
            it = iter(raw)
            for n in it:
                if n < 128:
                    out += bytes(next(it) for _ in range(n + 1))
                elif n > 128:
                    out += bytes([next(it)]) * (257 - n)
            return bytes(out)
        bits = int.from_bytes(raw, "big")
        left, width, table, old = 8 * len(raw), 9, {}, None
        while True:
            left -= width
            code = bits >> left & (1 << width) - 1
            if code == 257:
                return bytes(out)
            if code == 256:
                width, table, old = 9, {i: bytes([i]) for i in range(256)}, None
                following = 258
                continue
            if old is not None:
                table[following] = old + (table[code] if code in table else old)[:1]
                following += 1
                width = 9 if following < 511 else 10 if following < 1023 else 11 if following < 2047 else 12
            old = table[code]
            out += old

    payload, at, coding = b"", struct.unpack_from("<I", data, 4)[0], None
    while at:
        (count,) = struct.unpack_from("<H", data, at)
        tags = {}
        for k in range(count):
            tag, kind, n = struct.unpack_from("<HHI", data, at + 2 + 12 * k)
            form = f"<{n}{'H' if kind == 3 else 'I'}"
            place = at + 10 + 12 * k
            tags[tag] = struct.unpack_from(form, data, place if struct.calcsize(form) <= 4 else struct.unpack_from("<I", data, place)[0])
        at = struct.unpack_from("<I", data, at + 2 + 12 * count)[0]
        coding = coding or tags[259][0]
        offsets, sizes = (tags[324], tags[325]) if 322 in tags else (tags[273], tags[279])
        assert tags[256] == (64,) and tags.get(322, (64,)) == (64,)
        page = b"".join(unpack(data[a : a + n], tags[259][0]) for a, n in zip(offsets, sizes))
        if tags[317][0] == 2:
            rows = [list(page[k : k + 64]) for k in range(0, len(page), 64)]
            for r in rows:
                for x in range(1, 64):
                    r[x] = (r[x] + r[x - 1]) % 256
            page = b"".join(map(bytes, rows))
        payload += page[: 64 * tags[257][0]]
    return payload, coding


def test_damaged_and_null_media(spark):
    good = tiff.write([np.full((4, 64), 7, np.uint8), np.zeros((9, 64), np.uint8)], tiff.LZW)
    circle = bytearray(good)
    circle[-4:] = good[4:8]
    rows = [("a", 0, good), ("b", 0, None), ("c", 0, b"no"), ("d", 0, bytes(circle)), ("e", 0, good[:-60]), ("f", 0, good)]
    frame = spark.createDataFrame(rows, "doc_id string, PAGE int, media binary").coalesce(1)
    found = [(r.doc_id, r.page_, r.error is None) for r in tiff.pages(frame).collect()]
    assert found == [("a", 0, True), ("a", 1, True), ("b", 0, False), ("c", 0, False), ("d", 0, True), ("d", 1, True), ("d", 2, False), ("e", 0, True), ("e", 1, False), ("f", 0, True), ("f", 1, True)]
    taken = {r.doc_id: r for r in tiff.features(frame.selectExpr("doc_id", "7L AS n_bytes", "media")).collect()}
    assert {k for k, r in taken.items() if r.feature is not None} == {"a", "f"} and len(taken) == 6
    assert taken["a"].payload_bytes == 13 * 64 and taken["b"].media_bytes is None and taken["c"].media_bytes == 2


def test_query(spark):
    texts = [None, "", "a", "é" * 32, "x" * 63, "y" * 64, "z" * 65, "word " * 300, "long " * 200_000] + [f"text {i} " * (i * 9) for i in range(1, 40)]
    rows = [*enumerate(texts), (100, "word " * 300), (None, "n"), (5, "again")]
    frame = spark.createDataFrame([(i, t, b"") for i, t in rows], "doc_id long, text string, MEDIA binary").repartition(3)
    media = tiff.store_texts(frame)
    found = tiff.features(media).collect()
    assert len(found) == len(rows)
    by_hash = {r.payload_sha256: r for r in found}
    for _, t in rows:
        raw = (t or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        r = by_hash[hashlib.sha256(payload).hexdigest()]
        assert (r.payload_bytes, r.tail_crc32) == (len(payload), zlib.crc32(payload[-64:]))
    same = [tuple(r)[1:] for r in found if r.doc_id in (7, 100)]
    assert same[0] == same[1]
    assert {r.feature.split(";codec=")[1].split(";")[0] for r in found} == {"5", "8", "32773"}
    kept = {(r.doc_id, r.media_sha256): (bytes(r.media), r.n_bytes) for r in media.selectExpr("doc_id", "sha2(media, 256) AS media_sha256", "media", "n_bytes").collect()}
    for r in found:
        raw, n_bytes = kept[r.doc_id, r.media_sha256]
        payload, coding = plain_payload(raw)
        assert hashlib.sha256(payload).hexdigest() == r.payload_sha256 and r.media_bytes == len(raw) and r.n_bytes == n_bytes
        number = -(-len(payload) // (64 * 4096))
        mode = max(range(256), key=lambda v: (payload.count(v), -v))
        assert r.feature == f"pages={number};rows={len(payload) // 64};codec={coding};mean={sum(payload) * 1000 // len(payload)};levels={len(set(payload))};mode={mode}"
    assert tiff.pages(media).where("doc_id = 8").count() == 4
    assert tiff.features(tiff.store_texts(frame.limit(0))).count() == 0
