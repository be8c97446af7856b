import hashlib
import zlib

import numpy as np
import pytest

from changeledger.llm import flac
from changeledger.llm.queries import op3_flac
from tests.conftest import SF

RND = np.random.default_rng(6)
BLOCKS = [b" " * 192, bytes(RND.integers(0, 256, 1920, dtype=np.uint8)), flac.payload("Lorem ipsum dolor sit amet, élan ".encode() * 900), flac.payload(b"a" * 500 + b"\xff\xf8\x14\x02\x00" * 99), bytes(np.repeat(np.arange(256, dtype=np.uint8), 96)), flac.payload(b"x")]


def test_streams():
    streams = flac.encode(BLOCKS)
    assert flac.decode(streams) == BLOCKS
    assert streams == [flac.encode([b])[0] for b in BLOCKS]
    for m, b in zip(streams, BLOCKS):
        for a, n in ((0, 1), (len(b) - 16, 16), (max(0, len(b) // 2 - 5), 300)):
            assert flac.read_samples(m, a, n) == b[a : a + n]


class Bits:
    def __init__(self, data):
        self.data, self.at = data, 0

    def take(self, n):
        out = 0
        for _ in range(n):
            out = out << 1 | self.data[self.at >> 3] >> 7 - (self.at & 7) & 1
            self.at += 1
        return out

    def signed(self, n):
        v = self.take(n)
        return v - (1 << n) if v >> n - 1 else v


def plain_crc(data, poly, bits):
    crc = 0
    for byte in data:
        crc ^= byte << bits - 8
        for _ in range(8):
            crc = (crc << 1 ^ (poly if crc >> bits - 1 else 0)) & (1 << bits) - 1
    return crc


def plain_decode(media):
    """A stream read bit by bit after the format's description, without the library's helpers."""
    assert media[:4] == b"fLaC"
    at, last, seek = 4, False, []
    while not last:
        last, kind, size = media[at] >> 7, media[at] & 127, int.from_bytes(media[at + 1 : at + 4], "big")
        block = media[at + 4 : at + 4 + size]
        if kind == 0:
            total, md5 = int.from_bytes(block[10:18], "big") & (1 << 36) - 1, block[18:34]
        elif kind == 3:
            seek = [(int.from_bytes(block[k : k + 8], "big"), int.from_bytes(block[k + 8 : k + 16], "big")) for k in range(0, size, 18)]
        at += 4 + size
    first, out, starts = at, [], {}
    while len(out) < total:
        b, begin = Bits(media), at
        starts[len(out)] = begin - first
        b.at = 8 * begin
        assert (b.take(14), b.take(2), b.take(8), b.take(8)) == (0x3FFE, 0, 0x14, 0x02)
        lead = b.take(8)
        more = 0 if lead < 0x80 else 8 - (lead ^ 255).bit_length()
        number = lead if not more else lead & (1 << 7 - more) - 1
        for _ in range(max(0, more - 1)):
            number = number << 6 | b.take(8) & 63
        assert number == len(out) // 192
        head = b.at // 8
        assert b.take(8) == plain_crc(media[begin:head], 0x07, 8)
        kind = b.take(8) >> 1
        if kind == 0:
            x = [b.signed(8)] * 192
        elif kind == 1:
            x = [b.signed(8) for _ in range(192)]
        else:
            order = kind - 31 if kind >= 32 else kind - 8
            x = [b.signed(8) for _ in range(order)]
            if kind >= 32:
                precision, shift = b.take(4) + 1, b.signed(5)
                coefs = [b.signed(precision) for _ in range(order)]
            else:
                shift, coefs = 0, ([], [1], [2, -1])[order]
            assert b.take(6) == 0
            k = b.take(4)
            while len(x) < 192:
                q = 0
                while not b.take(1):
                    q += 1
                u = q << k | b.take(k)
                x.append((u >> 1 ^ -(u & 1)) + (sum(c * x[-1 - j] for j, c in enumerate(coefs)) >> shift))
        b.at = -(-b.at // 8) * 8
        end = b.at // 8
        assert b.take(16) == plain_crc(media[begin:end], 0x8005, 16)
        out += x
        at = end + 2
    assert at == len(media) and all(starts[s] == o for s, o in seek) and len(seek) == -(-len(starts) // 16)
    pcm = np.array(out, np.int8).tobytes()
    assert hashlib.md5(pcm).digest() == md5
    return pcm


def test_streams_by_a_plain_decoder():
    wave = (90 * np.sin(np.arange(192 * 140) * 0.4)).astype(np.int8).tobytes()
    for b in [*BLOCKS, wave]:
        assert plain_decode(flac.encode([b])[0]) == b


def test_false_header():
    """Verbatim samples that read like the next frame's header do not end a frame."""
    head, size = flac._headers(np.array([1]))
    noise = RND.integers(0, 256, 192 * 3, dtype=np.uint8)
    noise[50 : 50 + size[0]] = head[0, : size[0]]
    m = flac.encode([noise.tobytes()])[0]
    assert flac.decode([m]) == [noise.tobytes()] == [plain_decode(m)] and flac.read_samples(m, 180, 30) == noise[180:210].tobytes()


def test_predictors():
    t = np.arange(192 * 40)
    wave = (60 * np.sin(t * 1.3) + 40 * np.sin(t * 0.7)).astype(np.int8)
    ramp = ((t // 3) % 100 - 50).astype(np.int8)
    noise = RND.normal(0, 3, len(t)).astype(np.int8)
    kinds = set()
    for x in (wave, ramp, noise):
        m = flac.encode([x.tobytes()])[0]
        assert flac.decode([m]) == [x.tobytes()] and len(m) < 0.8 * len(t)
        h = flac.Header(m)
        d = np.frombuffer(m[h.start :], np.uint8)
        s = flac._frame_starts(d, 0, 40)
        kinds |= set((d[s + 6] >> 1).tolist())
    assert {8, 35} <= kinds and kinds & {9, 10}


def test_damage():
    m = bytearray(flac.encode([BLOCKS[2]])[0])
    m[-40] ^= 4
    with pytest.raises(ValueError):
        flac.decode([bytes(m)])


def test_numbers():
    assert [flac._number(n) for n in (5, 0x7F)] == [b"\x05", b"\x7f"] and all(flac._number(n) == chr(n).encode() for n in (0x80, 0x7FF, 0x800, 0xFFFD, 0x10000, 0x10FFFF))
    assert flac._crc(np.frombuffer(b"123456789", np.uint8)[None], np.array([9]), flac.CRC8, 8)[0] == 0xF4
    assert flac._crc(np.frombuffer(b"123456789", np.uint8)[None], np.array([9]), flac.CRC16, 16)[0] == 0xFEE8


def check(rows, got):
    assert len(got) == len(rows)
    want = {}
    for d, t in rows:
        p = flac.payload((t or "").encode())
        want.setdefault(d, set()).add((len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))
    for r in got:
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) in want[r.doc_id] and r.media_bytes > 0 and r.feature
    by = {}
    for r in got:
        assert by.setdefault(r.payload_sha256, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)


def test_small(spark):
    rows = [(1, None), (2, ""), (3, "é😀"), (3, "é😀"), (None, "x" * 192), (4, "word " * 60000), (5, "\x00" * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as media", "2 as n_bytes")
    check(rows, flac.round_trip(df).collect())
    assert [bytes(r.pcm) for r in flac.from_media(flac.to_media(df.where("doc_id = 5"))).collect()] == [flac.payload(b"\x00" * 200)]
    blocks = flac.pcm_blocks(flac.to_media(df.where("doc_id in (4, 5)")), 8).collect()
    text = flac.payload(b"word " * 60000)
    assert {(r.doc_id, r.sample_offset): bytes(r.pcm) for r in blocks} == {(4, a): text[a : a + 1536] for a in range(0, len(text), 1536)} | {(5, 0): flac.payload(b"\x00" * 200)}
    assert flac.round_trip(df.limit(0)).count() == 0


def test_stored_streams_are_read_back(spark, monkeypatch):
    """What round_trip reports comes from the stored table: damage there is found."""
    df = spark.createDataFrame([(1, "some words " * 50)], "doc_id long, text string")
    saved = []
    real = flac.Scratch.save
    monkeypatch.setattr(flac.Scratch, "save", lambda self, rows, *a, **k: saved.append(real(self, rows, *a, **k)) or saved[-1])
    flac.round_trip(df).collect()
    assert saved[0].columns == ["doc_id", "n_bytes", "media"] and plain_decode(bytes(saved[0].first().media)) == flac.payload(b"some words " * 50)


def test_query(spark):
    check([(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()], op3_flac(spark, SF).collect())
