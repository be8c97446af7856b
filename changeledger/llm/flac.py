"""FLAC media columns: mono 8-bit streams of 192-sample frames, coded and decoded in numpy for many frames at a time.

A stream is the marker, STREAMINFO (with the MD5 of the samples), a seek table and the frames. A frame holds one
subframe: constant, verbatim, a fixed predictor (orders 0 to 2) or a linear predictor of order 4, with residuals in one
Rice partition. The decoder finds the frames by their checked headers, verifies every frame's CRC-16, walks the Rice codes of
all frames in step and undoes the prediction. Any sample range is read through the seek table from the frames that
cover it alone.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeledger.llm.common import Scratch
from changeledger.shipping import ship

FRAME, RATE, ORDER, PRECISION, SHIFT, SEEK_EVERY = 192, 8000, 4, 12, 9, 16
#: Frame header up to the frame number: sync and fixed blocking, 192 samples at 8 kHz, mono with 8 bits.
SYNC = bytes([0xFF, 0xF8, 0x14, 0x02])
#: Payload bytes coded at a time.
BATCH = 1 << 20
FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


def _crc_table(poly: int, bits: int) -> np.ndarray:
    out = np.zeros(256, np.uint32)
    for i in range(256):
        c = i << (bits - 8)
        for _ in range(8):
            c = (c << 1) ^ poly if c >> (bits - 1) & 1 else c << 1
        out[i] = c & ((1 << bits) - 1)
    return out


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def _crc(rows: np.ndarray, lengths: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """CRC of the first bytes of every row, all rows in step."""
    crc, mask = np.zeros(len(rows), np.uint32), np.uint32((1 << bits) - 1)
    columns = np.ascontiguousarray(rows.T).astype(np.uint32)
    least = int(lengths.min()) if len(rows) else 0
    for j in range(int(lengths.max()) if len(rows) else 0):
        new = table[(crc >> np.uint32(bits - 8)) ^ columns[j]] ^ ((crc << np.uint32(8)) & mask)
        crc = new if j < least else np.where(j < lengths, new, crc)
    return crc


def _number(n: int) -> bytes:
    """A frame number in FLAC's extension of UTF-8."""
    if n < 0x80:
        return bytes([n])
    tail = b""
    size = 2
    while n >= 1 << (5 * size + 1):
        size += 1
    for _ in range(size - 1):
        tail = bytes([0x80 | n & 0x3F]) + tail
        n >>= 6
    return bytes([(0xFF00 >> size) & 0xFF | n]) + tail


def _headers(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, lengths) of the headers with their CRC-8."""
    kinds, back = np.unique(numbers, return_inverse=True)
    table, size = np.zeros((len(kinds), 12), np.uint8), np.zeros(len(kinds), np.int64)
    for i, n in enumerate(kinds.tolist()):
        head = SYNC + _number(n)
        table[i, : len(head)], size[i] = np.frombuffer(head, np.uint8), len(head)
    table[np.arange(len(kinds)), size] = _crc(table, size, CRC8, 8)
    return table[back], size[back] + 1


def _lpc(x: np.ndarray) -> np.ndarray:
    """Quantised coefficients of order 4 for every frame (Levinson-Durbin, all frames in step)."""
    f = x.astype(np.float64)
    r = [np.einsum("ij,ij->i", f[:, : FRAME - k], f[:, k:]) for k in range(ORDER + 1)]
    r[0] = r[0] * 1.0005 + 1e-3
    error, a = r[0].copy(), np.zeros((len(x), ORDER))
    for i in range(ORDER):
        k = (r[i + 1] - sum(a[:, j] * r[i - j] for j in range(i))) / error
        new = a.copy()
        new[:, i] = k
        for j in range(i):
            new[:, j] = a[:, j] - k * a[:, i - 1 - j]
        a, error = new, np.maximum(error * (1 - k * k), 1e-6)
    most = (1 << (PRECISION - 1)) - 1
    return np.clip(np.rint(a * (1 << SHIFT)), -most - 1, most).astype(np.int64)


def _residuals(x: np.ndarray, coefs: np.ndarray, shift: int) -> np.ndarray:
    order = coefs.shape[1]
    guess = np.zeros((len(x), FRAME - order), np.int32)
    for j in range(order):
        guess += coefs[:, j : j + 1] * x[:, order - 1 - j : FRAME - 1 - j]
    return x[:, order:] - (guess >> shift)


def _rice(res: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(zigzag values, Rice parameter, bits of all codes) for every frame."""
    u = (res << 1) ^ (res >> 31)
    mean = u.mean(1)
    k = np.clip(np.floor(np.log2(np.maximum(mean * 0.75, 1.0))), 0, 14).astype(np.int32)
    return u, k, (u >> k[:, None]).sum(1) + res.shape[1] * (1 + k)


def _bits(values: np.ndarray, n: int) -> np.ndarray:
    """Two's complement bits, high first, as columns."""
    return (values[:, None] >> np.arange(n - 1, -1, -1)) & 1


def encode_frames(x: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frames of the rows of x (int8) as padded rows and their lengths."""
    x = x.astype(np.int32)
    n = len(x)
    same = (x == x[:, :1]).all(1)
    lpc = _lpc(x).astype(np.int32)
    options = [(8 + order, np.tile(np.array(FIXED[order], np.int32), (n, 1)), 0) for order in (0, 1, 2)] + [(32 + ORDER - 1, lpc, SHIFT)]
    costs, coded = [], []
    for kind, coefs, shift in options:
        u, k, bits = _rice(_residuals(x, coefs, shift))
        costs.append(bits + 8 * coefs.shape[1] + 10 + (9 + PRECISION * ORDER if kind >= 32 else 0))
        coded.append((u, k))
    costs.append(np.full(n, 8 * FRAME))
    best = np.where(same, len(options) + 1, np.argmin(costs, 0))
    body = np.zeros((n, FRAME + 16), np.uint8)
    size = np.zeros(n, np.int64)
    rows = np.flatnonzero(best == len(options) + 1)
    body[rows, 0], body[rows, 1], size[rows] = 0, x[rows, 0].astype(np.uint8), 2
    rows = np.flatnonzero(best == len(options))
    body[rows, 0] = 1 << 1
    body[rows, 1 : FRAME + 1], size[rows] = x[rows].astype(np.uint8), FRAME + 1
    for number, (kind, coefs, _) in enumerate(options):
        rows = np.flatnonzero(best == number)
        if not len(rows):
            continue
        order, (u, k) = coefs.shape[1], coded[number]
        u, k = u[rows], k[rows]
        parts = [_bits(np.full(len(rows), kind << 1), 8)] + [_bits(x[rows, j], 8) for j in range(order)]
        if kind >= 32:
            parts += [_bits(np.full(len(rows), PRECISION - 1), 4), _bits(np.full(len(rows), SHIFT), 5)] + [_bits(coefs[rows, j], PRECISION) for j in range(order)]
        head = np.concatenate([*parts, np.zeros((len(rows), 6), np.int32), _bits(k, 4)], axis=1).astype(np.uint8)
        q = u >> k[:, None]
        ends = np.cumsum(q + 1 + k[:, None], axis=1) + head.shape[1]
        total = (ends[:, -1] + 7) // 8
        base = np.concatenate(([0], np.cumsum(total)[:-1])) * 8
        bits = np.zeros(int(total.sum()) * 8, np.uint8)
        bits[base[:, None] + np.arange(head.shape[1])] = head
        stop = base[:, None] + ends - k[:, None] - 1
        bits[stop] = 1
        for b in range(int(k.max())):  # bit b of the remainder, from its low end
            has = np.flatnonzero(k > b)
            at = base[has, None] + ends[has] - 1 - b
            bits[at] = (u[has] >> b) & 1
        flat = np.packbits(bits)
        width = int(total.max())
        inside = np.arange(width) < total[:, None]
        part = np.zeros((len(rows), width), np.uint8)
        part[inside] = flat
        body[rows, :width], size[rows] = part, total
    heads, head_size = _headers(numbers)
    out = np.zeros((n, body.shape[1] + 14), np.uint8)
    for length in np.unique(head_size).tolist():
        mine = head_size == length
        out[mine, :length], out[mine, length : length + body.shape[1]] = heads[mine, :length], body[mine]
    whole = head_size + size
    crc = _crc(out, whole, CRC16, 16)
    out[np.arange(n), whole], out[np.arange(n), whole + 1] = crc >> 8, crc & 255
    return out, whole + 2


def payload(text: bytes) -> bytes:
    """The text padded with spaces to a positive multiple of 192 bytes."""
    return text.ljust(max(FRAME, -(-len(text) // FRAME) * FRAME), b" ")


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC streams of payloads whose lengths are positive multiples of 192."""
    counts = [len(p) // FRAME for p in payloads]
    x = np.frombuffer(b"".join(payloads), np.int8).reshape(-1, FRAME)
    rows, sizes = [], []
    numbers = np.concatenate([np.arange(c) for c in counts]) if counts else np.zeros(0, np.int64)
    for at in range(0, len(x), BATCH // FRAME):
        r, s = encode_frames(x[at : at + BATCH // FRAME], numbers[at : at + BATCH // FRAME])
        rows.append(r[np.arange(r.shape[1]) < s[:, None]].tobytes())
        sizes.append(s)
    flat, sizes = b"".join(rows), np.concatenate(sizes or [np.zeros(0, np.int64)])
    ends = np.concatenate(([0], np.cumsum(sizes)))
    out, frame = [], 0
    for p, c in zip(payloads, counts):
        own = sizes[frame : frame + c]
        points = range(0, c, SEEK_EVERY)
        offset = ends[frame : frame + c] - ends[frame]
        info = struct.pack(">HH", FRAME, FRAME) + int(own.min()).to_bytes(3, "big") + int(own.max()).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big") + hashlib.md5(p).digest()
        seek = b"".join(struct.pack(">QQH", i * FRAME, int(offset[i]), FRAME) for i in points)
        out.append(b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(seek).to_bytes(3, "big") + seek + flat[ends[frame] : ends[frame + c]])
        frame += c
    return out


class Header:
    """STREAMINFO and the seek table of a stream."""

    def __init__(self, media: bytes):
        if media[:4] != b"fLaC":
            raise ValueError("not a FLAC stream")
        at, self.seek, last = 4, np.zeros((0, 2), np.int64), False
        while not last:
            kind, size = media[at] & 127, int.from_bytes(media[at + 1 : at + 4], "big")
            last, block = bool(media[at] >> 7), media[at + 4 : at + 4 + size]
            if kind == 0:
                packed = int.from_bytes(block[10:18], "big")
                self.samples, self.md5 = packed & ((1 << 36) - 1), block[18:34]
                if struct.unpack(">HH", block[:4]) != (FRAME, FRAME) or packed >> 36 & 31 != 7 or packed >> 41 & 7:
                    raise ValueError("only mono 8-bit streams of 192-sample frames are read")
            elif kind == 3:
                points = np.frombuffer(block, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")]))
                self.seek = np.stack([points["sample"].astype(np.int64), points["offset"].astype(np.int64)], 1)
            at += 4 + size
        self.start = at


def _whole(frame: np.ndarray) -> bool:
    """Whether the last two bytes are the CRC-16 of those before."""
    if len(frame) < 8:
        return False
    crc = _crc(frame[None, :-2], np.array([len(frame) - 2]), CRC16, 16)[0]
    return int(crc) == int(frame[-2]) << 8 | int(frame[-1])


def _frame_starts(data: np.ndarray, first: int, count: int) -> np.ndarray:
    """Offsets of frames first, first + 1, ... in data, which begins with the first of them; count or fewer."""
    d = data
    hit = np.flatnonzero((d[:-5] == SYNC[0]) & (d[1:-4] == SYNC[1]) & (d[2:-3] == SYNC[2]) & (d[3:-2] == SYNC[3])) if len(d) > 6 else np.zeros(0, np.int64)
    padded = np.concatenate((d, np.zeros(16, np.uint8)))
    heads, sizes = _headers(np.arange(first, first + count))
    if len(hit) != count or not (padded[hit[:, None] + np.arange(heads.shape[1])] == heads)[np.arange(heads.shape[1]) < sizes[:, None]].all():
        good, want = [], 0
        # Coded bits may look like a header, even like the next one: then the frame before it has no right checksum.
        for h in hit.tolist():
            same = want < count and padded[h : h + sizes[want]].tobytes() == heads[want, : sizes[want]].tobytes()
            if same and (not good or _whole(d[good[-1] : h])):
                good.append(h)
                want += 1
        hit = np.array(good, np.int64)
    if len(hit) != count:
        raise ValueError("frames are missing")
    return hit


def decode_frames(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Samples (int8) of the frames data[starts:ends], whose headers have `head` bytes."""
    n, width = len(starts), int((ends - starts).max()) if len(starts) else 0
    padded = np.concatenate((data, np.zeros(width + 16, np.uint8)))
    rows = padded[starts[:, None] + np.arange(width)]
    crc = _crc(rows, ends - starts - 2, CRC16, 16)
    if (crc != (padded[ends - 2].astype(np.uint32) << 8 | padded[ends - 1])).any():
        raise ValueError("a frame's checksum differs")
    at = starts + head
    kind = (padded[at] >> 1 & 63).astype(np.int64)
    out = np.zeros((n, FRAME), np.int32)
    rows = np.flatnonzero(kind == 0)
    out[rows] = padded[at[rows] + 1].view(np.int8)[:, None]
    rows = np.flatnonzero(kind == 1)
    out[rows] = padded[at[rows, None] + 1 + np.arange(FRAME)].view(np.int8)
    rows = np.flatnonzero(kind >= 8)
    if len(rows):
        bits = np.unpackbits(padded)
        ones = np.flatnonzero(bits).astype(np.int32)
        next_one = ones[np.minimum(np.cumsum(bits, dtype=np.int32) - bits, len(ones) - 1)]
        b = [padded[i : len(padded) - 3 + i].astype(np.uint32) for i in range(4)]
        window = b[0] << 24 | b[1] << 16 | b[2] << 8 | b[3]

        def take(pos: np.ndarray, count: int) -> np.ndarray:
            return (window[pos >> 3] >> (32 - count - (pos & 7)).astype(np.uint32) & np.uint32((1 << count) - 1)).astype(np.int32)

        def signed(v: np.ndarray, count: int) -> np.ndarray:
            return v - ((v >> (count - 1)) << count)

        kind, pos = kind[rows], at[rows] * 8 + 8
        linear = kind >= 32
        order = np.where(linear, kind - 31, kind - 8)
        most = int(order.max())
        if most > 4 or ((kind > 12) & ~linear).any():
            raise ValueError("predictors have an order of 4 at most")
        x = np.zeros((FRAME, len(rows)), np.int32)
        for j in range(most):
            mine = order > j
            x[j, mine] = signed(take(pos[mine], 8), 8)
            pos = pos + 8 * mine
        coefs, shift = np.zeros((4, len(rows)), np.int32), np.zeros(len(rows), np.int32)
        for o, c in FIXED.items():
            coefs[: len(c), (order == o) & ~linear] = np.array(c, np.int32).reshape(-1, 1)
        if linear.any():
            precision = np.where(linear, take(pos, 4) + 1, 0)
            shift = np.where(linear, signed(take(pos + 4, 5), 5), 0)
            pos = pos + 9 * linear
            for j in range(most):
                for p in np.unique(precision[linear]).tolist():
                    mine = linear & (order > j) & (precision == p)
                    coefs[j, mine] = signed(take(pos[mine], p), p)
                pos = pos + np.where(linear & (order > j), precision, 0)
        if take(pos, 6).any():
            raise ValueError("residuals have one partition of 4-bit parameters")
        k = take(pos + 6, 4)
        pos = pos + 10
        low = (np.uint32(1) << k.astype(np.uint32)) - np.uint32(1)
        for t in range(FRAME):
            on = None if t >= most else order <= t
            stop = next_one[pos]
            rest = stop + 1
            back = window[rest >> 3] >> (32 - k - (rest & 7)).astype(np.uint32) & low if int(k.max()) else 0
            u = ((stop - pos) << k) + np.asarray(back).astype(np.int64)
            value = (u >> 1) ^ -(u & 1)
            if t:
                guess = coefs[0] * x[t - 1]
                for j in range(1, min(most, t)):
                    guess = guess + coefs[j] * x[t - 1 - j]
                value = value + (guess >> shift)
            if on is None:
                x[t], pos = value, rest + k
            else:
                x[t], pos = np.where(on, value, x[t]), np.where(on, rest + k, pos)
        out[rows] = x.T
    if ((out < -128) | (out > 127)).any():
        raise ValueError("samples leave 8 bits")
    return out.astype(np.int8)


def decode(media: list[bytes]) -> list[bytes]:
    """The samples' bytes of whole streams; frame checksums and the stream's MD5 are verified."""
    out: list[bytes] = []
    group: list[tuple] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        if not group:
            return
        data = np.frombuffer(b"".join(g[0] for g in group), np.uint8)
        base = np.cumsum([0] + [len(g[0]) for g in group])
        starts = np.concatenate([g[1] + b for g, b in zip(group, base)])
        ends = np.concatenate([np.append(g[1][1:], len(g[0])) + b for g, b in zip(group, base)])
        heads = np.concatenate([g[2] for g in group])
        step = BATCH // FRAME
        samples = []
        for a in range(0, len(starts), step):
            lo, hi = int(starts[a]), int(ends[min(a + step, len(ends)) - 1])
            samples.append(decode_frames(data[lo:hi], starts[a : a + step] - lo, ends[a : a + step] - lo, heads[a : a + step]))
        flat, at = np.concatenate(samples).tobytes(), 0
        for *_, header in group:
            piece = flat[at : at + header.samples]
            if hashlib.md5(piece).digest() != header.md5:
                raise ValueError("the stream's MD5 differs")
            out.append(piece)
            at += header.samples
        group, held = [], 0

    for m in media:
        header = Header(m)
        frames = m[header.start :]
        count = header.samples // FRAME
        starts = _frame_starts(np.frombuffer(frames, np.uint8), 0, count)
        group.append((frames, starts, _headers(np.arange(count))[1], header))
        held += header.samples
        if held >= BATCH:
            flush()
    flush()
    return out


def read_ranges(wanted: list[tuple[bytes, int, int]]) -> list[bytes]:
    """Samples start to start + count of each (stream, start, count), from the frames between the seek points around them."""
    pieces, at, starts, ends, heads, cuts = [], 0, [], [], [], []
    for media, start, count in wanted:
        header = Header(media)
        stop = min(start + count, header.samples)
        i = max(0, int(np.searchsorted(header.seek[:, 0], start, "right")) - 1)
        j = int(np.searchsorted(header.seek[:, 0], stop, "left"))
        lo, hi = int(header.seek[i, 1]), int(header.seek[j, 1]) if j < len(header.seek) else len(media) - header.start
        first, last = int(header.seek[i, 0]) // FRAME, int(header.seek[j, 0]) // FRAME if j < len(header.seek) else header.samples // FRAME
        data = media[header.start + lo : header.start + hi]
        own = _frame_starts(np.frombuffer(data, np.uint8), first, last - first)
        a, z = start // FRAME - first, -(-stop // FRAME) - first  # of these frames, the ones that hold the samples
        pieces.append(data)
        starts.append(own[a:z] + at)
        ends.append(np.append(own[1:], len(data))[a:z] + at)
        heads.append(_headers(np.arange(first, last))[1][a:z])
        cuts.append((start - (first + a) * FRAME, stop - (first + a) * FRAME, (z - a) * FRAME))
        at += len(data)
    if not pieces:
        return []
    flat = decode_frames(np.frombuffer(b"".join(pieces), np.uint8), np.concatenate(starts), np.concatenate(ends), np.concatenate(heads)).tobytes()
    out, at = [], 0
    for a, z, n in cuts:
        out.append(flat[at + a : at + z])
        at += n
    return out


def read_samples(media: bytes, start: int, count: int) -> bytes:
    return read_ranges([(media, start, count)])[0]


def _slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes."""
    sizes = [0 if x is None else x for x in pa.compute.binary_length(column).to_pylist()]
    first = held = 0
    for i, s in enumerate(sizes):
        held += s
        if held >= most:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def to_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text as a FLAC stream; a null text is empty."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            for lo, hi in _slices(texts, 4 * BATCH):
                part = [t or b"" for t in texts.slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(map(len, part), pa.int64()), pa.array(encode(list(map(payload, part))), pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def feature(pcm: bytes) -> str:
    """Root mean square, mean step between samples and share of sign changes of the PCM block."""
    x = np.frombuffer(pcm, np.int8).astype(np.float64)
    step = np.abs(np.diff(x)).mean()
    return f"rms={np.sqrt((x * x).mean()):.4f};step={step:.4f};zcr={np.mean(np.signbit(x[1:]) != np.signbit(x[:-1])):.4f}"


def from_media(media: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media, pcm): the decoded PCM block beside each stream."""
    ship(media.sparkSession)

    def run(batches):
        for b in batches:
            for lo, hi in _slices(b.column(2), 4 * BATCH):
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decode(part.column(2).to_pylist()), pa.binary())], ["doc_id", "n_bytes", "media", "pcm"])

    return media.mapInArrow(run, "doc_id long, n_bytes long, media binary, pcm binary")


def digests(media: DataFrame) -> DataFrame:
    """Facts of each stream, from its stored bytes; the tail is read through the seek table."""
    ship(media.sparkSession)

    def run(batches):
        for b in batches:
            for lo, hi in _slices(b.column(2), 4 * BATCH):
                part = b.slice(lo, hi - lo)
                streams = part.column(2).to_pylist()
                pcm = decode(streams)
                tail = list(map(zlib.crc32, read_ranges([(m, len(p) - 16, 16) for m, p in zip(streams, pcm)])))
                cols = [
                    part.column(0), part.column(1), pa.array(map(len, pcm), pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in pcm]), pa.array(tail, pa.int64()),
                    pa.array(map(len, streams), pa.int64()), pa.array([hashlib.sha256(m).hexdigest() for m in streams]), pa.array(map(feature, pcm)),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def pcm_blocks(media: DataFrame, frames: int = 64) -> DataFrame:
    """(doc_id, sample_offset, pcm): each stream's samples in blocks of `frames` frames, to be found by their offset.

    Every stream has at least one block, the last may be shorter; offsets count samples from the stream's start.
    """
    ship(media.sparkSession)
    size = frames * FRAME

    def run(batches):
        for b in batches:
            for lo, hi in _slices(b.column(1), 4 * BATCH):
                ids, at, blocks = [], [], []
                for doc_id, pcm in zip(b.column(0).slice(lo, hi - lo).to_pylist(), decode(b.column(1).slice(lo, hi - lo).to_pylist())):
                    for a in range(0, len(pcm), size):
                        ids.append(doc_id)
                        at.append(a)
                        blocks.append(pcm[a : a + size])
                columns = [pa.array(ids, pa.int64()), pa.array(at, pa.int64()), pa.array(blocks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sample_offset", "pcm"])

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, sample_offset long, pcm binary")


def round_trip(docs: DataFrame) -> DataFrame:
    """Facts of every row's text, from the streams that are stored in the shared folder and read back.

    Null and empty texts are 192 spaces; repeated rows and null ids each get a row; equal texts have equal streams;
    other columns are ignored; an empty table gives no rows.
    """
    stored = Scratch(docs.sparkSession).save(to_media(docs), "media", compression="zstd")
    return digests(stored)
