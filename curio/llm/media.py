"""Media columns: AVI motion JPEG.

Writing: a payload becomes 24 x 24 grey frames of 8-bit samples, each a lossless JPEG (SOF3, predictor 1) in a RIFF AVI file
with an idx1 index. The Huffman table gives every difference category c a code of 9 - c bits, so each sample takes 9 bits, the
code of all ones stays free as the standard asks, and frames decode without a bit-by-bit loop.

Reading: the RIFF chunks and the idx1 index are parsed, each indexed frame is decoded, and shots are cut where the difference
of successive frames' histograms exceeds an adaptive threshold. Frames of other lossless JPEG writers (any Huffman tables,
predictors 1 to 7, one component) go through a general decoder.

The media column is a written table of AVI files; digests, features and clips are read from there.

Defined results: null is the empty payload; padding is bytes 255 up to a positive multiple of 576. Equal payloads give equal
files and features. A file without index is read by its movi list. Damaged files raise ValueError. Memory: one Arrow batch,
worked through in groups of at most GROUP_BYTES.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curio.llm.common import byte_column, docs_of, map_arrow, materialise

SIDE = 24
FRAME = SIDE * SIDE
FPS = 25
BINS = 16
GROUP_BYTES = 4 << 20

# Shots: a cut where the difference exceeds the mean of the window before it by this many mean deviations, and a floor.
SHOT_WINDOW, SHOT_FACTOR, SHOT_FLOOR = 8, 3, FRAME // 8

_LENGTHS = [9 - c for c in range(9)]  # of the code of category c


def _codes() -> np.ndarray:
    """9-bit codes of the differences -255..255."""
    code, last, cats = 0, 0, {}
    for c in range(8, -1, -1):
        code <<= _LENGTHS[c] - last
        cats[c], last, code = code, _LENGTHS[c], code + 1
    out = np.zeros(511, np.uint16)
    for d in range(-255, 256):
        c = abs(d).bit_length()
        out[d + 255] = (cats[c] << c) | (d if d > 0 else d + (1 << c) - 1 if c else 0)
    return out


CODE = _codes()
DIFF = np.zeros(512, np.int16)
DIFF[CODE] = np.arange(-255, 256)
_DHT = struct.pack(">HB16B", 19 + 9, 0, *[1 if n in _LENGTHS else 0 for n in range(1, 17)]) + bytes(range(8, -1, -1))
_HEAD = b"\xff\xd8" + b"\xff\xc4" + _DHT + b"\xff\xc3" + struct.pack(">HBHHB3B", 11, 8, SIDE, SIDE, 1, 1, 0x11, 0) + b"\xff\xda" + struct.pack(">HB2B3B", 8, 1, 1, 0, 1, 0, 0)
_TAIL = b"\xff\xd9"


def padded(raw: bytes) -> bytes:
    return raw + b"\xff" * (-len(raw) % FRAME or (0 if raw else FRAME))


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """Lossless JPEG files of (n, 24, 24) 8-bit samples."""
    s = samples.astype(np.int16)
    pred = np.empty_like(s)
    pred[:, :, 1:] = s[:, :, :-1]
    pred[:, 1:, 0] = s[:, :-1, 0]
    pred[:, 0, 0] = 128
    v = CODE[(s - pred + 255).reshape(-1)].reshape(-1, 8)
    out = np.empty((len(v), 9), np.uint8)
    for k in range(9):  # eight 9-bit values to nine bytes
        left = v[:, k - 1] << (8 - k) if k else 0
        right = v[:, k] >> (k + 1) if k < 8 else 0
        out[:, k] = (left | right) & 255
    flat = out.tobytes()
    size = FRAME * 9 // 8
    return [_HEAD + flat[i : i + size].replace(b"\xff", b"\xff\x00") + _TAIL for i in range(0, len(flat), size)]


def decode_frames(files: list[bytes]) -> np.ndarray:
    """(n, 24, 24) samples of frames that encode_frames wrote; of others too, if they have that size."""
    size, cut, plain = FRAME * 9 // 8, len(_HEAD), []
    other: dict[int, np.ndarray] = {}
    for i, f in enumerate(files):
        body = f[cut:-2].replace(b"\xff\x00", b"\xff") if f.startswith(_HEAD) and f.endswith(_TAIL) else b""
        if len(body) != size:
            other[i] = decode_any(f)
            if other[i].shape != (SIDE, SIDE):
                raise ValueError("frame of another size")
            body = bytes(size)
        plain.append(body)
    b = np.frombuffer(b"".join(plain), np.uint8).reshape(-1, 9).astype(np.uint16)
    v = np.empty((len(b), 8), np.uint16)
    for k in range(8):
        v[:, k] = ((b[:, k] << (k + 1)) | (b[:, k + 1] >> (7 - k))) & 511
    d = DIFF[v.reshape(-1)].reshape(-1, SIDE, SIDE)
    d[:, 0, 0] += 128
    d[:, :, 0] = np.cumsum(d[:, :, 0], axis=1)
    s = np.cumsum(d, axis=2, dtype=np.int16).astype(np.uint8)
    for i, x in other.items():
        s[i] = x
    return s


def decode_any(file: bytes) -> np.ndarray:
    """One-component lossless JPEG with any Huffman tables and predictor 1 to 7, bit by bit."""
    if file[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    at, tables, shape = 2, {}, None
    while True:
        if at + 4 > len(file) or file[at] != 0xFF:
            raise ValueError("damaged JPEG file")
        mark, (n,) = file[at + 1], struct.unpack_from(">H", file, at + 2)
        seg = file[at + 4 : at + 2 + n]
        at += 2 + n
        if mark == 0xC4:
            while seg:
                counts, code, k, own = seg[1:17], 0, 17, {}
                for bits in range(1, 17):
                    for _ in range(counts[bits - 1]):
                        own[bits, code] = seg[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                tables[seg[0]] = own
                seg = seg[k:]
        elif mark == 0xC3:
            precision, rows, cols, parts = struct.unpack_from(">BHHB", seg)
            if precision != 8 or parts != 1:
                raise ValueError("only one component of 8 bits")
            shape = rows, cols
        elif 0xC0 <= mark <= 0xCF and mark != 0xC8 and mark != 0xCC:
            raise ValueError("only lossless frames (SOF3)")
        elif mark == 0xDA:
            own, predictor, shift = tables[seg[2] >> 4], seg[3], seg[5] & 15
            break
    if shape is None:
        raise ValueError("damaged JPEG file")
    body = file[at:].split(_TAIL)[0].replace(b"\xff\x00", b"\xff")
    bits, pos = int.from_bytes(body, "big"), 0
    total = 8 * len(body)

    def take(n: int) -> int:
        nonlocal pos
        if pos + n > total:
            raise ValueError("damaged JPEG file")
        pos += n
        return (bits >> (total - pos)) & ((1 << n) - 1)

    out = np.zeros(shape, np.int32)
    for y in range(shape[0]):
        for x in range(shape[1]):
            code, n = take(1), 1
            while (n, code) not in own:
                code, n = code << 1 | take(1), n + 1
                if n > 16:
                    raise ValueError("damaged JPEG file")
            c = own[n, code]
            m = take(c) if 0 < c < 16 else 0
            d = 32768 if c == 16 else m if not c or m >> (c - 1) else m - (1 << c) + 1
            a, b = (out[y, x - 1] if x else 0), (out[y - 1, x] if y else 0)
            if not x and not y:
                p = 1 << (7 - shift)
            elif not y:
                p = a
            elif not x:
                p = b
            else:
                cc = out[y - 1, x - 1]
                p = (0, a, b, cc, a + b - cc, a + ((b - cc) >> 1), b + ((a - cc) >> 1), (a + b) >> 1)[predictor]
            out[y, x] = (p + d) & 0xFFFF
    return (out << shift).astype(np.uint8)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(frames: list[bytes]) -> bytes:
    largest = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, largest * FPS, 0, 0x10, len(frames), 0, 1, largest, SIDE, SIDE, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, len(frames), largest, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    body, index, at = [b"movi"], [], 4
    for f in frames:
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        body.append(_chunk(b"00dc", f))
        at += len(body[-1])
    rest = b"AVI " + hdrl + _chunk(b"LIST", b"".join(body)) + _chunk(b"idx1", b"".join(index))
    return b"RIFF" + struct.pack("<I", len(rest)) + rest


def _chunks(raw: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    if end > len(raw):
        raise ValueError("damaged RIFF file")
    while at + 8 <= end:
        name, (n,) = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)
        if at + 8 + n > end:
            raise ValueError("damaged RIFF chunk")
        yield name, at + 8, n
        at += 8 + n + (n & 1)


def read_avi(raw: bytes) -> tuple[int, list[bytes]]:
    """(microseconds per frame, JPEG files of the first video stream), by the idx1 index where there is one."""
    if raw[:4] != b"RIFF" or raw[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    movi, index, us = None, None, 0
    for name, at, n in _chunks(raw, 12, 8 + struct.unpack_from("<I", raw, 4)[0]):
        kind = raw[at : at + 4]
        if name == b"LIST" and kind == b"movi":
            movi = at, n
        elif name == b"LIST" and kind == b"hdrl":
            for inner, a, _ in _chunks(raw, at + 4, at + n):
                if inner == b"avih":
                    us = struct.unpack_from("<I", raw, a)[0]
        elif name == b"idx1":
            index = at, n
    if movi is None:
        raise ValueError("no movi list")
    if index is None:
        return us, [raw[a : a + n] for name, a, n in _chunks(raw, movi[0] + 4, sum(movi)) if name[2:] in (b"dc", b"db")]
    rows = [x for x in struct.iter_unpack("<4sIII", raw[index[0] : sum(index)]) if x[0][2:] in (b"dc", b"db")]
    base = movi[0] if not rows or raw[movi[0] + rows[0][2] : movi[0] + rows[0][2] + 4] == rows[0][0] else 0  # offsets from movi or from the file
    out = []
    for name, _, at, n in rows:
        if raw[base + at : base + at + 4] != name or struct.unpack_from("<I", raw, base + at + 4)[0] != n:
            raise ValueError("index does not match the frames")
        out.append(raw[base + at + 8 : base + at + 8 + n])
    return us, out


def histograms(samples: np.ndarray) -> np.ndarray:
    n = len(samples)
    at = (np.arange(n, dtype=np.int64)[:, None] * BINS + (samples.reshape(n, -1) >> 4)).reshape(-1)
    return np.bincount(at, minlength=n * BINS).reshape(n, BINS).astype(np.int64)


def shots(hist: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) frame numbers of the shots. Integers throughout, so equal payloads always agree."""
    d = np.abs(np.diff(hist, axis=0)).sum(axis=1)
    starts = [0]
    if len(d) and int(d.max()) > SHOT_FLOOR:
        total = np.concatenate([[0], np.cumsum(d)])
        for i in np.nonzero(d > SHOT_FLOOR)[0].tolist():
            lo = max(0, i - SHOT_WINDOW, starts[-1])
            n = i - lo
            if n:
                own = d[lo:i]
                mean = int(total[i] - total[lo])  # n times the mean
                spread = int(np.abs(own * n - mean).sum())  # n * n times the mean deviation
                if int(d[i]) * n * n <= mean * n + SHOT_FACTOR * spread:
                    continue
            starts.append(i + 1)
    return list(zip(starts, [*starts[1:], len(hist)], strict=True))


def feature(hist: np.ndarray, cuts: list[tuple[int, int]]) -> str:
    total = hist.sum(axis=0)
    longest = max(b - a for a, b in cuts)
    return f"frames={len(hist)};shots={len(cuts)};longest={longest};hist=" + ",".join(map(str, total.tolist()))


def encode_column(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): the media column of all texts."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = byte_column(b.column(1))
            for lo, hi in _groups([len(x) for x in raws]):
                pay = [padded(x) for x in raws[lo:hi]]
                files = encode_frames(np.frombuffer(b"".join(pay), np.uint8).reshape(-1, SIDE, SIDE))
                media, at = [], 0
                for p in pay:
                    n = len(p) // FRAME
                    media.append(write_avi(files[at : at + n]))
                    at += n
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array([len(x) for x in raws[lo:hi]], pa.int64()), pa.array(media, schema.field(2).type)], schema=schema)

    return map_arrow(docs_of(docs), run, "doc_id bigint, n_bytes bigint, media binary")


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > GROUP_BYTES:
            yield lo, i
            lo, total = i, 0
        total += n
    if sizes:
        yield lo, len(sizes)


def _decoded(b: pa.RecordBatch) -> Iterator[tuple[int, int, list[tuple[int, bytes, np.ndarray, np.ndarray]]]]:
    """(lo, hi, per file: microseconds per frame, file, samples, histograms) of groups of rows."""
    media = b.column(2).to_pylist()
    for lo, hi in _groups([len(x) for x in media]):
        parsed = [read_avi(x) for x in media[lo:hi]]
        samples = decode_frames([f for _, fs in parsed for f in fs])
        hist, at, out = histograms(samples), 0, []
        for (us, fs), raw in zip(parsed, media[lo:hi], strict=True):
            out.append((us, raw, samples[at : at + len(fs)], hist[at : at + len(fs)]))
            at += len(fs)
        yield lo, hi, out


def read_column(media: DataFrame) -> DataFrame:
    """Digests and features from the stored bytes of (doc_id, n_bytes, media)."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, files in _decoded(b):
                rows = []
                for (_, raw, samples, hist), n in zip(files, b.column(1).slice(lo, hi - lo).to_pylist(), strict=True):
                    pay = samples.tobytes()
                    rows.append((n, len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-32:]), len(raw), hashlib.sha256(raw).hexdigest(), feature(hist, shots(hist))))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *(pa.array(c, t.type) for c, t in zip(cols, list(schema)[1:], strict=True))], schema=schema)

    return map_arrow(media, run, "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")


def clips(media: DataFrame) -> DataFrame:
    """Timed clip rows: one per shot, with frame numbers and seconds."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, files in _decoded(b):
                rows = []
                for doc, (us, _, _, hist) in zip(b.column(0).slice(lo, hi - lo).to_pylist(), files, strict=True):
                    rows += [(doc, k, x, y, x * us / 1e6, y * us / 1e6) for k, (x, y) in enumerate(shots(hist))]
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema, strict=True)], schema=schema)

    return map_arrow(media.select("doc_id", F.lit(0).cast("bigint").alias("n_bytes"), "media"), run, "doc_id bigint, clip bigint, first_frame bigint, end_frame bigint, start_s double, end_s double")


def report(docs: DataFrame) -> DataFrame:
    """Stores every text in a table of media, in the shared folder, and reads it back from there."""
    return read_column(stored(docs))


def stored(docs: DataFrame) -> DataFrame:
    """The media column of all texts, written and read back."""
    return materialise(encode_column(docs), "media", level=6)


def report_clips(docs: DataFrame) -> DataFrame:
    """The timed clip rows of all texts' media."""
    return clips(stored(docs))
