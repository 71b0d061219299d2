"""Adaptive context-mixing range coder for token ids.

A block is coded on its own from a fresh model and carries checksums. Its ids stand in lanes of consecutive ids, which are coded
side by side, one id of each per step, with numpy vectors, and share one model:

* order 0 and order 1: the distributions of all ids of the block so far, and of those behind each id, as sorted occurrences;
  they are renewed at the steps of RENEW;
* order 4, for copies: a table of hashed contexts names the id that followed last, with a confidence, at once;
* mixture: every id is coded by one of these predictions, or escaped. Which one is coded first, with frequencies learned for each
  state: the confidence of order 4 and how often the last id was seen. The encoder takes order 4 where it is right, else the
  prediction that gives the id most.

All arithmetic that the decoder repeats is on whole numbers below 2**53, as integers or doubles, so any machine decodes what
another wrote.

Block layout, little-endian: magic "CMR4"; n_ids, n_words, crc32 of the ids as unsigned 32-bit numbers, crc32 of all that
follows (4 x u32); n_docs u32, and per document that ends in the block its id (i64, and u8 1 if it is null) and the end
position (u32); the largest id (u32); then the coder's 16-bit words in the order in which the decoder needs them. Ids are unsigned
32-bit numbers.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 3 << 19
LANES = 4096
STEPS = 1024  # ids of a lane, at most, where a block has several lanes
MAGIC = b"CMR4"
RENEW = frozenset((1, 3, 8, 20, 48, 100, 180, 320, 600))  # steps after which orders 0 and 1 are renewed
OFTEN, SELDOM = 16, 4  # the mixture learns after each of the first steps, then after every fourth
TABLE = 20  # bits of the table of order 4
ROWS = 1 << 16  # contexts of order 1
SURE = 4  # highest confidence; 0: never seen
_4, _1, _0, _ESCAPE = range(4)  # predictions
_SIZES = np.array([1, 2, 3, 5, 9, 17, 33, 65, 129, 257, 513, 1025, 2049, 4097, 16385])  # of an order-1 distribution, for the state
STATES = (len(_SIZES) + 1) * (SURE + 1)
_WEIGHTS = ((SURE + 1) * np.searchsorted(_SIZES, np.arange(_SIZES[-1] + 1), side="right")).astype(np.uint8)
SHARES = 10  # bits of the mixture's frequencies
_HALF = 21  # bits of a number of ids; a span is first << _HALF | number
_LOW = (1 << _HALF) - 1
# Ranges are whole numbers below 2**48, held as doubles: sums, products and the floor of a quotient of such numbers are exact.
_TOP, _LEAST, _WORD = 2.0**48, 2.0**32, 2.0**16


def _last_wins() -> bool:
    probe = np.zeros(4, np.int64)
    probe[np.array([1, 1, 2, 1])] = np.array([5, 6, 7, 8])
    return probe.tolist() == [0, 8, 7, 0]


if not _last_wins():  # lanes that meet in one context: the last one's entry must stay
    raise ImportError("numpy does not keep the last of repeated places")


def _changes(keys: np.ndarray, before: int) -> np.ndarray:
    """Which of sorted keys differ from the one before."""
    new = np.empty(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    new[0] = keys[0] != before
    return new


class _Sorted:
    """The sorted keys of a distribution so far; an id is the low bits of its key."""

    def __init__(self, kind: type, bits: int):
        self.all, self.mask = np.zeros(0, kind), (1 << bits) - 1

    def add(self, keys: np.ndarray) -> None:
        new = keys.astype(self.all.dtype)
        if new.itemsize > 2:
            new.sort()
        self.all = np.concatenate([self.all, new])
        self.all.sort(kind="stable")  # two sorted runs are merged, 16 bits sorted by digits
        new = _changes(self.all, -1)
        self.place = np.cumsum(new, dtype=np.int32) - np.int32(1)
        at = np.flatnonzero(new)
        self.ids = self.all.take(at).astype(np.int64) & self.mask
        self.spans = at << _HALF | np.diff(at, append=len(self.all))


class _Occurrences:
    """The decoder's distributions of orders 1 and 0, the second behind the first: places of occurrences, ids and spans."""

    def __init__(self, largest: int):
        bits = _bits(largest)
        self.one, self.zero = (_Sorted(kind, bits) for kind in ((np.uint32, np.uint16) if bits == 16 else (np.int64, np.int64)))
        self.place, self.ids, self.spans = np.zeros(1, np.int32), np.zeros(1, np.int64), np.ones(1, np.int64)

    def add(self, new: np.ndarray, keys: np.ndarray, since: slice, a: int) -> None:
        one, zero = self.one, self.zero
        one.add(keys)
        zero.add(new)
        self.place = np.concatenate([one.place, zero.place + np.int32(len(one.ids))])
        self.ids = np.concatenate([one.ids, zero.ids])
        self.spans = np.concatenate([one.spans, zero.spans + (len(one.all) << _HALF)])


class _Counts:
    """Of all keys of a block, the spans of those that the decoder has had."""

    def __init__(self, rank: np.ndarray, n: int):
        self.rank, self.count = rank, np.zeros(n, np.int64)
        self.spans = self.count

    def add(self, since: slice, a: int) -> None:
        self.count += np.bincount(self.rank[since, :a].reshape(-1), minlength=len(self.count))
        self.spans = (np.cumsum(self.count) - self.count) << _HALF | self.count

    def at(self, t: int, a: int) -> np.ndarray:
        return self.spans.take(self.rank[t, :a].astype(np.int64))


def _counts(keys: np.ndarray, most: int) -> _Counts:
    """keys, which are used up: int64, none above most."""
    flat = keys.reshape(-1)
    rank = np.empty(len(flat), np.int32)
    if most < 1 << 63 - _HALF:
        # Keys and their places in one number: a plain sort is faster than one for an order. Pieces stay in the processor's cache.
        piece, last, ahead = np.arange(1 << 14), -1, -1
        for i in range(0, len(flat), len(piece)):
            part = flat[i : i + len(piece)]
            part <<= _HALF
            part |= piece[: len(part)] + i
        flat.sort()
        for i in range(0, len(flat), len(piece)):
            part = flat[i : i + len(piece)]
            key = part >> _HALF
            run = np.cumsum(_changes(key, last), dtype=np.int32) + np.int32(ahead)
            rank[part & _LOW] = run
            last, ahead = int(key[-1]), int(run[-1])
    else:
        order = np.argsort(flat)
        run = np.cumsum(_changes(flat[order], -1), dtype=np.int32) - np.int32(1)
        rank[order], ahead = run, int(run[-1])
    return _Counts(rank.reshape(keys.shape), ahead + 1)


class _Known:
    """The encoder's view of the same distributions: it has all ids of the block, a step in each row."""

    def __init__(self, grid: np.ndarray, largest: int):
        keys, behind = np.empty(grid.shape, np.int64), np.zeros(grid.shape[1], np.int64)
        for own, ids in zip(keys, grid, strict=True):
            ids = ids.astype(np.int64)
            np.bitwise_or(behind << _bits(largest), ids, out=own)
            behind = _fold(ids, largest)
        self.one = _counts(keys, (ROWS << _bits(largest)) - 1)
        self.zero = _Counts(grid.astype(np.int32), largest + 1) if largest < 1 << 22 else _counts(grid.astype(np.int64), largest)

    def add(self, new: np.ndarray, keys: np.ndarray, since: slice, a: int) -> None:
        self.one.add(since, a)
        self.zero.add(since, a)


def _bits(largest: int) -> int:
    """Of an id in a key of order 1."""
    return 16 if largest < ROWS else 32


def _entry(largest: int) -> tuple[int, type]:
    """Bits of an id and type of an entry of the table, confidence << bits | id."""
    return (28, np.uint32) if largest < (1 << 28) - 1 else (33, np.uint64)


def _fold(ids: np.ndarray, largest: int) -> np.ndarray:
    """Contexts of order 1."""
    return ids if largest < ROWS else (ids ^ ids >> 16) & (ROWS - 1)


class _Model:
    """The adaptive state of a block of n lanes; every call is for the first a of them, those that still have ids."""

    def __init__(self, n: int, largest: int, known: _Occurrences | _Known):
        self.bits, self.type = _entry(largest)
        self.none = (1 << self.bits) - 1  # of a context that was never seen: confidence 0, and an id that there is not
        self.table = np.full(1 << TABLE, self.none, self.type)
        self.hash, self.context = np.zeros(n, np.uint32), np.zeros(n, np.int64)  # of the last four ids, and of the last one
        self.largest, self.known, self.total = largest, known, 0
        self.size, self.spans = np.zeros(ROWS, np.int64), np.zeros(ROWS, np.int64)  # of the contexts of order 1
        self.weight = np.zeros(ROWS, np.uint8)
        self.seen = np.ones((STATES, 4), np.int64)
        self.start, self.noted = 0, []
        self.sources = np.tile(np.arange(4, dtype=np.uint8), STATES)
        self._mixture()

    def _mixture(self) -> None:
        total = self.seen.sum(axis=1, keepdims=True)
        freq = 1 + self.seen * ((1 << SHARES) - 4) // total
        freq[np.arange(STATES), self.seen.argmax(axis=1)] += (1 << SHARES) - freq.sum(axis=1)
        self.inverse = np.repeat(self.sources, freq.reshape(-1))
        self.odds = freq[:, _1] / freq[:, _0]  # for the encoder's choice alone
        self.cum, self.freq = (np.cumsum(freq, axis=1) - freq).astype(np.float64).reshape(-1), freq.astype(np.float64).reshape(-1)

    def predict(self, a: int) -> None:
        self.context = self.context[:a]
        self.place = (self.hash[:a] >> np.uint32(32 - TABLE)).astype(np.int64)
        entry = self.table.take(self.place)
        self.guess, self.sure = entry & self.none, (entry >> self.bits).astype(np.uint8)
        self.state = (self.sure + self.weight.take(self.context)).astype(np.int64)

    def update(self, t: int, a: int, ids: np.ndarray, mixed: np.ndarray) -> None:
        """After step t; ids: all steps so far; mixed: state * 4 + source."""
        x, hit = ids[t, :a], np.minimum(self.sure, SURE - 1)
        hit *= self.guess == x
        entry = hit.astype(self.type)
        entry += self.type(1)
        entry <<= self.bits
        entry |= x
        self.table[self.place] = entry
        self.hash[:a] <<= np.uint32(8)
        self.hash[:a] += x.astype(np.uint32) * np.uint32(0x9E3779B1)
        self.context = _fold(x.astype(np.int64), self.largest)
        self.noted.append(mixed)
        if t < OFTEN or t % SELDOM == SELDOM - 1:
            self.seen += np.bincount(np.concatenate(self.noted), minlength=4 * STATES).reshape(STATES, 4) * 4
            self.noted = []
            self._mixture()
        if t + 1 in RENEW:
            since = slice(self.start, t + 1)
            new, behind = ids[since, :a].astype(np.int64), np.zeros((t + 1 - self.start, a), np.int64)
            if self.start:
                behind[0] = _fold(ids[self.start - 1, :a].astype(np.int64), self.largest)
            behind[1:] = _fold(new[:-1], self.largest)
            new, behind = new.reshape(-1), behind.reshape(-1)
            self.size += np.bincount(behind, minlength=ROWS)
            self.spans = (np.cumsum(self.size) - self.size) << _HALF | self.size
            self.weight = _WEIGHTS.take(np.minimum(self.size, _SIZES[-1]))
            self.total += len(new)
            behind <<= _bits(self.largest)
            behind |= new
            self.known.add(new, behind, since, a)
            self.start = t + 1


def _shape(n: int) -> tuple[int, int]:
    """Lanes and steps of a block of n ids; all lanes but the last are full."""
    lanes = max(1, min(LANES, max(n // STEPS, n * n * LANES // BLOCK**2)))
    steps = -(-n // lanes)
    return -(-n // steps), steps


def _raw_totals(largest: int) -> tuple[int, int]:
    """What the high and the low 16 bits of an escaped id are coded among."""
    return (largest >> 16) + 1, min(largest + 1, 1 << 16)


def _encode(ids: np.ndarray) -> np.ndarray:
    """The words of a block's ids."""
    lanes, steps = _shape(len(ids))
    largest = int(ids.max())
    totals = _raw_totals(largest)
    short = steps - (lanes * steps - len(ids))  # ids of the last lane
    grid = np.zeros(lanes * steps, _entry(largest)[1])
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    known = _Known(grid, largest)
    m = _Model(lanes, largest, known)
    low, rng = np.zeros(lanes), np.full(lanes, _TOP)
    out: list[np.ndarray] = []  # words, and the lanes that gave them, in order
    whose: list[np.ndarray] = []

    def widen(go: np.ndarray) -> None:
        """Lanes of small range give words."""
        while len(go):
            x = low.take(go)
            w = np.floor(x * (1 / _LEAST))
            out.append(w.astype(np.uint32))
            whose.append(go.astype(np.uint16))
            low[go] = (x - w * _LEAST) * _WORD
            r = rng.take(go) * _WORD
            rng[go] = r
            go = go[r < _LEAST]

    for t in range(steps):
        a = lanes if t < short else lanes - 1
        x = grid[t, :a]
        m.predict(a)
        one, zero, own = known.one.at(t, a), known.zero.at(t, a), m.spans.take(m.context)
        n1, n0 = one & _LOW, zero & _LOW
        by0, by1 = n0 > 0, n1 > 0
        by1 &= m.odds.take(m.state) * n1 * m.total >= n0 * (own & _LOW)
        source = _ESCAPE - by0.view(np.uint8) - by1.view(np.uint8)  # an id that order 1 has is one that order 0 has
        source *= m.guess != x
        mixed = m.state * 4 + source
        r = np.floor(rng[:a] * (1 / (1 << SHARES)))
        low[:a] += m.cum.take(mixed) * r
        r *= m.freq.take(mixed)
        span, own = np.where(by1, one, zero), np.where(by1, own, m.total)
        k = np.flatnonzero((source == _4) | (source == _ESCAPE))
        span[k] = own[k] = 1  # all of the range
        r = np.floor(r / (own & _LOW))
        low[:a] += ((span >> _HALF) - (own >> _HALF)) * r
        np.multiply(r, span & _LOW, out=rng[:a])
        k = np.flatnonzero(source == _ESCAPE)
        if len(k):
            raw = x.take(k).astype(np.int64)
            for part, total in zip((raw >> 16, raw & 0xFFFF), totals, strict=True):
                r = np.floor(rng.take(k) / total)
                low[k] = low.take(k) + part * r
                rng[k] = r
                widen(k[r < _LEAST])
        widen(np.flatnonzero(rng < _LEAST))
        m.update(t, a, grid, mixed)
    rest = low.astype(np.int64)
    for k in (32, 16, 0):
        out.append((rest >> k if k == 32 else rest >> k & 0xFFFF).astype(np.uint32))
        whose.append(np.arange(lanes, dtype=np.uint16))
    # Carries run towards a lane's earlier words; then each word moves to where the decoder, three words ahead, asks for it.
    words, owner = np.concatenate(out), np.concatenate(whose)
    order = np.argsort(owner, kind="stable")
    w = words[order]
    while (w >> 16).any():
        carry = w >> 16
        w &= 0xFFFF
        w[:-1] += carry[1:]
    n = np.bincount(owner, minlength=lanes)
    first = np.cumsum(n) - n
    head = (first[:, None] + np.arange(3)).T.reshape(-1)  # the first three words of all lanes
    place = np.empty(len(w), np.int32)
    place[order] = np.arange(len(w), dtype=np.int32)
    w = w.astype("<u2")
    return np.concatenate([w[head], w[place[: len(w) - 3 * lanes] + 3]])


def _decode(words: np.ndarray, n: int, largest: int) -> np.ndarray:
    """The inverse: n ids."""
    lanes, steps = _shape(n)
    short = steps - (lanes * steps - n)
    totals = _raw_totals(largest)
    known = _Occurrences(largest)
    m = _Model(lanes, largest, known)
    data = np.concatenate([words, np.zeros(4 * lanes, words.dtype)])
    head = data[: 3 * lanes].reshape(3, lanes).astype(np.float64)
    code, rng = (head[0] * _WORD + head[1]) * _WORD + head[2], np.full(lanes, _TOP)
    pos = 3 * lanes
    grid = np.zeros((steps, lanes), m.type)

    def widen(go: np.ndarray) -> None:
        nonlocal pos
        while len(go):
            code[go] = code.take(go) * _WORD + data[pos : pos + len(go)]
            pos += len(go)
            r = rng.take(go) * _WORD
            rng[go] = r
            go = go[r < _LEAST]

    for t in range(steps):
        a = lanes if t < short else lanes - 1
        m.predict(a)
        r = np.floor(rng[:a] * (1 / (1 << SHARES)))
        v = np.minimum(code[:a] / r, (1 << SHARES) - 1).astype(np.int64)
        v |= m.state << SHARES
        source = m.inverse.take(v)
        mixed = m.state * 4 + source
        code[:a] -= m.cum.take(mixed) * r
        r *= m.freq.take(mixed)
        own = np.where(source == _1, m.spans.take(m.context), m.total << _HALF | m.total)
        k = np.flatnonzero((source == _4) | (source == _ESCAPE))
        own[k] = 1  # all of the range
        size, row = own & _LOW, own >> _HALF
        r = np.floor(r / size)
        v = np.minimum(code[:a] / r, size - 1).astype(np.int64)
        v += row
        v = known.place.take(v)
        x, span = known.ids.take(v), known.spans.take(v)
        x[k], span[k] = m.guess.take(k), 1
        code[:a] -= ((span >> _HALF) - row) * r
        np.multiply(r, span & _LOW, out=rng[:a])
        k = np.flatnonzero(source == _ESCAPE)
        if len(k):
            raw = np.zeros(len(k), np.int64)
            for total in totals:
                r, c = np.floor(rng.take(k) / total), code.take(k)
                v = np.minimum(c / r, total - 1).astype(np.int64)
                code[k], rng[k] = c - v * r, r
                widen(k[r < _LEAST])
                raw = raw << 16 | v
            x[k] = raw
        widen(np.flatnonzero(rng < _LEAST))
        grid[t, :a] = x
        m.update(t, a, grid, mixed)
    return np.ascontiguousarray(grid.T).reshape(-1)[:n]


def encode_block(ids: np.ndarray, ends: list[tuple[int | None, int]]) -> bytes:
    """ids: 1 to BLOCK unsigned 32-bit numbers; ends: (document that ends here, end position)."""
    words = _encode(np.asarray(ids)).tobytes()
    rest = struct.pack("<I", len(ends)) + b"".join(struct.pack("<qBI", d or 0, d is None, e) for d, e in ends) + struct.pack("<I", int(np.max(ids))) + words
    return MAGIC + struct.pack("<4I", len(ids), len(words) // 2, zlib.crc32(np.asarray(ids, "<u4").tobytes()), zlib.crc32(rest)) + rest


def decode_block(raw: bytes) -> tuple[np.ndarray, list[tuple[int | None, int]]]:
    """The inverse; ids as unsigned 32-bit numbers."""
    if raw[:4] != MAGIC:
        raise ValueError("not a block of this format")
    n, k, crc, own = struct.unpack_from("<4I", raw, 4)
    if zlib.crc32(raw[20:]) != own:
        raise ValueError("damaged block")
    (d,) = struct.unpack_from("<I", raw, 20)
    ends = [(None if null else doc, e) for doc, null, e in struct.iter_unpack("<qBI", raw[24 : 24 + 13 * d])]
    (largest,) = struct.unpack_from("<I", raw, 24 + 13 * d)
    ids = _decode(np.frombuffer(raw, "<u2", k, 28 + 13 * d), n, largest).astype("<u4")
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("block does not match its checksum")
    return ids, ends


def encode_blocks(blocks: list[tuple[np.ndarray, list[tuple[int | None, int]]]]) -> list[bytes]:
    return [encode_block(*b) for b in blocks]


def decode_blocks(raws: list[bytes]) -> list[tuple[np.ndarray, list[tuple[int | None, int]]]]:
    return [decode_block(raw) for raw in raws]


_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of polynomials modulo the CRC-32 polynomial, bits reflected."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        b = (b >> 1) ^ (_POLY if b & 1 else 0)
        bit >>= 1
    return out


def combine_crc32(first: int, second: int, n: int) -> int:
    """CRC-32 of a text from those of its two parts, the second of n bytes."""
    power, x = 1 << 31, 1 << 23  # 1, and x**8
    while n:
        if n & 1:
            power = _times(power, x)
        x = _times(x, x)
        n >>= 1
    return _times(power, first) ^ second
