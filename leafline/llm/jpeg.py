"""Baseline JPEG in numpy: a lossless carrier for bytes, and a reader of any baseline file.

The carrier writes 64 payload bytes as the 64 quantised coefficients of one block, in zigzag order and
with a quantiser of one, so nothing is rounded. No coefficient is zero (bytes below 128 are -128..-1,
the rest 1..128), so each is a symbol of run zero. The Huffman tables are those that fit the symbols of
the text best, as an ordinary encoder would make them in a second pass.

A scan is decoded the same way whatever made it: numpy looks up the code, run and size that would begin
at every bit, a walk follows from code to code to find which bits do begin one, and numpy reads the
values at all these places at once. Scans are taken in bounded chunks.
"""

from __future__ import annotations

import heapq
import math
import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

#: Blocks that are turned into bits at once, and bytes of a scan that are decoded at once.
CHUNK, SCAN = 4096, 1 << 15
#: Bytes that a block takes at most: 64 codes with values, 32 bits each.
BLOCK = 256
#: Largest number of blocks in a row or column that 16-bit dimensions allow.
SIDE = 8191


def best_lengths(counts: dict[int, int]) -> dict[int, int]:
    """Code length by symbol of the best prefix code that leaves the code of ones only free. Few symbols, so
    no length nears the limit of 16."""
    heap = [(n, [s]) for s, n in counts.items() if n] + [(0, [-1])]
    lengths = dict.fromkeys((s for _, group in heap for s in group), 0)
    heapq.heapify(heap)
    while len(heap) > 1:
        (m, one), (n, other) = heapq.heappop(heap), heapq.heappop(heap)
        for s in one + other:
            lengths[s] += 1
        heapq.heappush(heap, (m + n, one + other))
    # The free code is among the longest; the table lists it last and then without it.
    del lengths[-1]
    return dict(sorted(lengths.items(), key=lambda x: (x[1], x[0])))


def canonical(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """(code, length) by symbol: codes count up within a length, in the order of the table."""
    code, last, out = 0, 0, {}
    for symbol, n in sorted(lengths.items(), key=lambda x: x[1]):
        code <<= n - last
        out[symbol], last = (code, n), n
        code += 1
    return out


#: Of a coefficient: each payload byte as an AC coefficient, and each DC difference from -256 to 256.
_AC, _DC = np.concatenate((np.arange(-128, 0), np.arange(1, 129))), np.arange(-256, 257)


def _sizes(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(np.abs(values) + 1)).astype(np.int64)


def _codes(values: np.ndarray, counts: np.ndarray) -> tuple[dict[int, int], np.ndarray, np.ndarray]:
    """(code lengths, words, bits of each word) for values that come counts times: a word is the code of the
    size, and the value in so many bits."""
    sizes = _sizes(values)
    lengths = best_lengths(dict(enumerate(np.bincount(sizes, counts).astype(np.int64).tolist())))
    words, bits = np.zeros(len(values), np.uint32), np.zeros(len(values), np.uint8)
    for size, (code, n) in canonical(lengths).items():
        own = sizes == size
        v = values[own]
        words[own] = code << size | np.where(v > 0, v, v + (1 << size) - 1)
        bits[own] = n + size
    return lengths, words, bits


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table(kind: int, lengths: dict[int, int]) -> bytes:
    ordered = sorted(lengths.items(), key=lambda x: x[1])
    counts = [sum(n == k for _, n in ordered) for k in range(1, 17)]
    return bytes([kind << 4, *counts, *(s for s, _ in ordered)])


def encode(payload: bytes) -> bytes:
    """A grey baseline JPEG that holds payload, a positive multiple of 64 bytes; blocks of zero bytes fill the last row."""
    data = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    wide = math.isqrt(len(data) - 1) + 1
    high = -(-len(data) // wide)
    if wide > SIDE:
        raise ValueError(f"{len(payload)} bytes don't fit one image")
    if spare := wide * high - len(data):
        data = np.concatenate([data, np.zeros((spare, 64), np.uint8)])
    difference = np.diff(_AC[data[:, 0]], prepend=0) + 256
    ac_lengths, ac_words, ac_bits = _codes(_AC, np.bincount(data[:, 1:].reshape(-1), minlength=256))
    dc_lengths, dc_words, dc_bits = _codes(_DC, np.bincount(difference, minlength=513))
    scan, rest = [], np.zeros(0, np.uint8)
    for at in range(0, len(data), CHUNK):
        part, first = data[at : at + CHUNK], difference[at : at + CHUNK]
        words, bits = ac_words[part], ac_bits[part]
        words[:, 0], bits[:, 0] = dc_words[first], dc_bits[first]
        words, bits = words.reshape(-1), bits.reshape(-1)
        ends = np.cumsum(bits, dtype=np.int32)
        places = np.repeat(ends, bits) - np.arange(1, ends[-1] + 1, dtype=np.int32)
        line = np.concatenate([rest, (np.repeat(words, bits) >> places.astype(np.uint32) & 1).astype(np.uint8)])
        whole = len(line) // 8 * 8 if at + CHUNK < len(data) else len(line)
        rest = line[whole:]
        scan.append(np.packbits(np.concatenate([line[:whole], np.ones(-whole % 8, np.uint8)])))
    scan = np.concatenate(scan)
    scan = np.insert(scan, np.flatnonzero(scan == 0xFF) + 1, 0)
    head = [b"\xff\xd8", _segment(0xFE, b"payload %d" % len(payload)), _segment(0xDB, bytes([0] + [1] * 64)), _segment(0xC0, struct.pack(">BHHBBBB", 8, high * 8, wide * 8, 1, 1, 0x11, 0))]
    return b"".join([*head, _segment(0xC4, _table(0, dc_lengths) + _table(1, ac_lengths)), _segment(0xDA, bytes([1, 1, 0, 0, 63, 0])), scan.tobytes(), b"\xff\xd9"])


@dataclass
class Image:
    """Dimensions, and by component number its sampling, quantiser and coefficients (rows, columns, 64 in zigzag order)."""

    width: int = 0
    height: int = 0
    comment: bytes = b""
    sampling: dict[int, tuple[int, int]] = field(default_factory=dict)
    quantiser: dict[int, np.ndarray] = field(default_factory=dict)
    blocks: dict[int, np.ndarray] = field(default_factory=dict)

    def payload(self) -> bytes:
        if not self.comment.startswith(b"payload "):
            raise ValueError("not a carrier of bytes")
        (own,) = self.blocks.values()
        coefficients = own.reshape(-1)[: int(self.comment[8:])]
        return np.where(coefficients < 0, coefficients + 128, coefficients + 127).astype(np.uint8).tobytes()

    def thumbnail(self) -> np.ndarray:
        """One grey pixel for each luminance block, from its DC coefficient alone."""
        luma = min(self.blocks)
        h, v = self.sampling[luma]
        most_h, most_v = (max(x[i] for x in self.sampling.values()) for i in (0, 1))
        rows, columns = -(-self.height * v // (8 * most_v)), -(-self.width * h // (8 * most_h))
        dc = self.blocks[luma][:rows, :columns, 0].astype(np.int64) * int(self.quantiser[luma][0])
        return np.clip(np.rint(dc / 8) + 128, 0, 255).astype(np.uint8)


def average_hash(grey: np.ndarray) -> str:
    """16 hexadecimal digits: which of 8 x 8 means over all pixels are above the mean of these. A side of fewer than 8 repeats pixels."""
    small = grey.astype(np.float64)
    for axis, n in enumerate(grey.shape):
        starts, ends = np.arange(8) * n // 8, np.maximum(np.arange(1, 9) * n // 8, np.arange(8) * n // 8 + 1)
        sums = np.insert(np.cumsum(small, axis=axis), 0, 0, axis=axis)
        small = np.take(sums, ends, axis) - np.take(sums, starts, axis)
        small /= (ends - starts).reshape((8, 1) if axis == 0 else (1, 8))
    return np.packbits(small - small.mean() > 1e-9).tobytes().hex()


def decode(data: bytes) -> Image:
    """Parses the markers and decodes the scans of a baseline file."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no start of image")
    image, at, restart = Image(), 2, 0
    quantisers: dict[int, np.ndarray] = {}
    huffman: dict[tuple[int, int], dict[int, int]] = {}
    frame: list[tuple[int, int, int, int]] = []
    while at < len(data):
        if data[at] != 0xFF:
            raise ValueError(f"no marker at byte {at}")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            break
        (n,) = struct.unpack_from(">H", data, at + 2)
        body, at = data[at + 4 : at + 2 + n], at + 2 + n
        if marker == 0xFE:
            image.comment = body
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quantisers[body[0] & 15] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                counts = body[1:17]
                lengths = [k for k, m in enumerate(counts, 1) for _ in range(m)]
                huffman[body[0] >> 4, body[0] & 15] = dict(zip(body[17:], lengths, strict=False))
                body = body[17 + len(lengths) :]
        elif marker == 0xC0:
            _, image.height, image.width, parts = struct.unpack_from(">BHHB", body)
            frame = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(parts)]
            for c, h, v, q in frame:
                image.sampling[c], image.quantiser[c] = (h, v), quantisers[q]
        elif marker == 0xDD:
            (restart,) = struct.unpack(">H", body)
        elif marker == 0xDA:
            tables = {body[1 + 2 * i]: (huffman[0, body[2 + 2 * i] >> 4], huffman[1, body[2 + 2 * i] & 15]) for i in range(body[0])}
            scan, at = _entropy_coded(data, at)
            _scan(image, scan, tables, restart)
        elif 0xC1 <= marker <= 0xCF and marker != 0xC8:
            raise ValueError(f"frame type {marker:02x} isn't baseline")
    return image


def _entropy_coded(data: bytes, at: int) -> tuple[list[np.ndarray], int]:
    """The scan's intervals between restart markers, without stuffed zeros, and where the next marker stands."""
    raw = np.frombuffer(data, np.uint8, offset=at)
    follows = raw[np.flatnonzero(raw[:-1] == 0xFF) + 1]
    marks = np.flatnonzero(raw[:-1] == 0xFF)
    true = marks[(follows != 0) & ((follows < 0xD0) | (follows > 0xD7)) & (follows != 0xFF)]
    end = int(true[0]) if len(true) else len(raw)
    cuts = marks[(follows >= 0xD0) & (follows <= 0xD7) & (marks < end)]
    stuffed = marks[(follows == 0) & (marks < end)] + 1
    keep = np.ones(end, bool)
    keep[stuffed] = False
    edges = [0, *(int(c) + 2 for c in cuts)], [*map(int, cuts), end]
    return [raw[a:b][keep[a:b]] for a, b in zip(*edges, strict=True)], at + end


@dataclass(frozen=True)
class _Table:
    """By the next bits, as many as the longest code has and so shift less than 16: length of the code, size of the
    value, and how many coefficients the code takes (AC)."""

    shift: int
    length: np.ndarray
    size: np.ndarray
    steps: np.ndarray
    jumps: np.ndarray


@lru_cache(maxsize=16)
def _lookup(lengths: tuple[tuple[int, int], ...]) -> _Table:
    width = max((n for _, n in lengths), default=1)
    length, size, jumps = (np.zeros(1 << width, np.uint8) for _ in range(3))
    jumps[:] = 64  # no code: the block ends, and a step of zero tells
    for symbol, (code, n) in canonical(dict(lengths)).items():
        own = slice(code << (width - n), (code + 1) << (width - n))
        length[own], size[own] = n, symbol & 15
        jumps[own] = 64 if symbol == 0 else (symbol >> 4) + 1
    return _Table(16 - width, length, size, length + size, jumps)


def _four(ahead: np.ndarray, table: _Table) -> tuple[np.ndarray, np.ndarray, bytes, bytes, bytes, bytes]:
    """Steps and jumps of the code at each bit; the same as bytes, and those of four codes in a row."""
    seen = ahead >> table.shift
    one, jump = table.steps[seen], table.jumps[seen]
    bits = np.arange(len(ahead), dtype=np.int64)
    # A step takes at most 32 bits and a jump 64 places, so that sums of four steps and two jumps fit a byte.
    after = bits + one
    two, jump_two = one + one.take(after, mode="clip"), jump + jump.take(after, mode="clip")
    np.minimum(jump_two, 127, out=jump_two)
    np.add(bits, two, out=after)
    four, jump_four = two + two.take(after, mode="clip"), jump_two + jump_two.take(after, mode="clip")
    return one, jump, one.tobytes(), jump.tobytes(), four.tobytes(), jump_four.tobytes()


def _walk(ahead: np.ndarray, start: int, limit: int, units: int, plan: list[tuple[_Table, _Table]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, int]:
    """The bits at which codes begin, in order, their blocks, the coefficient each gives and whether it is a
    block's first, for units that begin before limit; then how many units that were, and the bit behind them."""
    found = {id(ac): _four(ahead, ac) for _, ac in plan}
    tables = [(dc.shift, dc.steps.tobytes(), *found[id(ac)][2:], [], []) for dc, ac in plan]
    codes, firsts, p, done = memoryview(ahead), [], start, 0
    while done < units and p < limit:
        for shift, first, steps, jumps, steps4, jumps4, fours, ones in tables:
            firsts.append(p)
            p += first[codes[p] >> shift]
            k = 1
            while k + jumps4[p] <= 64:
                fours.append(p)
                k += jumps4[p]
                p += steps4[p]
            while k < 64:
                ones.append(p)
                k += jumps[p]
                p += steps[p]
        done += 1
    firsts, places = np.array(firsts), []
    for (_, ac), (*_, fours, ones) in zip(plan, tables, strict=True):
        at = np.array(fours, np.int64)
        places.append(np.array(ones, np.int64))
        for _ in range(4):
            places.append(at)
            at = at + found[id(ac)][0][at]
    places = np.sort(np.concatenate([firsts, *places]))
    block = np.searchsorted(firsts, places, "right") - 1
    is_first = places == firsts[block]
    jumped = found[id(plan[0][1])][1][places].astype(np.int64)
    for k, (_, ac) in enumerate(plan[1:], 1):
        own = block % len(plan) == k
        jumped[own] = found[id(ac)][1][places[own]]
    jumped[is_first] = 1
    total = np.cumsum(jumped)
    return places, block, total - (total - jumped)[is_first][block] - 1, is_first, done, p


def _values(wide: np.ndarray, places: np.ndarray, ahead: np.ndarray, table: _Table) -> np.ndarray:
    """What stands behind the codes that begin at places. wide: the 40 bits from each byte on."""
    seen = ahead[places] >> table.shift
    length = table.length[seen]
    if not length.all():
        raise ValueError("no such code")
    size = table.size[seen].astype(np.int64)
    at = places + length
    bits = wide[at >> 3] >> (40 - (at & 7) - size) & ((1 << size) - 1)
    return np.where(bits < (1 << size) >> 1, bits - (1 << size) + 1, bits)


def _interval(data: np.ndarray, units: int, plan: list[tuple[_Table, _Table]]):
    """(first unit, values, coefficients, blocks) of chunks of one interval: blocks count through all of plan."""
    data = np.concatenate([data, np.full(16, 255, np.uint8)])
    byte, bit, done = 0, 0, 0
    while done < units:
        part = data[byte : byte + SCAN + BLOCK * len(plan) + 16].astype(np.int32)
        if len(part) < 16:
            raise ValueError("the scan ends early")
        three = part[:-2] << 16 | part[1:-1] << 8 | part[2:]
        ahead = (three[:, None] >> np.arange(8, 0, -1, dtype=np.int32)).astype(np.uint16).reshape(-1)
        wide = np.zeros(len(part) - 4, np.int64)
        for k in range(5):
            wide = wide << 8 | part[k : len(part) - 4 + k]
        places, block, coefficient, first, more, p = _walk(ahead, bit, min(SCAN, len(part) - 8) * 8, units - done, plan)
        slot, values = block % len(plan), np.zeros(len(places), np.int64)
        for k, pair in enumerate(plan):
            for table, own in zip(pair, (first & (slot == k), ~first & (slot == k))):
                values[own] = _values(wide, places[own], ahead, table)
        if (values[coefficient > 63] != 0).any():
            raise ValueError("a block of more than 64 coefficients")
        yield done, values, coefficient, block
        done, byte, bit = done + more, byte + (p >> 3), p & 7


def _scan(image: Image, scan: list[np.ndarray], tables: dict, restart: int) -> None:
    alone = len(tables) == 1
    most_h, most_v = (max(x[i] for x in image.sampling.values()) for i in (0, 1))
    across, down = -(-image.width // (8 * most_h)), -(-image.height // (8 * most_v))
    plan, where = [], []
    for c, pair in tables.items():
        h, v = image.sampling[c]
        if alone:
            across, down = -(-image.width * h // (8 * most_h)), -(-image.height * v // (8 * most_v))
            h = v = 1
        image.blocks[c] = np.zeros((down * v, across * h, 64), np.int16)
        where += [(c, h, v, j, i) for j in range(v) for i in range(h)]
        plan += [tuple(_lookup(tuple(t.items())) for t in pair)] * (h * v)
    step, done = restart or across * down, 0
    for part in scan:
        last = dict.fromkeys(tables, 0)
        for unit, values, coefficient, block in _interval(part, min(step, across * down - done), plan):
            # DC differences add up over the blocks of a component, in the order of the scan.
            firsts = np.flatnonzero(coefficient == 0)
            for c in tables:
                own = firsts[np.isin(block[firsts] % len(plan), [k for k, w in enumerate(where) if w[0] == c])]
                values[own] = last[c] + np.cumsum(values[own])
                last[c] = int(values[own[-1]])
            there = coefficient < 64
            for k, (c, h, v, j, i) in enumerate(where):
                own = np.flatnonzero(there if len(plan) == 1 else there & (block % len(plan) == k))
                y, x = np.divmod(done + unit + block[own] // len(plan), across)
                flat = ((y * v + j) * image.blocks[c].shape[1] + x * h + i) * 64 + coefficient[own]
                image.blocks[c].reshape(-1)[flat] = values[own]
        done += step
