"""FLAC without an outside package: mono 16-bit files of plain samples are written, files of any kind of frame are read."""

from __future__ import annotations

import hashlib

import numpy as np

BLOCK = 4096


def _table(polynomial: int, bits: int) -> list[int]:
    out, top, mask = [], 1 << (bits - 1), (1 << bits) - 1
    for n in range(256):
        c = n << (bits - 8)
        for _ in range(8):
            c = (c << 1 ^ polynomial if c & top else c << 1) & mask
        out.append(c)
    return out


_CRC8, _CRC16 = _table(0x07, 8), _table(0x8005, 16)


def _crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8[c ^ b]
    return c


def _crc16(data: bytes) -> int:
    c = 0
    for b in data:
        c = (c << 8 & 0xFFFF) ^ _CRC16[c >> 8 ^ b]
    return c


def _number(n: int) -> bytes:
    """A frame's number, in the manner of UTF-8 up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    size = next(s for s in range(2, 8) if n < 1 << (5 * s + 1 if s < 7 else 36))
    tail = [0x80 | n >> 6 * k & 0x3F for k in range(size - 2, -1, -1)]
    return bytes([(0xFF00 >> size & 0xFF) | n >> 6 * (size - 1), *tail])


def encode(samples: np.ndarray, rate: int) -> bytes:
    """A mono file of 16-bit samples, each as it is."""
    pcm = samples.astype("<i2")
    info = (rate << 44 | 0 << 41 | 15 << 36 | len(pcm)).to_bytes(8, "big")
    head = BLOCK.to_bytes(2, "big") * 2 + bytes(6) + info + hashlib.md5(pcm.tobytes()).digest()
    out = [b"fLaC", b"\x80" + len(head).to_bytes(3, "big"), head]
    for n, at in enumerate(range(0, len(pcm), BLOCK)):
        block = pcm[at : at + BLOCK]
        front = b"\xff\xf8\x70\x08" + _number(n) + (len(block) - 1).to_bytes(2, "big")
        frame = front + bytes([_crc8(front)]) + b"\x02" + block.astype(">i2").tobytes()
        out.append(frame + _crc16(frame).to_bytes(2, "big"))
    return b"".join(out)


class _Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.ones, self.next = data, 0, None, 0

    def take(self, n: int) -> int:
        if not n:
            return 0
        a, b = self.at, self.at + n
        if b > 8 * len(self.data):
            raise ValueError("the file ends within a frame")
        self.at = b
        return int.from_bytes(self.data[a >> 3 : b + 7 >> 3], "big") >> (-b & 7) & (1 << n) - 1

    def signed(self, n: int) -> int:
        x = self.take(n)
        return x - (1 << n) if n and x >> (n - 1) else x

    def many(self, count: int, size: int) -> np.ndarray:
        """Signed numbers of one size."""
        a, b = self.at, self.at + count * size
        if b > 8 * len(self.data):
            raise ValueError("the file ends within a frame")
        self.at = b
        bits = np.unpackbits(np.frombuffer(self.data[a >> 3 : b + 7 >> 3], np.uint8))[a & 7 :][: count * size].reshape(count, size)
        weights = np.int64(1) << np.arange(size - 1, -1, -1, dtype=np.int64)
        weights[0] = -weights[0]
        return bits @ weights

    def zeros(self) -> int:
        """How many zeros stand before the next one, which is taken, too."""
        if self.ones is None:
            self.ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.data, np.uint8))).tolist()
        while self.next < len(self.ones) and self.ones[self.next] < self.at:
            self.next += 1
        n = self.ones[self.next] - self.at
        self.at += n + 1
        return n


def _residuals(bits: _Bits, block: int, order: int) -> list[int]:
    wide = bits.take(2)
    parts, out = 1 << bits.take(4), []
    for part in range(parts):
        n, k = block // parts - (order if part == 0 else 0), bits.take(5 if wide else 4)
        if k == (31 if wide else 15):
            size = bits.take(5)
            out += [bits.signed(size) for _ in range(n)]
            continue
        for _ in range(n):
            x = bits.zeros() << k | bits.take(k)
            out.append(x >> 1 ^ -(x & 1))
    return out


_FIXED = ([], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1])  # the polynomial predictors


def _subframe(bits: _Bits, block: int, size: int) -> np.ndarray:
    kind = bits.take(8)
    wasted = bits.zeros() + 1 if kind & 1 else 0
    kind, size = kind >> 1, size - wasted
    if kind == 0:
        return np.full(block, bits.signed(size) << wasted, np.int64)
    if kind == 1:
        return bits.many(block, size) << wasted
    if 8 <= kind <= 12:
        order, shift, weights = kind - 8, 0, _FIXED[kind - 8]
        out = [bits.signed(size) for _ in range(order)]
    elif kind >= 32:
        order = kind - 31
        out = [bits.signed(size) for _ in range(order)]
        precision, shift = bits.take(4) + 1, bits.signed(5)
        weights = [bits.signed(precision) for _ in range(order)]
    else:
        raise ValueError("unknown kind of subframe")
    for r in _residuals(bits, block, order):
        out.append(r + (sum(w * out[-1 - i] for i, w in enumerate(weights)) >> shift))
    return np.array(out, np.int64) << wasted


def decode(data: bytes) -> tuple[np.ndarray, int, int]:
    """Frames by channels as integers, the rate, and the bits of a sample."""
    if data[:4] != b"fLaC":
        raise ValueError("no FLAC file")
    at, info, last = 4, None, False
    while not last:
        last, kind, n = data[at] >> 7, data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
        if kind == 0:
            info = data[at + 4 : at + 4 + n]
        at += 4 + n
    packed = int.from_bytes(info[10:18], "big")
    rate, channels, size, total = packed >> 44, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & (1 << 36) - 1
    bits, out, have = _Bits(data[at:]), [], 0
    while bits.at + 16 < 8 * len(bits.data) and (not total or have < total):
        if bits.take(15) != 0x7FFC:
            raise ValueError("no frame where one ought to begin")
        bits.take(1)
        block, speed, layout, depth = bits.take(4), bits.take(4), bits.take(4), bits.take(4) >> 1
        lead = bits.take(8)
        for _ in range(max(0, 8 - (lead ^ 0xFF).bit_length() - 1) if lead & 0x80 else 0):
            bits.take(8)
        block = 192 if block == 1 else 576 << block - 2 if block < 6 else bits.take(8 * (block - 5)) + 1 if block < 8 else 1 << block
        bits.take({12: 8, 13: 16, 14: 16}.get(speed, 0) + 8)
        depth = {0: size, 1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}[depth]
        side = {8: (0, 1), 9: (1, 0), 10: (0, 1)}.get(layout, (0,) * channels)
        rows = [_subframe(bits, block, depth + extra) for extra in side]
        if layout == 8:
            rows[1] = rows[0] - rows[1]
        elif layout == 9:
            rows[0] = rows[0] + rows[1]
        elif layout == 10:
            middle = rows[0] * 2 + (rows[1] & 1)
            rows = [(middle + rows[1]) >> 1, (middle - rows[1]) >> 1]
        bits.take(-bits.at % 8 + 16)
        out.append(np.stack(rows, 1))
        have += block
    frames = np.concatenate(out) if out else np.zeros((0, channels), np.int64)
    wide = (size + 7) // 8
    if any(info[18:34]) and hashlib.md5(frames.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()).digest() != info[18:34]:
        raise ValueError("the samples don't agree with their sum")
    return frames, rate, size
