"""Reading a gzipped file from the middle.

A deflate stream is a sequence of blocks that begin at any bit and refer up to 32 KB back. To go on from a block's first bit, the decoder is
given the 32 KB before it (its window) and, where the bit isn't a byte's first, a few empty blocks that end at that bit.

Where blocks begin isn't written anywhere. :func:`find_block` tries the bits at which the header of a block with codes of its own would be valid,
and takes the first from which a long stretch decodes. What lies in a stretch's window is known only when all before it is
read; :func:`last_window` decodes with three windows that tell each byte's place, so the window after a stretch is told as a function of the one before
it, and windows of all stretches follow by composing these functions. The file's checksums are compared in the end, so a wrong start can't pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

WINDOW = 1 << 15
#: Compressed bytes that are fed at once, and that have to decode from a place for it to count as the start of a block.
PIECE, PROOF = 1 << 18, 1 << 17
# The order in which a block's header has the lengths of its length codes.
LENGTH_ORDER = (16, 17, 18, 0, 8, 7, 9, 6, 10, 5, 11, 4, 12, 3, 13, 2, 14, 1, 15)


def _bits(*fields: tuple[int, int]) -> list[int]:
    return [value >> i & 1 for value, width in fields for i in range(width)]


#: An empty block with the standard codes: 10 bits.
_EMPTY = _bits((0, 1), (1, 2), (0, 7))


def _odd_block() -> list[int]:
    """An empty block with codes of its own, of 93 bits: lengths of 256 unused symbols, then one bit for the end and for a distance."""
    lengths = [1 if symbol in (1, 18) else 0 for symbol in LENGTH_ORDER]
    return _bits((0, 1), (2, 2), (0, 5), (0, 5), (len(lengths) - 4, 4), *[(n, 3) for n in lengths], (1, 1), (127, 7), (1, 1), (107, 7), (0, 1), (0, 1), (0, 1))


def lead_in(bit: int, byte: int) -> bytes:
    """Bytes that make a decoder arrive at that bit of ``byte`` having given nothing out."""
    if not bit:
        return bytes([byte])
    bits = _odd_block() if bit % 2 else []
    while len(bits) % 8 != bit:
        bits = bits + _EMPTY
    out = np.packbits(np.array(bits, np.uint8), bitorder="little")
    out[-1] |= byte & (0xFF << bit) & 0xFF
    return out.tobytes()


def header_end(data: bytes) -> int | None:
    """Length of the gzip header that ``data`` begins with; None if it is longer than ``data``."""
    if len(data) < 10:
        return None
    if data[:3] != b"\x1f\x8b\x08":
        raise ValueError("no gzip header")
    flags, at = data[3], 10
    if flags & 4:
        if len(data) < at + 2:
            return None
        at += 2 + int.from_bytes(data[at : at + 2], "little")
    for flag in (8, 16):
        if flags & flag:
            end = data.find(b"\0", at)
            if end < 0:
                return None
            at = end + 1
    at += 2 if flags & 2 else 0
    return at if at <= len(data) else None


@dataclass
class Member:
    """The end of a gzip member: its checksum and size as the file states them."""

    crc: int
    size: int


class Inflater:
    """The output of a gzipped file from a bit on: bytes, and a :class:`Member` where one ends."""

    def __init__(self, window: bytes | None):
        self.decoder, self.rest, self.state = zlib.decompressobj(-15, zdict=window) if window else zlib.decompressobj(-15), b"", "body"

    def feed(self, data: bytes) -> Iterator[bytes | Member]:
        data = self.rest + data
        self.rest = b""
        while data:
            if self.state == "body":
                out = self.decoder.decompress(data)
                if out:
                    yield out
                if not self.decoder.eof:
                    return
                data, self.state = self.decoder.unused_data, "trailer"
            elif self.state == "trailer":
                if len(data) < 8:
                    break
                yield Member(int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little"))
                data, self.state = data[8:], "header"
            else:
                data = data.lstrip(b"\0")
                end = header_end(data) if data else None
                if end is None:
                    break
                data, self.state, self.decoder = data[end:], "body", zlib.decompressobj(-15)
        self.rest = data


def _input(read, start_bit: int, end_byte: int) -> Iterator[bytes]:
    """Bytes of a file from a bit on; ``read(offset, length)``."""
    at = start_bit // 8
    while at < end_byte:
        data = read(at, min(PIECE, end_byte - at))
        if not data:
            return
        yield lead_in(start_bit % 8, data[0]) + data[1:] if at == start_bit // 8 else data
        at += len(data)


# ------------------------------------------------------------ where blocks begin


def _field(bits: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(len(at), np.int64)
    for i in range(width):
        out |= bits[at + i].astype(np.int64) << i
    return out


def candidates(data: bytes) -> np.ndarray:
    """Bits of ``data`` at which the header of a block that isn't the last and has codes of its own may be."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    n = len(bits) - 17 - 3 * len(LENGTH_ORDER)
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero((bits[:n] == 0) & (bits[1 : n + 1] == 0) & (bits[2 : n + 2] == 1))
    at = at[(_field(bits, at + 3, 5) <= 29) & (_field(bits, at + 8, 5) <= 29)]
    count = _field(bits, at + 13, 4) + 4
    used = np.zeros(len(at), np.int64)
    for i in range(len(LENGTH_ORDER)):
        length = _field(bits, at + 17 + 3 * i, 3)
        used += np.where((i < count) & (length > 0), 128 >> length, 0)
    return at[used == 128]  # the lengths' code has to be complete


def find_block(read, begin: int, end: int, size: int) -> int | None:
    """The first bit in the bytes ``begin`` to ``end`` of a file of ``size`` bytes at which a block begins, as far as can be told."""
    unknown = bytes(WINDOW)
    for at in range(begin, end, PIECE // 4):
        upto = min(end, at + PIECE // 4)
        data = read(at, min(size, upto + PROOF) - at)
        for bit in candidates(data[: upto - at + 64]).tolist():
            if bit >= 8 * (upto - at):
                break
            decoder, out = Inflater(unknown), 0
            try:
                first = bit // 8
                proof = lead_in(bit % 8, data[first]) + data[first + 1 : first + PROOF]
                for i in range(0, len(proof), 1 << 12):  # most candidates fail early
                    out += sum(len(x) for x in decoder.feed(proof[i : i + (1 << 12)]) if isinstance(x, bytes))
            except (zlib.error, ValueError):
                continue
            if out:
                return 8 * at + bit
    return None


# ------------------------------------------------------------ windows


def _probes() -> tuple[bytes, bytes, bytes]:
    place = np.arange(WINDOW)
    low = (place & 0xFF).astype(np.uint8)
    return low.tobytes(), (place >> 8).astype(np.uint8).tobytes(), (low ^ 0xFF).tobytes()


def last_window(read, start_bit: int, end_bit: int) -> tuple[np.ndarray, np.ndarray]:
    """The window after the blocks between two bits: bytes, and for those that come from the window before them the place there, else -1."""
    tails, decoders = list(_probes()), [Inflater(w) for w in _probes()]
    for data in _input(read, start_bit, -(-end_bit // 8)):
        for i, decoder in enumerate(decoders):
            for out in decoder.feed(data):
                if isinstance(out, bytes):
                    tails[i] = (tails[i] + out[-WINDOW:])[-WINDOW:]
    low, high, other = (np.frombuffer(t, np.uint8) for t in tails)
    return low, np.where(low != other, low.astype(np.int32) | high.astype(np.int32) << 8, -1).astype(np.int32)


def composed(first: tuple[np.ndarray, np.ndarray], then: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The window after two stretches."""
    own, place = then[1] < 0, np.maximum(then[1], 0)
    return np.where(own, then[0], first[0][place]), np.where(own, -1, first[1][place])


NOTHING = (np.zeros(WINDOW, np.uint8), np.full(WINDOW, -1, np.int32))


# ------------------------------------------------------------ checksums


def _times(matrix: list[int], vector: int) -> int:
    out, i = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[i]
        vector >>= 1
        i += 1
    return out


def combined_crc(first: int, then: int, length: int) -> int:
    """The CRC-32 of two stretches, the second of that length."""
    square = [0xEDB88320, *[1 << i for i in range(31)]]  # one zero bit; squared thrice: one zero byte
    for _ in range(3):
        square = [_times(square, x) for x in square]
    while length:
        if length & 1:
            first = _times(square, first)
        length >>= 1
        if length:
            square = [_times(square, x) for x in square]
    return first ^ then


def check_members(stretches: Iterable[list[tuple[int, int, int | None, int | None]]]) -> bool:
    """Do checksums and sizes agree? For each stretch in order, its parts of members: CRC, length, and the stated ones where the member ends."""
    crc = size = 0
    open_member = True
    for parts in stretches:
        for part_crc, length, want, want_size in parts:
            crc, size = combined_crc(crc, part_crc, length), size + length
            open_member = want is None
            if want is not None:
                if crc != want or size & 0xFFFFFFFF != want_size:
                    return False
                crc = size = 0
    return not open_member
