"""Vectorised words over Arrow string buffers, shared by the text operators.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``. All six separators are ASCII, so words can be cut from UTF-8
bytes directly; no Python string is made per word. Word hashes are 64-bit polynomial hashes over random byte
values, finished by a splitmix64 round, so they depend on the bytes of the word alone and agree on every worker.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATORS = (9, 10, 11, 12, 13, 32)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SEPARATORS)] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; bounds the temporary arrays, not the words.
_BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, element by element."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_LOWER_BYTE = _BYTE[TO_LOWER]
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, _BLOCK + 4096)
        table = np.full(size, base, dtype=_U)
        table[0] = 1
        have = _powers[base] = np.multiply.accumulate(table)
    return have


@dataclass
class Words:
    """Words of a batch of texts: byte positions in ``data`` and, per text, its range of words."""

    data: np.ndarray
    offsets: np.ndarray  # texts: bytes offsets[i]:offsets[i+1]
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # texts: words first[i]:first[i+1]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, lower: bool = True) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, _LOWER_BYTE if lower else _BYTE)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    solid = ~IS_SPACE[data]
    begin, stop = solid.copy(), solid.copy()
    if len(data):
        begin[1:] &= ~solid[:-1]
        stop[:-1] &= ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        begin[inner] = solid[inner]
        stop[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(begin)
    return Words(data, offsets, starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, byte_values: np.ndarray = _BYTE) -> np.ndarray:
    """64-bit hashes of byte spans that are in order and don't overlap."""
    out = np.empty(len(starts), dtype=_U)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + _BLOCK, "right")))
        high = ends[j - 1]
        n = int(high - low)
        sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(byte_values[data[low:high]] * _power_table(_BASE, n)[:n], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * _power_table(_BASE_INVERSE, n + 1)[s] + (e - s).astype(_U))
        i = j
    return out


_STEP = tuple(int(x) | 1 for x in mix(np.arange(11, 19, dtype=_U)))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbours, also those across texts; use :func:`gram_texts` to select."""
    if len(hashes) < n:
        return np.empty(0, dtype=_U)
    total = np.zeros(len(hashes) - n + 1, dtype=_U)
    for k in range(n):
        total += hashes[k : len(hashes) - n + 1 + k] * _U(_STEP[k])
    return mix(total + _U(n))


def inside(first: np.ndarray, n: int) -> np.ndarray:
    """Which runs of n neighbouring words lie in one text: a mask over the run's first word."""
    total = int(first[-1])
    if total < n:
        return np.zeros(0, dtype=bool)
    good = np.ones(total - n + 1, dtype=bool)
    for k in range(1, n):
        crossing = first[1:-1] - k
        good[crossing[(crossing >= 0) & (crossing < len(good))]] = False
    return good


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 19):
    """Cut a record batch into runs of rows of about ``most_bytes`` of text, one row at least. Arrays of the size of a
    slice take some 60 times its bytes for a moment."""
    text = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to
