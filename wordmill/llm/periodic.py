"""Runs of words that repeat with a period, such as a line that stands many times in a row.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that is at least ``times``
periods and ``least`` words long and that no neighbouring word extends. Where words q apart are equal over (times - 1) * q
places, one of these places is a multiple of (times - 1) * q; so for each period a grid of that step is tried, which makes
n / (times - 1) * (1 + 1/2 + 1/3 + ...) pairs in all. Pairs of equal words are extended to both sides by a binary search over prefix
hashes, for all pairs of a slice of texts at once. Places that find the same stretch are one run, of its smallest period. The words of each
run are then compared byte by byte; should hashes have misled, the text is done again by comparing words period by period.

Defined results: a null or empty text has no words and no runs; its digests are those of empty strings. Equal rows have
equal results. Of runs of the same length the one with the smallest start, then period, is reported. A text is cut by no bound; arrays for a
very long one are held by the task that has it, some 150 bytes a word, while shorter texts are taken in slices. Other columns are
ignored, and an empty table gives an empty one. A null doc_id is never rewritten by :func:`rewritten_places`.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytewords as bw

LEAST, TIMES = 6, 4
#: Pairs of a period and a place that are looked at together.
_PAIRS = 1 << 20
#: Moduli and bases of the prefix hashes.
_PRIMES = ((2147483647, 1103515245), (2147483629, 690069069))
_U = np.uint64


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, _U)
    while len(out) < n:
        out = np.concatenate([out, out * _U(pow(base, len(out), prime)) % _U(prime)])
    return out[:n]


class PrefixHashes:
    """Hashes of all stretches of a sequence, by two primes."""

    def __init__(self, values: np.ndarray):
        self.tables = []
        for prime, base in _PRIMES:
            powers = _powers(base, prime, len(values) + 1)
            sums = np.zeros(len(values) + 1, _U)
            np.cumsum(values % _U(prime) * powers[:-1] % _U(prime), out=sums[1:])
            self.tables.append((_U(prime), powers, sums % _U(prime)))

    def equal(self, i: np.ndarray, shift: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Are the stretches at ``i`` and ``i + shift`` of that length equal?"""
        same = np.ones(len(i), bool)
        for prime, powers, sums in self.tables:
            a = (sums[i + length] + prime - sums[i]) % prime * powers[shift] % prime
            same &= a == (sums[i + shift + length] + prime - sums[i + shift]) % prime
        return same


def _longest(holds, most: np.ndarray) -> np.ndarray:
    """For each element the largest length up to ``most`` of which ``holds(rows, length)`` is true; true at 0 and falling."""
    low, high = np.zeros(len(most), np.int64), most.copy()
    rows = np.flatnonzero(high > low)
    while len(rows):
        middle = (low[rows] + high[rows] + 1) // 2
        good = holds(rows, middle)
        low[rows[good]] = middle[good]
        high[rows[~good]] = middle[~good] - 1
        rows = rows[high[rows] > low[rows]]
    return low


def _grid(first: np.ndarray, least: int, times: int):
    """text, place, period of all grid points, some at a time."""
    n = np.diff(first)
    periods = np.where(n >= least, n // times, 0)
    text = np.repeat(np.arange(len(n)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = (times - 1) * period
    points = -(-(n[text] - period) // step)
    ends = np.cumsum(points)
    at = 0
    while at < len(text):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + _PAIRS, "right")))
        which = np.repeat(np.arange(at, to), points[at:to])
        number = np.arange(len(which)) - (ends[which] - points[which] - before)
        yield text[which], first[text[which]] + number * step[which], period[which]
        at = to


def find_runs(values: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (text, start, end, period), in that order, of texts whose words have the hashes ``values[first[t]:first[t + 1]]``."""
    hashes, found = PrefixHashes(values), []
    for text, at, period in _grid(first, least, times):
        hit = values[at] == values[at + period]
        text, at, period = text[hit], at[hit], period[hit]
        after = _longest(lambda rows, n: hashes.equal(at[rows], period[rows], n), first[text + 1] - at - period)  # noqa: B023
        before = _longest(lambda rows, n: hashes.equal(at[rows] - n, period[rows], n), at - first[text])  # noqa: B023
        start, end = at - before, at + period + after
        long = end - start >= np.maximum(least, times * period)
        found.append(np.unique(np.stack([text[long], start[long], end[long], period[long]], 1), axis=0))
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)  # sorted, so the smallest period of a stretch comes first
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    return rows[new]


def plain_runs(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, end, period) by comparing words period by period; in quadratic time."""
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = {}
    for period in range(1, len(ids) // times + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids[:-period] == ids[period:], [0]]).astype(np.int8)))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if stop + period - start >= max(least, times * period):
                found.setdefault((start, stop + period), period)
    return sorted((*place, period) for place, period in found.items())


def _gathered(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words, one after the other, each with the byte that follows it, and where each ends."""
    ends = np.cumsum(lengths + 1)
    return padded[np.repeat(starts - ends + lengths + 1, lengths + 1) + np.arange(ends[-1] if len(ends) else 0)], ends


def _true_run(padded, values, starts, lengths, low: int, high: int, start: int, end: int, period: int) -> bool:
    """Do the words themselves make this run in the text that has the words low to high?"""
    a, b = slice(start, end - period), slice(start + period, end)
    if (values[a] != values[b]).any() or (lengths[a] != lengths[b]).any():
        return False
    if start > low and values[start - 1] == values[start - 1 + period] or end < high and values[end] == values[end - period]:
        return False
    for i in range(start, end - period, 1 << 14):
        j = min(end - period, i + (1 << 14))
        (x, ends), (y, _) = (_gathered(padded, starts[k : k + j - i], lengths[k : k + j - i]) for k in (i, i + period))
        x[ends - 1] = y[ends - 1] = 32
        if not np.array_equal(x, y):
            return False
    return True


def rewritten_places(doc_id, n: int) -> np.ndarray:
    """The place of the original word that stands at each place: for a tenth of the ids a beat is put from some word on."""
    places = np.arange(n)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        places[a:] = a + (places[a:] - a) % period
    return places


_COLUMNS = (("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()))


def _detect(rewrite: bool, least: int, times: int):
    def of_slice(part: pa.RecordBatch):
        ids = part.column("doc_id").to_pylist()
        data, offsets = bw.text_buffers(part.column("text"))
        words = bw.split_words(data, offsets)
        values, starts, lengths, first = words.hashes(lower=False), words.starts, words.ends - words.starts, words.first
        if rewrite:
            places = np.concatenate([low + rewritten_places(d, high - low) for d, low, high in zip(ids, first[:-1].tolist(), first[1:].tolist())])
            values, starts, lengths = values[places], starts[places], lengths[places]
        padded = np.append(data, np.uint8(32))
        runs = find_runs(values, first, least, times)
        bounds = np.searchsorted(runs[:, 0], np.arange(len(ids) + 1))
        rows = []
        for t in range(len(ids)):
            low, high = int(first[t]), int(first[t + 1])
            mine = [tuple(r) for r in runs[bounds[t] : bounds[t + 1], 1:].tolist()]
            if not all(_true_run(padded, values, starts, lengths, low, high, *r) for r in mine):
                spelt = [data[s : s + n].tobytes() for s, n in zip(starts[low:high].tolist(), lengths[low:high].tolist())]
                mine = [(low + s, low + e, q) for s, e, q in plain_runs(spelt, least, times)]
            keep = np.ones(high - low, bool)
            for s, e, q in mine:
                keep[s + q - low : e - low] = False
            kept = low + np.flatnonzero(keep)
            joined = hashlib.sha256()
            for i in range(0, len(kept), 1 << 15):
                some = kept[i : i + (1 << 15)]
                text, ends = _gathered(padded, starts[some], lengths[some])
                text[ends - 1] = 32
                joined.update(text if i + (1 << 15) < len(kept) else text[:-1])
            lines = "".join(f"{s - low},{e - s},{q}\n" for s, e, q in sorted(mine, key=lambda r: (r[0], r[2])))
            best = min(mine, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
            shown = (None,) * 4 if best is None else (best[0] - low, best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
            rows.append((len(mine), *shown, hashlib.sha256(lines.encode()).hexdigest(), joined.hexdigest()))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_COLUMNS))], ["doc_id", *(name for name, _ in _COLUMNS)])

    def run(batches):
        for batch in batches:
            for part in bw.slices(batch, "text"):
                yield of_slice(part)

    return run


def periodic_runs(docs: DataFrame, rewrite: bool = False, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli) and digests of all runs and of the text
    without repetitions, for each row of ``docs`` (doc_id, text). ``rewrite``: texts are first changed by :func:`rewritten_places`."""
    if times < 2 or least < 2:
        raise ValueError("a run has two periods and two words at least")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(_detect(rewrite, least, times), schema)
