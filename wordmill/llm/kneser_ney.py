"""Interpolated modified Kneser-Ney language model: n-grams counted in Spark, stored as sorted hash arrays, and
memory-mapped by the workers that score.

The model has words, word pairs and, up to its order, longer n-grams. Counting: each task cuts its texts into words, counts
n-grams of the highest order in bounded buffers, and sends them as sorted arrays to the shard that owns their last word but
one. All shorter ends of an n-gram have the same last word but one, and so have their contexts that word as their last. So a
shard has all that it takes to write n-grams of each order and what their contexts gathered, and n-grams are shuffled once;
only what it found of words goes to the shard of the word's hash. Words before which much of the text stands (by a bounded sample, which
decides where n-grams go and nothing else) are dealt over all shards by the word before them as well, and their pairs, which
several shards then have, are summed in a second step. Nothing passes the driver but sums and that list of at most two words a
shard. Shards follow the size of the input, not its partitions, and each is a task. They are made in ``PASSES`` over the texts,
each for a range of shards, and the shuffle's files go after each pass, so they take a part of the disk only. With more than
``FAN_OUT`` shards a pass, blobs go to ranges of shards first and are merged there before they go on, so their number grows
with the input and no blob gets small. Model files lie in the shared folder and are written whole under their name, so a lost
executor's tasks just write them again.

Files hold 48 bits of each hash in order, of which the first 16 are told by the place in large files, and half a byte a number;
numbers of 15 or more are listed beside, so counts have no bound. Words are told apart by 64-bit hashes (a million words have
two alike with odds of 3e-8, a billion of 3 %), and a shard of n entries takes an n-gram that it doesn't have for one of its
own with odds of n / 2.8e14.

Scores: log10 of p(w | u) = max(c(uw) - D(c(uw)), 0) / c(u.) + g(u) * p1(w), and p1 likewise from the numbers of
distinct predecessors, spread evenly over the words known and one unknown. At order k a text starts after k - 1 start tokens, the
highest order has counts and each lower one numbers of distinct predecessors, and p of a longer context backs off to p of the
shorter one in the same way. Discounts D(1), D(2), D(3+) come from the
counts of counts (where these are degenerate, as in tiny corpora, from fixed values). A context that was never
seen backs off to p1 whole.

Defined results: a null text counts as empty, one end token. Words are lower-cased in A-Z. Words of repeated rows count
as often as they occur. Very long texts are counted and scored whole, one a slice. With no training rows every token has
base probability 1 / (0 + 1) and model probability 1, so scores are 0; an empty table to score gives an empty one. Other
columns are kept by :func:`score`, but for those that it makes anew.
"""

from __future__ import annotations

import contextlib
import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .shared import Workspace, mapped, write_file

_U = np.uint64
#: Hashes of the end token and of the start of a text, which no word has: words are mixed from bytes they hold.
END, START = _U(0x243F6A8885A308D3), _U(0x13198A2E03707344)
#: Pairs that a counting task buffers before it merges them.
BUFFER = 1_000_000
PAIR = np.dtype([("left", "<u8"), ("right", "<u8"), ("n", "<u8")])
WORD = np.dtype([("word", "<u8"), ("count", "<u8"), ("before", "<u8"), ("total", "<u8"), ("n1", "<u8"), ("n2", "<u8"), ("n3", "<u8")])
_SUMS = WORD.names[1:]
#: What a context of two words or more gathered; its hash is stored beside.
CONTEXT = np.dtype([("total", "<u8"), ("n1", "<u8"), ("n2", "<u8"), ("n3", "<u8")])
#: Bytes of input a shard is made for, shards or ranges of them that blobs of a pass go to at first, tables that a scoring task has
#: mapped, passes over the texts, tokens that are scored at once, and bytes of input that the sample of frequent words has.
SHARD_BYTES, FAN_OUT, MAPPED, PASSES, LOT, SAMPLE_BYTES = 6 << 20, 1024, 1 << 14, 2, 1 << 19, 64 << 20


def token_hashes(words: bw.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens with an end after each text, of the token before each, and offsets of texts."""
    counts = words.counts()
    first = np.concatenate([[0], np.cumsum(counts + 1)])
    tokens = np.empty(first[-1], _U)
    is_end = np.zeros(first[-1], bool)
    is_end[first[1:] - 1] = True
    tokens[is_end] = END
    tokens[~is_end] = words.hashes()
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = START
    return tokens, before, first


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return bw.mix(left * _U(0x9E3779B97F4A7C15) + bw.mix(right + _U(0x632BE59BD9B4E019)))


def gram_dtype(k: int) -> np.dtype:
    """Rows of k words and a number."""
    return PAIR if k == 2 else np.dtype([*((f"w{i}", "<u8") for i in range(k)), ("n", "<u8")])


def histories(tokens: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """The token before each, the one before that, and so on, k in all; before a text there are start tokens."""
    place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    out = []
    for back in range(1, k + 1):
        before = np.full_like(tokens, START)
        inside = place >= back
        before[inside] = tokens[np.flatnonzero(inside) - back]
        out.append(before)
    return out


def context_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of runs of words, of which the first column has the first words."""
    return functools.reduce(pair_hashes, columns)


def in_order(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes in their order, and the hashes in it. Sorts first bits and place as one number, which takes a third of
    the time of ``argsort``; the few that have these bits alike are turned."""
    low = _U((1 << max(1, len(hashes).bit_length())) - 1)
    places = (np.sort(hashes & ~low | np.arange(len(hashes), dtype=_U)) & low).astype(np.int64)
    out = hashes[places]
    if (np.flatnonzero(out[1:] < out[:-1])).size > len(out) // 1000:
        places = np.argsort(hashes, kind="stable")
        return places, hashes[places]
    while (at := np.flatnonzero(out[1:] < out[:-1])).size:
        at = at[np.append(True, np.diff(at) > 1)]
        for x in (places, out):
            x[at], x[at + 1] = x[at + 1], x[at].copy()
    return places, out


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each value of an ordered array is first."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, np.int64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the place of one of each, and which of them each key is."""
    places, ordered = in_order(keys)
    first = _firsts(ordered)
    inverse = np.empty(len(keys), np.int64)
    inverse[places] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    return ordered[first], places[first], inverse


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards own equal ranges of hashes, in order."""
    return ((hashes >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


def fewer(shards: int) -> int:
    """Shards of words and of pairs after hot words, which are smaller and to which each of the others sends a blob."""
    return -(-shards // 4)


def same_bits(shards: int) -> int:
    """First bits of a hash that its shard tells."""
    return max(0, shards.bit_length() - 1)


def merge_grams(parts: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams with summed counts in the order of their hash, and the hashes."""
    rows = np.concatenate(parts) if parts else np.empty(0, gram_dtype(k))
    parts.clear()  # not needed any more, and large
    places, hashes = in_order(context_hashes([rows[x] for x in rows.dtype.names[:-1]]))
    if not len(rows):
        return rows, hashes
    first = _firsts(hashes)
    out = rows[places[first]]
    out["n"] = np.add.reduceat(rows["n"][places], first)
    return out, hashes[first]


def merge_pairs(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return merge_grams(parts, 2)


def merge_words(parts: list[np.ndarray]) -> np.ndarray:
    rows = np.concatenate(parts) if parts else np.empty(0, WORD)
    if not len(rows):
        return rows
    places, ordered = in_order(np.ascontiguousarray(rows["word"]))
    rows, first = rows[places], _firsts(ordered)
    out = rows[first].copy()
    for name in _SUMS:
        out[name] = np.add.reduceat(rows[name], first)
    return out


def _planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then second bytes and so on: the shuffle's compression finds the runs of zeros."""
    return values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def _from_planes(raw, dtype, n: int, at: int = 0) -> np.ndarray:
    dtype = np.dtype(dtype)
    flat = np.frombuffer(raw, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n)
    return np.ascontiguousarray(flat.T).reshape(-1).view(dtype)


def pack_pairs(rows: np.ndarray) -> bytes:
    """Pairs or longer n-grams by places in a list of their words, sorted by the last ones but one; in another order than ``rows``."""
    n = len(rows)
    columns = rows.dtype.names[:-1]
    names, _, place = distinct(np.concatenate([rows[c] for c in columns]))
    places = [place[n * i : n * (i + 1)].astype("<u4") for i in range(len(columns))]
    owner = places.pop(len(columns) - 2)
    order = np.argsort(owner)
    owner = owner[order]
    step = np.diff(owner, prepend=owner[:1]).astype("<u4")
    head = np.array([n, len(names), owner[0] if n else 0], "<u8").tobytes()
    return head + _pressed(b"".join(_planes(x) for x in (np.diff(names, prepend=_U(0)), step, *[x[order] for x in places], np.ascontiguousarray(rows["n"][order]))))


def _pressed(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def _unpressed(raw, size: int):
    return pa.Codec("zstd").decompress(raw, decompressed_size=size)


def unpack_pairs(raw, dtype: np.dtype = PAIR) -> np.ndarray:
    n, m, first = (int(x) for x in np.frombuffer(raw, "<u8", 3))
    columns = dtype.names[:-1]
    raw = _unpressed(memoryview(raw)[24:], 8 * m + (4 * len(columns) + 8) * n)
    names = np.cumsum(_from_planes(raw, "<u8", m))
    step, *others = (_from_planes(raw, "<u4", n, 8 * m + 4 * n * k) for k in range(len(columns)))
    rows = np.empty(n, dtype)
    rows[columns[-2]] = names[first + np.cumsum(step.astype(np.int64))]
    for column, place in zip([*columns[:-2], columns[-1]], others):
        rows[column] = names[place]
    rows["n"] = _from_planes(raw, "<u8", n, 8 * m + 4 * n * len(columns))
    return rows


def pack_words(rows: np.ndarray) -> bytes:
    """Rows in the order of their words."""
    steps = np.diff(rows["word"], prepend=_U(0))
    return np.array([len(rows)], "<u8").tobytes() + _pressed(b"".join(_planes(np.ascontiguousarray(x)) for x in (steps, *[rows[c] for c in _SUMS])))


def unpack_words(raw) -> np.ndarray:
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    raw = _unpressed(memoryview(raw)[8:], n * WORD.itemsize)
    rows = np.empty(n, WORD)
    for i, name in enumerate(WORD.names):
        rows[name] = _from_planes(raw, "<u8", n, 8 * n * i)
    rows["word"] = np.cumsum(rows["word"])
    return rows


def _key48(hashes: np.ndarray, same: int) -> np.ndarray:
    """48 bits of each hash after the first ``same`` ones, which a shard's hashes have in common. Hashes in order stay so, but
    for one turn."""
    return hashes << _U(same) >> _U(16)


#: Entries from which a table's first 16 bits are told by the place.
BY_PLACE = 1 << 15


def pack_table(hashes: np.ndarray, columns: list[np.ndarray], same: int = 0) -> bytes:
    """Numbers by hash, in the order of their 48 bits."""
    keys = _key48(hashes, same)
    if (keys[1:] < keys[:-1]).any():
        order, keys = in_order(keys)
        columns = [c[order] for c in columns]
    columns = [c.astype("<u8") for c in columns]
    large = [np.flatnonzero(c >= 15).astype("<u8") for c in columns]
    out = [np.array([len(keys), *map(len, large)], "<u8")]
    for c, at in zip(columns, large):
        out += [at, c[at]]
    if len(keys) < BY_PLACE:
        out.append(keys)
    else:
        out += [np.searchsorted(keys, np.arange((1 << 16) + 1, dtype=_U) << _U(32)).astype("<u4"), keys.astype("<u4")]
    for c in columns:
        small = np.append(np.minimum(c, _U(15)).astype("u1"), np.zeros(len(c) % 2, "u1"))
        out.append(small[::2] | small[1::2] << 4)
    return b"".join(x.tobytes() for x in out)


class Table:
    """What :func:`pack_table` made, mapped."""

    def __init__(self, raw, columns: int, same: int = 0):
        self.same = same
        self.n, *many = np.frombuffer(raw, "<u8", columns + 1).tolist() if len(raw) else [0] * (columns + 1)
        at = 8 * (columns + 1)
        self.large = []
        for m in many:
            self.large.append((np.frombuffer(raw, "<u8", m, at), np.frombuffer(raw, "<u8", m, at + 8 * m)) if m else None)
            at += 16 * m
        self.starts, self.keys = None, np.empty(0, _U)
        if self.n >= BY_PLACE:
            self.starts = np.frombuffer(raw, "<u4", (1 << 16) + 1, at)
            at += 4 * ((1 << 16) + 1)
            self.keys = np.frombuffer(raw, "<u4", self.n, at)
            self.turns = int(np.diff(self.starts).max()).bit_length()
        elif self.n:
            self.keys = np.frombuffer(raw, "<u8", self.n, at)
        at += self.n * self.keys.dtype.itemsize
        half = (self.n + 1) // 2
        self.small = [np.frombuffer(raw, "u1", half, at + c * half) for c in range(columns)] if self.n else []

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes, or -1."""
        if not self.n:
            return np.full(len(hashes), -1, np.int64)
        keys = _key48(hashes, self.same)
        if self.starts is None:
            spot = np.searchsorted(self.keys, keys)
            end = self.n
        else:  # the first of those with the same first 16 bits that isn't less
            first = (keys >> _U(32)).astype(np.int64)
            spot, end = self.starts[first].astype(np.int64), self.starts[first + 1].astype(np.int64)
            keys = keys.astype("<u4")
            size = end - spot
            for _ in range(self.turns):
                half = size >> 1
                less = self.keys[np.minimum(spot + half, self.n - 1)] < keys
                less &= size > 0
                spot = np.where(less, spot + half + 1, spot)
                size = np.where(less, size - half - 1, half)
        return np.where((spot < end) & (self.keys[np.minimum(spot, self.n - 1)] == keys), spot, -1)

    def numbers(self, column: int, places: np.ndarray) -> np.ndarray:
        """Numbers at the places, 0 at -1."""
        if not self.n:
            return np.zeros(len(places), _U)
        at = np.maximum(places, 0)
        out = self.small[column][at >> 1] >> ((at & 1) << 2).astype("u1") & 15
        out = np.where(places >= 0, out, 0).astype(_U)
        if self.large[column] is not None:
            where = np.flatnonzero(out == 15)
            at, values = self.large[column]
            out[where] = values[np.searchsorted(at, places[where].astype(_U))]
        return out


def owner_shards(columns: list[np.ndarray], hot: np.ndarray, shards: int) -> np.ndarray:
    """Shards of n-grams, given by columns of their words: by the last word but one, and if that is a ``hot`` one, by the one before
    it too, or in a pair by the whole pair."""
    out = shard_of(columns[-2], shards)
    if len(hot):
        at = np.flatnonzero(is_one_of(columns[-2], hot))
        two = columns[-3:-1] if len(columns) > 2 else columns
        out[at] = shard_of(pair_hashes(*[c[at] for c in two]), shards)
    return out


def is_one_of(hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """``hot``: in order."""
    if not len(hot):
        return np.zeros(len(hashes), bool)
    return hot[np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)] == hashes


def by_shard(shards: np.ndarray) -> np.ndarray:
    """Places in the order of shards, and as they are within a shard."""
    return np.argsort(shards.astype(np.uint16) if len(shards) and shards.max() < 1 << 16 else shards, kind="stable")


def _cut(shards: np.ndarray, rows: np.ndarray, pack, per: int = 1):
    """(shard, or range of ``per`` shards, and bytes) of rows."""
    shards = shards // per
    order = by_shard(shards)
    shards, rows = shards[order], rows[order]
    at = _firsts(shards)
    for a, b in zip(at, np.append(at[1:], len(rows))):
        yield int(shards[a]), pack(rows[a:b])


#: Blobs of n-grams, of words, and of counts of counts.
GRAMS, WORDS, COUNTS = 0, 1, 2
_BLOBS = "shard int, kind int, rows binary"


def _blobs(pairs: list[tuple[int, bytes]], kind: int = GRAMS) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s for s, _ in pairs], pa.int32()), pa.array([kind] * len(pairs), pa.int32()), pa.array([b for _, b in pairs], pa.binary())], ["shard", "kind", "rows"])


def _each_blob(batches):
    for batch in batches:
        for shard, kind, raw in zip(batch.column("shard").to_pylist(), batch.column("kind").to_pylist(), batch.column("rows")):
            yield shard, kind, raw.as_buffer()


def _columns(rows: np.ndarray) -> list[np.ndarray]:
    return [rows[c] for c in rows.dtype.names[:-1]]


def _spread(shards: int, k: int, hot: np.ndarray):
    """Merges blobs of ranges of shards, and sends them on to the shards."""

    def run(batches):
        parts: dict[int, list] = {}
        sizes: dict[int, int] = {}

        def flush(target: int):
            rows, _ = merge_grams(parts.pop(target), k)
            sizes.pop(target)
            return _blobs(list(_cut(owner_shards(_columns(rows), hot, shards), rows, pack_pairs)))

        for target, _, raw in _each_blob(batches):
            parts.setdefault(target, []).append(unpack_pairs(raw, gram_dtype(k)))
            sizes[target] = sizes.get(target, 0) + len(parts[target][-1])
            if sum(sizes.values()) > BUFFER:
                yield flush(max(sizes, key=sizes.get))
        for target in list(parts):
            yield flush(target)

    return run


def _count(shards: int, order: int, hot: np.ndarray, owned: tuple[int, int], per: int):
    """N-grams whose shards are from ``owned[0]`` up to ``owned[1]``; ``per``: shards that a blob is for."""

    def run(batches):
        held: list[np.ndarray] = []
        size = 0

        def blobs(rows):
            return _blobs(list(_cut(owner_shards(_columns(rows), hot, shards), rows, pack_pairs, per)))

        for batch in batches:
            for part in bw.slices(batch, "text"):
                tokens, _, first = token_hashes(bw.split_words(*bw.text_buffers(part.column("text"))))
                columns = [*histories(tokens, first, order - 1)[::-1], tokens]
                owners = owner_shards(columns, hot, shards)
                mine = np.flatnonzero((owners >= owned[0]) & (owners < owned[1]))
                rows = np.empty(len(mine), gram_dtype(order))
                for name, column in zip(rows.dtype.names, columns):
                    rows[name] = column[mine]
                rows["n"] = 1
                held.append(rows)
                size += len(rows)
                if size > BUFFER:
                    rows, _ = merge_grams(held, order)
                    held, size = [rows], len(rows)
                    if size > BUFFER // 2:
                        yield blobs(rows)
                        held, size = [], 0
        if size:
            yield blobs(merge_grams(held, order)[0])

    return run


def _kinds(n: np.ndarray) -> list[int]:
    """How many numbers are 1, 2, 3 and 4."""
    return [int((n == x).sum()) for x in (1, 2, 3, 4)]


def _gathered(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Distinct keys in order, and the sum of the numbers of each and how many of these are 1, 2 and more."""
    places, ordered = in_order(np.ascontiguousarray(keys))
    first = _firsts(ordered)
    n = n[places].astype(np.int64)
    out = {"total": np.add.reduceat(n, first) if len(first) else n}
    for x in (1, 2, 3):
        out[f"n{x}"] = np.add.reduceat((n == x if x < 3 else n >= x).astype(np.int64), first) if len(first) else n
    out["rows"] = np.diff(np.append(first, len(n))) if len(first) else n
    return ordered[first], out


def _words(keys: np.ndarray, **sums: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), WORD)
    out["word"] = keys
    for name, values in sums.items():
        out[name] = values
    return out


def _tally(rows: np.ndarray, counts: bool) -> list[np.ndarray]:
    """What distinct pairs tell of their words: as second word, and as context; a row for each word and side. Above order 2 pairs
    tell of distinct predecessors, and their numbers aren't the words' ``counts``."""
    second, of = _gathered(rows["right"], rows["n"])
    first, gathered = _gathered(rows["left"], rows["n"])
    return [_words(second, before=of["rows"], **({"count": of["total"]} if counts else {})), _words(first, **{x: gathered[x] for x in CONTEXT.names})]


def _send_words(parts: list[np.ndarray], shards: int) -> pa.RecordBatch:
    rows = merge_words(parts)
    return _blobs(list(_cut(shard_of(rows["word"], fewer(shards)), rows, pack_words)), WORDS)


def _gram_shards(folder: str, shards: int, order: int, hot: np.ndarray):
    """Writes a shard's n-grams of each order and their contexts, and sends what they tell of words, pairs after ``hot`` words, which
    other shards have too, and how many n-grams were counted once to four times."""

    def run(batches):
        parts: dict[int, list[np.ndarray]] = {}
        for shard, _, raw in _each_blob(batches):
            parts.setdefault(shard, []).append(raw)
        for shard in sorted(parts):
            rows, hashes = merge_grams([unpack_pairs(raw, gram_dtype(order)) for raw in parts.pop(shard)], order)
            counts, words = [], []
            for k in range(order, 2, -1):
                columns = _columns(rows)
                write_file(f"{folder}/grams{k}-{shard:05d}", pack_table(hashes, [rows["n"]]))
                counts = [*_kinds(rows["n"]), *counts]
                keys, gathered = _gathered(context_hashes(columns[:-1]), rows["n"])
                write_file(f"{folder}/contexts{k}-{shard:05d}", pack_table(keys, [gathered[x] for x in CONTEXT.names]))
                if k == order:
                    keys, gathered = _gathered(columns[-1], rows["n"])
                    words.append(_words(keys, count=gathered["total"]))
                shorter = np.empty(len(rows), gram_dtype(k - 1))
                for to, column in zip(shorter.dtype.names[:-1], columns[1:]):
                    shorter[to] = column
                shorter["n"] = 1
                del rows, hashes, columns
                rows, hashes = merge_grams([shorter], k - 1)
            if order > 2 and (shared := is_one_of(rows["left"], hot)).any():
                yield _blobs(list(_cut(shard_of(hashes[shared], fewer(shards)), rows[shared], pack_pairs)))
                rows, hashes = rows[~shared], hashes[~shared]
            write_file(f"{folder}/pairs-{shard:05d}", pack_table(hashes, [rows["n"]]))
            yield _blobs([(shard % fewer(shards), np.array([*_kinds(rows["n"]), *counts], "<i8").tobytes())], COUNTS)
            yield _send_words([*words, *_tally(rows, order == 2)], shards)

    return run


def _hot_shards(folder: str, shards: int, order: int):
    """Sums and writes pairs after hot words."""

    def run(batches):
        parts: dict[int, list[np.ndarray]] = {}
        for shard, _, raw in _each_blob(batches):
            parts.setdefault(shard, []).append(unpack_pairs(raw))
        for shard in sorted(parts):
            rows, hashes = merge_pairs(parts.pop(shard))
            write_file(f"{folder}/hot-{shard:05d}", pack_table(hashes, [rows["n"]], same_bits(fewer(shards))))
            yield _blobs([(shard, np.array([*_kinds(rows["n"]), *[0] * (4 * (order - 2))], "<i8").tobytes())], COUNTS)
            yield _send_words(_tally(rows, False), shards)

    return run


def _stats(order: int) -> list[str]:
    return ["tokens", "vocabulary", "pairs", "b1", "b2", "b3", "b4", *[f"g{k}_{x}" for k in range(2, order + 1) for x in (1, 2, 3, 4)]]


def _word_shards(folder: str, shards: int, order: int):
    names = _stats(order)

    def run(batches):
        parts: dict[int, list[np.ndarray]] = {}
        counts = np.zeros(4 * (order - 1), np.int64)
        for shard, kind, raw in _each_blob(batches):
            if kind == COUNTS:
                counts += np.frombuffer(raw, "<i8")
            else:
                held = parts.setdefault(shard, [])
                held.append(unpack_words(raw))
                if len(held) > 1 and sum(map(len, held)) > max(BUFFER // 2, 2 * len(held[0])):
                    held[:] = [merge_words(held)]
        rows = [[0] * 7 + counts.tolist()]
        for shard in sorted(parts):
            words = merge_words(parts.pop(shard))
            write_file(f"{folder}/words-{shard:05d}", pack_table(words["word"], [words[x] for x in _SUMS], same_bits(fewer(shards))))
            rows.append([int(words["count"].sum()), int((words["count"] > 0).sum()), int(words["before"].sum()), *_kinds(words["before"]), *[0] * len(counts)])
        yield pa.RecordBatch.from_arrays([pa.array([sum(r[i] for r in rows)], pa.int64()) for i in range(len(names))], names)

    return run


def _frequent(shards: int):
    """Words that a task finds before a sixteenth of a shard's share of its tokens or more, and beside null the number of tokens."""

    def run(batches):
        total, keys, many = 0, np.empty(0, _U), np.empty(0, np.int64)
        for batch in batches:
            for part in bw.slices(batch, "text"):
                _, before, _ = token_hashes(bw.split_words(*bw.text_buffers(part.column("text"))))
                found, n = np.unique(before, return_counts=True)
                enough = n * 64 * shards >= len(before)
                total += len(before)
                keys, _, place = distinct(np.concatenate([keys, found[enough]]))
                many = np.bincount(place, np.concatenate([many, n[enough]]), len(keys)).astype(np.int64)
        enough = many * 16 * shards >= total
        yield pa.RecordBatch.from_arrays([pa.array([None, *keys[enough].view(np.int64).tolist()], pa.int64()), pa.array([total, *many[enough].tolist()], pa.int64())], ["word", "n"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's closed forms; 0.5, 1, 1.5 where a count of counts is 0 or a form leaves (0, k)."""
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < x < k for x, k in zip(d, (1, 2, 3))):
            return d
    return 0.5, 1.0, 1.5


class Model:
    """A model's files as a worker sees them: mapped, not read."""

    def __init__(self, folder: str, shards: int, stats: dict[str, int], order: int = 2, hot: np.ndarray = np.empty(0, _U)):
        self.folder, self.shards, self.stats, self.order, self.hot = folder, shards, stats, order, hot
        self._tables: dict[tuple[str, int], Table] = {}  # a task's own: they go with it
        self.higher = {k: np.array([0.0, *discounts(*[stats[f"g{k}_{x}"] for x in (1, 2, 3, 4)])]) for k in range(3, order + 1)}
        self.d2 = np.array([0.0, *discounts(*[stats[f"g2_{k}"] for k in (1, 2, 3, 4)])])
        self.d1 = np.array([0.0, *discounts(*[stats[f"b{k}"] for k in (1, 2, 3, 4)])])
        b = [stats[f"b{k}"] for k in (1, 2)]
        many = stats["vocabulary"] - sum(b)
        mass = self.d1[1] * b[0] + self.d1[2] * b[1] + self.d1[3] * many
        self.floor = mass / max(stats["pairs"], 1) / (stats["vocabulary"] + 1)

    def table(self, name: str, shard: int) -> Table:
        if (name, shard) not in self._tables:
            if len(self._tables) >= MAPPED:
                self._tables.clear()
            columns = len(_SUMS) if name == "words" else len(CONTEXT.names) if name.startswith("contexts") else 1
            # only words and pairs after hot words go by their own hash
            same = same_bits(fewer(self.shards)) if name in ("words", "hot") else 0
            self._tables[name, shard] = Table(mapped(f"{self.folder}/{name}-{shard:05d}"), columns, same)
        return self._tables[name, shard]

    def _numbers(self, name: str, keys: np.ndarray, shards: np.ndarray, columns: list[int]) -> list[np.ndarray]:
        """The numbers that a kind of table has of each key in the key's shard, 0 where it has none."""
        order = by_shard(shards)
        out = [np.zeros(len(keys), _U) for _ in columns]
        at = _firsts(shards[order])
        for a, b in zip(at, np.append(at[1:], len(keys))):
            which = order[a:b]
            table = self.table(name, int(shards[which[0]]))
            places = table.find(keys[which])
            for numbers, c in zip(out, columns):
                numbers[which] = table.numbers(c, places)
        return out

    def pair_counts(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, one, inverse = distinct(pair_hashes(left, right))
        left, right = left[one], right[one]
        out = np.zeros(len(keys), np.int64)
        shared = is_one_of(left, self.hot)
        for name, at in (("pairs", np.flatnonzero(~shared)), ("pairs" if self.order == 2 else "hot", np.flatnonzero(shared))):
            owners = owner_shards([left[at], right[at]], self.hot, self.shards) if name == "pairs" else shard_of(keys[at], fewer(self.shards))
            out[at] = self._numbers(name, keys[at], owners, [0])[0]
        return out[inverse]

    def word_numbers(self, hashes: np.ndarray, *columns: str) -> tuple[list[np.ndarray], np.ndarray]:
        """Some of the numbers of distinct words, and which of these each word is."""
        keys, _, inverse = distinct(hashes)
        return self._numbers("words", keys, shard_of(keys, fewer(self.shards)), [_SUMS.index(c) for c in columns]), inverse

    def gram_numbers(self, k: int, words: list[np.ndarray], d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of each n-gram of k words, of which the first column has the first words, how often its context was seen, and what
        the discounts leave of that."""
        context = context_hashes(words[:-1])
        owners = owner_shards(words, self.hot, self.shards)
        keys, one, inverse = distinct(context)
        total, left = _left(self._numbers(f"contexts{k}", keys, owners[one], list(range(len(CONTEXT.names)))), d)
        total, left = total[inverse], left[inverse]
        keys, one, inverse = distinct(pair_hashes(context, words[-1]))
        return self._numbers(f"grams{k}", keys, owners[one], [0])[0].astype(np.int64)[inverse], total, left

    def token_scores(self, tokens: np.ndarray, before: np.ndarray, *earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, base log10 probability and model log10 probability of each token after the one ``before`` and, above order
        2, the ``earlier`` ones, the nearest first."""
        s = self.stats
        (count, b), which = self.word_numbers(tokens, "count", "before")
        count, base = count[which], np.log10((count + 1.0) / (s["tokens"] + s["vocabulary"] + 1.0))[which]
        if not s["tokens"]:
            return count, base, np.zeros(len(tokens))
        b = b.astype(np.int64)
        p = (np.maximum(b - self.d1[np.minimum(b, 3)], 0) / s["pairs"] + self.floor)[which]
        numbers, which = self.word_numbers(before, *CONTEXT.names)
        total, left = _left(numbers, self.d2)
        p = _interpolated(self.pair_counts(before, tokens), self.d2, total[which], left[which], p)
        for k, d in self.higher.items():
            n, total, left = self.gram_numbers(k, [*earlier[: k - 2][::-1], before, tokens], d)
            p = _interpolated(n, d, total, left, p)
        return count, base, np.log10(p)


def _left(gathered: list[np.ndarray], d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total, *kinds = gathered
    return total.astype(float), d[1] * kinds[0] + d[2] * kinds[1] + d[3] * kinds[2]


def _interpolated(n: np.ndarray, d: np.ndarray, total: np.ndarray, left: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Probability by a longer context, where that was seen, of the one by a shorter."""
    seen = total > 0
    safe = np.where(seen, total, 1.0)
    return np.where(seen, np.maximum(n - d[np.minimum(n, 3)], 0) / safe + left / safe * p, p)


def _size(texts: DataFrame) -> int | None:
    """Spark's estimate of the input's size, or none (as for tables made of Python rows)."""
    size = int(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else None


def shards_for(texts: DataFrame) -> int:
    """Shards by the input's size, or where that isn't known a partition each."""
    size = _size(texts)
    return max(4, texts.rdd.getNumPartitions() if size is None else min(1 << 20, -(-size // SHARD_BYTES)))


def frequent_words(texts: DataFrame, shards: int) -> np.ndarray:
    """Hashes of words before which half a shard's share of a sample's tokens stands, in order."""
    size = _size(texts)
    sample = texts.select("text") if size is None or size <= SAMPLE_BYTES else texts.select("text").sample(SAMPLE_BYTES / size, 7)
    found = sample.mapInArrow(_frequent(shards), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total, *words = found.orderBy(F.col("word").isNotNull(), F.desc("n")).limit(1 + 2 * shards).collect() or [{"n": 0}]
    return np.sort(np.array([r["word"] for r in words if r["n"] * 2 * shards >= total["n"]], np.int64).view(_U))


def train(texts: DataFrame, work: Workspace, order: int = 2, shards: int | None = None) -> Model:
    """Count and store a model of the column ``text`` with n-grams of up to ``order`` (2 or more) words."""
    shards = shards or shards_for(texts)
    folder = f"{work.path}/model"
    hot = frequent_words(texts, shards)
    passes = min(PASSES, shards)
    bounds = [shards * i // passes for i in range(passes + 1)]
    per = -(-shards // (FAN_OUT * passes))
    sent = []
    with _shuffles_dropped(work.spark):
        for i, owned in enumerate(zip(bounds, bounds[1:])):
            many = owned[1] - owned[0]
            counted = texts.select("text").mapInArrow(_count(shards, order, hot, owned, per), _BLOBS)
            if per > 1:
                salted = counted.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(per)))
                counted = salted.repartition(many, "shard", "salt").drop("salt").mapInArrow(_spread(shards, order, hot), _BLOBS)
            found = counted.repartitionById(many, F.col("shard") - owned[0]).mapInArrow(_gram_shards(folder, shards, order, hot), _BLOBS)
            sent.append(work.keep(found, f"sent{i}"))
        found = functools.reduce(DataFrame.unionByName, sent)
        summed = found.where(F.col("kind") == GRAMS).repartitionById(fewer(shards), F.col("shard")).mapInArrow(_hot_shards(folder, shards, order), _BLOBS)
        words = found.where(F.col("kind") != GRAMS).unionByName(summed)
        names = _stats(order)
        stats = words.repartitionById(fewer(shards), F.col("shard")).mapInArrow(_word_shards(folder, shards, order), ", ".join(f"{c} long" for c in names))
        sums = stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first().asDict()
    work.drop(*[f"sent{i}" for i in range(passes)])
    return Model(folder, shards, sums, order, hot)


@contextlib.contextmanager
def _shuffles_dropped(spark):
    """Meanwhile a query's shuffle files go when it ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _score(model: Model):
    folder, shards, stats, order, hot = model.folder, model.shards, model.stats, model.order, model.hot

    def run(batches):
        model = Model(folder, shards, stats, order, hot)
        held: list[tuple] = []

        def scored():
            """Several slices at once, so that each table is asked for many n-grams."""
            tokens = np.concatenate([h[0] for h in held])
            first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(h[1]) for h in held]))])
            part = pa.Table.from_batches([h[2] for h in held]).combine_chunks()
            held.clear()
            count, base, score = model.token_scores(tokens, *histories(tokens, first, order - 1))
            at = first[:-1]
            values = [np.diff(first), np.add.reduceat((count > 0).astype(np.int64), at), np.add.reduceat(base, at), np.add.reduceat(score, at)]
            for name, v in zip(("n_tokens", "n_known", "base_score", "score"), values):
                part = part.append_column(name, pa.array(v))
            return part.to_batches()

        for batch in batches:
            for part in bw.slices(batch, "text", 1 << 20):
                tokens, _, first = token_hashes(bw.split_words(*bw.text_buffers(part.column("text"))))
                held.append((tokens, first, part.drop_columns(["text"])))
                if sum(len(h[0]) for h in held) >= LOT:
                    yield from scored()
        if held:
            yield from scored()

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but text, and n_tokens, n_known, train_tokens, base_score, score, perplexity of the text."""
    docs = docs.drop("n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
    columns = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != "text")
    out = docs.mapInArrow(_score(model), f"{columns}n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(model.stats["tokens"]).cast("long")).withColumn("perplexity", F.exp(-F.col("score") * math.log(10) / F.col("n_tokens")))
