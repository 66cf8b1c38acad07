"""Candidates for pairs of similar sets, found in blocks of sets.

A large group's sets are dealt over blocks, small groups share blocks; each block is a file in the shared folder, and a task maps two of
them (or one) and compares all their sets. So what is shuffled and stored grows with the input, and not with the pairs of sets that share a word,
which never leave a task. The work of a group grows with its pairs, in memory that blocks bound.

In a task words are ordered by how many of its sets have them. The rare ones, which make two sets meet ``MEETINGS`` times on average, are counted
for all pairs of sets at once. Two sets of m and n words as similar as ``threshold`` t share t / (1 + t) * (m + n) words, of which no more are frequent
than either set has of these; pairs that share the rest among the rare ones, which are few unless sets have hardly any rare words, are compared
whole. Words are 32-bit hashes; of words of a set with one hash each counts, so no pair is lost, and pairs are to be confirmed.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..llm.shared import Workspace, mapped, write_file

#: Words of a block's sets, pairs that a task looks at at once, and rare words that two sets share on average.
BLOCK, MATCHES, MEETINGS = 2_000_000, 1 << 20, 1
_U = np.uint64
_LOW = _U(0xFFFFFFFF)


def _write(folder: str):
    def run(key, table):
        hashes = table.column("hashes").combine_chunks()
        offsets = np.concatenate([[0], np.cumsum(hashes.value_lengths().to_numpy())]).astype("<i8")
        path = f"{folder}/{key[0].as_py()}-{key[1].as_py()}-{uuid.uuid4().hex}"
        parts = [np.array([len(hashes)], "<i8"), table.column("class").to_numpy(), offsets, hashes.flatten().to_numpy()]
        write_file(path, b"".join(x.tobytes() for x in parts))
        return pa.table({"unit": table.column("unit")[:1], "block": table.column("block")[:1], "path": pa.array([path])})

    return run


def _read(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes, offsets and hashes of a block."""
    data = mapped(path)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    offsets = np.frombuffer(data, "<i8", n + 1, 8 * (n + 1))
    return np.frombuffer(data, "<i8", n, 8), offsets, np.frombuffer(data, "<u4", int(offsets[-1]), 8 * (2 * n + 2))


def _ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places first to first + n of each, in a row."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _runs(counts: np.ndarray):
    """Ranges of entries with about ``MATCHES`` in all, one at least."""
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MATCHES, "right")))
        yield slice(at, to)
        at = to


def similar_sets(sizes: np.ndarray, hashes: np.ndarray, n_left: int, threshold: float):
    """Pairs (x, y) of sets that may be as similar: of the first ``n_left`` ones with later ones than these, or with each other if there are
    no others. Yields arrays of x and y."""
    n = len(sizes)
    owner = np.repeat(np.arange(n, dtype=_U), sizes) << _U(32)
    keyed = np.sort(owner | hashes)
    words = keyed & _LOW
    new = np.append(True, keyed[1:] != keyed[:-1]) if n else np.empty(0, bool)
    if not new.all():  # words of a set that have one hash
        nth = np.arange(len(keyed))
        words |= (nth - np.maximum.accumulate(np.where(new, nth, 0))).astype(_U) << _U(32)
    names, place, often = np.unique(words, return_inverse=True, return_counts=True)
    rank = np.empty(len(names), _U)
    rank[np.argsort(often, kind="stable")] = np.arange(len(names), dtype=_U)
    keyed = np.sort(owner | rank[place])  # each set's words, the rarest first
    del words, place
    starts = np.cumsum(sizes) - sizes
    among = n_left == n
    split = int(starts[n_left]) if n_left < n else 0
    word = (keyed & _LOW).astype(np.int64)
    ours, theirs = (word, word) if among else (word[:split], word[split:])
    meetings = np.bincount(ours, minlength=len(names)) * (np.bincount(theirs, minlength=len(names)) - among)
    limit = int(np.searchsorted(np.cumsum(meetings), MEETINGS * n_left * (n if among else n - n_left), "right"))  # rare words are below
    frequent = np.bincount((owner >> _U(32))[word >= limit].astype(np.int64), minlength=n).astype(np.float32)
    rare = (word < limit) & (meetings[word] > 0)
    place = np.flatnonzero(rare)
    x, word = (keyed[place] >> _U(32)).astype(np.int64), word[place]
    right = slice(0, None) if among else slice(int(np.searchsorted(x, n_left)), None)
    owners = np.sort((word[right] << 32) | x[right])  # who has a word
    share = threshold / (1 + threshold)
    total = sizes.astype(np.float32) * np.float32(share)
    at = 0
    while at < n_left:
        low = at if among else n_left
        width = n - low
        to = min(n_left, at + max(1, MATCHES // width))
        some = slice(int(np.searchsorted(x, at)), int(np.searchsorted(x, to)))
        first = np.searchsorted(owners, word[some] << 32 | low)
        count = np.searchsorted(owners, (word[some] + 1) << 32) - first
        shared = np.zeros((to - at) * width, np.int32)
        for part in _runs(count):
            mine = np.repeat((x[some][part] - at) * width - low, count[part])
            shared += np.bincount(mine + (owners[_ragged(first[part], count[part])] & 0xFFFFFFFF), minlength=len(shared)).astype(np.int32)
        # frequent words that both have are no more than either has
        needs = total[at:to, None] + total[None, low:] - np.minimum(frequent[at:to, None], frequent[None, low:])
        a, b = np.nonzero(shared.reshape(to - at, width) >= needs - np.float32(0.01))
        a, b = a + at, b + low
        a, b = (a[a < b], b[a < b]) if among else (a, b)
        at = to
        for part in _runs(sizes[a]):
            c, d = a[part], b[part]
            wanted = np.repeat(d.astype(_U) << _U(32), sizes[c]) | keyed[_ragged(starts[c], sizes[c])] & _LOW
            spot = np.minimum(np.searchsorted(keyed, wanted), len(keyed) - 1)
            both = np.add.reduceat((keyed[spot] == wanted).astype(np.int64), np.cumsum(sizes[c]) - sizes[c])
            alike = both >= (sizes[c] + sizes[d] - both) * threshold - 1e-6
            if alike.any():
                yield c[alike], d[alike]


def _compare(threshold: float):
    def run(batches):
        for batch in batches:
            for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist()):
                blocks = [_read(path) for path in dict.fromkeys((one, two))]
                classes = np.concatenate([c for c, _, _ in blocks])
                sizes = np.concatenate([np.diff(o) for _, o, _ in blocks])
                for x, y in similar_sets(sizes, np.concatenate([h for _, _, h in blocks]), len(blocks[0][0]), threshold):
                    yield pa.RecordBatch.from_arrays([pa.array(classes[x]), pa.array(classes[y])], ["a", "b"])

    return run


def candidates(members: DataFrame, group: str, work: Workspace, threshold: float) -> DataFrame:
    """(group, a, b): each pair of different classes that may be as similar, once. ``members`` have group, class and hashes."""
    classes = members.groupBy(group, "class").agg(F.first("hashes").alias("hashes"))
    counts = work.keep(members.groupBy(group).agg(F.sum(F.size("hashes")).alias("n")), "counts")
    small = counts.where(F.col("n") <= BLOCK // 2).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # there are no more large groups than one for so many words
    large = counts.where(F.col("n") > BLOCK // 2).select(group, F.ceil(F.col("n") / BLOCK).alias("blocks"))
    shared = max(1, -(-small // BLOCK))
    dealt = classes.join(F.broadcast(large), group, "left").select(
        F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.xxhash64(group)).alias("unit"),
        F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64(group), F.lit(shared))).otherwise(F.pmod("class", "blocks")).alias("block"),
        "class",
        "hashes",
    )
    written = dealt.groupBy("unit", "block").applyInArrow(_write(f"{work.path}/blocks"), "unit long, block long, path string")
    blocks = work.keep(written, "blocks-written")
    one, two = blocks.select("unit", F.col("block").alias("x"), F.col("path").alias("one")), blocks.select("unit", F.col("block").alias("y"), F.col("path").alias("two"))
    pairs = work.keep(one.join(two, "unit").where("x = y or unit <> 0 and x < y").select("one", "two"), "block-pairs")
    found = pairs.repartition(max(1, min(pairs.count(), 100_000)), "one", "two").mapInArrow(_compare(threshold), "a long, b long")
    # a class has its group in its hash; blocks of small groups hold several
    named = members.select(group, "class").distinct()
    a, b = (named.select(group, F.col("class").alias(c)) for c in "ab")
    return found.join(a, "a").join(b, [group, "b"]).select(group, "a", "b")
