"""MinHash near-duplicates: many universal hash minima, banding, signature verification, an exact check on whole
sets, and connected components by alternating large-star and small-star.

No group is compared pair by pair. In a task a pivot row is compared with the rows that aren't connected with it yet, and
pivots are taken only until all rows that weren't one are connected: a group of near copies takes one. A group beyond a block
is dealt over blocks that all hold the group's centre; rows that stay apart from it in their block meet all blocks after.

Defined results: a null or word-less text has an empty set and is linked with nothing. A text with fewer words than a
shingle has one shingle, the whole sequence. Rows with equal sets form one class, whatever their number, and only
classes are compared. A null doc_id can't name a component: such a row takes part in links, and a component of such
rows alone has a null id; they are kept only if no other row is. Rows that repeat a doc_id are linked by their texts
like any others; of several rows that carry a component's smallest doc_id all are kept. A very long text is one row of a
slice and takes some 60 times its bytes in a worker for a moment. An empty table gives an empty one. Other columns are
ignored by :func:`near_duplicates` and kept by :func:`drop_near_duplicates`, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .shared import Workspace, renamed

_U = np.uint64
#: Most rows of a group in a block: of signatures, and of texts, which their shingles bound by size too.
BLOCK_ROWS, BLOCK_TEXTS, BLOCK_SHINGLES = 1024, 1024, 1 << 19


def shingle_sets(column: pa.Array, shingle: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles."""
    words = bw.split_words(*bw.text_buffers(column))
    hashes = words.hashes()
    grams = bw.gram_hashes(hashes, shingle)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= shingle:
            out.append(np.unique(grams[a : b - shingle + 1]))
        elif b > a:
            out.append(bw.gram_hashes(hashes[a:b], int(b - a)))
        else:
            out.append(np.empty(0, _U))
    return out


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _digests(column: pa.Array) -> list[bytes]:
    """A digest of each text; that of a null is empty."""
    return [hashlib.md5(t.as_buffer()).digest() if t.is_valid else b"" for t in column]


def signatures(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """Minima of ``hashes`` multiply-add-shift hash functions for each set that isn't empty (others: all ones)."""
    sizes = np.array([len(s) for s in sets])
    out = np.full((len(sets), hashes), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    values = np.concatenate([sets[i] for i in full])
    at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    a = bw.mix(np.arange(1, hashes + 1, dtype=_U) * _U(0xA24BAED4963EE407)) | _U(1)
    b = bw.mix(np.arange(1, hashes + 1, dtype=_U) * _U(0x9FB21C651E98DF25))
    work = np.empty_like(values)
    for k in range(hashes):
        np.multiply(values, a[k], out=work)
        np.add(work, b[k], out=work)
        out[full, k] = np.minimum.reduceat(work, at) >> _U(32)
    return out


def _describe(shingle: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for part in bw.slices(batch, "text", 1 << 19):
                sets = shingle_sets(part.column("text"), shingle)
                sig = signatures(sets, bands * rows)
                folded = bw.gram_hashes(sig.astype(_U).ravel(), rows)[::rows].reshape(len(sets), bands) if len(sets) else np.empty((0, bands), _U)
                buckets = bw.mix(folded + np.arange(1, bands + 1, dtype=_U) * _U(0xC2B2AE3D27D4EB4F)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) for s in sets], pa.binary()),
                        pa.array(_digests(part.column("text")), pa.binary()),
                        pa.array([r.tobytes() for r in (sig & 0xFF).astype(np.uint8)], pa.binary()),
                        pa.ListArray.from_arrays(np.arange(0, (len(sets) + 1) * bands, bands, dtype=np.int32), pa.array(buckets.ravel())),
                    ],
                    ["doc_id", "n_shingles", "node", "digest", "sig", "buckets"],
                )

    return run


def _groups(batch_iter, key: str):
    """Tables of a partition sorted by ``key``, cut at changes of the key. Batches are taken a block at a time, so a table has
    not many more rows than its last key, or than a block."""
    held: list[pa.RecordBatch] = []
    for batch in (b.slice(at, BLOCK_ROWS) for b in batch_iter for at in range(0, b.num_rows, BLOCK_ROWS)):
        held.append(batch)
        if held[0].column(key)[0] != batch.column(key)[-1]:
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def connect(label: np.ndarray, test, pivots: np.ndarray | None = None) -> np.ndarray:
    """Rows whose ``label`` is equal are connected; joins labels for each link that ``test(i, js)`` (a mask over js) finds
    between rows of different ones. With ``pivots``, a mask, only links of these rows are looked for."""
    every = pivots is None
    left = np.ones(len(label), bool) if every else pivots.copy()
    while left.any():
        at = np.flatnonzero(left)
        names, where, counts = np.unique(label[at], return_inverse=True, return_counts=True)
        if every and len(names) == 1:  # what isn't connected with these was a pivot, so it was compared with them
            break
        i = int(at[where == int(counts.argmin())][0])
        left[i] = False
        others = np.flatnonzero((label != label[i]) & left if every else label != label[i])
        if len(others):
            hits = others[test(i, others)]
            joined = np.union1d(label[hits], label[i : i + 1])
            label[np.isin(label, joined)] = joined[0]
    return label


def _edges(nodes: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """A star for each label: (node, the label's node)."""
    off = np.flatnonzero(label != np.arange(len(label)))
    return _found(nodes[off], nodes[label[off]], [None] * len(off))


def _found(u, v, key) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(key, pa.binary())], ["u", "v", "key"])


def _tests(hashes: int, least: float):
    """Comparer of signatures: do so many minima agree."""

    def over(table: pa.Table):
        sig = np.frombuffer(b"".join(table.column("payload").to_pylist()), np.uint8).reshape(table.num_rows, hashes)
        return lambda i, js: (sig[js] == sig[i]).sum(axis=1) >= least * hashes

    return over


def _exact_tests(shingle: int, percent: int):
    """Comparer of whole sets of shingles; a row whose text isn't that of its node, as its doc_id repeats, is linked with nothing."""

    def over(table: pa.Table):
        sets = [s for batch in table.to_batches() for part in bw.slices(batch, "payload") for s in shingle_sets(part.column("payload"), shingle)]
        sets = [s if set_key(s) == n else np.empty(0, _U) for s, n in zip(sets, table.column("node").to_pylist())]
        size = np.array([len(s) for s in sets], np.int64)

        def test(i: int, js: np.ndarray) -> np.ndarray:
            out = np.zeros(len(js), bool)
            near = np.flatnonzero((100 * np.minimum(size[js], size[i]) >= percent * np.maximum(size[js], size[i])) & (size[js] > 0))
            if len(near) and size[i]:
                own = sets[i]
                values = np.concatenate([sets[j] for j in js[near]])
                spot = np.searchsorted(own, values)
                spot[spot == len(own)] = 0
                both = np.add.reduceat((own[spot] == values).astype(np.int64), np.cumsum(size[js[near]]) - size[js[near]])
                out[near] = 100 * both >= percent * (size[i] + size[js[near]] - both)
            return out

        return test

    return over


def _task_bounds(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    task = table.column("task").to_numpy()
    first = np.flatnonzero(np.append(True, task[1:] != task[:-1]))
    return first, np.append(first[1:], len(task))


def _link_blocks(tests):
    """Links in each task (task, key, node, payload, blocks, is_center), and with a key the rows of a group of several blocks
    that aren't connected with its centre in theirs."""

    def run(batches):
        for table in _groups(batches, "task"):
            nodes = np.array(table.column("node").to_pylist(), dtype=object)
            test = tests(table)
            label = np.arange(len(nodes))
            first, last = _task_bounds(table)
            several = table.column("blocks").to_numpy() > 1
            for a, b in zip(first, last):
                if b - a == 2:
                    if test(a, np.array([a + 1]))[0]:
                        label[a + 1] = a
                elif b - a > 2:
                    label[a:b] = a + connect(np.arange(b - a), lambda i, js, a=a: test(a + i, a + js))
            yield _edges(nodes, label)
            if several.any():
                center, keys = table.column("is_center").to_numpy(zero_copy_only=False), table.column("key").to_pylist()
                for a, b in zip(first, last):
                    if several[a]:
                        with_center = label[a:b][center[a:b]]
                        rest = a + np.flatnonzero(~np.isin(label[a:b], with_center))
                        yield _found(nodes[rest], [None] * len(rest), [keys[a]] * len(rest))

    return run


def _link_rest(tests):
    """Links of the rows that ``is_rest`` marks with the others of their task."""

    def run(batches):
        for table in _groups(batches, "task"):
            nodes = np.array(table.column("node").to_pylist(), dtype=object)
            test, rest = tests(table), table.column("is_rest").to_numpy(zero_copy_only=False)
            label = np.arange(len(nodes))
            for a, b in zip(*_task_bounds(table)):
                label[a:b] = a + connect(np.arange(b - a), lambda i, js, a=a: test(a + i, a + js), rest[a:b])
            yield _edges(nodes, label)

    return run


def links(rows: DataFrame, tests, work: Workspace, name: str) -> DataFrame:
    """Edges (u, v) that connect in each group what ``tests`` link, from rows (key binary, node, payload, blocks, is_center)."""
    found = "u binary, v binary, key binary"
    mine = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    own = rows.withColumn("block", mine)
    centers = own.where("blocks > 1 and is_center").withColumn("home", F.col("block")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block <> home").drop("home")
    tasks = own.union(centers).withColumn("task", F.xxhash64("key", "block")).drop("block")
    first = work.keep(tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_link_blocks(tests), found), f"{name}-first")
    edges, rest = first.where("v is not null").select("u", "v"), first.where("v is null").select("key", F.col("u").alias("node"))
    if rest.isEmpty():
        return edges
    sizes = work.keep(rest.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("rest_blocks")), f"{name}-sizes")
    rest = work.keep(rest.withColumn("is_rest", F.lit(True)), f"{name}-rest")
    marked = rows.join(sizes, "key").join(rest, ["key", "node"], "left").withColumn("is_rest", F.coalesce("is_rest", F.lit(False)))
    against = marked.withColumn("block", mine).withColumn("rest_block", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1))).withColumn("is_rest", F.lit(False))
    rest_block = F.pmod(F.xxhash64("node", F.lit(1)), "rest_blocks").cast("int")
    spread = marked.where("is_rest").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("rest_block", rest_block)
    columns = [F.xxhash64("key", "block", "rest_block").alias("task"), "node", "payload", "is_rest"]
    second = spread.select(*columns).union(against.select(*columns))
    return edges.union(second.repartition("task").sortWithinPartitions("task").mapInArrow(_link_rest(tests), found).select("u", "v"))


def connected_components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, root) for each node of the edges (u, v), by large-star and small-star until nothing changes.

    Each star is a group-by with a minimum joined back to the edges, so no neighbourhood is gathered in one task. The minima
    of the large stars are a table of their own: then both sides of their join are plain shuffles, of which Spark splits
    the part that holds a node with very many neighbours.
    """

    def small_star(e: DataFrame) -> DataFrame:
        # each node sends its smaller neighbours and itself to its smallest
        both = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lows = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        joined = both.join(lows, both.u == lows.c)
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lows.select(F.col("c").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()

    def large_star(e: DataFrame, step: int) -> DataFrame:
        # each node sends its larger neighbours to the smallest of its neighbours and itself
        both = e.union(e.select("v", "u"))
        lows = work.keep(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("m", "u").alias("m")), f"{name}-lows-{step}")
        return both.join(lows, both.u == lows.c).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    edges = work.keep(edges.where("u <> v").distinct(), f"{name}-0")
    state, step = None, 0
    while True:
        step += 1
        now = work.keep(small_star(large_star(edges, step)), f"{name}-{step}")
        work.drop(f"{name}-{step - 1}", f"{name}-lows-{step}")
        edges = now
        # a fixed point is a forest of stars; the number and the sum of hashes of its edges then stay as they are
        was, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if was == state:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = work.keep(roots.union(roots.select(F.col("root").alias("node"), "root").distinct()), name)
    work.drop(f"{name}-{step}")
    return found


def _components(docs: DataFrame, work: Workspace, shingle: int, percent: int, bands: int, rows: int, likely: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node, digest) of each row, and (node, root, low) of each class: its component and the smallest
    doc_id in it."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    described = work.keep(docs.select("doc_id", "text").mapInArrow(_describe(shingle, bands, rows), f"doc_id {kind}, n_shingles long, node binary, digest binary, sig binary, buckets array<long>"), "described")
    classes = work.keep(
        described.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("buckets").alias("buckets")),
        "classes",
    )
    spots = classes.select("node", F.explode("buckets").alias("bucket"))
    center = F.xxhash64("node")
    shared = spots.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min(center).alias("center")).where("size > 1")
    members = spots.join(shared, "bucket").join(classes.select("node", F.col("sig").alias("payload")), "node")
    members = members.select(F.hex("bucket").cast("binary").alias("key"), "node", "payload", F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("blocks"), (center == F.col("center")).alias("is_center"))
    alike = links(members, _tests(bands * rows, likely), work, "alike")
    candidates = connected_components(alike, work, "candidates")
    work.drop("alike-first", "alike-sizes", "alike-rest")

    # the centre of a candidate component is the text that meets most others in buckets, as what was copied is near to all copies
    met = spots.join(shared, "bucket").groupBy("node").agg(F.sum("size").alias("met"))
    named = work.keep(candidates.join(classes.select("node", "rep", "n_shingles"), "node").join(met, "node"), "met")
    sizes = named.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("shingles"), F.max(F.struct("met", "node")).alias("most"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_TEXTS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = work.keep(sizes.select("root", blocks.alias("blocks"), F.col("most.node").alias("center")), "sizes")
    chosen = named.join(sizes, "root").select(F.col("root").alias("key"), "node", "rep", "blocks", (F.col("node") == F.col("center")).alias("is_center"))
    texts = docs.select(F.col("doc_id").alias("rep"), F.col("text").alias("payload"))
    columns = ["key", "node", "payload", "blocks", "is_center"]
    exact = chosen.where("rep is not null").join(texts, "rep").select(*columns)
    lost = chosen.where("rep is null")
    if not lost.isEmpty():  # classes without any doc_id: their texts are found by their sets
        nameless = docs.where("doc_id is null").select("text").mapInArrow(_keyed(shingle), "node binary, payload string").dropDuplicates(["node"])
        exact = exact.union(lost.join(nameless, "node").select(*columns))
    parts = connected_components(links(exact, _exact_tests(shingle, percent), work, "exact"), work, "parts")
    lows = work.keep(parts.join(classes.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("low")), "lows")
    grouped = parts.join(lows, "root").select("node", "root", "low")
    both = classes.select("node", "rep").join(grouped, "node", "left")
    final = work.keep(both.select("node", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNotNull(), F.col("low")).otherwise(F.col("rep")).alias("low")), "named")
    work.drop("classes", "candidates", "met", "sizes", "exact-first", "exact-sizes", "exact-rest", "parts", "lows")
    return described.select("doc_id", "n_shingles", "node", "digest"), final


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 32, rows: int = 5, likely: float = 0.65) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text).

    Two texts are linked if 100 * |A & B| >= percent * |A | B| on their whole sets of shingles. A linked pair at 85 %
    misses all 32 bands of 5 with probability 7e-9 (80 %: 3e-6), and shows under 65 % equal minima of 160 with less than 1e-6.
    Those minima only propose; every link is confirmed on the whole sets.
    """
    described, named = _components(docs, Workspace(docs.sparkSession, "minhash"), shingle, percent, bands, rows, likely)
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("low"))
    kept = F.coalesce(F.col("doc_id") == component, component.isNull() & F.col("doc_id").isNull())
    return described.join(named, "node", "left").select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 32, rows: int = 5, likely: float = 0.65) -> DataFrame:
    """One row of ``docs`` for each component, with its columns: that of the smallest doc_id (nulls last), then of the
    smallest digest of its text. Rows without words all stay. Of rows that are equal in doc_id and text one stays."""
    work = Workspace(docs.sparkSession, "minhash")
    described, named = _components(docs, work, shingle, percent, bands, rows, likely)
    told = described.where("n_shingles > 0").join(named.select("node", "root"), "node")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")
    first = told.groupBy("root").agg(F.min(order).alias("one")).select("one.doc_id", "one.digest")
    n_equal = described.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n_equal"))
    stays = work.keep(n_equal.join(first.withColumn("first", F.lit(True)), [n_equal.doc_id.eqNullSafe(first.doc_id), n_equal.digest == first.digest]).select(n_equal.doc_id.alias("stay_id"), n_equal.digest.alias("stay_digest"), "n_equal"), "stays")
    wordless = described.where("n_shingles = 0").select(F.col("doc_id").alias("stay_id"), F.col("digest").alias("stay_digest"), F.lit(0).cast("long").alias("n_equal")).distinct()
    plain, old = renamed(docs, "doc_id", "text")
    digest = F.coalesce(F.unhex(F.md5("text")), F.lit("").cast("binary"))
    found = plain.withColumn("digest", digest).join(stays.union(wordless), F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("digest") == F.col("stay_digest")))
    back = [F.col(n).alias(old.get(n, n)) for n in plain.columns]
    # texts pass no further shuffle but where a row has an equal
    twice = found.where("n_equal > 1").dropDuplicates(["doc_id", "digest"])
    return found.where("n_equal <= 1").select(*back).union(twice.select(*back))


def _keyed(shingle: int):
    def run(batches):
        for batch in batches:
            for part in bw.slices(batch, "text", 1 << 19):
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in shingle_sets(part.column("text"), shingle)], pa.binary()), part.column("text")], ["node", "payload"])

    return run


#: The contract of three-word shingles at 85 %, by comparing all texts that share a shingle, in DuckDB.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS c FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 85 * (p.c + q.c - i)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(id, other) AS (
  SELECT x, y FROM both_ways UNION SELECT r.id, b.y FROM reach r JOIN both_ways b ON b.x = r.other),
low AS (SELECT id, min(other) AS low FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.c, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.id = d.doc_id
"""
