"""A word list as a prefix tree, its radix form, and the WTRI v1 file: made from ranges of the words, and looked up by workers that map it."""

from __future__ import annotations

import base64
import hashlib
import os
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import filesystem, mapped, write_file
from . import ordered as O
from .lineage import Scratch

MAGIC, VERSION = b"WTRI", 1


def trie_nodes(words: DataFrame, word: str = "word") -> DataFrame:
    """prefix, terminal: the root and each different beginning of the words; empty words are skipped."""
    w = words.select(F.col(word).alias("w")).where("length(w) > 0").distinct()
    # the word itself is told from its beginnings before they are summed, so a beginning shared by all is one row a task
    spread = w.select("w", F.explode(F.sequence(F.lit(0), F.length("w"))).alias("n")).select(F.substring("w", F.lit(1), F.col("n")).alias("prefix"), (F.col("n") == F.length("w")).alias("ends"))
    return spread.groupBy("prefix").agg(F.bool_or("ends").alias("terminal"))


def radix_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes that stay when chains are collapsed: the root, ends of words, and those with two children or more."""
    parent = F.substring("prefix", F.lit(1), F.length("prefix") - 1)
    children = nodes.where("prefix <> ''").groupBy(parent.alias("of")).agg(F.count(F.lit(1)).alias("children"))
    return nodes.join(children, nodes["prefix"] == F.col("of"), "left").where("prefix = '' or terminal or children >= 2").select("prefix", "terminal")


def radix_of_words(words: DataFrame, word: str = "word") -> DataFrame:
    """What :func:`radix_nodes` gives of a word list, without a row for each beginning: the root, the words, and what two words that are
    neighbours in their order have in common."""
    work = Scratch(words.sparkSession, "radix")
    w = words.select(F.col(word).alias("prefix")).where("length(prefix) > 0").distinct()
    ranged = O.in_ranges(w, ["prefix"], work, "words")
    # the last word of each range goes to the next one
    lasts = ranged.groupBy(O.RANGE).agg(F.max("prefix").alias("prefix")).select("prefix", (F.col(O.RANGE) + 1).alias(O.RANGE), F.lit(-1).cast("long").alias(O.PLACE))
    common = _by_range(ranged.unionByName(lasts)).mapInArrow(_common, "prefix string, terminal boolean")
    rows = common.unionByName(words.sparkSession.createDataFrame([("", False)], common.schema))
    return work.keep(rows.groupBy("prefix").agg(F.bool_or("terminal").alias("terminal")), "kept")


def _by_range(rows: DataFrame) -> DataFrame:
    """A task for each range, in order of place."""
    n = rows.agg(F.max(O.RANGE)).first()[0]
    return rows.repartitionById((n or 0) + 1, O.RANGE).sortWithinPartitions(O.PLACE)


def _common(batches):
    last = None
    for batch in batches:
        found: dict[str, bool] = {}
        for prefix, place in zip(batch.column("prefix").to_pylist(), batch.column(O.PLACE).to_pylist()):
            if place >= 0:
                found[prefix] = True
                if last is not None:
                    found.setdefault(os.path.commonprefix((last, prefix)), False)
            last = prefix
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.bool_())], ["prefix", "terminal"])


def numbered(kept: DataFrame) -> DataFrame:
    """Nodes with their preorder number; preorder is the order of prefixes."""
    return O.numbered(kept, ["prefix"], "node")


_LINKED = "node long, prefix string, terminal boolean, parent_node long, parent string, label string"


def linked(kept: DataFrame) -> DataFrame:
    """node, prefix, terminal, parent_node, parent (the longest kept beginning), label (the rest); the root has no parent.

    In preorder a node's parent is the last one before it that it begins with, so a stack finds it. A range starts with the
    kept beginnings of its first node, which are looked up for one node a range.
    """
    work = Scratch(kept.sparkSession, "linked")
    ranged = O.in_ranges(kept.select("prefix", "terminal"), ["prefix"], work, "ranged")
    nodes = ranged.join(O.offsets(ranged, work, "offsets"), O.RANGE).withColumn("node", F.col("range_start") + F.col(O.PLACE)).drop("range_start")
    firsts = ranged.where(f"{O.PLACE} = 0 and prefix <> ''")
    open_ = firsts.select(F.col(O.RANGE).alias("of_range"), F.explode(F.expr("transform(sequence(0, length(prefix) - 1), n -> substring(prefix, 1, n))")).alias("up"))
    above = nodes.join(open_, F.col("prefix") == F.col("up")).select("node", "prefix", "terminal", F.col("of_range").alias(O.RANGE), (F.length("prefix") - (1 << 40)).cast("long").alias(O.PLACE))
    return _by_range(nodes.select(*above.columns).unionByName(above)).mapInArrow(_link, _LINKED)


def _link(batches):
    stack: list[tuple[str, int]] = []
    for batch in batches:
        rows = []
        for node, prefix, terminal, place in zip(*(batch.column(c).to_pylist() for c in ("node", "prefix", "terminal", O.PLACE))):
            while stack and not prefix.startswith(stack[-1][0]):
                stack.pop()
            if place >= 0:
                up, number = stack[-1] if stack else (None, None)
                rows.append((node, prefix, terminal, number, up, None if up is None else prefix[len(up) :]))
            stack.append((prefix, node))
        kinds = (pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["node", "prefix", "terminal", "parent_node", "parent", "label"])


def radix_edges(kept: DataFrame) -> DataFrame:
    """prefix, terminal, parent (the longest kept beginning), label (the rest) for all nodes but the root."""
    return linked(kept).where("parent is not null").select("prefix", "terminal", "parent", "label")


def trie_stats(kept: DataFrame) -> DataFrame:
    """One row: node_count, edge_count, label_bytes. Each node but the root is the end of one edge."""
    return linked(kept).agg(F.count(F.lit(1)).alias("node_count"), F.count("parent_node").alias("edge_count"), F.coalesce(F.sum(F.octet_length("label")), F.lit(0)).alias("label_bytes"))


# ------------------------------------------------------------ the WTRI v1 file

#: Nodes whose arrays one task packs; a multiple of 8, so that each has whole bytes of bits.
SHARD_NODES = 1 << 20
_HEADER = struct.Struct("<4sBBHIIII")
#: Arrays of the file in their order: first edge and number of edges of each node, place, length and target of each edge's label, bits, labels.
SECTIONS = (("first", "<u4"), ("count", "<u4"), ("start", "<u4"), ("length", "<u2"), ("target", "<u4"), ("bits", "u1"), ("labels", "u1"))


def _pack(folder: str, shard_nodes: int, n_nodes: int, before: dict[int, tuple[int, int]]):
    """Arrays of the nodes of a shard, each written as a file of its own. Rows: a node's edges by parent, and the ends of words."""

    def run(batches):
        shard = TaskContext.get().partitionId()
        low = shard * shard_nodes
        n = min(shard_nodes, n_nodes - low)
        rows = pa.Table.from_batches(list(batches), pa.schema([("shard", pa.int32()), ("node", pa.int64()), ("target", pa.int64()), ("label", pa.string())]))
        ends = rows.filter(pc.is_null(rows["target"]))["node"].to_numpy() - low
        edges = rows.filter(pc.is_valid(rows["target"])).sort_by([("node", "ascending"), ("target", "ascending")])
        labels = edges["label"].to_pylist()
        for label in labels:
            if not label.isascii():
                raise ValueError(f"label isn't ASCII: {label!r}")
            if len(label) > 0xFFFF:
                raise ValueError("label is longer than 65535")
        n_edges, n_bytes = before.get(shard, (0, 0))
        count = np.bincount(edges["node"].to_numpy() - low, minlength=n)
        length = np.array([len(x) for x in labels], np.int64)
        bits = np.zeros(-(-n // 8) * 8, np.uint8)
        bits[ends] = 1
        arrays = {"first": n_edges + np.cumsum(count) - count, "count": count, "start": n_bytes + np.cumsum(length) - length, "length": length, "target": edges["target"].to_numpy()}
        parts = {name: arrays[name].astype(kind).tobytes() for name, kind in SECTIONS[:5]}
        parts |= {"bits": np.packbits(bits, bitorder="little").tobytes(), "labels": "".join(labels).encode()}
        for name, data in parts.items():
            write_file(f"{folder}/{name}/{shard:06d}", data)
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n], pa.int64())], ["shard", "nodes"])

    return run


def write_wtri(kept: DataFrame, path: str, shard_nodes: int = SHARD_NODES) -> dict:
    """Write the file of the kept nodes (prefix, terminal) to ``path``; returns node_count, edge_count, label_bytes, bytes and sha256.

    Tasks pack the arrays of ranges of nodes, whose places in the file follow from sums over ranges; the parts are then copied one after the
    other. Numbers have 32 bits in the format, so there are 4096 shards of the usual size at most; more is an error. Labels have to be ASCII, as
    places count characters and bytes alike.
    """
    if shard_nodes % 8:
        raise ValueError("a shard has to have whole bytes of bits")
    work = Scratch(kept.sparkSession, "wtri")
    nodes = work.keep(linked(kept), "linked")
    shard = lambda c: (F.col(c) / shard_nodes).cast("int").alias("shard")
    edges = nodes.where("parent_node is not null").select(shard("parent_node"), F.col("parent_node").alias("node"), F.col("node").alias("target"), "label")
    totals = edges.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("label")).alias("size"))
    n_nodes = nodes.count()
    found = {r["shard"]: (r["n"], r["size"]) for r in totals.collect()}  # a row a shard, of which 32 bits bound the number
    n_edges, n_bytes, before, shards = 0, 0, {}, -(-n_nodes // shard_nodes)
    for k in range(shards):
        before[k] = (n_edges, n_bytes)
        n_edges, n_bytes = (a + b for a, b in zip((n_edges, n_bytes), found.get(k, (0, 0))))
    if max(n_nodes, n_edges, n_bytes) > 0xFFFFFFFF:
        raise ValueError(f"{n_nodes} nodes, {n_edges} edges and {n_bytes} bytes of labels don't fit 32 bits")
    ends = nodes.where("terminal").select(shard("node"), "node", F.lit(None).cast("long").alias("target"), F.lit(None).cast("string").alias("label"))
    rows = edges.unionByName(ends).repartitionById(max(1, shards), "shard")
    work.keep(rows.mapInArrow(_pack(f"{work.path}/parts", shard_nodes, n_nodes, before), "shard int, nodes long"), "packed")
    header = _HEADER.pack(MAGIC, VERSION, 0, 0, n_nodes, n_edges, n_bytes, -(-n_nodes // 8))
    digest, size = hashlib.sha256(header), len(header)
    fs, at = filesystem(path)
    with fs.open_output_stream(at, compression=None) as out:
        out.write(header)
        for name, _ in SECTIONS:
            for k in range(shards):
                source, part = filesystem(f"{work.path}/parts/{name}/{k:06d}")
                with source.open_input_stream(part, compression=None) as src:
                    while block := src.read(1 << 22):
                        out.write(block)
                        digest.update(block)
                        size += len(block)
    work.drop("parts", "linked", "packed")
    return {"node_count": n_nodes, "edge_count": n_edges, "label_bytes": n_bytes, "bytes": size, "sha256": digest.hexdigest()}


class Wtri:
    """A file's arrays, mapped or in memory."""

    def __init__(self, data):
        if bytes(data[:4]) != MAGIC or data[4] != VERSION:
            raise ValueError("no WTRI v1 file")
        n, e, size, n_bits = _HEADER.unpack_from(data)[4:]
        at = _HEADER.size
        for (name, kind), length in zip(SECTIONS, (n, n, e, e, e, n_bits, size)):
            setattr(self, name, np.frombuffer(data, kind, length, at))
            at += length * np.dtype(kind).itemsize

    def ends_word(self, node: np.ndarray) -> np.ndarray:
        return (self.bits[node >> 3] >> (node & 7) & 1).astype(bool)

    def words(self, low: int = 0, high: int | None = None):
        """Words that end at the nodes ``low`` to ``high``, in order."""
        high = len(self.first) if high is None else min(high, len(self.first))
        if low >= high:
            return
        node, prefix, stack = 0, "", []
        while node < low:  # the node's path; siblings after it are visited after it
            a, b = int(self.first[node]), int(self.first[node] + self.count[node])
            k = a + int(np.searchsorted(self.target[a:b], low, "right")) - 1
            stack += [(j, prefix) for j in range(b - 1, k, -1) if self.target[j] < high]
            node, prefix = int(self.target[k]), prefix + self._label(k)
        while True:
            if self.bits[node >> 3] >> (node & 7) & 1:
                yield prefix
            a, b = int(self.first[node]), int(self.first[node] + self.count[node])
            stack += [(j, prefix) for j in range(b - 1, a - 1, -1) if self.target[j] < high]
            if not stack:
                return
            k, prefix = stack.pop()
            node, prefix = int(self.target[k]), prefix + self._label(k)

    def _label(self, edge: int) -> str:
        a = int(self.start[edge])
        return self.labels[a : a + int(self.length[edge])].tobytes().decode()

    def contains(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which of the words (bytes ``starts`` to ``ends`` of ``data``) the file has; all go down the tree together, an edge a step."""
        found, row = np.zeros(len(starts), bool), np.arange(len(starts))
        node, at = np.zeros(len(starts), np.int64), starts.astype(np.int64)
        while len(row):
            done = at == ends[row]
            found[row[done]] = self.ends_word(node[done]) & (starts[row[done]] < ends[row[done]])
            row, node, at = row[~done], node[~done], at[~done]
            # the edge whose label begins with the next byte; a node's edges are in order of that byte
            low, stop = self.first[node].astype(np.int64), self.first[node].astype(np.int64) + self.count[node]
            high, byte = stop.copy(), data[at]
            while (open_ := low < high).any():
                middle = (low + high) // 2
                less = open_ & (self.labels[self.start[np.where(open_, middle, 0)]] < byte)
                low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
            fits = low < stop
            row, at, edge = row[fits], at[fits], low[fits]
            length = self.length[edge].astype(np.int64)
            fits = at + length <= ends[row]
            row, at, edge, length = row[fits], at[fits], edge[fits], length[fits]
            step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            same = data[np.repeat(at, length) + step] == self.labels[np.repeat(self.start[edge].astype(np.int64), length) + step]
            fits = np.ones(len(row), bool)
            np.logical_and.at(fits, np.repeat(np.arange(len(row)), length), same)
            row, at, node = row[fits], (at + length)[fits], self.target[edge[fits]].astype(np.int64)
        return found


def file_words(spark: SparkSession, path: str, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """word: all words of a file; each task walks a range of nodes."""

    def run(batches):
        for batch in batches:
            for low in batch.column("id").to_pylist():
                found = []
                for word in Wtri(mapped(path)).words(low, low + shard_nodes):
                    found.append(word)
                    if len(found) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(found)], ["word"])
                        found = []
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["word"])

    fs, at = filesystem(path)
    with fs.open_input_stream(at, compression=None) as src:
        n = _HEADER.unpack(src.read(_HEADER.size))[4]
    shards = max(1, -(-n // shard_nodes))
    return spark.range(0, shards * shard_nodes, shard_nodes, shards).mapInArrow(run, "word string")


def in_file(words: DataFrame, path: str, word: str = "word", result: str = "valid") -> DataFrame:
    """``words`` with a column that says whether the file at ``path`` has the word as it is; null for null. The file lies where all workers
    read it; each maps it once, and no row is shuffled."""

    def run(batches):
        tree = Wtri(mapped(path))
        for batch in batches:
            column = batch.column(word).cast(pa.large_string())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
            valid = tree.contains(data, offsets[:-1], offsets[1:])
            mask = np.asarray(column.is_null())
            kept = [i for i, n in enumerate(batch.schema.names) if n != result]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(valid, mask=mask)], [*(batch.schema.names[i] for i in kept), result])

    schema = T.StructType([*(f for f in words.schema if f.name != result), T.StructField(result, T.BooleanType())])
    return words.mapInArrow(run, schema)


def write_js_module(path: str, to: str, name: str = "lexicon") -> None:
    """The file as a JavaScript module, copied in pieces."""
    (fs, at), (to_fs, to_at) = filesystem(path), filesystem(to)
    with fs.open_input_stream(at, compression=None) as src, to_fs.open_output_stream(to_at, compression=None) as out:
        out.write(f'export const {name} = Uint8Array.from(atob("'.encode())
        while block := src.read(3 << 20):
            out.write(base64.b64encode(block))
        out.write(b'"), (c) => c.charCodeAt(0));\n')
