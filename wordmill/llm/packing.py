"""Packing token sequences into windows of a fixed size, online with bounded space.

Each partition keeps at most ``open_windows`` open windows. A piece goes to the window it fills best; when none has
room the fullest is emitted (topped up with the head of the piece if ``least_cut`` tokens or more fit) and a new one is
opened. Documents longer than a window are cut into full ones first. What is still open at the end of a partition
is merged: open windows of all partitions are dealt out in lots of bounded size and their pieces combined best-fit, largest
first.

Defined results: a null text counts as empty; it has one piece, the end token. Repeated rows are packed each for
itself. Order and partitions of the input decide the packing, and a task that runs again makes the same pieces; of windows with
as much room (ties) the one opened first is taken. Very long texts are cut into windows like others; their ids are held whole
until their last piece is placed. Other columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import bisect
import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .shared import Workspace

WINDOW, END_ID = 2048, 1
#: Open windows merged in one task.
LOT = 4096
#: Runs without (or of) white space that are left to the JSON file's library, which has no limits on them.
_RUN = re.compile(r"\S{2000}|\s{2000}")


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(2)
def encoder(json_path: str, ranks_path: str | None):
    """Texts to token ids as the JSON file's library gives them without added special tokens. The rank file holds the same
    vocabulary and is read by a library that is some times faster; texts that hold one of the JSON file's added tokens
    (which are one id each), texts with very long runs, and all texts if there is no rank file, take the JSON file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(json_path)
    if ranks_path is None:
        return lambda texts: [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = [t.content for t in plain.get_added_tokens_decoder().values()]
    slow = re.compile("|".join([_RUN.pattern, *map(re.escape, added)]))

    def run(texts: list[str]) -> list[list[int]]:
        return [plain.encode(t, add_special_tokens=False).ids if slow.search(t) else fast.encode_ordinary(t) for t in texts]

    return run


class OpenWindows:
    """Windows by free space. ``place`` returns the windows that are emitted for it."""

    def __init__(self, size: int, most: int, least_cut: int):
        self.size, self.most, self.least_cut = size, most, least_cut
        self.free: list[tuple[int, int]] = []  # (free tokens, number), sorted
        self.pieces: dict[int, list] = {}
        self.made = 0

    def place(self, key, start: int, length: int):
        while length:
            at = bisect.bisect_left(self.free, (length, -1))
            if at < len(self.free):
                free, number = self.free.pop(at)
                self.pieces[number].append((key, start, length))
                if free == length:
                    yield number, self.pieces.pop(number)
                else:
                    bisect.insort(self.free, (free - length, number))
                return
            if len(self.free) >= self.most:
                free, number = self.free.pop(0)
                if free >= self.least_cut:
                    self.pieces[number].append((key, start, free))
                    start, length = start + free, length - free
                yield number, self.pieces.pop(number)
                continue
            take = min(length, self.size)
            if take == self.size:
                yield self.made, [(key, start, take)]
            else:
                self.pieces[self.made] = [(key, start, take)]
                bisect.insort(self.free, (self.size - take, self.made))
            self.made += 1
            start, length = start + take, length - take


COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, is_open boolean"


def _pack(paths, window: int, open_windows: int, least_cut: int, with_ids: bool):
    def run(batches):
        encode = encoder(*paths)
        base = TaskContext.get().partitionId() << 32
        windows = OpenWindows(window, open_windows, least_cut)
        held: dict[int, list] = {}  # documents with a piece in an open window: [doc_id, ids, pieces still open]
        rows: list[tuple] = []
        kind = None

        def emit(number: int, pieces, is_open: bool):
            offset = 0
            for key, start, length in pieces:
                doc = held[key]
                part = doc[1][start : start + length]
                rows.append((doc[0], start, length, zlib.crc32(part.tobytes()), len(doc[1]), base | number, offset, is_open, part if with_ids else None))
                offset += length
                doc[2] -= length
                if not doc[2]:
                    del held[key]

        def batch_of():
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "is_open"]
            types = [kind, *[pa.int64()] * 6, pa.bool_()]
            columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate(types)]
            if with_ids:
                names.append("ids")
                columns.append(pa.array([r[8] for r in rows], pa.list_(pa.int32())))
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        key = 0
        for batch in batches:
            kind = batch.column("doc_id").type
            for part in bw.slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(texts)):
                    ids = np.array([*ids, END_ID], dtype="<u4")
                    held[key] = [doc_id, ids, len(ids)]
                    whole = len(ids) // window * window
                    for start in range(0, whole, window):
                        number, windows.made = windows.made, windows.made + 1
                        emit(number, [(key, start, window)], False)
                    for number, pieces in windows.place(key, whole, len(ids) - whole):
                        emit(number, pieces, False)
                    key += 1
                if rows:
                    yield batch_of()
        for number, pieces in list(windows.pieces.items()):
            emit(number, pieces, True)
        if rows:
            yield batch_of()

    return run


def _merge(window: int):
    """The pieces of one lot's open windows, largest first, each into the fullest merged window with room."""

    def run(batches):
        base = 1 << 62 | TaskContext.get().partitionId() << 32
        batches = list(batches)
        table = pa.Table.from_batches(batches) if batches else None
        if table is None or not table.num_rows:
            return
        ids, offset, length = (table.column(c).to_numpy() for c in ("sequence_id", "offset", "length"))
        free: list[tuple[int, int]] = []  # (free tokens, number)
        made = 0
        new_id, new_offset = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
        for row in np.lexsort((offset, ids, -length)).tolist():
            size = int(length[row])
            at = bisect.bisect_left(free, (size, -1))
            if at < len(free):
                room, number = free.pop(at)
            else:
                room, number, made = window, made, made + 1
            new_id[row], new_offset[row] = base | number, window - room
            bisect.insort(free, (room - size, number))
        for name, values in (("sequence_id", new_id), ("offset", new_offset)):
            table = table.set_column(table.schema.get_field_index(name), name, pa.array(values))
        yield from table.combine_chunks().to_batches()

    return run


def pack(docs: DataFrame, window: int = WINDOW, open_windows: int = 32, least_cut: int = 16, with_ids: bool = False, paths: tuple[str, str | None] | None = None) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked.

    ``paths``: of the tokenizer's JSON file and of its rank file or None.
    """
    work = Workspace(docs.sparkSession, "packing")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {COLUMNS}" + ", ids array<int>" * with_ids
    pieces = work.keep(docs.select("doc_id", "text").mapInArrow(_pack(paths or tokenizer_paths(), window, open_windows, least_cut, with_ids), schema), "pieces")
    left = pieces.where("is_open")
    lots = max(1, -(-left.select("sequence_id").distinct().count() // LOT))
    merged = left.repartitionById(lots, F.pmod(F.xxhash64("sequence_id"), F.lit(lots)).cast("int")).mapInArrow(_merge(window), schema)
    return pieces.where("not is_open").union(merged).drop("is_open")
