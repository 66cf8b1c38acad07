"""Token ids in files, compressed by a grammar (Re-Pair) that can be read from any place.

Documents are sorted by doc_id over ranges and cut into shards of about ``SHARD_TOKENS`` ids, whole documents each. Per shard,
frequent pairs of neighbouring ids are replaced by new symbols, again and again: each round counts all pairs and replaces those that are
at least an eighth as frequent as the most frequent one. Where two of them overlap the more frequent one goes first, and in a row of
equal ids every second place. A pair never spans two documents, so a document is a run of symbols of its own. Rounds end when no
pair occurs ``LEAST`` times, when a round gains less than ``LEAST_GAIN``, or when the symbols are used up that their width (two bytes, four for
large vocabularies) leaves.

A file holds a header, an index (doc_id, first symbol, first token and number of tokens of each document) as an Arrow stream, the
rules, the number of ids that each one stands for, and the symbols. :class:`Shard` maps it: ids from any place of a document are found by the
lengths of its symbols, and only those that hold them are expanded.

Ids are those of the tokenizer's library for the whole text. Words of ``[^\\x20\\x09-\\x0D]+`` are encoded each by itself and known ones are
looked up; that gives the same ids only with a tokenizer that treats words apart, which is why :class:`Encoder` takes no other one. One that
lower-cases and tells letters from marks gets words of ASCII and letters up to U+00FF in lower case and without the marks after them, which
leaves fewer of them.

Defined results: a null or empty text has one token, the end id. Documents of the same doc_id (null first) follow each other by a hash of their
text, equal rows in any order. A very long text lies in one shard, which is as large as it has to be; the task that writes or reads it holds some
50 bytes a token. Other columns are ignored. An empty table gives no files and an empty result. Files are written whole under their name,
so a task that runs again replaces what it wrote.
"""

from __future__ import annotations

import functools
import io
import json
import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw
from .shared import Workspace, mapped, write_file

END_ID = 2
SHARD_TOKENS = 1 << 20
#: Least occurrences of a pair that is replaced.
LEAST = 8
#: Pairs go in one round that occur at least this part as often as the most frequent one.
SPAN = 8
#: Rounds end with one that makes the sequence shorter by less than this part.
LEAST_GAIN = 1 / 256
_SPREAD = 0x9E3779B97F4A7C15
#: Bytes of the words whose ids a worker keeps, in each of two generations.
_KEPT = 1 << 27
MAGIC = b"RPG1"
_HEAD = struct.Struct("<4sBxxxIQQQ")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: What a tokenizer does before its model, for which words of ASCII may be taken apart by :func:`_pieces`.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_IS_LETTER, _IS_OTHER = np.zeros(256, bool), np.zeros(256, bool)
_IS_LETTER[97:123] = _IS_LETTER[0x80:] = True
_IS_OTHER[[*b"0123456789'"]] = True
#: Letters in lower case up to U+00FF, of which none is composed with another, and the characters that
#: stand for their bytes in the vocabulary where these aren't the bytes' own.
_LETTERS = re.compile(rb"(?:[a-z]|\xC3[\x9F-\xB6\xB8-\xBF])+")
_CHARACTERS = [(chr(b), chr(256 + i)) for i, b in enumerate([*range(33), *range(127, 161), 173]) if b in (0x9F, 0xA0, 0xAD)]
#: Words of letters alone that go to the tokenizer as one text, and bytes of text whose words are told apart at once.
_JOINED, _SLICE = 512, 1 << 20


def _takes_apart(told: dict) -> bool:
    normalizer, splits = told.get("normalizer") or {}, told.get("pre_tokenizer") or {}
    split, *rest = splits.get("pretokenizers") or [{}]
    as_bytes = len(rest) == 1 and rest[0].get("type") == "ByteLevel" and not rest[0]["add_prefix_space"] and not rest[0]["use_regex"]
    return as_bytes and normalizer.get("normalizers") == _NORMALIZER and split.get("type") == "Split" and split.get("pattern") == {"Regex": _PATTERN}


def _pieces(words: bw.Words, apart: bool) -> tuple[pa.Array, np.ndarray]:
    """Pieces of words that are encoded by themselves, in order, and where each text ends in them. With ``apart`` a word of ASCII and of
    letters up to U+00FF is in lower case, and letters followed by marks alone are two pieces, as the tokenizer has them; all other words are
    pieces as they are."""
    sizes = words.ends - words.starts
    solid = words.data[~bw.IS_SPACE[words.data]]
    starts, ends = np.concatenate([[0], np.cumsum(sizes)]), words.first[1:]
    if apart and len(sizes):

        def inside(which: np.ndarray) -> np.ndarray:
            """How many of a word's bytes."""
            before = np.zeros(len(solid) + 1, np.int32)
            np.cumsum(which, out=before[1:])
            return np.diff(before[starts])

        lead = np.flatnonzero(solid == 0xC3)
        lead = lead[lead + 1 < len(solid)]
        lead = lead[(solid[lead + 1] != 0x97) & (solid[lead + 1] != 0xB7)]
        wide = solid >= 0x80
        wide[lead] = wide[lead + 1] = False  # bytes of other characters are left
        plain = inside(wide) == 0
        upper = lead[solid[lead + 1] < 0x9F] + 1
        low = bw.TO_LOWER[solid]
        low[upper] += 32
        solid = np.where(np.repeat(plain, sizes), low, solid)
        is_letter = _IS_LETTER[solid]
        later = is_letter.copy()  # letters after something else in a word
        later[1:] &= ~is_letter[:-1]
        later[starts[:-1]] = False
        n = inside(is_letter)
        cut = plain & (n > 0) & (n < sizes) & is_letter[starts[:-1]] & (inside(later) == 0) & (inside(_IS_OTHER[solid]) == 0)
        ends = ends + np.concatenate([[0], np.cumsum(cut)])[ends]
        starts = np.sort(np.concatenate([starts, (starts[:-1] + n)[cut]]))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(solid))]), ends


class Encoder:
    """Texts to ids, piece by piece; ids of pieces are kept."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        text = json.dumps([told.get("normalizer"), told.get("pre_tokenizer"), [t for t in told.get("added_tokens", []) if any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) or t["content"].split() != [t["content"]]]])
        removes = '"behavior": "Removed", "invert": true' in text and "\\\\s" in text
        if not removes or '"add_prefix_space": true' in text or '"content": "<' in text or any(k in text for k in ("Prepend", "Strip", "Metaspace")):
            raise ValueError(f"{path}: words aren't told apart by white space that is dropped")
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # an added token is found in a word before all else, so none may be in a word that is taken apart or in lower case
        self.added = [t["content"].encode() for t in told.get("added_tokens", [])]
        self.apart = _takes_apart(told) and all(not t.isalpha() for t in self.added)
        if self.apart:  # letters in lower case pass all that comes before the model as they are, but for the characters that stand for their bytes
            self.letters = Tokenizer.from_file(path)
            self.letters.normalizer, self.letters.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        # ids of pieces as bytes; pieces that are still in use go on to the next generation
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def _encode(self, pieces: list[bytes]):
        """Each piece and its ids."""
        if self.apart:
            fits = _LETTERS.fullmatch
            letters, others = [], []
            for w in pieces:
                (letters if fits(w) else others).append(w)
            pieces = others
            for i in range(0, len(letters), _JOINED):
                run = letters[i : i + _JOINED]
                text = b" ".join(run).decode("latin-1")
                for byte, character in _CHARACTERS:
                    text = text.replace(byte, character)
                e = self.letters.encode(text, add_special_tokens=False)
                raw, ends = np.array(e.ids, "<u4").tobytes(), (4 * np.cumsum(np.bincount(e.word_ids, minlength=len(run)))).tolist()
                yield from zip(run, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)))
        yield from zip(pieces, (array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast([w.decode() for w in pieces], add_special_tokens=False)))

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        if self.held > _KEPT:
            self.known, self.older, self.held = {}, self.known, 0
        known, older = self.known, self.older
        missing = [w for w in pieces if w not in known]
        known.update(self._encode([w for w in missing if w not in older]))
        known.update((w, older[w]) for w in missing if w in older)
        self.held += sum(map(len, missing)) + 170 * len(missing)
        return [known[w] for w in pieces]

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, with ``end_id`` after each if there is one, and where each text ends in them."""
        words = bw.split_words(*bw.text_buffers(texts))
        lower = words.data.tobytes().lower()
        apart = self.apart and not any(t.lower() in lower for t in self.added)
        pieces, ends = _pieces(words, apart)
        found = pieces.dictionary_encode()
        ids = self._ids(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        which = found.indices.to_numpy()
        if end_id is not None:
            which = np.insert(which, ends, len(ids))
            ends = ends + np.arange(1, len(ends) + 1)
            ids.append(np.array([end_id], "<u4").tobytes())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        n = sizes[which]
        to = np.concatenate([[0], np.cumsum(n)])
        kind = np.int32 if max(to[-1], sizes.sum()) < 1 << 31 else np.int64  # half the bytes where they do
        place = (np.cumsum(sizes, dtype=kind) - sizes)[which] - to[:-1].astype(kind)
        place = np.repeat(place, n)
        place += np.arange(len(place), dtype=kind)
        return np.frombuffer(b"".join(ids), "<u4")[place], to[ends]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        flat, ends = self.encode(pa.array(texts, pa.large_string()))
        return np.split(flat, ends[:-1])


@functools.lru_cache(1)
def encoder(path: str) -> Encoder:
    """The worker's encoder, which its tasks share with the ids that it keeps."""
    return Encoder(path)


# ------------------------------------------------------------ grammar


def _counted(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys that occur ``least`` times or more, and how often."""
    keys = np.sort(keys)
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    counts = np.diff(edges)
    often = counts >= least
    return keys[edges[:-1]][often], counts[often]


def compress(tokens: np.ndarray, ends: np.ndarray, base: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """symbols, where each document ends in them, and rules (n rows: left, right) of documents that end at ``ends`` in
    ``tokens``, which are below ``base``. Symbol ``base`` + k stands for rule k."""
    wide = base >= 1 << 16
    kind, key, shift = (np.uint32, np.uint64, 32) if wide else (np.uint16, np.uint32, 16)
    room = (1 << 32 if wide else 1 << 16) - base
    seq = tokens.astype(kind)
    last = np.zeros(len(seq), bool)
    last[ends - 1] = True
    rules: list[np.ndarray] = []
    slots = 16 if wide else 18

    def slot_of(pairs: np.ndarray) -> np.ndarray:
        return ((pairs * key(_SPREAD & ((1 << 2 * shift) - 1))) >> key(2 * shift - slots)).astype(np.int32)

    while room and len(seq) > 1:
        pair = seq[:-1].astype(key) << key(shift) | seq[1:]
        keys, counts = _counted(pair[~last[:-1]], least)
        if not len(keys):
            break
        # from the most frequent down; of pairs that are as frequent the smaller one first
        often = counts >= max(least, int(counts.max()) // SPAN)
        chosen = keys[often][np.lexsort((keys[often], -counts[often]))]
        chosen = chosen[np.sort(np.unique(slot_of(chosen), return_index=True)[1])][:room]  # of two in a slot one waits for the next round
        ranks = np.full(1 << slots, -1, np.int32)
        ranks[slot_of(chosen)] = np.arange(len(chosen))
        number = ranks[slot_of(pair)]
        at = np.flatnonzero((number >= 0) & ~last[:-1])
        at = at[chosen[number[at]] == pair[at]]
        number = number[at]
        # neighbours overlap: the better rank goes, in a row of one pair every second place
        same = np.concatenate([[False], (at[1:] == at[:-1] + 1) & (number[1:] == number[:-1])])
        place = np.arange(len(at))
        weight = 2 * number + ((place - np.maximum.accumulate(np.where(same, 0, place))) & 1)
        beats = np.ones(len(at), bool)
        touching = at[1:] == at[:-1] + 1
        beats[1:] &= ~touching | (weight[1:] < weight[:-1])
        beats[:-1] &= ~touching | (weight[:-1] < weight[1:])
        at, number = at[beats], number[beats]
        seq[at] = (base + sum(map(len, rules)) + number).astype(kind)
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
        rules.append(np.stack([chosen >> key(shift), chosen & key((1 << shift) - 1)], 1).astype(kind))
        room -= len(chosen)
        if len(at) < LEAST_GAIN * len(seq):
            break
    return seq, np.flatnonzero(last) + 1, np.concatenate(rules) if rules else np.zeros((0, 2), kind)


def lengths_of(rules: np.ndarray, base: int) -> np.ndarray:
    """Number of ids that each rule stands for."""
    out = np.zeros(len(rules), np.int64)
    at = 0
    while at < len(rules):  # a rule's symbols are older than it, so rules up to the first that needs this stretch go together
        newest = rules[at:].max(1).astype(np.int64) - base
        late = np.flatnonzero(newest >= at)
        to = at + int(late[0]) if len(late) else len(rules)
        some = rules[at:to].astype(np.int64)
        parts = np.where(some >= base, out[np.maximum(some - base, 0)], 1)
        out[at:to] = parts.sum(1)
        at = to
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids of symbols."""
    seq = symbols.astype(np.int64)
    while len(at := np.flatnonzero(seq >= base)):
        pairs = rules[seq[at] - base]
        out = np.repeat(seq, np.where(seq >= base, 2, 1))
        first = at + np.arange(len(at))
        out[first], out[first + 1] = pairs[:, 0], pairs[:, 1]
        seq = out
    return seq.astype("<u4")


def shard_bytes(ids: pa.Array, tokens: np.ndarray, n_tokens: np.ndarray, base: int, least: int = LEAST) -> bytes:
    """The file of documents ``ids`` whose tokens follow each other."""
    ends = np.cumsum(n_tokens)
    symbols, symbol_ends, rules = compress(tokens, ends, base, least)
    index = pa.RecordBatch.from_arrays([ids, pa.array(symbol_ends), pa.array(ends)], ["doc_id", "symbols_end", "tokens_end"])
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, index.schema) as out:
        out.write_batch(index)
    told = sink.getvalue()
    told += b"\0" * (-len(told) % 8)
    head = _HEAD.pack(MAGIC, symbols.itemsize, base, len(rules), len(symbols), len(told))
    return b"".join([head, told, lengths_of(rules, base).astype("<u8").tobytes(), rules.tobytes(), symbols.tobytes()])


class Shard:
    """A file of documents, mapped; ``ids`` are their doc_ids, by row."""

    def __init__(self, data):
        magic, width, self.base, n_rules, n_symbols, size = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("no file of grammar-compressed ids")
        kind, at = np.dtype(f"<u{width}"), _HEAD.size + size
        with pa.ipc.open_stream(pa.py_buffer(memoryview(data)[_HEAD.size : at])) as index:
            table = index.read_all()
        self.ids = table.column("doc_id").combine_chunks()
        self.symbol_ends, self.token_ends = (table.column(c).to_numpy() for c in ("symbols_end", "tokens_end"))
        self.lengths = np.frombuffer(data, "<u8", n_rules, at).astype(np.int64)
        self.rules = np.frombuffer(data, kind, 2 * n_rules, at + 8 * n_rules).reshape(-1, 2)
        self.symbols = np.frombuffer(data, kind, n_symbols, at + 8 * n_rules + 2 * n_rules * width)

    def all_tokens(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.base)

    def tokens(self, row: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of a document; only symbols that hold them are expanded."""
        mine = self.symbols[self.symbol_ends[row - 1] if row else 0 : self.symbol_ends[row]].astype(np.int64)
        ends = np.cumsum(np.where(mine < self.base, 1, self.lengths[np.maximum(mine - self.base, 0)] if len(self.lengths) else 1))
        stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
        if start >= stop:
            return np.zeros(0, "<u4")
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        before = int(ends[a - 1]) if a else 0
        return expand(mine[a:b], self.rules, self.base)[start - before : stop - before]


# ------------------------------------------------------------ tables


def _write(folder: str, path: str, end_id: int, shard_tokens: int, least: int):
    def run(batches):
        made = encoder(path)
        base, partition = max(made.size, end_id + 1), TaskContext.get().partitionId()
        ids, tokens, kind, n_files = [], [], None, 0

        def flush():
            n = np.array([len(t) for t in tokens], np.int64)
            name = f"{folder}/{partition:06d}-{n_files:06d}.rpg"
            write_file(name, shard_bytes(pa.array(ids, kind), np.concatenate(tokens), n, base, least))
            row = [(pa.array([v], t)) for v, t in ((name, pa.string()), (partition, pa.int32()), (n_files, pa.int32()), (len(ids), pa.int64()), (int(n.sum()), pa.int64()))]
            return pa.RecordBatch.from_arrays(row, ["path", "part", "number", "documents", "tokens"])

        held = 0
        for batch in batches:
            kind = batch.column("doc_id").type
            for some in bw.slices(batch, "text", _SLICE):
                flat, ends = made.encode(some.column("text"), end_id)
                for doc_id, a, b in zip(some.column("doc_id").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
                    if held and held + b - a > shard_tokens:
                        yield flush()
                        ids, tokens, held, n_files = [], [], 0, n_files + 1
                    ids.append(doc_id)
                    tokens.append(flat[a:b])
                    held += b - a
        if ids:
            yield flush()

    return run


def write_shards(docs: DataFrame, work: Workspace, path: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, least: int = LEAST) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order; returns path, part, number, documents, tokens, and start, the ids
    before, of each file."""
    # rows of one doc_id are told apart by text, equal ones by place, so that ranges can split them
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "text_hash", "row"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    written = ranged.select("doc_id", "text").mapInArrow(_write(f"{work.path}/files", path or tokenizer_path(), end_id, shard_tokens, least), "path string, part int, number int, documents long, tokens long")
    shards = work.keep(written, "written")
    # prefix sums in two levels: one row a partition, then the files of one
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("part_tokens")).select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(parts, "part")
    return work.keep(placed.select(*shards.columns, (F.col("part_start") + F.col("inside")).alias("start")), "shards")


def _read(batches):
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            shard = Shard(mapped(path))
            tokens = shard.all_tokens()
            ends = shard.token_ends
            starts = np.concatenate([[0], ends[:-1]])
            if len(tokens) != ends[-1]:
                raise ValueError(f"{path}: {len(tokens)} ids, not {ends[-1]}")
            crc = [zlib.crc32(tokens[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([shard.ids, pa.array(start + starts), pa.array(ends - starts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(shards: DataFrame, doc_id_type: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in the files (path, start)."""
    # files hold about as many ids each; four a task
    tasks = max(1, -(-shards.count() // 4))
    return shards.select("path", "start").repartition(tasks, "path").mapInArrow(_read, f"doc_id {doc_id_type}, start long, n_tokens long, ids_crc32 long")
