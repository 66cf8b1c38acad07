"""GIF media columns: a GIF89a reader and writer, and tables of timed frames with colour histograms.

The reader decodes LZW code streams of any depth (also with late clear codes), interlaced rows, local palettes, the
disposal rules and transparency. Code widths depend only on the number of codes since the last clear code, so all
codes of a run are taken from the bit stream at once.

Defined results: a null text counts as empty and a null GIF has no frames and null digests. A truncated or broken file,
code sizes that the format doesn't have, samples beyond a frame and pictures of more than ``MOST_PIXELS`` raise ``ValueError``
in :func:`decode`; :func:`frames` gives such a file a last entry with its ``error``, :func:`digests` null digests and the error
as feature. Frames are decoded one by one and leave a task in small batches, so a long animation, or a very long text, needs
its stored bytes, a frame and the canvas. Equal texts give equal rows, repeated rows each their own; empty tables give empty
ones. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytewords as bw

#: Columns of a picture made of bytes, and most rows of a frame.
WIDTH, ROWS = 192, 256
DELAY_CS = 10
UNIT = 192
#: Largest canvas or frame that is decoded; headers can claim 4 billion pixels.
MOST_PIXELS = 1 << 26
#: What a broken file may raise.
BROKEN = (ValueError, IndexError, KeyError, OverflowError, struct.error)


def colour_cube() -> np.ndarray:
    """256 colours, 8 levels of red and green by 4 of blue; each index has its own colour."""
    i = np.arange(256)
    return np.stack([(i >> 5) * 255 // 7, (i >> 2 & 7) * 255 // 7, (i & 3) * 255 // 3], axis=1).astype(np.uint8)


# ---------------------------------------------------------------- code streams


def _widths(depth: int) -> np.ndarray:
    """Bits of the i-th code after a clear code."""
    i = np.arange(4096 - (1 << depth) - 1)
    return np.maximum(depth + 1, np.ceil(np.log2((1 << depth) + 2 + i))).astype(np.int64)


_RUN = {d: (w := _widths(d), np.concatenate([[0], np.cumsum(w)])) for d in range(2, 9)}


def lzw_encode(samples: bytes, depth: int = 8) -> bytes:
    """Once its table is full an encoder may go on with it; that is done here, as frames are small."""
    clear = 1 << depth
    codes = [clear]
    put = codes.append
    table: dict[int, int] = {}
    get = table.get
    free = clear + 2
    if samples:
        it = iter(samples)
        prefix = next(it)
        for b in it:
            key = prefix << 8 | b
            code = get(key)
            if code is not None:
                prefix = code
            else:
                put(prefix)
                prefix = b
                table[key] = free
                free += 1
                if free == 4096:
                    break
        for b in it:
            code = get(prefix << 8 | b)
            if code is not None:
                prefix = code
            else:
                put(prefix)
                prefix = b
        put(prefix)
    put(clear + 1)
    values = np.array(codes, dtype=np.int64)
    width = np.empty(len(values), np.int64)
    width[:] = 12
    width[0] = depth + 1
    each = _RUN[depth][0]
    width[1 : len(each) + 1] = each[: len(values) - 1]
    at = np.concatenate([[0], np.cumsum(width)])
    size = int(at[-1] + 7 >> 3)
    at = at[:-1]
    shifted = values << (at & 7)
    byte = at >> 3
    out = np.zeros(size + 3)
    for k in range(3):
        out += np.bincount(byte + k, weights=shifted >> 8 * k & 255, minlength=size + 3)[: size + 3]
    return out[:size].astype(np.uint8).tobytes()


def _expand(codes: np.ndarray, clear: int, most: int) -> np.ndarray:
    """Samples of the codes of one run. The table's entry j is the text of code j and one sample more, so each entry
    is a piece of the output that starts where code j's text starts, and each sample is a literal or has a place
    further left that it equals; following those places doubles its reach each time."""
    n = len(codes)
    literal = codes < clear
    entry = codes - clear - 2
    if (entry >= np.arange(n)).any() or ((entry < 0) & ~literal).any():
        raise ValueError("code beyond the table")
    up = np.append(np.where(literal, n, entry), n)
    length = np.append((~literal).astype(np.int64), 0)
    while (up[:n] != n).any():
        length += length[up]
        up = up[up]
    length = length[:n] + 1
    begin = np.cumsum(length) - length
    size = int(begin[-1] + length[-1])
    if size > most:
        raise ValueError("more samples than the frame has")
    owner = np.repeat(np.arange(n), length)
    place = np.arange(size)
    source = np.where(literal[owner], place, begin[np.where(literal, 0, entry)][owner] + place - begin[owner])
    while True:
        further = source[source]
        if (further == source).all():
            return codes[owner[source]].astype(np.uint8)
        source = further


def lzw_decode(stream: bytes, depth: int, most: int = MOST_PIXELS) -> bytes:
    """The samples of a code stream, ``most`` at most."""
    if depth not in _RUN:
        raise ValueError(f"code size {depth}")
    clear, end = 1 << depth, (1 << depth) + 1
    bits = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int64)
    total = 8 * len(stream)
    widths, ahead = _RUN[depth]
    out: list[bytes] = []
    run: list[np.ndarray] = []
    at = 0
    while True:
        if run:  # the table is full and no clear code came: codes stay 12 bits wide
            n = min(4096, (total - at) // 12)
            offset, width = at + 12 * np.arange(n), np.full(n, 12)
        else:
            n = min(int(np.searchsorted(ahead, total - at, "right")) - 1, len(widths))
            offset, width = at + ahead[:n], widths[:n]
        if n <= 0:
            raise ValueError("code stream ends early")
        byte = offset >> 3
        got = (bits[byte] | bits[byte + 1] << 8 | bits[byte + 2] << 16) >> (offset & 7) & ((1 << width) - 1)
        stops = np.flatnonzero((got == clear) | (got == end))
        k = int(stops[0]) if len(stops) else n
        run.append(got[:k])
        if not len(stops):
            at = int(offset[-1] + width[-1])
            continue
        codes = np.concatenate(run)
        if len(codes):
            out.append(_expand(codes, clear, most).tobytes())
            most -= len(out[-1])
        at, run = int(offset[k] + width[k]), []
        if got[k] == end:
            return b"".join(out)


# ---------------------------------------------------------------- files


@dataclass
class Frame:
    samples: np.ndarray  # height x width palette indices
    left: int
    top: int
    palette: np.ndarray
    delay_cs: int = 0
    disposal: int = 0
    transparent: int | None = None


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes((len(p := data[i : i + 255]),)) + p for i in range(0, len(data), 255)) + b"\0"


def encode(width: int, height: int, palette: np.ndarray, frames: list[Frame]) -> bytes:
    """A GIF89a with a global palette of 2**n colours and a frame for each of ``frames``."""
    depth = max(1, (len(palette) - 1).bit_length())
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0x80 | 0x70 | depth - 1, 0, 0), np.asarray(palette, np.uint8).tobytes()]
    for f in frames:
        h, w = f.samples.shape
        out.append(b"\x21\xf9\x04" + struct.pack("<BHBB", f.disposal << 2 | (f.transparent is not None), f.delay_cs, f.transparent or 0, 0))
        out.append(b"\x2c" + struct.pack("<HHHHB", f.left, f.top, w, h, 0) + bytes((max(2, depth),)))
        out.append(_blocks(lzw_encode(f.samples.tobytes(), max(2, depth))))
    return b"".join(out) + b"\x3b"


def decode(data: bytes) -> tuple[int, int, Iterator[Frame]]:
    """Width and height of the canvas, and the frames as they are stored."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("no GIF")
    width, height, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    if width * height > MOST_PIXELS:
        raise ValueError(f"canvas of {width} x {height}")
    at = 13
    shared = None
    if flags & 0x80:
        n = 2 << (flags & 7)
        shared = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n

    def parts(at: int) -> tuple[bytes, int]:
        out = []
        while n := data[at]:
            out.append(data[at + 1 : at + 1 + n])
            at += 1 + n
        return b"".join(out), at + 1

    def read(at: int) -> Iterator[Frame]:
        delay, disposal, clear = 0, 0, None
        while True:
            if at >= len(data):
                raise ValueError("file ends early")
            kind = data[at]
            if kind == 0x3B:
                return
            if kind == 0x21:
                body, then = parts(at + 2)
                if data[at + 1] == 0xF9:
                    bits, delay, index = struct.unpack_from("<BHB", body)
                    disposal, clear = bits >> 2 & 7, index if bits & 1 else None
                at = then
            elif kind == 0x2C:
                left, top, w, h, bits = struct.unpack_from("<HHHHB", data, at + 1)
                at += 10
                palette = shared
                if bits & 0x80:
                    n = 2 << (bits & 7)
                    palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
                    at += 3 * n
                if palette is None:
                    raise ValueError("no palette")
                if w * h > MOST_PIXELS:
                    raise ValueError(f"frame of {w} x {h}")
                depth = data[at]
                body, at = parts(at + 1)
                # encoders may send some samples too many
                flat = np.frombuffer(lzw_decode(body, depth, w * h + (1 << 16)), np.uint8)
                if len(flat) < w * h:
                    raise ValueError("too few samples")
                samples = flat[: w * h].reshape(h, w)
                if bits & 0x40:  # interlaced: rows come in four passes
                    order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
                    samples = samples[np.argsort(order)]
                yield Frame(samples, left, top, palette, delay, disposal, clear)
                delay, disposal, clear = 0, 0, None
            else:
                raise ValueError(f"unknown block {kind:#x}")

    return width, height, read(at)


def compose(width: int, height: int, stored: Iterator[Frame]) -> Iterator[tuple[Frame, np.ndarray]]:
    """Each stored frame with the canvas (RGBA) that is shown at its time."""
    canvas = np.zeros((height, width, 4), np.uint8)
    for f in stored:
        h, w = f.samples.shape
        before = canvas.copy() if f.disposal == 3 else None
        spot = canvas[f.top : f.top + h, f.left : f.left + w]
        seen = f.samples[: spot.shape[0], : spot.shape[1]]
        colours = np.zeros((256, 4), np.uint8)
        colours[: len(f.palette), :3] = f.palette
        colours[:, 3] = 255
        if f.transparent is None:
            spot[:] = colours[seen]
        else:
            shown = seen != f.transparent
            spot[shown] = colours[seen[shown]]
        yield f, canvas
        if f.disposal == 2:
            spot[:] = 0
        elif f.disposal == 3:
            canvas = before


def histogram(canvas: np.ndarray) -> np.ndarray:
    """64 bins, two bits a channel, over the pixels that aren't transparent."""
    flat = canvas.reshape(-1, 4)
    bins = (flat[:, 0] >> 6).astype(np.uint8) << 4 | flat[:, 1] >> 6 << 2 | flat[:, 2] >> 6
    return np.bincount(bins[flat[:, 3] == 255], minlength=64)


# ---------------------------------------------------------------- bytes as pictures


def pad(raw: bytes) -> bytes:
    return raw + b" " * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def from_bytes(payload: bytes) -> bytes:
    """A picture whose samples are the payload, row after row and frame after frame."""
    flat = np.frombuffer(payload, np.uint8)
    step = WIDTH * ROWS
    cut = [flat[i : i + step].reshape(-1, WIDTH) for i in range(0, len(flat), step)]
    palette = colour_cube()
    return encode(WIDTH, max(len(c) for c in cut), palette, [Frame(c, 0, 0, palette, DELAY_CS, 2) for c in cut])


def _store(batches):
    for batch in batches:
        for part in bw.slices(batch, "text", 1 << 22):
            data, offsets = bw.text_buffers(part.column("text"))
            raw = data.tobytes()
            media = [from_bytes(pad(raw[a:b])) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "gif"])


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, gif: each text of ``docs`` (doc_id, text) as a GIF."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_store, f"doc_id {kind}, n_bytes long, gif binary")


_FRAME_NAMES = ("frame", "start_ms", "duration_ms", "width", "height", "disposal", "rgba", "histogram", "error")
_FRAME_TYPES = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.string())


def _frames(key: str):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                data, value = batch.column("gif")[k].as_py(), batch.column(key)[k].as_py()

                def some(rows, value=value, batch=batch):
                    columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate(_FRAME_TYPES)]
                    return pa.RecordBatch.from_arrays([pa.array([value] * len(rows), batch.column(key).type), *columns], [key, *_FRAME_NAMES])

                rows, start, n, held = [], 0, 0, 0
                try:
                    for f, canvas in compose(*decode(data)) if data is not None else ():
                        rows.append((n, start, 10 * f.delay_cs, *f.samples.shape[::-1], f.disposal, canvas.tobytes(), histogram(canvas).tolist(), None))
                        start, n, held = start + 10 * f.delay_cs, n + 1, held + canvas.size
                        if held > 1 << 22:
                            yield some(rows)
                            rows, held = [], 0
                except BROKEN as e:
                    rows.append((n, start, None, None, None, None, None, None, str(e) or "broken"))
                if rows:
                    yield some(rows)

    return run


def frames(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each frame of each GIF of ``media`` (key, gif): its time, the canvas shown and the histogram."""
    kind = media.schema[key].dataType.simpleString()
    return media.select(key, "gif").mapInArrow(_frames(key), f"{key} {kind}, frame int, start_ms long, duration_ms int, width int, height int, disposal int, rgba binary, histogram array<long>, error string")


def _digest(batches):
    for batch in batches:
        rows = []
        for n, stored in zip(batch.column("n_bytes").to_pylist(), batch.column("gif")):
            data = stored.as_py()
            if data is None:
                rows.append((n, *[None] * 6))
                continue
            file = (len(data), hashlib.sha256(data).hexdigest())
            payload, shown, size, tail, count, ms = hashlib.sha256(), np.zeros(64, np.int64), 0, b"", 0, 0
            try:
                for f, canvas in compose(*decode(data)):
                    samples = f.samples.tobytes()
                    payload.update(samples)
                    size, tail = size + len(samples), (tail + samples[-16:])[-16:]
                    shown += histogram(canvas)
                    count, ms = count + 1, ms + 10 * f.delay_cs
            except BROKEN as e:
                rows.append((n, None, None, None, *file, f"error={str(e) or 'broken'}"))
                continue
            feature = f"frames={count};ms={ms};hist=" + ",".join(map(str, shown.tolist()))
            rows.append((n, size, payload.hexdigest(), zlib.crc32(tail), *file, feature))
        names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array([r[c] for r in rows], t) for c, t in enumerate(types)]], ["doc_id", *names])


def digests(stored: DataFrame) -> DataFrame:
    """What reading a table of :func:`store_texts` back gives: digests of samples and file, frame times, histogram."""
    kind = stored.schema["doc_id"].dataType.simpleString()
    return stored.select("doc_id", "n_bytes", "gif").mapInArrow(_digest, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
