"""GIFs and archives of other makers, and broken ones."""

import gzip
import struct

import numpy as np
import pytest

from wordmill.llm import gif, warc


def plain_lzw(stream, depth):
    """A second decoder, code by code with a table of byte strings."""
    clear, out = 1 << depth, []
    bits, have, at, width, table, last = 0, 0, 0, depth + 1, None, None
    while True:
        while have < width:
            bits |= stream[at] << have
            have, at = have + 8, at + 1
        code, bits, have = bits & ((1 << width) - 1), bits >> width, have - width
        if code == clear:
            table, width, last = [bytes((i,)) for i in range(clear)] + [b"", b""], depth + 1, None
        elif code == clear + 1:
            return b"".join(out)
        else:
            text = table[code] if code < len(table) else last + last[:1]
            out.append(text)
            if last is not None and len(table) < 4096:
                table.append(last + text[:1])
            if len(table) == 1 << width and width < 12:
                width += 1
            last = text


@pytest.mark.parametrize("depth", [2, 4, 8])
def test_streams_against_a_second_decoder(depth):
    r = np.random.default_rng(depth)
    for size in (0, 1, 50, 5000, 60_000):
        samples = r.integers(0, 1 << depth, size).astype(np.uint8)
        samples[size // 3 : size // 2] = 1
        stream = gif.lzw_encode(samples.tobytes(), depth)
        assert plain_lzw(stream, depth) == samples.tobytes() == gif.lzw_decode(stream, depth)


def broken_gifs():
    good = gif.from_bytes(gif.pad(b"hello world" * 500))
    at = good.index(b"\x2c", 780) + 10
    return {
        "whole": good,
        "cut": good[:1200],
        "code size": good[:at] + b"\x0c" + good[at + 1 :],
        "huge": b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0) + b"\x3b",
        "empty": b"",
        "junk": b"junk" * 10,
        "null": None,
    }


def test_broken_gifs_are_rows_with_an_error(spark):
    cases = broken_gifs()
    media = spark.createDataFrame([(k, v, 1) for k, v in cases.items()], "doc_id string, gif binary, n_bytes long")
    shown = {}
    for r in gif.frames(media).collect():
        shown.setdefault(r["doc_id"], []).append(r["error"])
    assert shown.pop("whole") == [None] and "null" not in shown
    assert set(shown) == set(cases) - {"whole", "null"} and all(e[-1] for e in shown.values())
    told = {r["doc_id"]: r for r in gif.digests(media).collect()}
    assert told["whole"]["payload_bytes"] == len(gif.pad(b"hello world" * 500))
    assert told["null"]["payload_bytes"] is None and told["null"]["feature"] is None
    for name in set(cases) - {"whole", "null"}:
        assert told[name]["payload_sha256"] is None and told[name]["feature"].startswith("error=")


def test_more_samples_than_a_frame_has():
    flat = gif.lzw_encode(b"\1" * 200_000, 8)
    with pytest.raises(ValueError, match="more samples"):
        gif.lzw_decode(flat, 8, 1000)


def test_long_animations_leave_in_batches(spark):
    cube = gif.colour_cube()
    stored = [gif.Frame(np.full((64, 64), k, np.uint8), 0, 0, cube, k + 1, 0) for k in range(100)]
    media = spark.createDataFrame([(1, gif.encode(256, 128, cube, stored))], "doc_id long, gif binary")
    rows = gif.frames(media).orderBy("frame").collect()
    assert [r["frame"] for r in rows] == list(range(100))
    assert [r["start_ms"] for r in rows] == np.cumsum([0, *[10 * (k + 1) for k in range(99)]]).tolist()


def record(kind, name, body, more=b""):
    head = b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <urn:uuid:" + name + b">\r\n" + more
    return head + b"Content-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def test_archives_of_other_makers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nX-Long: " + b"y" * 70_000 + b"\r\n\r\n"
    made = [
        record(b"warcinfo", b"a1", b"software: x\r\n"),
        record(b"response", b"a2", http + b"body text", b"Content-Type: application/http; msgtype=response\r\nWARC-Target-URI: http://x/\xff\r\n"),
        record(b"revisit", b"a3", http, b"Content-Type: application/http\r\nWARC-Refers-To: <urn:uuid:a2>\r\nWARC-Payload-Digest: sha1:ABC\r\n"),
    ]
    zipped = b"".join(gzip.compress(m) for m in made)
    files = {"a.warc.gz": zipped, "b.warc": b"".join(made), "cut.warc.gz": zipped[:-30], "cut.warc": b"".join(made)[:-40], "junk.warc": b"nonsense", "empty.warc": b""}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)

    def read(*names):
        return warc.read_chunks(spark.createDataFrame([(str(tmp_path / n),) for n in names], "path string")).collect()

    for name in ("a.warc.gz", "b.warc"):
        rows = read(name)
        assert [(r["record_id"], r["record_type"], r["refers_to"], r["payload_end"]) for r in rows] == [("urn:uuid:a1", "warcinfo", None, 13), ("urn:uuid:a2", "response", None, 9), ("urn:uuid:a3", "revisit", "urn:uuid:a2", None)]
        assert bytes(rows[1]["data"]) == b"body text" and rows[2]["digest"] == "ABC" and all(r["error"] is None for r in rows)
    for name in ("cut.warc.gz", "cut.warc"):
        rows = read(name)
        assert [r["record_type"] for r in rows][:2] == ["warcinfo", "response"] and rows[-1]["record_type"] == "error" and rows[-1]["error"]
    assert [r["record_type"] for r in read("junk.warc")] == ["error"] and read("empty.warc") == []
    assert sorted(r["record_type"] for r in read("junk.warc", "a.warc.gz")) == ["error", "response", "revisit", "warcinfo"]
