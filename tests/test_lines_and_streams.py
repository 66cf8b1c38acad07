"""Exact line numbers of large files read by many tasks, and streams that give what a batch gives."""

import gzip
import json
import random
import time
import zlib

import pytest

from wordmill.operators import snapshot
from wordmill.sources import entries, inflate, lines
from wordmill.streaming import ingest as streaming


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(3000)]
    out = []
    for i in range(30_000):
        out.append(" ".join(rng.choices(words, k=rng.randint(0, 14))) + f" é{i}" + rng.choice(["\n", "\n", "\r\n", "\r", "\n\n"]))
    return "".join(out).encode()


def deflated(data, level, strategy=zlib.Z_DEFAULT_STRATEGY, flush=0):
    c = zlib.compressobj(level, zlib.DEFLATED, 31, 9, strategy)
    if not flush:
        return c.compress(data) + c.flush()
    return b"".join(c.compress(data[i : i + flush]) + c.flush(zlib.Z_FULL_FLUSH) for i in range(0, len(data), flush)) + c.flush()


@pytest.mark.parametrize(("level", "strategy", "flush"), [(1, 0, 0), (6, 0, 0), (9, 0, 0), (6, zlib.Z_HUFFMAN_ONLY, 0), (6, zlib.Z_RLE, 0), (6, 0, 50_000), (3, 0, 999)])
def test_stretches_of_one_member(prose, level, strategy, flush):
    packed = deflated(prose, level, strategy, flush)
    read = lambda at, n: packed[at : at + n]
    step = 60_000
    starts = [8 * inflate.header_end(packed[:50])]
    starts += [s for i in range(step, len(packed), step) if (s := inflate.find_block(read, i, min(i + step, len(packed)), len(packed))) is not None]
    assert len(starts) > 4 and (flush or len({s % 8 for s in starts}) > 1)
    window, out, parts = inflate.NOTHING, b"", []
    rows = [{"gzipped": True, "start_bit": a, "end_bit": b} for a, b in zip(starts, [*starts[1:], 8 * len(packed)])]
    for r in rows:
        assert (window[1] < 0).all()
        own, ends = b"", None
        for piece in lines._pieces(read, r | {"window": window[0].tobytes()}):
            if isinstance(piece, bytes):
                own += piece
            else:
                ends = piece
        parts.append([(zlib.crc32(own), len(own), ends and ends.crc, ends and ends.size)])
        out += own
        window = inflate.composed(window, inflate.last_window(read, r["start_bit"], r["end_bit"]))
    assert out == prose and inflate.check_members(parts)
    wrong = [[(p[0][0] ^ (i == 1), *p[0][1:])] for i, p in enumerate(parts)]
    assert not inflate.check_members(wrong) and not inflate.check_members(parts[:-1])


def test_decoders_arrive_at_any_bit():
    for bit in range(8):
        out = inflate.lead_in(bit, 0xFF)
        decoder = zlib.decompressobj(-15)
        assert decoder.decompress(out[:-1] + bytes([out[-1] & (1 << bit) - 1 if bit else 0])) == b"" and not decoder.eof


def test_combined_checksums():
    rng = random.Random(1)
    for n in (0, 1, 7, 1000):
        a, b = rng.randbytes(50), rng.randbytes(n)
        assert inflate.combined_crc(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


@pytest.fixture(scope="module")
def folder(prose, tmp_path_factory):
    """Files whose sizes don't follow their names: plain, gzipped in one member and in several, empty, without a last line end."""
    at = tmp_path_factory.mktemp("lines")
    third = len(prose) // 3
    raw = {"a.txt": b"small\nfile", "b.gz": prose, "c.gz": prose[:third], "d.txt": prose[third : 2 * third], "e.txt": b"", "f.gz": prose[2 * third :], "g.gz": b""}
    for name, data in raw.items():
        cut = len(data) // 2 + 3
        packed = deflated(data[:cut], 6) + deflated(data[cut:], 9) if name == "f.gz" else gzip.compress(data) if name.endswith(".gz") else data
        (at / name).write_bytes(packed)
    want = [line.decode("utf-8", "replace") for name in sorted(raw) for line in raw[name].splitlines()]
    return str(at), want


@pytest.mark.parametrize("stretch", [1 << 25, 100_000, 30_000])
def test_numbers_are_exact_however_files_are_cut(spark, folder, tmp_path, stretch):
    path, want = folder
    index = lines.build_index(spark, path, str(tmp_path / "ix"), stretch)
    n = index.count()
    assert n == 6 if stretch > 1 << 20 else n > (12 if stretch < 50_000 else 6)
    assert index.where("gzipped and file like '%b.gz'").count() > (1 if stretch < 1 << 20 else 0)
    df = lines.read_numbered(spark, str(tmp_path / "ix"))
    assert df.rdd.getNumPartitions() == index.where("n_lines > 0").count()
    assert sorted(map(tuple, df.collect())) == list(enumerate(want))
    late = lines.read_numbered(spark, str(tmp_path / "ix"), len(want) - 100)
    assert sorted(map(tuple, late.collect())) == list(enumerate(want))[-100:] and late.rdd.getNumPartitions() < max(n, 5)
    assert lines.read_numbered(spark, str(tmp_path / "ix"), len(want)).count() == 0


def test_wrong_starts_are_found_out(spark, tmp_path, prose):
    (tmp_path / "x.gz").write_bytes(gzip.compress(prose))
    rows = spark.createDataFrame([(str(tmp_path / "x.gz"), 0, (tmp_path / "x.gz").stat().st_size, True)], "file string, file_no int, size long, gzipped boolean")
    found = lines._one_pass(spark, rows, str(tmp_path / "w"), 50_000, [])
    assert found.count() > 2
    parts = [r["parts"] for r in found.orderBy("stretch").collect()]
    as_rows = lambda ps: [[(p["crc"], p["length"], p["want"], p["want_size"]) for p in x] for x in ps]
    assert inflate.check_members(as_rows(parts)) and not inflate.check_members(as_rows(parts[::-1]))
    assert lines._one_pass(spark, rows, str(tmp_path / "w"), 50_000, [0]).count() == 1
    broken = bytearray(gzip.compress(prose))
    broken[-6] ^= 1
    (tmp_path / "y.gz").write_bytes(broken)
    with pytest.raises(ValueError, match="checksums"):
        lines.build_index(spark, str(tmp_path / "y.gz"), str(tmp_path / "iy"), 50_000)


def test_stored_blocks_have_one_stretch(spark, tmp_path):
    data = random.Random(3).randbytes(300_000).replace(b"\r", b"\n")
    (tmp_path / "z.gz").write_bytes(deflated(data, 0))
    index = lines.build_index(spark, str(tmp_path / "z.gz"), str(tmp_path / "iz"), 50_000)
    assert index.count() == 1
    assert lines.read_numbered(spark, str(tmp_path / "iz")).count() == len(data.splitlines())


def test_index_is_used_again(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text("x\ny\n")
    assert entries.read_lines(spark, str(tmp_path / "a.txt"), str(tmp_path / "i")).count() == 2
    monkeypatch.setattr(lines, "build_index", None)
    assert [tuple(r) for r in entries.read_lines(spark, str(tmp_path / "a.txt"), str(tmp_path / "i"), 1).collect()] == [(1, "y")]
    with pytest.raises(FileNotFoundError):
        lines.list_files(spark, str(tmp_path / "none*"))


# ------------------------------------------------------------ streams


def entry(word, gloss, code="en"):
    return json.dumps({"word": word, "lang_code": code, "pos": "noun", "senses": [{"glosses": [gloss]}]})


@pytest.fixture(scope="module")
def many_entries():
    rng = random.Random(9)
    rows = []
    for i in range(400):
        word = rng.choice(["apple", "Apple", "APPLE", "run", "Run", "blue", "hot" if i % 2 else "x y"])
        rows.append(entry(word, f"Sense {rng.randint(0, 25)}. More." if rng.random() < 0.95 else "[[]]"))
    return [*rows, "{bad", "", entry("only", "[[]]")]


@pytest.mark.parametrize("cuts", [[403], [1, 2, 200, 200], [50] * 8 + [3]])
def test_any_cut_of_the_stream_is_the_batch(spark, tmp_path, many_entries, cuts):
    source, table, check = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    source.mkdir()
    at, names = 0, []
    for i, n in enumerate(cuts):
        name = source / (f"p{i:03d}.jsonl" + (".gz" if i % 2 else ""))
        data = "".join(r + "\n" for r in many_entries[at : at + n]).encode()
        name.write_bytes(gzip.compress(data) if i % 2 else data)
        names.append(name)
        at += n
        if i in (1, 5):  # the stream is stopped and started again in between
            streaming.stream_words(spark, str(source), table, check, 2).awaitTermination(200)
            time.sleep(1.1)
    streaming.stream_words(spark, str(source), table, check, 2).awaitTermination(200)
    rows = entries.read_lines(spark, str(source), str(tmp_path / "ix"))
    kept = entries.gated(entries.parse(rows))
    defs = snapshot.source_definitions(entries.exploded(kept))
    words = snapshot.source_words(kept, defs)
    plain = lambda df: sorted(map(repr, df.collect()))
    assert plain(streaming.read_definitions(spark, table)) == plain(defs) and defs.count() > 60
    assert plain(streaming.read_words(spark, table)) == plain(words)


def test_a_task_reads_only_its_part_of_the_index(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"stretch": range(10), "window": [bytes(9)] * 10}), tmp_path / "i.parquet", row_group_size=3)
    for place in range(10):
        with open(tmp_path / "i.parquet", "rb") as f:
            assert lines._index_row(f, place)["stretch"] == place
