import base64
import hashlib
import io
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from wordmill.llm import mixing, packing, warc
from wordmill.llm import queries as Q
from wordmill.llm.shared import Workspace

from .conftest import LONG, TEXTS

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_oracle(spark, name, tmp_path):
    Q.QUERIES[name](spark, DATA).write.parquet(f"{tmp_path}/out")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(Q.ORACLE_SQL[name])
    pick = ", ".join(f'"{c}"' for c in sorted(want.columns))
    got = con.sql(f"SELECT * FROM '{tmp_path}/out/*.parquet'")
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, got.project(pick).fetchall())) == sorted(map(repr, want.project(pick).fetchall()))


# ------------------------------------------------------------ op7


def slow_targets(sizes, weights, most):
    """Shares by repeated resharing of what goes over the caps."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        free -= set(over)
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 50}, {"x": 7}, {"a": 0, "b": 0}, {"a": 1, "b": 1, "c": 1, "d": 3000}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df, (1, 2, 3), 3).collect()}
    for s, want in slow_targets(sizes, (1, 2, 3), 3).items():
        assert got[s] == pytest.approx(want)


def test_mix(spark, odd, empty):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = mixing.plan(docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    targets = slow_targets({s: sum(r["size"] for r in rs) for s, rs in by.items()}, (1, 2, 3), 3)
    for s, rs in by.items():
        assert rs[0]["target"] == pytest.approx(targets[s])
        assert abs(sum(r["taken"] for r in rs) - targets[s]) <= max(r["size"] for r in rs)
        places = sorted((r["place"], r["size"]) for r in rs if r["size"])
        assert [p for p, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist()
    assert mixing.plan(odd).count() == len(TEXTS) and mixing.plan(empty).count() == 0 and mixing.curriculum(empty).count() == 0


def test_slices_agree_with_one(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = sorted((r["doc_id"], r["taken"], r["place"]) for r in mixing.plan(docs).collect())
    monkeypatch.setattr(mixing, "SLICE_WORDS", 500)
    assert sorted((r["doc_id"], r["taken"], r["place"]) for r in mixing.plan(docs).collect()) == want


def test_curriculum_follows_the_schedules(spark, odd):
    rows = [(i, "w " * 20, "abc"[i % 3]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.curriculum(docs).collect()
    positions = [r["mix_position"] for r in out]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    early = [r["source"] for r in out if r["mix_position"] < 0.5]
    share = {s: early.count(s) / sum(r["source"] == s for r in out) for s in "abc"}
    # integrals up to the middle of lines from 0.5 to 1.5, from 1.5 to 0.5 and at 1
    assert share["a"] == pytest.approx(0.375, abs=0.02) and share["b"] == pytest.approx(0.625, abs=0.02) and share["c"] == pytest.approx(0.5, abs=0.02)
    mixed = mixing.curriculum(odd)
    assert mixed.columns == [*odd.columns, "mix_position", "mix_repeat"] and {r["sig"] for r in mixed.collect()} == {"g"}


def test_inverse_of_many_knots(spark):
    from pyspark.sql import functions as F

    knots = ((0.0, 0.2), (0.25, 1.0), (0.75, 1.0), (1.0, 3.0))
    area = lambda t: np.trapezoid(np.interp(x := np.linspace(0, t, 20001), *zip(*knots)), x)
    times = spark.createDataFrame([(float(s),) for s in np.linspace(0, 1, 21)], "s double").select("s", mixing._demand_inverse(F.col("s"), F.lit(1), (knots,)).alias("t")).collect()
    for s, t in times:
        assert area(t) / area(1) == pytest.approx(s, abs=1e-6)


# ------------------------------------------------------------ op8


def check_pack(pieces, docs, window=2048):
    encode = packing.encoder(packing.tokenizer_paths()[0], None)  # the JSON file alone
    by_sequence, starts = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append(p)
        starts[p["doc_id"]].append(p)
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
    texts = dict(docs)
    for doc, ps in starts.items():
        ids = np.array([*encode([texts[doc] or ""])[0], 1], "<u4")
        times = sum(p["start"] == 0 for p in ps)
        assert sum(p["length"] for p in ps) == times * len(ids)
        for p in ps:
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) and p["doc_tokens"] == len(ids)
    return sum(p["length"] for p in pieces) / (window * len(by_sequence))


def test_packing(spark, odd, empty):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    pieces = Q.op8_packing(spark, DATA).collect()
    assert {p["doc_id"] for p in pieces} == {d for d, _ in docs} and check_pack(pieces, docs) > 0.93
    again = Q.op8_packing(spark, DATA).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, pieces))
    rows = [(i, t) for i, t, *_ in TEXTS]
    check_pack(packing.pack(odd, with_ids=True).collect(), rows)
    assert packing.pack(empty).count() == 0


def test_many_partitions_are_merged(spark):
    docs = [(i, "word " * (50 + i % 300)) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    assert check_pack(packing.pack(df).collect(), docs) > 0.9


def test_open_windows():
    w = packing.OpenWindows(10, 2, 3)
    assert list(w.place("a", 0, 6)) == [] and list(w.place("b", 0, 7)) == []
    assert list(w.place("c", 0, 3)) == [(1, [("b", 0, 7), ("c", 0, 3)])]  # the window it fills best
    assert list(w.place("d", 0, 9)) == []
    assert list(w.place("e", 0, 5)) == [(2, [("d", 0, 9)])]  # none has room: the fullest goes; one token isn't worth a cut
    # the fullest is topped up with the head, and the rest fills the other
    assert list(w.place("f", 0, 9)) == [(0, [("a", 0, 6), ("f", 0, 4)]), (3, [("e", 0, 5), ("f", 4, 5)])] and not w.pieces


def test_long_runs_have_the_same_ids():
    both = packing.encoder(*packing.tokenizer_paths())
    plain = packing.encoder(packing.tokenizer_paths()[0], None)
    texts = ["a" * 5000, " " * 5000 + "x", LONG[:3000], "<|endoftext|> é 中文\n\n  x", "", "don't 12345 $$$"]
    assert both(texts) == plain(texts)


# ------------------------------------------------------------ op9


def test_archives(spark, empty):
    rows = [(3, "http://a", "same"), (1, "http://b\r\nX: y", "same"), (2, None, None), (5, "u", ""), (4, "u", "ü" * 300_000), (None, "u", "same"), (6, "u", "WARC/1.1\r\n\r\nHTTP"), (1, "http://b", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    work = Workspace(spark, "warc")
    files = warc.write_archives(pages, work)
    chunks = warc.read_chunks(files, chunk=1000).collect()
    payload, last = defaultdict(bytes), {}
    for c in sorted(chunks, key=lambda c: (c["record_id"] or "", c["chunk"])):
        if c["record_type"] == "response" and c["record_id"] != "1":
            payload[c["record_id"]] += c["data"]
            assert c["payload_end"] == len(payload[c["record_id"]]) and len(c["data"]) <= 1000
            assert c["digest"] == base64.b32encode(hashlib.sha1(payload[c["record_id"]]).digest()).decode()
        if c["is_last"]:
            last.setdefault(c["record_id"], c)
    assert payload["4"].decode() == "ü" * 300_000 and payload["6"].decode() == "WARC/1.1\r\n\r\nHTTP"
    assert [(k, last[k]["record_type"], last[k]["refers_to"]) for k in ("1", "2", "3", "5")] == [("1", "response", None), ("2", "response", None), ("3", "revisit", "1"), ("5", "revisit", "2")]
    assert last[None]["refers_to"] == "1" and last["3"]["payload_end"] == 4 and last["3"]["digest"] == last["1"]["digest"]
    assert warc.read_chunks(warc.write_archives(pages.where("false"), Workspace(spark, "warc"))).count() == 0
    small = warc.read_chunks(warc.write_archives(pages, Workspace(spark, "warc"), least=5))
    assert small.where("record_type = 'revisit'").count() == 0


def test_reader_takes_other_archives():
    raw = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nWARC-Type: resource\r\nContent-Type: text/plain\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    got = [(h["warc-type"], n, end, last, data) for h, n, end, _, last, data in warc.records(io.BytesIO(raw), 2)]
    assert got == [("warcinfo", 0, 2, False, b"ab"), ("warcinfo", 1, 3, True, b"c"), ("resource", 0, 0, True, b"")]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(raw[:70])))


# ------------------------------------------------------------ pipeline


def test_pipeline(spark, odd, empty):
    import corpus_pipeline
    from wordmill.llm import pii

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    now, seen = docs, []
    work = Workspace(spark, "stages")
    for name, stage in corpus_pipeline.STAGES:
        after = work.keep(stage(spark, now, DATA), name)
        if name != "packed":
            assert after.columns == docs.columns
        seen.append((name, now, after))
        now = after
    (_, start, good), (_, _, single), (_, _, clean), (_, _, mixed), (_, _, pieces) = seen
    assert 0.6 * start.count() < good.count() < start.count() and single.count() < good.count() and clean.count() == single.count()
    model = pii.trained()
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        assert r["text"] == pii.redact_text(before[r["doc_id"]], [(a, b, k) for k, a, b in pii.all_spans(model, before[r["doc_id"]])[1]]) and r["n_chars"] == len(r["text"])
        assert not any(pii.base_spans(r["text"]).values())
    assert {r["doc_id"] for r in mixed.collect()} <= set(before)
    check_pack(pieces.collect(), [(r["doc_id"], r["text"]) for r in clean.collect()])
    documents_like = odd.select("doc_id", "text", "lang", "source", "size")
    for table in (documents_like, documents_like.where("false")):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            now = work.keep(stage(spark, now, DATA), f"odd-{name}-{table is documents_like}")
