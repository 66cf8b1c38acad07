"""No page of op9 is lost, and the mixture's plan."""

import base64
import gzip
import hashlib
import io
import re

import pytest

from wordmill.llm import mixing, warc
from wordmill.llm import queries as Q
from wordmill.llm.shared import Workspace, documents

DATA = "/root/testdata/sf0.001"


def test_pages_with_long_urls_all_come_back(spark, tmp_path):
    sizes = [65_518, 65_519, 65_520, 65_535, 65_536, 70_000, 200_000, 1]
    rows = [(i, "u" * n, f"text {i % 5}") for i, n in enumerate(sizes)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, Q.op9_warc(spark, str(tmp_path)).collect()))
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    want = [(i, len(t), digest(t), "response" if i < 5 else "revisit", None if i < 5 else i % 5) for i, _, t in rows]
    assert got == want
    files = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), Workspace(spark, "warc"))
    assert sorted(len(r["url"]) for r in warc.read_chunks(files).collect()) == sorted(sizes)


def test_identifiers_of_any_characters(spark):
    ids = ["a>b", "x\r\nContent-Length: 3", "ü%41", " ", "7"]
    files = warc.write_archives(spark.createDataFrame([(i, "u", "same") for i in ids], "page_id string, url string, html string"), Workspace(spark, "warc"))
    got = warc.read_chunks(files, own=True).collect()
    assert sorted(r["record_id"] for r in got) == sorted(ids) and {r["refers_to"] for r in got} == {None, min(ids)}


def test_headers_beyond_the_bound_are_faults(monkeypatch):
    monkeypatch.setattr(warc, "MOST_HEADER", 1000)
    raw = b"WARC/1.1\r\nX: " + b"y" * 100_000 + b"\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    with pytest.raises(ValueError, match="header of more"):
        list(warc.records(io.BytesIO(raw)))


class Failing(io.RawIOBase):
    """A store that breaks off after some bytes, the first time."""

    tries = 0

    def __init__(self, data, after):
        self.data, self.after = io.BytesIO(data), after

    def readable(self):
        return True

    def readinto(self, buffer):
        if not Failing.tries and self.data.tell() >= self.after:
            Failing.tries += 1
            raise OSError("connection reset by peer")
        return self.data.readinto(buffer[:1000])


def test_errors_of_the_store_fail_the_task(monkeypatch):
    import pyarrow as pa

    records = [b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" % i for i in range(400)]

    class Store:
        def open_input_stream(self, at, compression=None):
            return Failing(b"".join(records if at == "plain" else map(gzip.compress, records)), 20_000)

    monkeypatch.setattr(warc, "filesystem", lambda path: (Store(), path))
    for path in ("plain", "zipped"):
        Failing.tries = 0
        files = pa.RecordBatch.from_pydict({"path": [path], "records": [400]})
        with pytest.raises(OSError, match="reset by peer"):
            list(warc._read(False, 1 << 18, True)([files]))
        assert sum(b.num_rows for b in warc._read(False, 1 << 18, True)([files])) == 400


def test_a_lost_record_fails_the_query(spark):
    pages = spark.createDataFrame([(i, "u", f"t{i}") for i in range(20)], "page_id long, url string, html string").coalesce(1)
    files = warc.write_archives(pages, Workspace(spark, "warc"))
    (path,) = (r["path"] for r in files.collect())
    at = path.removeprefix("file:")
    members = open(at, "rb").read()
    cuts = [m.start() for m in re.finditer(rb"\x1f\x8b\x08", members)]
    for left in (members[: cuts[-1]], members[:-5], members[: cuts[3]] + members[cuts[4] :]):
        open(at, "wb").write(left)
        with pytest.raises(Exception, match="record"):
            warc.read_chunks(files, own=True).count()
        assert warc.read_chunks(files).count() >= 19


# ------------------------------------------------------------ mixture


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_schedule_reads_a_thin_table(spark):
    docs = documents(spark, DATA)
    plan = plan_of(mixing.schedule(docs))
    assert "documents.parquet" not in plan and "text" not in re.sub(r"InMemoryFileIndex\S*", "", plan)
    assert not re.search(r"Exchange hashpartitioning\(source", plan)
    plan = plan_of(mixing.curriculum(docs))
    assert len(re.findall(r"FileScan parquet [^\n]*documents\.parquet", plan)) == 1
    assert len([x for x in re.findall(r"Exchange \w+\([^\n]*", plan) if "source" in x]) == 0


@pytest.mark.parametrize("call", [mixing.schedule, mixing.curriculum])
def test_many_sources_are_salted(spark, odd, monkeypatch, call):
    rows = lambda df: sorted(map(repr, df.collect()))
    docs = documents(spark, DATA).limit(100)
    want = rows(call(docs)), rows(call(odd))
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 1)
    assert (rows(call(docs)), rows(call(odd))) == want
