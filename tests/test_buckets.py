"""Upserts by buckets: what they change, what they leave, and runs that are cut off."""

import os

import pytest

from wordmill import schemas as S
from wordmill.operators import state
from wordmill.operators.buckets import BucketTable
from wordmill.plans import build

SCHEMA = "k long, v string"


def files(folder):
    return {os.path.join(at, n) for at, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def table(spark, tmp_path, buckets=16):
    return BucketTable(spark, f"{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema, ["k"], buckets)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.read().count() == 0
    assert t.upsert(spark.range(1600).selectExpr("id as k", "string(id) as v")) == 1
    first = t.manifest()["folders"]
    assert len(first) == 16
    assert t.upsert(spark.createDataFrame([(3, "three"), (7, "seven"), (5000, "new")], SCHEMA)) == 2
    second = t.manifest()["folders"]
    changed = {b for b in first if first[b] != second[b]}
    assert 1 <= len(changed) <= 3
    want = {i: str(i) for i in range(1600)} | {3: "three", 7: "seven", 5000: "new"}
    assert dict(content(t.read())) == want
    assert t.read(1).count() == 1600  # the version before stays readable
    t.vacuum()
    assert dict(content(t.read())) == want and t.versions() == [2]


def test_ties_nulls_and_deletes(spark, tmp_path):
    t = table(spark, tmp_path, 4)
    t.upsert(spark.createDataFrame([(None, "a"), (1, "b"), (2, None)], SCHEMA))
    rows = spark.createDataFrame([(None, "c", 2, False), (None, "d", 1, False), (1, "x", 0, True), (9, "y", 0, True), (2, "p", 0, None), (2, "q", 0, None)], SCHEMA + ", at int, gone boolean")
    t.upsert(rows, ["at"], "gone")
    assert content(t.read()) == content(spark.createDataFrame([(None, "c"), (2, "q")], SCHEMA))
    assert t.upsert(spark.createDataFrame([], SCHEMA)) == 2  # nothing to change
    t.upsert(spark.createDataFrame([(None, "", True), (2, "", True)], SCHEMA + ", gone boolean"), deletes="gone")
    assert t.read().count() == 0


def test_a_run_that_is_cut_off(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path, 4)
    t.upsert(spark.createDataFrame([(1, "a")], SCHEMA))
    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_commit", lambda self, told: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.upsert(spark.createDataFrame([(1, "b"), (2, "c")], SCHEMA))
    assert content(t.read()) == [(1, "a")]
    assert t.upsert(spark.createDataFrame([(1, "b"), (2, "c")], SCHEMA)) == 2
    t.vacuum()
    assert content(t.read()) == [(1, "b"), (2, "c")]
    named = {f.split("/")[1] for f in t.manifest()["folders"].values()}
    assert {f.split("/data/")[1].split("/")[0] for f in files(t.root)} == named


def test_a_plain_table_is_taken_over(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA).write.parquet(f"{tmp_path}/t")
    t = table(spark, tmp_path, 4)
    assert content(t.read()) == [(1, "a"), (2, "b")]
    t.upsert(spark.createDataFrame([(2, "c")], SCHEMA))
    assert content(t.read()) == [(1, "a"), (2, "c")]
    t.vacuum()
    assert content(t.read()) == [(1, "a"), (2, "c")]


def test_published_state_of_a_build(spark, tmp_path):
    store = build.Store(spark, str(tmp_path))
    published = store.published()
    for extract, at in ((1, 10), (2, 20)):
        published.upsert(spark.createDataFrame([("d1", extract, at, f"v{extract}")], S.PUBLISHED_STATE))
    published.upsert(spark.createDataFrame([("web", 1, 30, "v1")], S.PUBLISHED_STATE))
    assert content(published.read().select("target", "extract_id")) == [("d1", 2), ("web", 1)]
    assert state.pipeline_status(spark.createDataFrame([], S.EXTRACT_RUNS), published.read()).first()["published"] == {"d1": 2, "web": 1}
