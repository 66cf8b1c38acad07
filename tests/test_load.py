"""Chunks of statements: order, what is committed, and sending that goes on after a failure."""

import json
import os

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from wordmill.operators import load
from wordmill.plans import build


def both(spark, n_definitions, n_words, size):
    made = [(p, spark.range(n).select(F.col("id"), F.concat(F.lit(f"INSERT INTO {p} VALUES ("), F.col("id"), F.lit(");")).alias("statement"))) for p, n in (("definitions", n_definitions), ("words", n_words))]
    return load.chunks(made[0][1], "definitions", ["id"], size).union(load.chunks(made[1][1], "words", ["id"], size))


def test_chunks_come_back_in_order(spark, tmp_path):
    path = f"{tmp_path}/c"
    assert load.write_chunks(both(spark, 23, 10, 5), path) == {"chunks": 7, "statements": 33}
    got = {(r["part"], r["chunk"]): r["statements"] for r in load.read_chunks(spark, path).collect()}
    assert sorted(got) == [("definitions", i) for i in range(5)] + [("words", 0), ("words", 1)]
    assert [s for i in range(5) for s in got["definitions", i]] == [f"INSERT INTO definitions VALUES ({i});" for i in range(23)]


def test_a_repeated_task_writes_no_chunk_twice(spark, tmp_path):
    """What an attempt that isn't committed leaves is in no manifest."""
    path, rows = f"{tmp_path}/c", [{"part": "words", "chunk": 0, "place": i, "statement": f"s{i}"} for i in range(3)]
    writer = load._ChunkWriter(path)
    writer.write(iter(rows))  # lost after its files were there
    writer.commit([writer.write(iter(rows)), None])
    assert [r["statements"] for r in load.read_chunks(spark, path).collect()] == [["s0", "s1", "s2"]]
    with pytest.raises(ValueError):
        writer.write(iter(rows[1:]))


def test_nothing_to_load(spark, tmp_path):
    assert load.write_chunks(both(spark, 0, 0, 5), f"{tmp_path}/c") == {"chunks": 0, "statements": 0}
    assert load.send(spark, f"{tmp_path}/c", lambda text: None) == {"definitions": 0, "words": 0}


def test_sending_goes_on(spark, tmp_path):
    path, log = f"{tmp_path}/c", f"{tmp_path}/log"
    os.makedirs(log)
    load.write_chunks(both(spark, 20, 10, 5), path)

    def execute(text):
        first = text.split("\n")[0]
        with open(f"{log}/{TaskContext.get().taskAttemptId()}", "a") as f:
            f.write(first + "\n")
        if "definitions VALUES (10)" in first and not os.path.exists(f"{tmp_path}/well"):
            raise OSError("away")

    with pytest.raises(Exception, match="away"):
        load.send(spark, path, execute, 1)
    lines = lambda: sorted(line for n in os.listdir(log) for line in open(f"{log}/{n}"))
    assert not any("words" in line for line in lines())
    open(f"{tmp_path}/well", "w").close()
    assert load.send(spark, path, execute, 1) == {"definitions": 2, "words": 2}
    assert load.send(spark, path, execute) == {"definitions": 0, "words": 0}
    asked = [line for line in lines() if "(10)" not in line]
    assert len(asked) == len(set(asked)) == 5


def test_a_builds_load(spark, tmp_path):
    store = build.Store(spark, f"{tmp_path}/s")
    with open(f"{tmp_path}/in.jsonl", "w") as f:
        f.writelines(json.dumps({"word": w, "lang": "English", "lang_code": "en", "pos": "noun", "senses": [{"glosses": [f"A {w}."]}]}) + "\n" for w in ("apple", "pear", "fig"))
    build.ingest(store, f"{tmp_path}/in.jsonl", now=1)
    build.plan_update(store)
    build.export_current(store)
    told = build.write_load(store, f"{tmp_path}/load", size=2)
    assert (told["mode"], told["chunks"], told["statements"]) == ("full", 4, 6)
    assert load.send(spark, f"{tmp_path}/load", lambda text: None) == {"definitions": 2, "words": 2}
