"""Beginnings in sorted order against all pairs, over any number of ranges and with one beginning of many."""

import random

import pytest
from pyspark.sql import functions as F

from wordmill.functions import text as T
from wordmill.operators import beginnings, dedupe


def brute(df, spark):
    p, q = df.toDF("g", "i", "s"), df.toDF("g", "j", "u")
    both = p.join(q, "g").where((F.col("i") != F.col("j")) & (T.without_dots("s") != "") & T.is_extension("s", "u"))
    return sorted(tuple(r) for r in both.select("g", "i", "j", T.merge_extension("s", "u")).collect())


@pytest.mark.parametrize("ranges, head, head_rows", [(1, 64, 1 << 16), (4, 64, 1 << 16), (13, 64, 2), (13, 1, 12), (7, 2, 1)])
def test_extensions_are_all_pairs(spark, ranges, head, head_rows, monkeypatch):
    monkeypatch.setattr(beginnings, "HEAD", head)
    monkeypatch.setattr(beginnings, "HEAD_ROWS", head_rows)
    r = random.Random(ranges)
    texts = ["".join(r.choices(["a", "b", ".", "; ", ". ", "é", "\U0001f600", " "], k=r.randint(0, 9))) for _ in range(150)]
    texts += ["", " ", "...", "a", "a", "a" * 40, "a" * 20, "x....", "x....", None]
    df = spark.createDataFrame([(None if i % 40 == 39 else "uv"[i % 2], i, t) for i, t in enumerate(texts)], "g string, k long, t string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(tuple(x) for x in dedupe.extension_pairs(df, "g", "k", "t").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(df, spark) and len(got) > 100


def test_one_beginning_of_ten_thousand(spark):
    rows = [("g", 0, "base")] + [("g", i, f"base {i:05d} and more") for i in range(1, 10_001)]
    df = spark.createDataFrame(rows, "g string, k long, t string")
    got = dedupe.extension_pairs(df, "g", "k", "t")
    assert got.agg(F.count(F.lit(1)), F.min("base"), F.max("base"), F.countDistinct("extended")).first() == (10_000, 0, 0, 10_000)


def test_no_rows_and_no_pairs(spark):
    assert dedupe.extension_pairs(spark.createDataFrame([], "g int, k long, t string"), "g", "k", "t").count() == 0
    pairs, members = dedupe.extension_classes(spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (2, 3, "x y")], "g int, k long, t string"), "g", "k", "t")
    assert pairs.count() == 0 and members.select("class").distinct().count() == 2


def test_long_texts_with_the_same_first_characters_are_dealt_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(beginnings, "HEAD_CHARS", 50_000)
    r = random.Random(5)
    tails = [f"{r.random()}" for _ in range(60)]
    rows = [("g", i, "h" * 64 + t, 0) for i, t in enumerate([t * 200 for t in tails] + [t * 200 + " on" for t in tails])]
    df = spark.createDataFrame(rows, "group string, key long, text string, whole_length int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = beginnings._sorted(df, beginnings.Scratch(spark, "test")).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(ranges) > 1
    assert dedupe.extension_pairs(df, "group", "key", "text").count() == 0  # none is a tenth longer than its base
