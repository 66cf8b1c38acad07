import random
import time

from pyspark.sql import functions as F

from wordmill.functions import text as T


def counted(t):
    """The two questions answered from the counts of all marks."""
    low = F.lower(T.strip(t))
    return (low != "") & low.rlike(r"\p{L}") & (T.technical_marks(low) < 2), T.notation_marks(t) >= 3


def test_looking_for_marks_takes_little_more_than_reading_texts(spark, tmp_path):
    r = random.Random(1)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyzéüñ", k=r.randint(2, 9))) for _ in range(500)]
    texts = [(" ".join(r.choices(words, k=1000)) + ".",) for _ in range(1000)]
    spark.createDataFrame(texts * 3, "t string").coalesce(1).write.parquet(f"{tmp_path}/texts")
    df = spark.read.parquet(f"{tmp_path}/texts")

    def seconds(*columns):
        times = []
        for _ in range(3):
            began = time.time()
            df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).write.format("noop").mode("overwrite").save()
            times.append(time.time() - began)
        return min(times)

    # the patterns used to be tried at each of the 20 million characters: ten times as long as reading them
    assert seconds(T.is_helpful("t"), T.needs_context("t")) < 8 * seconds(F.length(F.lower("t")))


def test_marks_far_apart_and_side_by_side(spark):
    r = random.Random(5)
    pieces = ["1", "22", "a", "Zz", "é", "(", ")", "(b2)", "]", "+", "-", "=", "°", "′", "¬", "²", "Σ", "ς", "Π", "ж", "中", "𝔸", "∑", "∫", "≠", "₂", "’", "℀", "\n", " "]
    texts = ["".join(r.choices(pieces, k=r.randint(1, 9))) for _ in range(4000)]
    texts += [("blah ж中 1 " * r.randint(0, 400)).join(r.choices(pieces, k=r.randint(2, 5))) for _ in range(500)]
    df = spark.createDataFrame([("a" + t,) for t in texts], "t string")
    helpful, context = counted(F.col("t"))
    got = df.select("t", T.is_helpful("t").alias("a"), helpful.alias("b"), T.needs_context("t").alias("c"), context.alias("d")).collect()
    assert [x for x in got if x["a"] != x["b"] or x["c"] != x["d"]] == []
    assert 500 < sum(x["a"] for x in got) < 4000 and 500 < sum(x["c"] for x in got) < 4000


def test_a_text_of_near_marks_needs_no_deep_stack(spark):
    df = spark.range(1).select(F.explode(F.array(*[F.repeat(F.lit(s), 200_000) for s in ("1 ", "ж1é", "° ", "() ")])).alias("t"))
    got = df.select(T.is_helpful(F.concat(F.lit("a "), "t")).alias("a"), T.needs_context("t").alias("b"), T.needs_context(F.concat("t", F.lit("22 a1+"))).alias("c")).collect()
    assert [tuple(r) for r in got] == [(True, False, True), (True, False, True), (False, False, True), (True, False, True)]
