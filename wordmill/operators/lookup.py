"""Point lookups, as joins of a batch of requests with the serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def validate(requests: DataFrame, words: DataFrame, word: str = "word") -> DataFrame:
    """``requests`` with key and valid."""
    asked = requests.withColumn("key", T.normalize_word_key(word))
    known = words.select(F.col("word").alias("known")).distinct()
    return asked.join(known, F.col("key") == F.col("known"), "left").withColumn("valid", F.col("known").isNotNull()).drop("known")


def define(requests: DataFrame, words: DataFrame, definitions: DataFrame, word: str = "word") -> DataFrame:
    """``requests`` with key, status (200, 400 for an empty word, 404) and definition."""
    asked = requests.withColumn("key", T.normalize_word_key(word))
    served = words.select("id", F.col("word").alias("served")).join(definitions, "id")
    status = F.when(F.col("key") == "", 400).when(F.col("served").isNull(), 404).otherwise(200)
    return asked.join(served, F.col("key") == F.col("served"), "left").withColumn("status", status).drop("served", "id")
