"""The serving tables: words with the id of their definition, and definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.hashing import stable_id
from .forms import forms_notes


def export(resolved: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words: id, word), (definitions: id, definition) from (word_key, definition) and resolved form links.

    A form has its base's id where the base is exported, else an id and the definition of its own; a base's
    definition ends with a note on its forms. The definition of an id depends on its owner alone, not on the order of rows.
    """
    forms = links.select("form_key", "base_key")
    exported = resolved.select(F.col("word_key").alias("base_word"))
    owned = (
        resolved.select("word_key", "definition")
        .join(forms, F.col("word_key") == F.col("form_key"), "left")
        .join(exported, F.col("base_key") == F.col("base_word"), "left")
        .withColumn("owner", F.coalesce("base_word", "word_key"))
    )
    words = owned.select(stable_id("owner").alias("id"), F.col("word_key").alias("word"))
    notes = forms_notes(links)
    own = owned.where("owner = word_key").join(notes.withColumnRenamed("base_key", "noted"), (F.col("word_key") == F.col("noted")) & F.col("form_key").isNull(), "left")
    return words, own.select(stable_id("owner").alias("id"), F.concat("definition", F.coalesce("note", F.lit(""))).alias("definition"))


def pure(words: DataFrame, definitions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words of ASCII letters alone, and the definitions that they use."""
    some = words.where(T.is_pure_alpha("word"))
    return some, definitions.join(some, "id", "left_semi")


def missing_ids(words: DataFrame, definitions: DataFrame) -> DataFrame:
    """Words whose id has no definition; none if an export is whole."""
    return words.join(definitions, "id", "left_anti")


def colliding_ids(words: DataFrame, links: DataFrame) -> DataFrame:
    """Ids that two words own which are no forms of one base: a collision of hashes."""
    owners = words.join(links.select(F.col("form_key").alias("word"), "base_key"), "word", "left").select("id", F.coalesce("base_key", "word").alias("owner"))
    return owners.distinct().groupBy("id").agg(F.count(F.lit(1)).alias("owners")).where("owners > 1")


def json_rows(rows: DataFrame, key: str, display: str, order: str, line: str) -> DataFrame:
    """word, definitions in order, of words that have any; for a JSON lines sink."""
    lined = rows.where(F.col(line).isNotNull()).groupBy(key).agg(F.min(display).alias("word"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(line).alias("l")))).alias("d"))
    return lined.select("word", F.col("d.l").alias("definitions"))


def legacy_pure(words: DataFrame, definitions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word, raw) and (word, idx, pos, definition) of the words of ASCII letters."""
    some = words.where(T.is_pure_alpha("word"))
    return some.select("word", "raw"), definitions.join(some, "word", "left_semi").select("word", "idx", "pos", "definition")


def write_text(df: DataFrame, column: str, path: str, *order: str) -> None:
    """Sorted text. Parts are written in order of ranges, so their names in order give the whole file."""
    sorted_rows = df.repartitionByRange(*(order or (column,))).sortWithinPartitions(*(order or (column,)))
    sorted_rows.select(column).write.mode("overwrite").text(path)


def write_json_lines(rows: DataFrame, path: str, order: str = "word") -> None:
    """A JSON object a row, sorted over ranges; gzipped, as parts can be read side by side."""
    rows.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").json(path, compression="gzip")


def compact(df: DataFrame, path: str, columns: list[str] | None = None, files: int | None = None) -> None:
    """A copy of a table with the columns that are needed and few files; ``files``: by the size Spark aims at, if not given."""
    some = df.select(*columns) if columns else df
    (some.coalesce(files) if files else some.hint("rebalance")).write.mode("overwrite").parquet(path)
