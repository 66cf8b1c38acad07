"""What changes from one serving state to the next, and the SQL that does it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sql_literal


def definition_changes(new: DataFrame, prior: DataFrame) -> DataFrame:
    """op (insert, update, delete), id, definition. An update needs both texts to be there and to differ."""
    return _changes(new, prior, "id", "definition")


def word_changes(new: DataFrame, prior: DataFrame) -> DataFrame:
    """op (insert, update, delete), word, id."""
    return _changes(new, prior, "word", "id")


def _changes(new: DataFrame, prior: DataFrame, key: str, value: str) -> DataFrame:
    n = new.select(key, F.col(value).alias("new_value"), F.lit(True).alias("in_new"))
    p = prior.select(key, F.col(value).alias("old_value"), F.lit(True).alias("in_prior"))
    op = F.when(F.col("in_prior").isNull(), "insert").when(F.col("in_new").isNull(), "delete").when(F.col("new_value") != F.col("old_value"), "update")
    return n.join(p, key, "full_outer").select(op.alias("op"), key, F.col("new_value").alias(value)).where("op is not null")


def snapshot_changes(snapshots: DataFrame, words: DataFrame, definitions: DataFrame, prior_words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes of (words, definitions) from a change set: touched words are written anew, gone ones deleted, and a
    definition goes only when no word is left that uses it."""
    touched = snapshots.where("word_status in ('new', 'changed')").select(F.col("word_key").alias("word"))
    upserts = words.join(touched, "word", "left_semi")
    gone = prior_words.join(words, "word", "left_anti")
    lost = snapshots.where("word_status = 'deleted'").select(F.col("word_key").alias("word"))
    gone = gone.union(prior_words.join(lost, "word", "left_semi").join(words, "word", "left_anti")).distinct()
    word_ops = upserts.select(F.lit("upsert").alias("op"), "word", "id").union(gone.select(F.lit("delete"), "word", F.lit(None).cast("bigint")))
    # all words that share an id get its new text with it
    ids = upserts.select("id").distinct()
    texts = definitions.join(ids, "id", "left_semi").select(F.lit("upsert").alias("op"), "id", "definition")
    return word_ops, texts.union(orphan_ids(gone, words).select(F.lit("delete"), "id", F.lit(None).cast("string")))


def orphan_ids(gone: DataFrame, words: DataFrame) -> DataFrame:
    """Ids of words that went which no word uses any more."""
    return gone.select("id").distinct().join(words, "id", "left_anti")


def sharing(ids: DataFrame, words: DataFrame) -> DataFrame:
    """All words of the given ids."""
    return words.join(ids.select("id").distinct(), "id", "left_semi")


def definition_sql(changes: DataFrame, table: str, more: list[str] | None = None) -> DataFrame:
    """op, id, statement, and what columns of the changes ``more`` names."""
    text = sql_literal("definition")
    key = F.col("id").cast("string")
    line = (
        F.when(F.col("op") == "insert", F.concat(F.lit(f"INSERT INTO {table} VALUES ("), key, F.lit(", "), text, F.lit(");")))
        .when(F.col("op") == "upsert", F.concat(F.lit(f"INSERT OR REPLACE INTO {table} VALUES ("), key, F.lit(", "), text, F.lit(");")))
        .when(F.col("op") == "update", F.concat(F.lit(f"UPDATE {table} SET definition="), text, F.lit(" WHERE id="), key, F.lit(";")))
        .otherwise(F.concat(F.lit(f"DELETE FROM {table} WHERE id="), key, F.lit(";")))
    )
    return changes.select("op", "id", line.alias("statement"), *(more or []))


def word_sql(changes: DataFrame, table: str, more: list[str] | None = None) -> DataFrame:
    """op, word, statement, and what columns of the changes ``more`` names."""
    word = sql_literal("word")
    key = F.col("id").cast("string")
    line = (
        F.when(F.col("op") == "insert", F.concat(F.lit(f"INSERT INTO {table} VALUES ("), key, F.lit(", "), word, F.lit(");")))
        .when(F.col("op") == "upsert", F.concat(F.lit(f"INSERT OR REPLACE INTO {table} VALUES ("), key, F.lit(", "), word, F.lit(");")))
        .when(F.col("op") == "update", F.concat(F.lit(f"UPDATE {table} SET id="), key, F.lit(" WHERE word="), word, F.lit(";")))
        .otherwise(F.concat(F.lit(f"DELETE FROM {table} WHERE word="), word, F.lit(";")))
    )
    return changes.select("op", "word", line.alias("statement"), *(more or []))


def delta_meta(word_ops: DataFrame, definition_ops: DataFrame, mode: str = "delta") -> DataFrame:
    """One row: mode, numbers of operations by table and kind, and their total."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        done = lambda *ops: F.count_if(F.col("op").isin(*ops))
        return df.agg(done("insert", "upsert").alias(f"{name}_inserted"), done("update").alias(f"{name}_updated"), done("delete").alias(f"{name}_deleted"))

    one = counts(word_ops, "words").crossJoin(counts(definition_ops, "definitions"))  # two tables of one row
    total = sum((F.col(c) for c in one.columns[1:]), F.col(one.columns[0]))
    return one.select(F.lit(mode).alias("mode"), "*", total.alias("total_ops"))


def apply(prior: DataFrame, changes: DataFrame, key: str, value: str) -> DataFrame:
    """The prior table after the changes."""
    written = changes.where("op <> 'delete'").select(key, value)
    return prior.join(changes, key, "left_anti").select(key, value).union(written)
