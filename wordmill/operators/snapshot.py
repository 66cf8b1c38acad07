"""Snapshots of an extract: words and definitions with content hashes, and the comparison of two snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from ..schemas import ENHANCEMENT_VERSION
from .lineage import Scratch
from .ordered import running


def display_forms(rows: DataFrame, key: str, form: str, order: list[str], *more: str) -> DataFrame:
    """For each key the form of lowest casing rank, the first of those in ``order``; ``more`` columns come with it."""
    best = F.min_by(F.struct(F.col(form).alias("display_word"), *more), F.struct(T.casing_rank(form), *order))
    return rows.groupBy(key).agg(best.alias("best")).select(key, "best.*")


def first_of_each(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("kept")).select("kept.*")


def index_definitions(rows: DataFrame, key: str, unique: str, order: list[str], index: str = "source_idx") -> DataFrame:
    """The first row of each (key, unique) in ``order``, numbered from 0 in each key, however many rows one key has: keys, numbers and order
    are scanned over ranges, and the rows, which were written once, take their number by (key, unique)."""
    work = Scratch(rows.sparkSession, "indexed")
    first = work.keep(first_of_each(rows, [key, unique], order), "first")
    numbers = running(first.select(key, unique, *order), key, order, F.lit(1).cast("long"), index)
    numbers = numbers.select(F.col(key).alias("n_key"), F.col(unique).alias("n_unique"), (F.col(index) - 1).alias(index))
    return first.join(numbers, F.col(key).eqNullSafe(F.col("n_key")) & F.col(unique).eqNullSafe(F.col("n_unique"))).select(*rows.columns, index)


def source_definitions(definitions: DataFrame, numbers: bool = True) -> DataFrame:
    """From definitions (line_no, ordinal, word, pos, gloss): key, hash, sentence and place of each different one; without ``numbers`` no place."""
    sentence = T.first_sentence("gloss")
    rows = definitions.withColumn("source_first_sentence", sentence).where(F.length("source_first_sentence") > 0)
    rows = rows.withColumn("word_key", T.normalize_word_key("word")).withColumn("source_hash", H.hash_definition("word", "pos", "source_first_sentence")).withColumn("definition_key", H.definition_key("source_hash"))
    order, place = ["line_no", "ordinal"], [F.col("source_idx").cast("int").alias("source_idx")] * numbers
    rows = index_definitions(rows, "word_key", "definition_key", order) if numbers else first_of_each(rows, ["word_key", "definition_key"], order)
    return rows.select("word_key", "definition_key", *place, T.normalize_pos("pos").alias("pos"), "source_first_sentence", "source_hash", T.normalize_for_hash("source_first_sentence").alias("normalized_source"))


def source_words(entries: DataFrame, definitions: DataFrame) -> DataFrame:
    """A row for each word of the entries (line_no, word, lang_code), its hash over the definitions' hashes.

    Words without definitions have an empty hash.
    """
    keyed = entries.withColumn("word_key", T.normalize_word_key("word")).withColumn("lang_code", F.coalesce("lang_code", F.lit("en")))
    shown = display_forms(keyed, "word_key", "word", ["line_no"], "lang_code")
    hashes = definitions.groupBy("word_key").agg(F.collect_list("source_hash").alias("hashes"))
    joined = shown.join(hashes, "word_key", "left")
    digest = F.when(F.col("hashes").isNull(), F.lit("")).otherwise(H.hash_word("word_key", "display_word", "hashes"))
    return joined.select("word_key", "display_word", F.col("lang_code").alias("language_code"), digest.alias("word_hash"), T.is_pure_alpha("word_key").alias("is_pure_alpha"))


def compare(new: DataFrame, prior: DataFrame) -> DataFrame:
    """word_key, display_word, word_hash, word_status: new, changed, unchanged or deleted, by one full outer join."""
    n = new.select("word_key", F.col("display_word").alias("new_display"), F.col("word_hash").alias("new_hash"), F.lit(True).alias("in_new"))
    p = prior.select("word_key", F.col("display_word").alias("old_display"), F.col("word_hash").alias("old_hash"), F.lit(True).alias("in_prior"))
    status = F.when(F.col("in_prior").isNull(), "new").when(F.col("in_new").isNull(), "deleted").when(F.col("new_hash").eqNullSafe(F.col("old_hash")), "unchanged").otherwise("changed")
    return n.join(p, "word_key", "full_outer").select("word_key", F.coalesce("new_display", "old_display", "word_key").alias("display_word"), F.col("new_hash").alias("word_hash"), status.alias("word_status"))


def with_accepted(words: DataFrame, cache: DataFrame, version: str = ENHANCEMENT_VERSION) -> DataFrame:
    """``words`` (word_key, word_hash, ...) and ``has_pocket``: is there an accepted line for this very content?"""
    have = cache.where((F.col("enhancement_version") == version) & (F.col("quality_status") == "accepted")).select("word_key", "word_hash", F.lit(True).alias("accepted")).distinct()
    return words.join(have, ["word_key", "word_hash"], "left").withColumn("has_pocket", F.coalesce("accepted", F.lit(False))).drop("accepted")


def word_snapshots(new: DataFrame, prior: DataFrame, definitions: DataFrame, cache: DataFrame) -> DataFrame:
    """The change set: status, number of definitions, and what is to be done for the word's line.

    A word that reverts to content once seen finds its line in the cache too, so it is reused whatever its status.
    """
    counts = definitions.groupBy("word_key").agg(F.count(F.lit(1)).alias("n"))
    rows = with_accepted(compare(new, prior), cache).join(counts, "word_key", "left")
    gone = F.col("word_status") == "deleted"
    action = F.when(~gone, F.when(F.col("has_pocket"), "reused").otherwise("regenerate"))
    return rows.select("word_key", "display_word", "word_status", F.when(gone, F.lit(0)).otherwise(F.coalesce("n", F.lit(0))).cast("bigint").alias("source_definition_count"), action.alias("enhancement_action"))


def count_of(condition: Column | str) -> Column:
    return F.count_if(F.expr(condition) if isinstance(condition, str) else condition)


def plan_report(snapshots: DataFrame, new: DataFrame, prior: DataFrame) -> DataFrame:
    """One row of totals over the change set and both snapshots."""
    changes = snapshots.agg(
        *[count_of(F.col("word_status") == s).alias(f"{s}_words") for s in ("unchanged", "changed", "new", "deleted")],
        count_of(F.col("enhancement_action") == "reused").alias("words_reusable"),
        count_of(F.col("enhancement_action") == "regenerate").alias("words_to_regenerate"),
    )
    totals = lambda df, name: df.agg(F.count(F.lit(1)).alias(f"total_words_{name}_extract"), count_of("is_pure_alpha").alias(f"pure_{name}"))
    # three tables of one row each
    one = changes.crossJoin(totals(new, "new")).crossJoin(totals(prior, "prior"))
    return one.withColumn("pure_word_count", F.col("pure_new")).withColumn("pure_word_delta", F.col("pure_new") - F.col("pure_prior")).drop("pure_new", "pure_prior")
