"""Inflected forms: which words only name a form of another, the base at the end of each chain, and notes on forms."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.forms import form_label, form_of
from .lineage import Scratch


def form_links(definitions: DataFrame) -> DataFrame:
    """form_key, base_key, form_type of words all of whose definitions name a form; the first one decides.

    Definitions: word_key, source_idx, source_first_sentence. A word that names itself is no form.
    """
    found = definitions.withColumn("ref", form_of("source_first_sentence"))
    per_word = found.groupBy("word_key").agg(F.count(F.lit(1)).alias("n"), F.count("ref").alias("n_refs"), F.min_by("ref", F.when(F.col("ref").isNotNull(), F.col("source_idx"))).alias("ref"))
    return per_word.where("n = n_refs and ref.base_key <> word_key").select(F.col("word_key").alias("form_key"), F.col("ref.base_key").alias("base_key"), F.col("ref.form_type").alias("form_type"))


def resolve_chains(links: DataFrame) -> DataFrame:
    """``links`` with base_key at the end of its chain, however long, and the number of hops to it.

    Pointers reach twice as far with each round. One that stands at no form, or at a form that has arrived, has arrived and leaves the rounds;
    a round writes what still moves. As all forms on the way of a moving one that are as far from the end move too, some arrive in each round, unless
    what is left leads into cycles. Such words get their cycle's smallest key, which is therefore a form of itself and left out.
    """
    work = Scratch(links.sparkSession, "chains")
    moving = work.keep(links.select("form_key", "form_type", F.col("base_key").alias("at"), F.lit(1).cast("long").alias("hops"), F.least("form_key", "base_key").alias("low")), "links")
    arrived, before, rounds = [], None, 0
    while True:
        ahead = lambda df, done: df.select(F.col("form_key").alias("n_key"), F.col("at").alias("n_at"), F.col("hops").alias("n_hops"), F.col("low").alias("n_low"), F.lit(done).alias("n_done"))
        known = functools.reduce(DataFrame.unionByName, [ahead(moving, False), *(ahead(df, True) for df in arrived)])
        stepped = moving.join(known, F.col("at") == F.col("n_key"), "left").select(
            "form_key", "form_type", F.coalesce("n_at", "at").alias("at"), (F.col("hops") + F.coalesce("n_hops", F.lit(0))).alias("hops"), F.least("low", "n_low").alias("low"), F.col("n_low").alias("ahead_low"), F.coalesce("n_done", F.lit(True)).alias("done")
        )
        stepped = work.keep(stepped, f"round-{rounds}")
        moving = stepped.where("not done")
        left = moving.count()
        if left != before:
            arrived.append(stepped.where("done"))
        if not left:
            break
        if left == before and 1 << rounds > left:  # what is ahead lies in the cycle, and its own pointer has been all around it
            arrived.append(moving.withColumn("at", F.col("ahead_low")))
            break
        before, rounds = left, rounds + 1
    return functools.reduce(DataFrame.unionByName, arrived).select("form_key", F.col("at").alias("base_key"), "form_type", "hops").where("form_key <> base_key")


def forms_notes(links: DataFrame) -> DataFrame:
    """base_key and its note: forms by label, three a label at most, labels in the order of their first form."""
    rows = links.select("base_key", "form_key", "form_type", form_label("form_type").alias("label"))
    w = Window.partitionBy("base_key", "label").orderBy("form_key", "form_type")
    top = rows.withColumn("place", F.row_number().over(w)).groupBy("base_key", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("form_key", "form_type")).alias("first"),
        F.array_sort(F.collect_list(F.when(F.col("place") <= 3, F.struct("place", "form_key")))).alias("shown"),
    )
    part = F.concat("label", F.lit(": "), F.array_join(F.col("shown.form_key"), ", "), F.when(F.col("n") > 3, ", ...").otherwise(""))
    parts = top.groupBy("base_key").agg(F.array_sort(F.collect_list(F.struct("first", part.alias("part")))).alias("parts"))
    return parts.select("base_key", F.concat(F.lit(" ("), F.array_join(F.col("parts.part"), "; "), F.lit(")")).alias("note"))


def forms_of(links: DataFrame) -> DataFrame:
    """base_key and its sorted forms."""
    return links.groupBy("base_key").agg(F.array_sort(F.collect_list(F.struct("form_key", "form_type"))).alias("forms"))
