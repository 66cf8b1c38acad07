"""Checks of lines by rules or by a function, and what follows from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def check_lines(lines: DataFrame, line: str, most_words: int) -> DataFrame:
    """``lines`` with reason and valid by the rules."""
    return lines.withColumn("reason", T.sanity_reason(line, most_words)).withColumn("valid", F.col("reason") == "ok")


def check_lines_with(lines: DataFrame, source: str, line: str, judge: Callable[[str, str], tuple[bool, str]], most_words: int) -> DataFrame:
    """As :func:`check_lines`, by a function; lines within the budget are valid without asking."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(True, "ok") if short else judge(s, c) for s, c, short in zip(pdf[source], pdf[line], pdf["is_short"])]
            yield pdf.drop(columns="is_short").assign(reason=[g[1] for g in got], valid=[bool(g[0]) for g in got])

    short = lines.withColumn("is_short", F.coalesce(T.word_count(line) <= most_words, F.lit(False)))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema.fields)
    return short.mapInPandas(run, f"{columns}, reason string, valid boolean")


def hit_rate(checked: DataFrame) -> DataFrame:
    """One row: validated, failed and the share that passed (0 if nothing was checked)."""
    one = checked.agg(F.count(F.lit(1)).alias("validated"), F.count_if(~F.col("valid")).alias("failed"))
    return one.withColumn("hit_rate", F.when(F.col("validated") > 0, (F.col("validated") - F.col("failed")) / F.col("validated")).otherwise(F.lit(0.0)))


def to_reprocess(checked: DataFrame, word: str) -> DataFrame:
    return checked.where("not valid").select(word).distinct()


def flag(words: DataFrame, failed: DataFrame, word: str) -> DataFrame:
    """``words`` with reprocess set for those that failed; their status is pending again."""
    hit = failed.select(word, F.lit(True).alias("hit")).distinct()
    out = words.join(hit, word, "left")
    return out.withColumn("reprocess", F.coalesce("hit", F.col("reprocess"))).withColumn("status", F.when(F.col("hit"), "pending").otherwise(F.col("status"))).select(*words.columns)


def input_lines(definitions: DataFrame, words: DataFrame, n: int = 0) -> DataFrame:
    """The definitions (word, idx) of words (word, status) that are done, the first ``n`` in order; 0: all."""
    return sample(definitions.join(words.where("status = 'done'").select("word"), "word", "left_semi"), ["word", "idx"], n)


def sample(lines: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` lines in order; 0: all."""
    return lines.orderBy(*order).limit(n) if n else lines.orderBy(*order)


def dropped(before: DataFrame, returned: DataFrame, keys: list[str]) -> DataFrame:
    """Definitions that a rewrite of their word didn't give back."""
    return before.join(returned, keys, "left_anti")


def apply_rewrite(before: DataFrame, returned: DataFrame, keys: list[str], line: str) -> DataFrame:
    """Definitions after a rewrite: lines it gave back are new; other definitions of the words it treated are gone."""
    treated = returned.select(keys[0]).distinct()
    new = returned.select(*keys, F.col(line).alias("new_line"))
    kept = before.join(new, keys).withColumn(line, F.col("new_line")).select(*before.columns)
    return before.join(treated, keys[0], "left_anti").unionByName(kept)


def clean_tags(lines: DataFrame, line: str) -> DataFrame:
    return lines.withColumn(line, F.when(T.has_bracket_tag(line), T.strip_bracket_tags(line)).otherwise(F.col(line)))
