"""Keep-first and keep-better rules, similar pairs, and merging of definitions that extend each other."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .alike import Workspace, candidates
from .beginnings import beginnings
from .ordered import running


def keep_first(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group in ``order``."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("kept_place", F.row_number().over(w)).where("kept_place = 1").drop("kept_place")


def keep_first_marked(rows: DataFrame, line: str, marker: str, order: list[str]) -> DataFrame:
    """Of equal lines that hold the marker word only the first; all others stay."""
    # only marked lines are shuffled, and of these one a key and task
    marked = rows.withColumn("is_marked", F.coalesce(F.contains(F.lower(line), F.lit(marker)), F.lit(False)))
    first = marked.where("is_marked").groupBy(F.lower(T.strip(line)).alias("kept_key")).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("kept"))
    return marked.where("not is_marked").drop("is_marked").unionByName(first.select("kept.*"))


def keep_running_best(rows: DataFrame, by: list[str], score: str, order: list[str]) -> DataFrame:
    """Rows whose score is above all earlier ones of the same group, however many rows a group has. Of rows that are equal in ``by`` and
    ``order`` none is earlier than the others."""
    # the best score up to each row is that of earlier rows unless the row itself is the first to reach it
    keyed = rows.withColumn("running_key", F.struct(*by))
    reached = running(keyed, "running_key", order, F.col(score), "running_best", "max")
    first = Window.partitionBy("running_key", "running_best").orderBy(*order)
    at_best = reached.where(F.col(score) == F.col("running_best")).withColumn("place", F.rank().over(first)).where("place = 1").drop("place")
    none_yet = reached.where(F.col("running_best").isNull())
    return at_best.unionByName(none_yet).select(*rows.columns)


def keep_most(rows: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of each group, the first ones; 0: all."""
    if not most:
        return rows
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("kept_place", F.row_number().over(w)).where(F.col("kept_place") <= most).drop("kept_place")


#: Candidates up to which the words that they are confirmed on are looked up by a broadcast.
_FEW = 500_000


def similar_pairs(rows: DataFrame, group: str, key: str, text: str, threshold: float) -> DataFrame:
    """Pairs i < j of one group whose Jaccard similarity of words, without stop words, reaches the threshold.

    Exact. Equal sets (copies) are compared once, as one class; candidates come from blocks of classes (see :mod:`.alike`) and are
    confirmed on their words. Words are stored once; only their hashes are shuffled, and the words of candidates.
    """
    work = Workspace(rows.sparkSession, "similar-pairs")
    sets = rows.where(F.col(group).isNotNull()).select(group, F.col(key).alias("k"), F.sort_array(T.content_words(text)).alias("words"))
    # stored, as words would be made again for each use of them
    sets = work.keep(sets, "sets").where(F.size("words") > 0).withColumn("class", F.xxhash64(group, "words"))
    members = work.keep(sets.select(group, "class", "k", F.transform("words", lambda w: F.hash(group, w)).alias("hashes")), "members")
    met = work.keep(candidates(members, group, work, threshold), "met")
    touched = met.select(group, F.col("a").alias("class")).union(met.select(group, F.col("b").alias("class"))).distinct()
    found = sets.join(F.broadcast(touched) if met.count() <= _FEW else touched, [group, "class"], "left_semi").groupBy(group, "class").agg(F.first("words").alias("words"))
    left, right = (found.select(group, F.col("class").alias(c), F.col("words").alias(f"w{c}")) for c in "ab")
    alike = met.join(left, [group, "a"]).join(right, [group, "b"]).withColumn("similarity", T.similarity("wa", "wb")).where(F.col("similarity") >= threshold).select(group, "a", "b", "similarity")
    copies = members.groupBy(group, "class").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    within = copies.select(group, F.col("class").alias("a"), F.col("class").alias("b"), F.lit(1.0).alias("similarity"))
    both = alike.union(alike.select(group, F.col("b"), F.col("a"), "similarity")).union(within)
    i, j = (members.select(group, F.col("class").alias(c), F.col("k").alias(k)) for c, k in ("ai", "bj"))
    return both.join(i, [group, "a"]).join(j, [group, "b"]).where("i < j").select(group, "i", "j", "similarity")


def extension_classes(rows: DataFrame, group: str, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Classes of texts that are equal but for dots at their end: pairs (base, extended) where one's text begins with the other's, and the
    members (group, key, class, length: that of the text without these dots, whole_length).

    A base that is another's part before ``;`` or its first sentence is a beginning of it as well, so beginnings are all there is to find;
    and as no base ends with a dot, it's a beginning of a text if it's one of the text without its last dots.
    """
    named = rows.select(F.col(group).cast("string").alias("group"), F.col(key).alias("key"), T.without_dots(text).alias("text"), F.length(T.strip(text)).alias("whole_length"))
    pairs, members = beginnings(named.where("group is not null and key is not null and text <> ''"))
    return pairs, members.select(F.col("group").cast(rows.schema[group].dataType).alias(group), F.col("key").alias(key), "class", "length", "whole_length")


def extension_pairs(rows: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """(base, extended, merged) of one group where one definition extends another; no pair of unrelated rows is built. Rows of no group, key
    or text are in no pair. As a text begins with its base, that's only put before it where blanks come first and it is one sentence."""
    pairs, members = extension_classes(rows, group, key, text)
    bases = members.select(F.col("class").alias("b"), F.col(key).alias("base"), F.col("length").alias("base_length"))
    wholes = members.select(group, F.col("class").alias("e"), F.col(key).alias("extended"), "whole_length")
    met = pairs.select(F.col("base").alias("b"), F.col("extended").alias("e")).join(bases, "b").join(wholes, "e")
    found = met.where((F.col("base") != F.col("extended")) & (F.col("whole_length") > F.col("base_length") * 1.1)).select(group, "base", "base_length", "extended")
    texts = rows.select(group, F.col(key).alias("extended"), F.col(text).alias("whole"))
    e = T.strip("whole")
    as_it_is = (F.left("whole", F.lit(1)) == F.left(e, F.lit(1))) | F.contains("whole", F.lit(";")) | (F.size(T.sentences("whole")) >= 2)
    merged = F.when(as_it_is, F.col("whole")).otherwise(F.concat(F.left(e, F.col("base_length")), F.lit("; "), e))
    return found.join(texts, [group, "extended"]).select(group, "base", "extended", merged.alias("merged")).distinct()


def merge_first(rows: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """For each row the first other row (by key) that it extends or that extends it, and the merged text."""
    pairs = extension_pairs(rows, group, key, text)
    either = pairs.select(group, F.col("extended").alias(key), F.col("base").alias("other"), "merged").union(pairs.select(group, F.col("base").alias(key), F.col("extended").alias("other"), "merged"))
    return either.groupBy(group, key).agg(F.min_by("merged", F.struct("other", "merged")).alias("merged"), F.min("other").alias("other"))


DECISIONS = ("keep_first", "keep_second", "merge", "combine", "keep_both")


def decide_duplicates(rows: DataFrame, group: str, key: str, text: str, decide: Callable[[str, str], tuple[str, str]], threshold: float = 0.5) -> DataFrame:
    """The rows left after the pairs of each group, most similar first, went through ``decide`` (a decision of
    DECISIONS and a text). merge and combine put the text in the place of the first; a row that went is asked about no
    more. A group is one word's definitions."""
    pairs = similar_pairs(rows, group, key, text, threshold)
    involved = pairs.select(group, F.col("i").alias(key)).union(pairs.select(group, F.col("j").alias(key))).distinct()
    touched = rows.select(group, key, text).join(involved, [group, key], "left_semi")
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def fold(names, members: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        lines = dict(zip(members[key], members[text]))
        for i, j in links.sort_values(["similarity", "i", "j"], ascending=[False, True, True])[["i", "j"]].itertuples(index=False):
            if i not in lines or j not in lines or lines[i] == lines[j] and lines.pop(j, None) is not None:
                continue
            decision, line = decide(lines[i], lines[j])
            if decision == "keep_second":
                del lines[i]
            elif decision in ("keep_first", "merge", "combine"):
                del lines[j]
                if decision != "keep_first":
                    lines[i] = line
        return pd.DataFrame({group: [names[0]] * len(lines), key: list(lines), text: list(lines.values())})

    apart = touched.select(F.col(group).alias("group_key"), key, text).groupBy("group_key"), pairs.select(F.col(group).alias("pair_key"), "i", "j", "similarity").groupBy("pair_key")
    folded = apart[0].cogroup(apart[1]).applyInPandas(fold, f"{group} {kind[group]}, {key} {kind[key]}, {text} string")
    return rows.select(group, key, text).join(involved, [group, key], "left_anti").unionByName(folded)
