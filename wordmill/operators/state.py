"""Ledgers and small states: runs, published artifacts, word status, stored search results, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BUILDER_VERSION, ENHANCEMENT_VERSION
from .dedupe import keep_most


def complete_runs(runs: DataFrame, n: int) -> DataFrame:
    """The last ``n`` complete runs, the latest first."""
    return runs.where("status = 'complete'").orderBy(F.col("id").desc()).limit(n)


def last_status(events: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key of an append-only ledger."""
    rest = [c for c in events.columns if c != key]
    return events.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("last")).select(key, "last.*")


def publish(state: DataFrame, target: str, extract_id: int, version: str, now: int) -> DataFrame:
    """The published state after one target got an artifact."""
    new = state.sparkSession.createDataFrame([(target, extract_id, now, version)], state.schema)
    return state.where(F.col("target") != target).union(new)


def pipeline_status(runs: DataFrame, published: DataFrame) -> DataFrame:
    """One row: the latest complete run, a map of what is published, and whether any target is behind."""
    latest = runs.where("status = 'complete'").agg(F.max("id").alias("latest_extract_id"), F.max_by("sha256", "id").alias("latest_sha256"))
    targets = published.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("target", "extract_id")))).alias("published"), F.min("extract_id").alias("oldest"))
    one = latest.crossJoin(targets)  # two tables of one row
    behind = F.col("latest_extract_id").isNotNull() & (F.col("oldest").isNull() | (F.col("oldest") < F.col("latest_extract_id")))
    return one.select("latest_extract_id", "latest_sha256", "published", behind.alias("has_unpublished_extract"))


def keep_display(old: DataFrame, new: DataFrame) -> DataFrame:
    """word, display_word, status after an upsert that leaves a display form that is there."""
    o = old.select("word", F.col("display_word").alias("old_display"), F.col("status").alias("old_status"))
    n = new.select("word", F.col("display_word").alias("new_display"), F.col("status").alias("new_status"))
    return o.join(n, "word", "full_outer").select("word", F.coalesce("old_display", "new_display").alias("display_word"), F.coalesce("new_status", "old_status").alias("status"))


def state_counts(words: DataFrame) -> DataFrame:
    """One row: total, pending, reprocess, done."""
    return words.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "pending").alias("pending"), F.count_if("reprocess").alias("reprocess"), F.count_if(F.col("status") == "done").alias("done"))


def status_counts(snapshots: DataFrame) -> DataFrame:
    """One row with a count for each status; a status that doesn't occur has 0."""
    return snapshots.agg(*[F.count_if(F.col("word_status") == s).alias(s) for s in ("new", "changed", "unchanged", "deleted")])


def with_several(rows: DataFrame, key: str, least: int = 2) -> DataFrame:
    """Keys with that many rows or more, the most first."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).orderBy(F.col("n").desc(), key)


def source_counts(cache: DataFrame, words: DataFrame, version: str = ENHANCEMENT_VERSION) -> DataFrame:
    """Lines by how they were made, for words of the extract."""
    return cache.where(F.col("enhancement_version") == version).join(words, "word_key", "left_semi").groupBy("enhanced_source").agg(F.count(F.lit(1)).alias("n"))


def build_report(extract: DataFrame, words: DataFrame, definitions: DataFrame, snapshots: DataFrame, cache: DataFrame, exported: DataFrame | None = None, pure: DataFrame | None = None) -> DataFrame:
    """One nested row about the latest extract (id, sha256, source_path, completed_at) and what was made of it."""
    made = source_counts(cache, words).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), *[F.coalesce(F.sum(F.when(F.col("enhanced_source") == s, F.col("n"))), F.lit(0)).alias(s) for s in ("llm", "passthrough")])
    parts = [
        extract.select(F.struct("id", "sha256", "source_path", "completed_at").alias("extract")),
        words.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_pure_alpha").alias("pure_alpha")).crossJoin(status_counts(snapshots)).select(F.struct("*").alias("words")),
        definitions.agg(F.struct(F.count(F.lit(1)).alias("total")).alias("source_definitions")),
        made.select(F.struct("*").alias("pocket_definitions")),
    ]
    for name, df in (("export", exported), ("pure_export", pure)):
        if df is not None:
            parts.append(df.agg(F.struct(F.count(F.lit(1)).alias("words")).alias(name)))
    out = parts[0].select(F.lit(BUILDER_VERSION).alias("builder_version"), F.lit(ENHANCEMENT_VERSION).alias("enhancement_version"), "*")
    for part in parts[1:]:
        out = out.crossJoin(part)  # each has one row
    return out


def recent(results: DataFrame, now: int, hours: int = 87600) -> DataFrame:
    return results.where(F.col("created_at") > now - hours * 3600)


def ranked_results(results: DataFrame) -> DataFrame:
    return results.orderBy("rank")


def top_results(results: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` results of each word and definition, by rank."""
    return keep_most(results, ["word", "definition_idx"], ["rank"], n)


def add_results(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored search results after new ones came: those of a word and definition take the place of what was stored for it."""
    return stored.join(new.select("word", "definition_idx").distinct(), ["word", "definition_idx"], "left_anti").unionByName(new)


def contexts(results: DataFrame, most: int = 3) -> DataFrame:
    """word, definition_idx, context: titles and snippets of the first results, a line each."""
    line = F.concat_ws(": ", F.nullif(F.trim("title"), F.lit("")), F.nullif(F.trim("snippet"), F.lit("")))
    rows = top_results(results, most).withColumn("line", line).where("line <> ''")
    return rows.groupBy("word", "definition_idx").agg(F.array_join(F.array_sort(F.collect_list(F.struct("rank", "line")))["line"], "\n").alias("context"))


def write_report(report: DataFrame, path: str) -> None:
    """A report's row as one file of JSON."""
    report.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def search_metadata(results: DataFrame, now: int) -> DataFrame:
    """A row for each word and definition: numbers of results, and of those with a snippet."""
    return results.groupBy("word", "definition_idx").agg(F.array_sort(F.collect_set("source")).alias("search_engines"), F.count(F.lit(1)).alias("total_results"), F.count_if(F.length(F.trim("snippet")) > 0).alias("helpful_results")).withColumn("created_at", F.lit(now).cast("bigint"))
