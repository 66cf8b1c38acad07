"""Short definitions: reuse by content, pass short ones through, and have the others made by a function."""

from __future__ import annotations

import inspect
import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import ENHANCED_WORDS, ENHANCEMENT_VERSION
from ..sources.files import filesystem, write_file
from .snapshot import with_accepted

#: Makes a line from a word and its definitions (index, part of speech, sentence). If it takes a ``temperature``, that rises by try.
Synthesizer = Callable[..., str | None]
#: Temperature of the first try, what each further one adds, and the highest.
TEMPERATURE, WARMER, WARMEST = 0.3, 0.2, 1.0


def work_list(words: DataFrame, definitions: DataFrame, cache: DataFrame, most_words: int, limit: int = 0) -> DataFrame:
    """Words without an accepted line for their content, their definitions in order, and whether one passes as it is.

    ``limit`` (0: none) takes the first words by key.
    """
    todo = with_accepted(words, cache).where("not has_pocket").select("word_key", "word_hash")
    if limit:
        todo = todo.orderBy("word_key").limit(limit)
    lines = definitions.groupBy("word_key").agg(
        F.array_sort(F.collect_list(F.struct("source_idx", "pos", "source_first_sentence"))).alias("defs"),
        F.array_sort(F.collect_set("pos")).alias("source_pos_list"),
        F.sum(T.word_count("source_first_sentence")).alias("n_words"),
    )
    passes = (F.size("defs") == 1) & (F.col("n_words") <= most_words)
    return todo.join(lines, "word_key").withColumn("passes", passes)


def _takes_temperature(make: Callable) -> bool:
    try:
        return "temperature" in inspect.signature(make).parameters
    except (TypeError, ValueError):
        return False


def temperatures(tries: int) -> list[float]:
    return [min(WARMEST, round(TEMPERATURE + WARMER * n, 6)) for n in range(tries)]


#: Calls after which a task stores what came; at most that many are asked again after it is lost.
_LOT = 16


class Answers:
    """Answers as they come, in a folder that all tasks share, by bucket of their key: a task that is tried again, or a run after one that
    failed, asks only for what isn't there. The folder's first use fixes the number of buckets."""

    def __init__(self, folder: str, buckets: int = 64):
        self.folder = folder.rstrip("/")
        fs, at = filesystem(f"{self.folder}/_buckets")
        if fs.get_file_info(at).type == pafs.FileType.NotFound:
            write_file(f"{self.folder}/_buckets", str(buckets).encode())
        with fs.open_input_stream(at, compression=None) as f:
            self.buckets = int(f.read())

    def dealt(self, todo: DataFrame, keys: list[str]) -> DataFrame:
        """Rows with their bucket, a task a bucket."""
        named = todo.withColumn("answer_bucket", F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int"))
        return named.repartitionById(self.buckets, "answer_bucket")

    def known(self, bucket: int) -> dict[tuple[str, ...], str]:
        """All answers of a bucket, which is a bucket's share of what there is to ask."""
        fs, at = filesystem(f"{self.folder}/{bucket}")
        out = {}
        for info in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)):
            if info.base_name.endswith(".json"):
                with fs.open_input_stream(info.path, compression=None) as f:
                    out |= {tuple(key): line for key, line in json.loads(f.read())}
        return out

    def keep(self, bucket: int, answers: list[tuple[tuple[str, ...], str]]) -> None:
        if answers:
            write_file(f"{self.folder}/{bucket}/{uuid.uuid4().hex}.json", json.dumps(answers).encode())

    def clear(self) -> None:
        """Forget all, once what came of it is stored."""
        fs, at = filesystem(self.folder)
        if fs.get_file_info(at).type != pafs.FileType.NotFound:
            fs.delete_dir(at)


def _all(pool: ThreadPoolExecutor | None, ask: Callable, items: list) -> tuple[list, BaseException | None]:
    """What ``ask`` gives for each item, None for one that failed, and the first failure."""

    def one(item):
        try:
            return ask(*item), None
        except Exception as e:  # told to the caller, once what came is stored
            return None, e

    got = list(pool.map(one, items) if pool else map(one, items))
    return [line for line, _ in got], next((e for _, e in got if e is not None), None)


def _synthesize(make: Synthesizer, tries: int, answers: Answers | None = None, at_once: int = 1):
    """Asks ``at_once`` calls at a time within a task; with ``answers`` each lot of calls is stored before the next one is asked."""
    warm, lot_size = _takes_temperature(make), max(_LOT, at_once)

    def ask(word: str, pairs: list) -> str | None:
        if not pairs:  # without a sentence there is nothing to ask about
            return None
        for heat in temperatures(tries):
            line = make(word, pairs, temperature=heat) if warm else make(word, pairs)
            if line:
                return line
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, known = None, {}
        pool = ThreadPoolExecutor(at_once) if at_once > 1 else None
        try:
            for pdf in batches:
                if answers and len(pdf) and bucket is None:
                    bucket = int(pdf["answer_bucket"].iloc[0])
                    known = answers.known(bucket)
                keys = list(zip(pdf["word_key"], pdf["word_hash"]))
                lines = [known.get(key) for key in keys]
                items = [(word, [(int(d["source_idx"]), d["pos"], d["source_first_sentence"]) for d in defs if d["source_first_sentence"] is not None]) for word, defs in zip(pdf["word_key"], pdf["defs"])]
                missing = [i for i, line in enumerate(lines) if line is None]
                for start in range(0, len(missing), lot_size):
                    lot = missing[start : start + lot_size]
                    came, failure = _all(pool, ask, [items[i] for i in lot])
                    for i, line in zip(lot, came):
                        lines[i] = line
                    if answers:
                        answers.keep(bucket, [(keys[i], line) for i, line in zip(lot, came) if line])
                    if failure is not None:
                        raise failure
                yield pdf[["word_key", "word_hash", "source_pos_list"]].assign(source_definition_count=[len(d) for d in pdf["defs"]], line=lines)
        finally:
            if pool:
                pool.shutdown()

    return run


def enhance(words: DataFrame, definitions: DataFrame, cache: DataFrame, make: Synthesizer, most_words: int, now: int, limit: int = 0, tries: int = 1, version: str = ENHANCEMENT_VERSION, answers: Answers | None = None, at_once: int = 1, review: bool = False) -> DataFrame:
    """New cache rows. Words for which ``make`` gives nothing, or more than one and a half times the budget, get none; with ``review`` they
    get one that isn't accepted: the long line as needs_review, no line as failed. With ``answers``, what came before a failure isn't asked
    again; a task asks ``at_once`` words at a time."""
    todo = work_list(words, definitions, cache, most_words, limit)
    passed = todo.where("passes").select("word_key", "word_hash", "source_pos_list", F.size("defs").alias("source_definition_count"), F.col("defs")[0]["source_first_sentence"].alias("line"), F.lit("passthrough").alias("enhanced_source"), F.lit("accepted").alias("quality_status"))
    asked = todo.where("passes is not true").select("word_key", "word_hash", "source_pos_list", "defs")
    if answers:
        asked = answers.dealt(asked, ["word_key", "word_hash"])
    made = asked.mapInPandas(_synthesize(make, tries, answers, at_once), "word_key string, word_hash string, source_pos_list array<string>, source_definition_count int, line string")
    made = made.withColumn("line", T.unquoted_line("line")).withColumn("enhanced_source", F.lit("llm"))
    made = made.withColumn("quality_status", F.when(F.col("line").isNull(), "failed").when(T.within_budget("line", most_words), "accepted").otherwise("needs_review"))
    if not review:
        made = made.where("quality_status = 'accepted'")
    rows = passed.unionByName(made)
    return rows.select("word_key", "word_hash", F.lit(version).alias("enhancement_version"), F.col("line").alias("pocket_definition"), "source_pos_list", "source_definition_count", "enhanced_source", "quality_status", F.lit(now).cast("bigint").alias("updated_at")).to(ENHANCED_WORDS)


#: Ways a gloss is rewritten: as it is, without its notation, or with what a search found.
PLAIN, NOTATION, CONTEXT = "plain", "notation", "context"


def rewrite_plan(glosses: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """``glosses`` (word, definition_idx, gloss) with helpful, context, search_term and way.

    A stored context is taken where there is one; the search term of glosses that are no help and have none says what to look for.
    """
    out = glosses.withColumn("helpful", T.is_helpful("gloss"))
    out = out.join(contexts, ["word", "definition_idx"], "left") if contexts is not None else out.withColumn("context", F.lit(None).cast("string"))
    missing = ~F.col("helpful") & F.col("context").isNull()
    way = F.when(F.col("context").isNotNull(), CONTEXT).when(T.needs_context("gloss"), NOTATION).otherwise(PLAIN)
    return out.withColumn("search_term", F.when(missing, T.search_term("gloss"))).withColumn("way", way)


def rewrite_glosses(planned: DataFrame, make: Callable[[str, str, str | None, int], str | None], most_words: int) -> DataFrame:
    """``planned`` with line: what ``make`` (gloss, way, context, most words) gives, without quotes and artifacts, or null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            asked = zip(pdf["gloss"], pdf["way"], pdf["context"])
            yield pdf.assign(line=[make(g, way, None if pd.isna(c) else c, most_words) for g, way, c in asked])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in planned.schema.fields)
    made = planned.mapInPandas(run, f"{columns}, line string")
    return made.withColumn("line", F.nullif(T.strip_artifacts(F.btrim(T.strip("line"), F.lit('"'))), F.lit("")))


def latest(cache: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The last row of each key by updated_at."""
    keys = keys or ["word_key", "word_hash", "enhancement_version"]
    rest = [c for c in cache.columns if c not in keys]
    return cache.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("updated_at", *[c for c in rest if c not in ("updated_at", "source_pos_list")])).alias("last")).select(*keys, "last.*")


def after_run(snapshots: DataFrame, words: DataFrame, cache: DataFrame) -> DataFrame:
    """Snapshots with the action as the run left it: what wasn't reused is regenerated if a line came, else pending."""
    have = with_accepted(words, cache).select("word_key", F.col("has_pocket"))
    action = F.when(F.col("word_status") == "deleted", F.lit(None)).when(F.col("enhancement_action") == "reused", "reused").when(F.col("has_pocket"), "regenerate").otherwise("pending")
    return snapshots.join(have, "word_key", "left").withColumn("enhancement_action", action).select(*snapshots.columns)


def resolve(words: DataFrame, definitions: DataFrame, cache: DataFrame, version: str = ENHANCEMENT_VERSION) -> DataFrame:
    """word_key, definition: the accepted line of the word's content, else its first sentence. Words with neither go."""
    accepted = cache.where((F.col("enhancement_version") == version) & (F.col("quality_status") == "accepted"))
    lines = accepted.groupBy("word_key", "word_hash").agg(F.max_by("pocket_definition", F.struct("updated_at", "pocket_definition")).alias("pocket"))
    first = definitions.groupBy("word_key").agg(F.min_by("source_first_sentence", "source_idx").alias("first"))
    out = words.join(lines, ["word_key", "word_hash"], "left").join(first, "word_key", "left")
    return out.withColumn("definition", F.coalesce(F.nullif("pocket", F.lit("")), "first")).drop("pocket", "first").where("definition <> ''")
