"""Entries that arrive as files in a folder, and the words and definitions that they make, kept as they come.

:func:`stream_entries` keeps the entries of each micro-batch, whole under its number, so one that is run again after a failure replaces itself.
:func:`stream_words` goes on to numbered definitions: for each word Spark's state holds the definitions it has had, the next number and
the form that is shown, so a micro-batch is compared with nothing but the state of its own words. Micro-batches take files in order of their names,
whenever each was modified, and within one rows go in order of file name and line; so as long as no file comes whose name is before one that an
earlier run took, any cut of them into micro-batches gives what one batch over all files gives, numbers included.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import hashing as H
from ..functions import text as T
from ..sources import entries, lines
from ..sources.files import filesystem, list_files, write_file

#: Lines of one file are numbered in the low bits, files that were modified together are told apart by name.
LINES = "file string, line_no long, value string"


def _file_lines(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            found: list[str] = []
            number = 0
            for line in lines.whole_file(path):
                found.append(line)
                if len(found) == 4096:
                    yield _rows(path, number, found)
                    number, found = number + len(found), []
            if found:
                yield _rows(path, number, found)


def _rows(path: str, number: int, values: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(values)), pa.array(range(number, number + len(values)), pa.int64()), pa.array(values, pa.string())], ["file", "line_no", "value"])


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """file, line_no (from 0 in each file), value of files as they arrive; a file is read by one task, plain or gzipped."""
    # contents aren't asked for here, so Spark only lists the files
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch).load(folder).select("path")
    return files.mapInArrow(_file_lines, LINES)


def _turns(folder: str) -> list[list[str]]:
    """The files of each turn that a run has written to ``folder``, in order."""
    fs, at = filesystem(folder)
    found = []
    for info in sorted(fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)), key=lambda i: i.base_name):
        if info.base_name.endswith(".txt"):
            with fs.open_input_stream(info.path, compression=None) as f:
                found.append(f.read().decode().splitlines())
    return found


def _lines_by_name(spark: SparkSession, folder: str, turns: str, files_per_batch: int) -> DataFrame:
    """As :func:`stream_lines`, in order of the files' names. Spark takes files as they were modified, which tasks that write at the same time leave to
    chance; so it is handed lists of ``files_per_batch`` names each, which are written to ``turns`` one after the other."""
    known = _turns(turns)
    taken = {path for turn in known for path in turn}
    names = [path for path, _ in list_files(spark, folder) if path not in taken]
    filesystem(turns)[0].create_dir(filesystem(turns)[1], recursive=True)
    for n, start in enumerate(range(0, len(names), files_per_batch), len(known)):
        write_file(f"{turns}/{n:09d}.txt", "\n".join(names[start : start + files_per_batch]).encode())
        time.sleep(0.002)  # file times have milliseconds
    lists = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(turns)
    found = lists.select(F.col("value").alias("path")).repartition(files_per_batch).mapInArrow(_file_lines, LINES)
    return found.repartition(_tasks(spark), "file", "line_no")  # what is made of a file's lines is all tasks' work


def _tasks(spark: SparkSession) -> int:
    """Partitions of a micro-batch: what can run at a time, as each one costs its start and a commit of its state however few rows it has."""
    return max(1, min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _parsed(rows: DataFrame) -> DataFrame:
    """Kept entries of lines (file, line_no, value), with the file."""
    keyed = rows.select(F.struct("file", "line_no").alias("line_no"), "value")
    return entries.gated(entries.parse(keyed))


def stream_entries(spark: SparkSession, folder: str, table: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Read all files that are there, batch after batch, then stop; start it again for those that came meanwhile."""

    def keep(batch: DataFrame, number: int) -> None:
        _parsed(batch).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream_lines(spark, folder, files_per_batch).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_entries(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table).drop("batch")


# ------------------------------------------------------------ words by state

_OUT = "kind string, word_key string, definition_key string, source_idx int, pos string, source_first_sentence string, source_hash string, normalized_source string, display_word string, language_code string"
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


_FOUND = "word_key string, kind string, name string, " + _OUT.split(", ", 2)[2].replace("source_idx int, ", "") + ", casing_rank int, file string, line long, ordinal int"
_ORDER = ["file", "line", "ordinal"]


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each (word_key, kind, name) that a task has of a micro-batch."""
    kept, held = None, []

    def first_of(parts: list) -> pa.Table:
        rows = pa.concat_tables(parts).sort_by([(c, "ascending") for c in _ORDER])
        places = rows.append_column("at", pa.array(range(rows.num_rows), pa.int64()))
        return rows.take(places.group_by(["word_key", "kind", "name"]).aggregate([("at", "min")]).column("at_min")).combine_chunks()

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(part.num_rows for part in held) > max(1 << 16, kept.num_rows if kept is not None else 0):
            kept, held = first_of([kept, *held] if kept is not None else held), []
    if kept is not None:
        held.append(kept)
    if held:
        yield from first_of(held).to_batches(max_chunksize=4096)


class WordState(StatefulProcessor):
    """A word's next number and the casing rank of the form that is shown, the first of the lowest. What comes is new to the word."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.word = handle.getValueState("word", "next_idx int, casing_rank int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        parts = [part for part in rows if len(part)]
        if not parts:
            return
        new = pd.concat(parts).sort_values(_ORDER, kind="stable").reset_index(drop=True)
        next_idx, rank = map(int, self.word.get()) if self.word.exists() else (0, 1 << 30)
        kept = new["kind"] == "definition"
        new["source_idx"] = (next_idx - 1 + kept.cumsum()).astype("Int32").where(kept)
        next_idx += int(kept.sum())
        forms = new[~kept]
        if len(forms) and (best := int(forms["casing_rank"].min())) < rank:
            rank = best
            kept[forms["casing_rank"].idxmin()] = True  # the first of the lowest
        self.word.update((next_idx, rank))
        if kept.any():
            yield new.loc[kept, _NAMES].assign(word_key=key[0])

    def close(self) -> None:
        pass


def _new(rows: DataFrame, tasks: int) -> DataFrame:
    """Definitions and forms that a word hasn't had, the first of each. That is asked by word and name, so a word with many is all tasks' work."""
    nothing = F.lit(None).cast("string")
    of_definition = F.struct(F.lit("definition").alias("kind"), F.col("definition_key").alias("name"), "definition_key", "pos", "source_first_sentence", "source_hash", "normalized_source", nothing.alias("display_word"), nothing.alias("language_code"))
    of_word = F.struct(F.lit("word").alias("kind"), F.col("word").alias("name"), *[nothing.alias(c) for c in ("definition_key", "pos", "source_first_sentence", "source_hash", "normalized_source")], F.col("word").alias("display_word"), F.col("lang_code").alias("language_code"))
    both = F.when(F.length("source_first_sentence") > 0, F.array(of_definition, of_word)).otherwise(F.array(of_word))
    rows = rows.select("word_key", F.explode(both).alias("of"), "casing_rank", *_ORDER).select("word_key", "of.*", "casing_rank", *_ORDER)
    named = ["word_key", "kind", "name"]
    return rows.select([c.split()[0] for c in _FOUND.split(", ")]).repartition(tasks, *named).mapInArrow(_firsts, _FOUND).dropDuplicates(named)


def stream_words(spark: SparkSession, folder: str, table: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Definitions and shown forms of files as they arrive, by name, appended to ``table``; all that is there, then it stops. What is taken when is
    written beside ``checkpoint``. Needs the RocksDB state store, which is set where the session names none."""
    rows = entries.exploded(_parsed(_lines_by_name(spark, folder, f"{checkpoint.rstrip('/')}-turns", files_per_batch)))
    sentence = T.first_sentence("gloss")
    rows = rows.select(F.col("line_no.file").alias("file"), F.col("line_no.line_no").alias("line"), "ordinal", "word", F.coalesce("lang_code", F.lit("en")).alias("lang_code"), T.casing_rank("word").cast("int").alias("casing_rank"), T.normalize_word_key("word").alias("word_key"), "pos", F.coalesce(sentence, F.lit("")).alias("source_first_sentence"))
    rows = rows.withColumn("source_hash", H.hash_definition("word", "pos", "source_first_sentence")).withColumn("definition_key", H.definition_key("source_hash"))
    rows = rows.withColumn("normalized_source", T.normalize_for_hash("source_first_sentence")).withColumn("pos", T.normalize_pos("pos"))
    made = _new(rows, _tasks(spark)).groupBy("word_key").transformWithStateInPandas(WordState(), _OUT, "Append", "none")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    with _settings(spark):
        return made.writeStream.foreachBatch(keep).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    """A stream copies the session's settings when it starts. The number of state partitions stays as the checkpoint's first start had it."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    wanted = {"spark.sql.shuffle.partitions": str(_tasks(spark)), "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    if "RocksDB" not in spark.conf.get(provider, ""):
        wanted[provider] = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    had = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in had.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_definitions(spark: SparkSession, table: str) -> DataFrame:
    """The definitions of :func:`stream_words`, as the batch's ``source_definitions``."""
    return spark.read.parquet(table).where("kind = 'definition'").select("word_key", "definition_key", "source_idx", "pos", "source_first_sentence", "source_hash", "normalized_source")


def read_words(spark: SparkSession, table: str) -> DataFrame:
    """The words of :func:`stream_words`, as the batch's ``source_words``: the last form that was shown, and the hash of all definitions."""
    rows = spark.read.parquet(table)
    shown = rows.where("kind = 'word'").groupBy("word_key").agg(F.max_by(F.struct("display_word", "language_code"), "batch").alias("best")).select("word_key", "best.*")
    hashes = rows.where("kind = 'definition'").groupBy("word_key").agg(F.collect_list("source_hash").alias("hashes"))
    digest = F.when(F.col("hashes").isNull(), F.lit("")).otherwise(H.hash_word("word_key", "display_word", "hashes"))
    return shown.join(hashes, "word_key", "left").select("word_key", "display_word", "language_code", digest.alias("word_hash"), T.is_pure_alpha("word_key").alias("is_pure_alpha"))
