"""A build over a folder of tables: ingest an extract, plan the update, make lines, export, publish, report.

Every step reads Parquet and writes the partition of its extract whole, and an extract counts only once its row is in
the ledger, which is written last. So a step that is run again, or was cut off, just replaces what it wrote.
"""

from __future__ import annotations

import hashlib
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import delta, enhance, export, forms, lexicon, load, snapshot, state
from ..operators.buckets import BucketTable
from ..sources import entries
from ..sources.files import filesystem, write_file
from .config import Settings


class Store:
    """Tables of a build below one folder, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def read(self, table: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(table)) if self._exists(self.path(table)) else self.spark.createDataFrame([], schema)

    def extract(self, table: str, schema, extract_id: int | None) -> DataFrame:
        """One extract's partition, read alone."""
        path = f"{self.path(table)}/extract_id={extract_id}"
        bare = type(schema)([f for f in schema.fields if f.name != "extract_id"])
        if extract_id is None or not self._exists(path):
            return self.spark.createDataFrame([], bare)
        return self.spark.read.schema(bare).parquet(path)

    def write_extract(self, df: DataFrame, table: str, extract_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path(table)}/extract_id={extract_id}")

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(self.path(table))

    def published(self) -> BucketTable:
        """What each target has; upserted in place."""
        return BucketTable(self.spark, self.path("published_state"), S.PUBLISHED_STATE, ["target"], 1)

    def runs(self) -> DataFrame:
        return state.last_status(self.read("extract_runs", S.EXTRACT_RUNS), "id", "completed_at")

    def latest(self, n: int = 2) -> list[int]:
        """Ids of the last complete extracts; a ledger of a few rows."""
        return [r["id"] for r in state.complete_runs(self.runs(), n).select("id").collect()]


def file_digest(spark: SparkSession, path: str) -> tuple[str, int]:
    """SHA-256 and size of one file, wherever Spark reads it."""
    found = entries.file_facts(spark, path).select("sha256", "file_size").collect()
    if not found:  # Spark's reader skips a file without bytes
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        status = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p)
        if status.isFile():
            return hashlib.sha256().hexdigest(), 0
    if len(found) != 1:
        raise ValueError(f"{path} is {len(found)} files, not one")
    return found[0]["sha256"], found[0]["file_size"]


def run(spark: SparkSession, settings: Settings, make: enhance.Synthesizer, limit: int = 0, now: int | None = None) -> dict:
    """A whole build by its settings: the input is ingested, missing lines are made with so many words and tries, and words, definitions and the
    lexicon's files are written."""
    store = Store(spark, settings.state)
    ingest(store, settings.input, now, settings.max_defs)
    told = plan_update(store)
    told |= enhance_changed(store, make, settings.max_total_words, limit, now=now, tries=max(1, settings.max_retry_count))
    told |= export_current(store)
    return told | {"lexicon": write_lexicon(store, settings.output)}


def ingest(store: Store, path: str, now: int | None = None, max_defs: int = 0) -> int:
    """The id of the extract of a file; a file whose content is in already isn't read again. Lines keep their exact numbers, and a gzipped file is
    read by many tasks; a run that comes after one that was cut off finds the file's index of lines by its content."""
    now = int(time.time()) if now is None else now
    sha, size = file_digest(store.spark, path)
    done = store.runs().where((F.col("sha256") == sha) & (F.col("status") == "complete")).select("id").first()
    if done:
        return done["id"]
    known = store.runs().where(F.col("sha256") == sha).select("id").first()
    top = store.runs().agg(F.max("id")).first()[0] or 0
    extract_id = known["id"] if known else top + 1

    def note(status: str, notes: str | None = None) -> None:
        row = (extract_id, f"sha256:{sha[:16]}", path, size, sha, status, S.BUILDER_VERSION, now, now + (status != "running"), notes)
        store.append(store.spark.createDataFrame([row], S.EXTRACT_RUNS), "extract_runs")

    note("running")
    try:
        kept = entries.gated(entries.parse(entries.read_lines(store.spark, path, f"{store.path('line_index')}/{sha}")))
        if max_defs > 0:
            kept = kept.withColumn("defs", F.slice("defs", 1, max_defs))
        store.write_extract(kept, "entries", extract_id)
        kept = store.spark.read.schema(kept.schema).parquet(f"{store.path('entries')}/extract_id={extract_id}")
        store.write_extract(snapshot.source_definitions(entries.exploded(kept)), "source_definitions", extract_id)
        definitions = store.extract("source_definitions", S.SOURCE_DEFINITIONS, extract_id)
        store.write_extract(snapshot.source_words(kept, definitions), "source_words", extract_id)
    except Exception:
        note("failed", "ingest_failed")
        raise
    note("complete")
    return extract_id


def plan_update(store: Store) -> dict:
    ids = store.latest(2)
    if not ids:
        return {}
    new_id, prior_id = ids[0], ids[1] if len(ids) > 1 else None
    new, prior = (store.extract("source_words", S.SOURCE_WORDS, i) for i in (new_id, prior_id))
    definitions = store.extract("source_definitions", S.SOURCE_DEFINITIONS, new_id)
    cache = store.read("enhanced_words", S.ENHANCED_WORDS)
    store.write_extract(snapshot.word_snapshots(new, prior, definitions, cache), "word_snapshots", new_id)
    rows = store.extract("word_snapshots", S.WORD_SNAPSHOTS, new_id)
    return {"extract_id": new_id, "prior_extract_id": prior_id} | snapshot.plan_report(rows, new, prior).first().asDict()


def enhance_changed(store: Store, make: enhance.Synthesizer, most_words: int = 25, limit: int = 0, dry_run: bool = False, now: int | None = None, tries: int = 1, at_once: int = 1) -> dict:
    """Make the missing lines of the latest extract; returns numbers made and reused. Answers are stored as they come, so a run that failed
    midway goes on where it was."""
    (new_id,) = store.latest(1)
    words, definitions = store.extract("source_words", S.SOURCE_WORDS, new_id), store.extract("source_definitions", S.SOURCE_DEFINITIONS, new_id)
    cache = store.read("enhanced_words", S.ENHANCED_WORDS)
    reused = snapshot.with_accepted(words, cache).where("has_pocket").count()
    if dry_run:
        return {"to_do": enhance.work_list(words, definitions, cache, most_words, limit).count(), "reused": reused}
    before = cache.count()
    answers = enhance.Answers(store.path("answers"))
    store.append(enhance.enhance(words, definitions, cache, make, most_words, int(time.time()) if now is None else now, limit, tries, answers=answers, at_once=at_once), "enhanced_words")
    answers.clear()
    cache = store.read("enhanced_words", S.ENHANCED_WORDS)
    snaps = store.extract("word_snapshots", S.WORD_SNAPSHOTS, new_id)
    store.write_extract(enhance.after_run(snaps, words, cache), "word_snapshots_done", new_id)
    return {"enhanced": cache.count() - before, "reused": reused}


def export_current(store: Store) -> dict:
    """Write words and definitions of the latest extract, all and those of letters alone."""
    (new_id,) = store.latest(1)
    words, definitions = store.extract("source_words", S.SOURCE_WORDS, new_id), store.extract("source_definitions", S.SOURCE_DEFINITIONS, new_id)
    cache = store.read("enhanced_words", S.ENHANCED_WORDS)
    links = forms.resolve_chains(forms.form_links(definitions))
    out_words, out_definitions = export.export(enhance.resolve(words, definitions, cache), links)
    store.write_extract(out_words, "export/words", new_id)
    store.write_extract(out_definitions, "export/definitions", new_id)
    out_words, out_definitions = exported(store, new_id)
    pure_words, pure_definitions = export.pure(out_words, out_definitions)
    store.write_extract(pure_words, "pure/words", new_id)
    store.write_extract(pure_definitions, "pure/definitions", new_id)
    return {"words": out_words.count(), "definitions": out_definitions.count(), "pure_words": exported(store, new_id, "pure")[0].count()}


def exported(store: Store, extract_id: int | None, kind: str = "export") -> tuple[DataFrame, DataFrame]:
    return store.extract(f"{kind}/words", S.WORDS, extract_id), store.extract(f"{kind}/definitions", S.DEFINITIONS, extract_id)


def publish_plan(store: Store, target: str = "d1") -> tuple[dict, DataFrame, DataFrame]:
    """Meta (mode skip, full or delta, and counts) and the statements for definitions and words, against what the
    target has."""
    (new_id,) = store.latest(1)
    has = store.published().read().where(F.col("target") == target).agg(F.max("extract_id")).first()[0]
    mode = "skip" if has == new_id else "full" if has is None else "delta"
    words, definitions = exported(store, new_id, "pure")
    old_words, old_definitions = exported(store, new_id if mode == "skip" else has, "pure")
    word_ops, definition_ops = delta.word_changes(words, old_words), delta.definition_changes(definitions, old_definitions)
    meta = delta.delta_meta(word_ops, definition_ops, mode).first().asDict()
    return meta, delta.definition_sql(definition_ops, "definitions"), delta.word_sql(word_ops, "words")


def write_load(store: Store, folder: str, target: str = "d1", size: int = load.CHUNK) -> dict:
    """The statements of :func:`publish_plan` as numbered chunks below ``folder``, which :func:`load.send` sends; meta with their numbers."""
    meta, definitions, words = publish_plan(store, target)
    rows = load.chunks(definitions, "definitions", ["id", "statement"], size).unionByName(load.chunks(words, "words", ["word", "statement"], size))
    return meta | load.write_chunks(rows, folder)


def mark_published(store: Store, target: str, version: str, now: int | None = None) -> None:
    (new_id,) = store.latest(1)
    row = (target, new_id, int(time.time()) if now is None else now, version)
    published = store.published()
    published.upsert(store.spark.createDataFrame([row], S.PUBLISHED_STATE))
    published.vacuum()


def status(store: Store) -> dict:
    return state.pipeline_status(store.runs(), store.published().read()).first().asDict()


def report(store: Store) -> DataFrame:
    (new_id,) = store.latest(1)
    words, definitions = store.extract("source_words", S.SOURCE_WORDS, new_id), store.extract("source_definitions", S.SOURCE_DEFINITIONS, new_id)
    snaps = store.extract("word_snapshots", S.WORD_SNAPSHOTS, new_id)
    return state.build_report(state.complete_runs(store.runs(), 1), words, definitions, snaps, store.read("enhanced_words", S.ENHANCED_WORDS), exported(store, new_id)[0], exported(store, new_id, "pure")[0])


def write_lexicon(store: Store, folder: str) -> dict:
    """The WTRI file, its JavaScript module and a manifest in a folder of any file system."""
    (new_id,) = store.latest(1)
    words, _ = exported(store, new_id, "pure")
    fs, at = filesystem(folder)
    fs.create_dir(at, recursive=True)
    told = lexicon.write_wtri(lexicon.radix_of_words(words), f"{folder}/lexicon.trie")
    manifest = {"format": "WTRI", "version": lexicon.VERSION, "extract_id": new_id} | told
    lexicon.write_js_module(f"{folder}/lexicon.trie", f"{folder}/lexicon.js")
    write_file(f"{folder}/manifest.json", json.dumps(manifest, indent=2).encode())
    return manifest
