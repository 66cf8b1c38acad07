"""Loading a serving database: statements in numbered chunks, definitions before words, each chunk written and sent once.

The data source ``statement_chunks`` writes a file a chunk. What a task wrote counts when the job commits: the manifest, written last, names
each task's folder, so what a lost or repeated attempt left behind isn't read. Sending a chunk leaves a mark beside it; one that
has its mark isn't sent again, whichever run or attempt comes next.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..sources.files import filesystem, write_file
from .ordered import numbered

#: Statements of a chunk.
CHUNK = 5000
#: What is loaded, in this order, as words refer to definitions.
PARTS = ("definitions", "words")
_MANIFEST = "_chunks.json"


def chunks(statements: DataFrame, part: str, order: list[str], size: int = CHUNK) -> DataFrame:
    """part, chunk (from 0), place (in the chunk), statement. ``order`` has to tell the rows of ``statements`` apart for runs to agree."""
    number = numbered(statements, order, "statement_no")
    return number.select(F.lit(part).alias("part"), F.floor(F.col("statement_no") / size).cast("long").alias("chunk"), (F.col("statement_no") % size).cast("int").alias("place"), "statement")


@dataclass
class _Written(WriterCommitMessage):
    folder: str
    chunks: int
    statements: int


class _ChunkWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, rows: Iterator) -> _Written:
        """A file for each chunk, in a folder of this attempt. Rows come sorted by part, chunk and place, and go out as they come."""
        folder, done, total, at, place, out = uuid.uuid4().hex, 0, 0, None, 0, None
        fs, root = filesystem(f"{self.path}/{folder}")
        try:
            for row in rows:
                if (row["part"], row["chunk"]) != at:
                    if out is not None:
                        out.close()
                    else:
                        fs.create_dir(root, recursive=True)
                    at, place, done = (row["part"], row["chunk"]), 0, done + 1
                    out = fs.open_output_stream(f"{root}/{at[0]}-{at[1]:09d}.sql", compression=None, buffer_size=1 << 20)
                if row["place"] != place:
                    raise ValueError(f"place {row['place']} of chunk {at} came as number {place}")
                out.write(row["statement"].encode() + b"\n")
                place, total = place + 1, total + 1
        finally:
            if out is not None:
                out.close()
        return _Written(folder, done, total)

    def commit(self, messages: list[_Written | None]) -> None:
        told = [m for m in messages if m is not None and m.chunks]
        write_file(f"{self.path}/{_MANIFEST}", json.dumps({"folders": sorted(m.folder for m in told), "chunks": sum(m.chunks for m in told), "statements": sum(m.statements for m in told)}).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        for m in messages:
            if m is not None and m.chunks:
                fs, at = filesystem(f"{self.path}/{m.folder}")
                fs.delete_dir(at)


class StatementChunks(DataSource):
    """``df.write.format("statement_chunks").save(path)`` of rows as :func:`chunks` gives them, dealt by chunk and sorted."""

    @classmethod
    def name(cls) -> str:
        return "statement_chunks"

    def writer(self, schema, overwrite: bool) -> _ChunkWriter:
        if "path" not in self.options:
            raise ValueError("statement_chunks needs a path")
        return _ChunkWriter(self.options["path"])


def write_chunks(rows: DataFrame, path: str) -> dict:
    """Write chunks below ``path``; statements are one line each. Gives the numbers of chunks and statements."""
    rows.sparkSession.dataSource.register(StatementChunks)
    dealt = rows.repartition("part", "chunk").sortWithinPartitions("part", "chunk", "place")
    dealt.write.format("statement_chunks").mode("append").save(path)
    told = manifest(path)
    return {k: told[k] for k in ("chunks", "statements")}


def manifest(path: str) -> dict:
    fs, at = filesystem(f"{path.rstrip('/')}/{_MANIFEST}")
    with fs.open_input_stream(at, compression=None) as f:
        return json.loads(f.read())


_FILES = "part string, chunk long, file string"


def chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """part, chunk, file of what was committed; each task's folder is listed by a task."""
    path = path.rstrip("/")
    folders = manifest(path)["folders"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for folder in pdf["folder"]:
                fs, at = filesystem(f"{path}/{folder}")
                names = [i.base_name for i in fs.get_file_info(pafs.FileSelector(at)) if i.base_name.endswith(".sql")]
                parts = [n[:-4].rpartition("-") for n in names]
                yield pd.DataFrame({"part": [p[0] for p in parts], "chunk": [int(p[2]) for p in parts], "file": [f"{path}/{folder}/{n}" for n in names]})

    return spark.createDataFrame([(f,) for f in folders], "folder string").mapInPandas(run, _FILES)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """part, chunk, statements (an array, in order) of what was committed, read back from the files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, chunk, file in pdf.itertuples(index=False):
                yield pd.DataFrame({"part": [part], "chunk": [chunk], "statements": [_text(file)[:-1].split("\n")]})

    return chunk_files(spark, path).mapInPandas(run, "part string, chunk long, statements array<string>")


def _text(file: str) -> str:
    fs, at = filesystem(file)
    with fs.open_input_stream(at, compression=None) as f:
        return f.read().decode()


def send(spark: SparkSession, path: str, execute: Callable[[str], None], tasks: int = 4) -> dict:
    """Send all chunks that have no mark yet through ``execute`` (a chunk's statements, as one script), ``tasks`` at a time: first definitions,
    then words. Gives the number of chunks sent by part.

    A mark follows the answer, so after a loss between the two a chunk is sent once more; statements that replace rows allow that. A chunk that
    fails fails the run, and the next run goes on with what has no mark.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sent = 0
            for file in pdf["file"]:
                fs, at = filesystem(f"{file}.sent")
                if fs.get_file_info(at).type == pafs.FileType.NotFound:
                    execute(_text(file))
                    write_file(f"{file}.sent", b"")
                    sent += 1
            yield pd.DataFrame({"sent": [sent]})

    files, told = chunk_files(spark, path), {}
    for part in PARTS:
        todo = files.where(F.col("part") == part).repartitionByRange(tasks, "chunk").sortWithinPartitions("chunk")
        told[part] = todo.select("file").mapInPandas(run, "sent long").agg(F.coalesce(F.sum("sent"), F.lit(0))).first()[0]
    return told
