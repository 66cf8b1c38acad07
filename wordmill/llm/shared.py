"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import mmap
import os
import re
import sys
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder of our own is set in local mode (tests), and
    on a cluster that is an error, as a machine's own folder isn't seen by the others."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="wordmill-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


class Workspace:
    """A folder of its own below the shared root. ``keep`` writes a table and reads it back, which cuts the lineage:
    after the loss of an executor nothing before the table is computed again. ``drop`` removes what no result reads any
    more; the rest goes when the session's JVM ends, as results are computed when they are asked for."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        fs, path = self._hadoop(self.path)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _hadoop(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            fs, path = self._hadoop(f"{self.path}/{name}")
            fs.delete(path, True)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared path and the path in it; used by workers for files that aren't tables."""
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    # names that Hadoop has for stores which Arrow names otherwise
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def write_file(path: str, data: bytes) -> None:
    """Write a whole file under its name at once, so that a task that is tried again just replaces it."""
    fs, at = filesystem(path)
    fs.create_dir(os.path.dirname(at), recursive=True)
    part = f"{at}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    fs.move(part, at)


#: A mapping keeps no file open, so that a task can have any number of them; Python before 3.13 can't do without.
_NO_DESCRIPTOR = {"trackfd": False} if sys.version_info >= (3, 13) else {}


def mapped(path: str) -> bytes | mmap.mmap:
    """A shared file in memory, without reading it: mapped where the shared folder is mounted, else from a copy that has
    no name any more once it is mapped, so nothing stays on the worker's disk. No file, or an empty one: no bytes."""
    fs, at = filesystem(path)
    if fs.get_file_info(at).size in (None, 0):
        return b""
    if isinstance(fs, pafs.LocalFileSystem):
        with open(at, "rb") as f:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **_NO_DESCRIPTOR)
    with tempfile.TemporaryFile() as copy:
        with fs.open_input_stream(at, compression=None) as src:
            while block := src.read(1 << 22):
                copy.write(block)
        copy.flush()
        return mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ, **_NO_DESCRIPTOR)


def renamed(docs: DataFrame, *needed: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c0, c1 and so on after those that are ``needed`` by name, and the old name of each."""
    old = {f"c{i}": name for i, name in enumerate(docs.columns) if name not in needed}
    new = {name: key for key, name in old.items()}
    return docs.select(*[F.col(f"`{n}`").alias(new.get(n, n)) for n in docs.columns]), old


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
