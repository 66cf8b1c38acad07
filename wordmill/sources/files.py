"""Files that workers open themselves, on any file system that Arrow and Spark both name."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    # names that Hadoop has for stores which Arrow names otherwise
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, size) of the files that ``path`` names (a file, a folder or a pattern), by name; hidden ones and markers are left out."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(pattern) or []:
        inner = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [(s.getPath().toString(), s.getLen()) for s in inner if s.isFile() and s.getPath().getName()[0] not in "._"]
    if not found and not fs.globStatus(pattern):
        raise FileNotFoundError(path)
    return sorted(found)


def write_file(path: str, data: bytes) -> None:
    """Write a whole file under its name at once, so that a task that is tried again just replaces it."""
    fs, at = filesystem(path)
    fs.create_dir(os.path.dirname(at), recursive=True)
    part = f"{at}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    fs.move(part, at)


def mapped(path: str) -> mmap.mmap:
    """A file in memory, without reading it: mapped where its store is mounted, else from a copy without a name, which goes when it isn't
    used any more."""
    fs, at = filesystem(path)
    if isinstance(fs, pafs.LocalFileSystem):
        with open(at, "rb") as f:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    with tempfile.TemporaryFile() as copy:
        with fs.open_input_stream(at, compression=None) as src:
            while block := src.read(1 << 22):
                copy.write(block)
        copy.flush()
        return mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ)
