"""Tables that a query writes on its way, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where that is unset, a folder of our own is taken in local mode; on a cluster
    that is an error, as a machine's own folder isn't seen by the others."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="wordmill-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


class Scratch:
    """A folder of its own below the shared one, which goes with the session's JVM. ``keep`` writes a table and reads it back, so
    nothing before it is computed again; ``drop`` removes tables that aren't read any more."""

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
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            fs, path = self._hadoop(f"{self.path}/{name}")
            fs.delete(path, True)
