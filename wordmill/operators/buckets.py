"""Tables that are upserted in place: rows lie in buckets of their key's hash, and only buckets that a change touches are written again.

A manifest a version says which folder each bucket's rows are in. It's written last, whole, under a name of its own, so a run that was
cut off leaves the version before, and readers of an older version keep it until ``vacuum``. One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BUCKET = "bucket_no"


class BucketTable:
    """A table below ``root``, on any file system of Spark, with one row a key (``keys``; null is a key as any other).

    The number of buckets is fixed by the first write. Parquet files that lie in ``root`` itself, of a table that was written plainly,
    are taken over by the first upsert.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], buckets: int = 64):
        if _BUCKET in schema.names:
            raise ValueError(f"a column named {_BUCKET}")
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self.buckets = (self.manifest() or {"buckets": buckets})["buckets"]

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def versions(self) -> list[int]:
        fs, at = self._fs(f"{self.root}/_manifests")
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        """version, buckets (their number), folders (by bucket) of a version, the last one by default."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return None
        return json.loads(self.spark.read.text(f"{self.root}/_manifests/{version:012d}.json", wholetext=True).first()[0])

    def _plain(self) -> bool:
        fs, at = self._fs(self.root)
        return fs.exists(at) and any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(at))

    def _folders(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        told = self.manifest(version)
        if told is None and self._plain():
            return self.spark.read.schema(self.schema).parquet(self.root)
        return self._folders(sorted(told["folders"].values()) if told else [])

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def upsert(self, rows: DataFrame, order: list[str] | None = None, deletes: str | None = None) -> int:
        """The new version after each key of ``rows`` got its row: the last one by ``order`` and then by all columns, if it has several. Where the
        boolean column ``deletes`` is true the key goes. Rows without a change make no version; the number of the last one comes back."""
        told = self.manifest() or {"version": 0, "folders": {}}
        took_over = not told["version"] and self._plain()
        run = f"data/{told['version'] + 1:012d}-{uuid.uuid4().hex[:12]}"
        changes = rows.select(*self.schema.names, (F.coalesce(F.col(deletes), F.lit(False)) if deletes else F.lit(False)).alias("is_gone"), F.struct(*(order or [])).alias("comes") if order else F.lit(0).alias("comes"))
        rest = [c for c in self.schema.names if c not in self.keys]
        # the winners are written once, so that all that is read from them is of one and the same evaluation
        last = changes.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "is_gone"), F.struct("comes", "is_gone", *[F.to_json(F.struct(c)) for c in rest])).alias("last"))
        last = last.select(*self.keys, "last.*").withColumn(_BUCKET, self._bucket())
        last.write.parquet(f"{self.root}/{run}-changes")
        last = self.spark.read.schema(last.schema).parquet(f"{self.root}/{run}-changes")
        touched = {r[0] for r in last.select(_BUCKET).distinct().collect()}  # as many as there are buckets
        if took_over:
            old, touched = self.spark.read.schema(self.schema).parquet(self.root), set(range(self.buckets))
        else:
            old = self._folders([f for b, f in sorted(told["folders"].items()) if int(b) in touched])
        if touched:
            match = None
            for k in self.keys:
                here = old[k].eqNullSafe(last[k])
                match = here if match is None else match & here
            kept = old.join(last, match, "left_anti").withColumn(_BUCKET, self._bucket())
            merged = kept.unionByName(last.where("not is_gone").drop("is_gone"))
            merged.repartition(F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(f"{self.root}/{run}")
        self._delete(f"{run}-changes")
        if not touched:
            return told["version"]
        folders = {b: f for b, f in told["folders"].items() if int(b) not in touched}
        fs, at = self._fs(f"{self.root}/{run}")
        written = [s.getPath().getName() for s in fs.listStatus(at)]
        folders |= {n.partition("=")[2]: f"{run}/{n}" for n in written if n.startswith(f"{_BUCKET}=")}
        self._commit({"version": told["version"] + 1, "buckets": self.buckets, "folders": folders})
        return told["version"] + 1

    def _commit(self, told: dict) -> None:
        name = f"{self.root}/_manifests/{told['version']:012d}.json"
        fs, at = self._fs(name)
        _, part = self._fs(f"{name}.{uuid.uuid4().hex}")
        out = fs.create(part)
        out.write(bytearray(json.dumps(told).encode()))
        out.close()
        if fs.exists(at) or not fs.rename(part, at):
            fs.delete(part, False)
            raise RuntimeError(f"version {told['version']} of {self.root} is there already: another writer was faster")

    def _delete(self, folder: str) -> None:
        fs, at = self._fs(f"{self.root}/{folder}")
        fs.delete(at, True)

    def vacuum(self, keep: int = 1) -> None:
        """Delete all but the last ``keep`` versions, and folders that no version names, those of runs that were cut off among them. Not
        while another run writes."""
        versions = self.versions()
        stay = versions[-max(1, keep) :]
        used = {f.rpartition("/")[0] for v in stay for f in self.manifest(v)["folders"].values()}
        for v in versions:
            if v not in stay:
                self._delete(f"_manifests/{v:012d}.json")
        fs, at = self._fs(f"{self.root}/data")
        for status in fs.listStatus(at) if stay and fs.exists(at) else []:
            if f"data/{status.getPath().getName()}" not in used:
                fs.delete(status.getPath(), True)
        fs, at = self._fs(self.root)
        for status in fs.listStatus(at) if stay and fs.exists(at) else []:  # a plain table that was taken over
            if status.getPath().getName().endswith(".parquet"):
                fs.delete(status.getPath(), False)
