"""State of a change feed in buckets by key, of which an upsert rewrites only those it touches.

A manifest names the folder that holds each bucket. An upsert writes new folders for
the buckets of its keys and then one new manifest, a single file that appears by a
rename: before it the old state stands, whatever was written; after it the new one does.
Folders that no manifest names any more can be removed by :meth:`BucketedState.unused`.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.operators.changelog import last_changes, upsert
from paperloom.session import list_names, publish_file, read_file

BUCKETS = 64


class BucketedState:
    """Winning change of every key, deletes included, as rows of ``schema`` in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, key: str = "pmid", buckets: int = BUCKETS, files_per_bucket: int = 1):
        self.spark, self.folder, self.schema, self.key = spark, folder.rstrip("/"), schema, key
        self.buckets, self.files_per_bucket = buckets, files_per_bucket

    def version(self) -> int:
        """Number of the newest manifest; 0 without one."""
        names = list_names(self.spark, f"{self.folder}/manifests")
        return max([int(n.removesuffix(".json")) for n in names if n.endswith(".json")], default=0)

    def paths(self) -> dict[int, str]:
        """Folder of each bucket that holds rows."""
        version = self.version()
        if not version:
            return {}
        whole = json.loads(read_file(self.spark, f"{self.folder}/manifests/{version}.json"))
        if whole["buckets"] != self.buckets:
            raise ValueError(f"the state has {whole['buckets']} buckets")
        return {int(b): path for b, path in whole["paths"].items()}

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{p}" for p in paths])

    def rows(self) -> DataFrame:
        return self._read(sorted(self.paths().values()))

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def upsert(self, changes: DataFrame) -> list[int]:
        """Apply change rows; gives the buckets that were rewritten. Late and repeated changes do no harm."""
        version, current = self.version() + 1, self.paths()
        incoming = f"{self.folder}/incoming/{version}"
        latest = last_changes(changes.select(*self.schema.names), self.key)
        latest.withColumn("_bucket", self._bucket()).write.mode("overwrite").parquet(incoming)
        delta = self.spark.read.parquet(incoming)
        touched = sorted(r[0] for r in delta.select("_bucket").distinct().collect())  # at most one row a bucket
        if not touched:
            return []
        old = self._read([current[b] for b in touched if b in current])
        new = upsert(old, delta.select(*self.schema.names), self.key).withColumn("_bucket", self._bucket())
        spread = F.pmod(F.xxhash64(F.lit(1), F.col(self.key)), F.lit(self.files_per_bucket))
        dealt = new.repartition(len(touched) * self.files_per_bucket, "_bucket", spread).sortWithinPartitions("_bucket", self.key)
        dealt.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/data/version={version}")
        paths = {**current, **{b: f"data/version={version}/_bucket={b}" for b in touched}}
        publish_file(self.spark, f"{self.folder}/manifests/{version}.json", json.dumps({"buckets": self.buckets, "paths": paths}))
        return touched

    def unused(self) -> list[str]:
        """Folders of buckets, relative to the state's, that the newest manifest does not name."""
        kept, found = set(self.paths().values()), []
        for name in list_names(self.spark, f"{self.folder}/data"):
            below = list_names(self.spark, f"{self.folder}/data/{name}")
            found += [f"data/{name}/{b}" for b in below if b.startswith("_bucket=") and f"data/{name}/{b}" not in kept]
        return found
