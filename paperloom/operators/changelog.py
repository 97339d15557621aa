"""Current state of a table from its change rows.

The winner of a key is the change with the greatest ``(file_name, is_delete,
pos)``. Taking the greatest is associative, so arrival order, partitioning and
repeated delivery do not matter, and map-side combining leaves one row per key
and task even for a key that holds most of the changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.schemas import CHANGE_ORDER, CHANGES
from paperloom.session import list_names


def last_changes(changes: DataFrame, key: str = "pmid", order: list[str] | None = None) -> DataFrame:
    """The winning change of every key, deletes included."""
    order = order or CHANGE_ORDER
    others = [c for c in changes.columns if c != key]
    winner = F.max_by(F.struct(*others), F.struct(*order)).alias("_w")
    return changes.groupBy(key).agg(winner).select(key, *[f"_w.{c}" for c in others])


def live_rows(changes: DataFrame, key: str = "pmid", order: list[str] | None = None) -> DataFrame:
    """Rows that exist after all changes, without the change bookkeeping."""
    kept = last_changes(changes, key, order).filter(F.col("is_delete") == 0)
    return kept.drop("is_delete")


def upsert(target: DataFrame, delta: DataFrame, key: str = "pmid") -> DataFrame:
    """Winning changes of an already compacted table and other change rows.

    The table is read whole once, each row beside the delta's last change of its
    key, of which the greater one stays; keys that only the delta has are found by
    a scan of the key alone. Nothing of the table is shuffled whenever the delta
    is small enough for Spark to broadcast.
    """
    others = [c for c in target.columns if c != key]
    latest = last_changes(delta, key).select(key, F.struct(*others).alias("_new"))
    beside = target.select(key, F.struct(*others).alias("_old")).join(latest, key, "left")
    order = lambda row: F.struct(*[F.col(f"{row}.{c}") for c in CHANGE_ORDER])
    newer = F.col("_new").isNotNull() & (order("_new") > order("_old"))
    known = beside.select(key, F.when(newer, F.col("_new")).otherwise(F.col("_old")).alias("_w"))
    added = latest.join(target.select(key), key, "left_anti").withColumnRenamed("_new", "_w")
    whole = known.unionByName(added).select(key, *[f"_w.{c}" for c in others])
    return whole.select(*target.columns)


def last_value_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Map built in row order: a repeated key keeps its last value."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def delete_by_ids(articles: DataFrame, ids: DataFrame, key: str = "pmid") -> DataFrame:
    return articles.join(ids.select(key), key, "left_anti")


class ArticleStore:
    """Article table as a folder of change batches and compacted snapshots.

    A batch costs what it holds: it is appended under its own number, and a
    repeated batch replaces itself. ``compact`` folds all batches into a new
    snapshot; a snapshot counts once its job has committed, so a lost job
    leaves the previous state in place.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def batches(self) -> list[int]:
        names = list_names(self.spark, f"{self.folder}/changes")
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))

    def snapshot_version(self) -> int | None:
        """Last batch contained in the newest complete snapshot."""
        versions = [
            int(n.split("=")[1])
            for n in list_names(self.spark, f"{self.folder}/snapshots")
            if n.startswith("version=")
            and "_SUCCESS" in list_names(self.spark, f"{self.folder}/snapshots/{n}")
        ]
        return max(versions) if versions else None

    def append(self, changes: DataFrame, batch: int | None = None) -> int:
        """Add a batch of change rows; the default number follows the last one."""
        if batch is None:
            known = [*self.batches(), self.snapshot_version() or 0]
            batch = max(known) + 1
        rows = last_changes(changes.select(*CHANGES.names))
        rows.write.mode("overwrite").parquet(f"{self.folder}/changes/batch={batch}")
        return batch

    def _read(self, parts: list[str]) -> DataFrame:
        return self.spark.read.schema(CHANGES).parquet(*[f"{self.folder}/{p}" for p in parts])

    def _last_changes(self) -> DataFrame:
        """Winning changes of the newest snapshot and the batches after it."""
        version = self.snapshot_version()
        newer = [f"changes/batch={b}" for b in self.batches() if version is None or b > version]
        if version is None:
            if not newer:
                return self.spark.createDataFrame([], CHANGES)
            return last_changes(self._read(newer))
        snapshot = self._read([f"snapshots/version={version}"])
        return upsert(snapshot, self._read(newer)) if newer else snapshot

    def articles(self) -> DataFrame:
        """One row per living article."""
        living = self._last_changes().filter(F.col("is_delete") == 0)
        return living.drop("is_delete", "file_name", "pos")

    def compact(self) -> int | None:
        """Write a snapshot holding everything so far; deletes stay as tombstones."""
        batches = self.batches()
        if not batches or batches[-1] == self.snapshot_version():
            return self.snapshot_version()
        target = f"{self.folder}/snapshots/version={batches[-1]}"
        self._last_changes().write.mode("overwrite").parquet(target)
        return batches[-1]

    def upsert(self, changes: DataFrame) -> int:
        """Append and compact: the new state is one snapshot."""
        self.append(changes)
        return self.compact()
