"""Vectors for new and changed articles as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperloom.embedding import pending_texts
from paperloom.session import exists

STORED = "pmid bigint, text_hash string, embedding array<float>, batch bigint"


def stored_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors written so far; an article re-embedded later counts once."""
    if not exists(spark, folder):
        return spark.createDataFrame([], STORED)
    rows = spark.read.schema(STORED).parquet(folder)
    newest = F.max_by(F.struct("text_hash", "embedding", "batch"), "batch").alias("v")
    return rows.groupBy("pmid").agg(newest).select("pmid", "v.*")


def stored_hashes(spark: SparkSession, folder: str, other_than: int) -> DataFrame:
    """``pmid, text_hash`` of the newest vectors outside one batch; no vector is read."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "pmid bigint, text_hash string")
    rows = spark.read.schema(STORED).parquet(folder).filter(F.col("batch") != other_than)
    return rows.groupBy("pmid").agg(F.max_by("text_hash", "batch").alias("text_hash"))


def embed_article_stream(
    texts: DataFrame,
    embed: Callable[[DataFrame], DataFrame],
    vector_folder: str,
    checkpoint: str,
) -> StreamingQuery:
    """Start a stream over ``texts(pmid, text)`` that embeds what is new, then stops.

    ``texts`` brings an article at most once per micro-batch. ``embed`` turns
    ``pmid, text_hash, text`` into ``pmid, text_hash, embedding``. A retried
    micro-batch overwrites its own part of the vector folder.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = stored_hashes(spark, vector_folder, batch_id)
        pending = pending_texts(batch.select("pmid", "text"), done)
        embed(pending).select("pmid", "text_hash", "embedding").write.mode("overwrite").parquet(
            f"{vector_folder}/batch={batch_id}"
        )

    return (
        texts.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
