"""Change files applied as they are published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from paperloom.operators.changelog import ArticleStore
from paperloom.sources.change_files import (
    fail_on_errors,
    number_chunks,
    parse_changes,
    read_text_stream,
    split_errors,
)


def apply_change_stream(
    spark: SparkSession,
    folder: str,
    store_folder: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    text_mode: str = "leading",
    first_delete_only: bool = False,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Start a stream that appends new files to the store and then stops.

    A retried micro-batch overwrites its own batch. Late files are safe: the
    store orders changes by file name, not by arrival. A micro-batch takes
    ``files_per_batch`` files, or as many as ``read_text_stream`` bounds by their
    size. Unreadable records go
    to the ``quarantine`` folder, or fail the stream when none is given.
    """
    store = ArticleStore(spark, store_folder)

    def append(batch: DataFrame, batch_id: int) -> None:
        number = batch_id + 1
        changes = parse_changes(number_chunks(batch), text_mode, first_delete_only)
        if quarantine is None:
            store.append(fail_on_errors(changes), number)
            return
        # One parse feeds both outputs.
        changes = changes.persist()
        try:
            readable, unreadable = split_errors(changes)
            unreadable.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
            store.append(readable, number)
        finally:
            changes.unpersist()

    text = read_text_stream(spark, folder, files_per_batch)
    return (
        text.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
