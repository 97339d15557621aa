"""Retrieval results kept for reuse."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import lines_to_ids
from paperloom.session import exists, list_names

# Fixed value: cached results are named by their query.
RESULT_FILE_PATTERN = r"Results_query(\d+)\.txt$"
RUN_COLUMNS = ["query_id", "pmid", "rank", "score", "system"]


def read_result_files(spark: SparkSession, folder: str) -> DataFrame:
    """``query_id, pmids`` of files with one id per line; an empty file is an empty list."""
    # Spark skips empty files, so the queries come from the listing.
    named = [re.search(RESULT_FILE_PATTERN, name) for name in list_names(spark, folder)]
    ids = [(int(m.group(1)),) for m in named if m]
    if not ids:
        return spark.createDataFrame([], "query_id int, pmids array<bigint>")
    queries = spark.createDataFrame(ids, "query_id int")
    files = spark.read.text(f"{folder}/*Results_query*.txt", wholetext=True)
    lists = files.select(
        F.regexp_extract("_metadata.file_name", RESULT_FILE_PATTERN, 1).cast("int").alias("query_id"),
        lines_to_ids(F.col("value")).alias("pmids"),
    )
    none = F.array().cast("array<bigint>")
    return queries.join(lists, "query_id", "left").withColumn("pmids", F.coalesce("pmids", none))


def save_run(run: DataFrame, folder: str) -> None:
    """Replace the stored runs of the systems in ``run``, leaving others alone."""
    run.select(RUN_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "system"
    ).parquet(folder)


def read_run(spark: SparkSession, folder: str, system: str) -> DataFrame:
    schema = "query_id int, pmid bigint, rank int, score double, system string"
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder).filter(F.col("system") == system)
