"""Whole tables: listing, copying, scanning, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import embedding_text
from paperloom.session import exists, publish_file, read_file

FETCH_ROWS = 100_000


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Drop the target and write it anew from the source table."""
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.table(source).write.saveAsTable(target)


def copy_database(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copy every table of a database; gives their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
    names = list_tables(spark, source)
    for name in names:
        copy_table(spark, f"{source}.{name}", f"{target}.{name}")
    return names


def copy_in_chunks(source: DataFrame, folder: str, key: str, width: int) -> DataFrame:
    """Copy ``source`` by ranges of ``width`` keys; gives ``chunk, n_rows, running_total``, chunks without rows left out.

    A chunk is all rows with one ``floor(key / width)``, the rows without a key are the
    last one. Its rows are counted as they are written, and a file that holds the count
    marks it as done: a copy that was stopped goes on with the chunks that are not.
    ``width`` must stay the same. The number of chunks is the number of jobs.
    """
    spark, chunk = source.sparkSession, F.floor(F.col(key) / F.lit(width))
    ends = source.agg(F.min(chunk).alias("first"), F.max(chunk).alias("last"), F.count_if(F.col(key).isNull()).alias("none")).first()
    chunks = list(range(ends.first, ends.last + 1)) if ends.first is not None else []
    totals, so_far = [], 0
    for number in [*chunks, *([None] if ends.none else [])]:
        name = "none" if number is None else str(number)
        done = f"{folder}/done/{name}"
        if not exists(spark, done):
            inside = F.col(key).isNull() if number is None else (F.col(key) >= number * width) & (F.col(key) < (number + 1) * width)
            counted = Observation()
            rows = source.filter(inside).observe(counted, F.count(F.lit(1)).alias("n_rows"))
            rows.write.mode("overwrite").parquet(f"{folder}/rows/chunk-{name}")
            publish_file(spark, done, str(counted.get["n_rows"]))
        n_rows = int(read_file(spark, done))
        so_far += n_rows
        if n_rows:
            totals.append((number, n_rows, so_far))
    return spark.createDataFrame(totals, "chunk bigint, n_rows bigint, running_total bigint")


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a copy made in chunks."""
    return spark.read.parquet(f"{folder}/rows/chunk-*")


def jdbc_read_options(url: str, table: str, key: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')`` that split a table by its key."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(FETCH_ROWS),
    }


def jdbc_write_options(url: str, table: str, truncate: bool = False) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(FETCH_ROWS), "truncate": str(truncate).lower()}


def register_temporary(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def refresh_statistics(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def declared_types(spark: SparkSession, table: str) -> DataFrame:
    """``column_name, source_type`` of a table."""
    rows = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]
    return spark.createDataFrame(rows, "column_name string, source_type string")


def texts_to_embed(articles: DataFrame) -> DataFrame:
    """``pmid, text, publication_date`` of every article."""
    return articles.select(
        "pmid",
        embedding_text(*[F.col(c) for c in ("title", "abstract", "mesh_terms", "keywords", "chemicals")]).alias("text"),
        "publication_date",
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def max_id_as_of(articles: DataFrame, file_number: int) -> DataFrame:
    """Greatest id published up to a file number: one row."""
    return articles.filter(F.col("file_number") <= file_number).agg(F.max("pmid").alias("max_pmid"))


def point_lookup(articles: DataFrame, pmid: int) -> DataFrame:
    return articles.filter(F.col("pmid") == pmid)


def write_by_date(articles: DataFrame, folder: str, files: int = 200) -> None:
    """Files clustered by publication date, so that a date range skips most of them."""
    articles.repartitionByRange(files, "publication_date", "pmid").sortWithinPartitions(
        "publication_date"
    ).write.mode("overwrite").parquet(folder)


def date_range(articles: DataFrame, first: str, last: str) -> DataFrame:
    days = F.col("publication_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return articles.filter(days)
