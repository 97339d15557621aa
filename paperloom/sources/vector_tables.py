"""Vector files and vector tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.vectors import from_wide, pack_half, require_dimension, to_wide, unpack_half
from paperloom.operators.quality import append_check
from paperloom.session import exists, shared_dir

PARTITIONS = 8
ROWS_PER_FILE = 10_000
PRECISIONS = ("full", "half")


def write_wide(df: DataFrame, folder: str, dim: int, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Exchange format: ``pmid, pub_date`` and one column per dimension; appends."""
    to_wide(df.select("pmid", "pub_date", "embedding"), dim).write.mode("append").option(
        "maxRecordsPerFile", rows_per_file
    ).parquet(folder)


def read_wide(spark: SparkSession, folder: str) -> DataFrame:
    """``pmid, embedding`` and, where present, ``pub_date`` of exchange files."""
    return from_wide(spark.read.parquet(folder))


def prepare_vectors(df: DataFrame, dim: int, precision: str = "full") -> DataFrame:
    """Rows as a vector table stores them, half precision as two bytes a component; a wrong dimension or an id beyond int fails."""
    if precision not in PRECISIONS:
        raise ValueError(f"precision is one of {PRECISIONS}")
    vector = require_dimension(F.col("embedding"), dim)
    vector = vector.cast("array<float>")
    if precision == "half":
        vector = pack_half(vector)
    return df.select(F.col("pmid").cast("int").alias("pmid"), vector.alias("embedding"))


def read_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``pmid, embedding`` of a vector table, as floats whatever its precision."""
    rows = spark.read.parquet(folder)
    if rows.schema["embedding"].dataType.typeName() == "binary":
        rows = rows.withColumn("embedding", unpack_half("embedding"))
    return rows


def append_vectors(df: DataFrame, folder: str, dim: int, precision: str = "full") -> int:
    """Append to a vector table, creating it if absent; gives its size afterwards.

    Refuses vectors of another dimension and ids that are there already. The input
    is evaluated once, into a staging table that is checked and then appended.
    """
    spark = df.sparkSession
    prepare_vectors(df, dim, precision)  # refuses an unknown precision before anything is staged
    staging = f"{shared_dir(spark).rstrip('/')}/vectors-{uuid.uuid4().hex}"
    df.select("pmid", "embedding").write.parquet(staging)
    df = spark.read.parquet(staging)
    rows = prepare_vectors(df, dim, precision)
    stored = spark.read.parquet(folder) if exists(spark, folder) else spark.createDataFrame([], rows.schema)
    if stored.schema["embedding"].dataType != rows.schema["embedding"].dataType:
        raise ValueError(f"the table does not hold vectors of {precision} precision")
    check = append_check(df, stored, dim).first()
    if check.n_wrong_dim:
        raise ValueError(f"{check.n_wrong_dim} vectors do not have {dim} dimensions")
    if check.n_existing or check.n_repeated:
        raise ValueError(f"duplicate ids: {check.n_existing} stored, {check.n_repeated} repeated")
    rows.write.mode("append").parquet(folder)
    return check.n_after


def save_bucketed(df: DataFrame, table: str, path: str | None = None, buckets: int = PARTITIONS) -> DataFrame:
    """Table hash-partitioned on ``pmid``: joins of such tables need no shuffle.

    Use the same number of buckets for vectors and articles; at scale, a
    multiple of the executor cores.
    """
    writer = df.repartition(buckets, "pmid").write.mode("overwrite").bucketBy(buckets, "pmid").sortBy("pmid")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def partition_number(modulus: int = PARTITIONS):
    """Number of the partition a row's id falls in."""
    return F.pmod(F.col("pmid"), F.lit(modulus)).cast("int")


def write_partitioned(df: DataFrame, folder: str, modulus: int = PARTITIONS, splits: int = 16) -> None:
    """Copy of a vector table with one folder per partition number, written by up to ``splits`` tasks each."""
    numbered = df.withColumn("part", partition_number(modulus))
    numbered.repartition(modulus * splits, "part", F.pmod(F.xxhash64("pmid"), F.lit(splits))).write.mode("overwrite").partitionBy(
        "part"
    ).parquet(folder)


def partition_counts(df: DataFrame, modulus: int = PARTITIONS) -> DataFrame:
    return df.groupBy(partition_number(modulus).alias("part")).agg(F.count("*").alias("n_rows"))
