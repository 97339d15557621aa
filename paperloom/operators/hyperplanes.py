"""Approximate nearest neighbours by random-hyperplane hash tables.

A table hashes a vector to the signs of its products with a few fixed directions, so
vectors at a small angle often share a bucket. A query looks into its own bucket and
those that differ in one sign, in every table. The index is one row per vector and
hash table, written in the order of the buckets; a search filters the buckets its queries probe,
and rows are scored where they are read, so a bucket with a third of the vectors is
spread over the tasks that read it and pairs are never rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.ivf import probe_in_task
from paperloom.operators.knn import NEIGHBOUR_SCHEMA, matrix, merge_nearest, query_blocks

INDEX_SCHEMA = "cell int, pmid bigint, embedding array<float>"


def directions(n_tables: int, n_bits: int, dim: int) -> np.ndarray:
    """``n_tables * n_bits`` directions of ones and minus ones, from the MD5 hash of their place."""
    sign = lambda *place: 1.0 if hashlib.md5(":".join(map(str, place)).encode()).hexdigest()[0] < "8" else -1.0
    return np.array([[sign(t, b, i) for i in range(dim)] for t in range(n_tables) for b in range(n_bits)])


def cells_of(rows: np.ndarray, n_tables: int, n_bits: int) -> np.ndarray:
    """One cell number per row and table: the table's number and the signs as bits."""
    signs = rows @ directions(n_tables, n_bits, rows.shape[1]).T > 0
    buckets = signs.reshape(len(rows), n_tables, n_bits) @ (1 << np.arange(n_bits))
    return buckets + (np.arange(n_tables) << n_bits)


def probed_cells(cells: np.ndarray, n_bits: int) -> np.ndarray:
    """Each cell, and those of its table that differ in one sign, one row per query."""
    flips = np.concatenate([[0], 1 << np.arange(n_bits)])
    return (cells[:, :, None] ^ flips).reshape(len(cells), -1)


def hashed(vectors: DataFrame, n_tables: int, n_bits: int) -> DataFrame:
    """``cell, pmid, embedding``: a row per vector and table. Null vectors are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cells = cells_of(matrix(batch.column("embedding")), n_tables, n_bits)
            for t in range(n_tables):
                columns = [pa.array(cells[:, t].astype(np.int32)), batch.column("pmid"), batch.column("embedding")]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "pmid", "embedding"])

    rows = vectors.filter(F.col("embedding").isNotNull()).select(
        F.col("pmid").cast("bigint").alias("pmid"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    return rows.mapInArrow(run, INDEX_SCHEMA)


def write_index(vectors: DataFrame, path: str, n_tables: int, n_bits: int) -> None:
    """Store the index in the order of its cells; a hot cell is cut by a hash of the id."""
    rows = hashed(vectors, n_tables, n_bits)
    ordered = rows.repartitionByRange("cell", F.xxhash64("pmid")).sortWithinPartitions("cell")
    ordered.write.mode("overwrite").parquet(f"{path}/cells")
    sizes = vectors.sparkSession.createDataFrame([(n_tables, n_bits)], "n_tables int, n_bits int")
    sizes.write.mode("overwrite").parquet(f"{path}/sizes")


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 1000) -> DataFrame:
    """``query_id, pmid, rank, distance``: k nearest of the vectors that share a probed cell.

    The query set is read in blocks of a checked size. A task keeps ``k`` rows per query
    and table, as it can meet a vector once per table.
    """
    n_tables, n_bits = spark.read.parquet(f"{path}/sizes").first()
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/cells")
    passes = []
    for block in query_blocks(queries, k * n_tables):
        probes = probed_cells(cells_of(np.nan_to_num(block.unit), n_tables, n_bits), n_bits)
        owner = np.repeat(np.arange(len(block)), probes.shape[1])
        order = np.argsort(probes.ravel(), kind="stable")
        cells, starts = np.unique(probes.ravel()[order], return_index=True)
        asking = dict(zip(cells.tolist(), np.split(owner[order], starts[1:])))
        shared = spark.sparkContext.broadcast((block.ids, block.unit, asking))
        wanted = index.filter(F.col("cell").isin(cells.tolist()))
        passes.append(wanted.mapInArrow(probe_in_task(shared, k * n_tables), NEIGHBOUR_SCHEMA))
    if not passes:
        return merge_nearest(spark.createDataFrame([], NEIGHBOUR_SCHEMA), k)
    # A vector found in several tables counts once.
    found = reduce(DataFrame.union, passes).groupBy("query_id", "pmid").agg(F.min("distance").alias("distance"))
    return merge_nearest(found, k)
