"""Approximate nearest neighbours: an inverted-file index over k-means cells.

``n_probe`` is the recall knob; probing every cell gives the exact result.
The index is a plain table partitioned by cell, so a search reads only the
cells its queries probe. Tasks score the batches they read, whatever their
cell: a cell holding a third of the vectors is spread over its files.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.vectors import l2_norm, l2_normalize
from paperloom.operators.knn import (
    NEIGHBOUR_SCHEMA,
    NearestRows,
    QueryBlock,
    distance_block,
    matrix,
    merge_nearest,
    query_blocks,
    query_chunks,
    unit_rows,
)

MAX_CENTROID_BYTES = 256 << 20


def _check_centroids(n_cells: int, vectors: DataFrame) -> None:
    first = vectors.select("embedding").filter(F.col("embedding").isNotNull()).first()
    size = 8 * n_cells * (len(first.embedding) if first else 0)
    if size > MAX_CENTROID_BYTES:
        raise ValueError(f"centroids take {size} bytes; use fewer cells")


def train_centroids(
    vectors: DataFrame, n_cells: int, train_fraction: float = 1.0, seed: int = 17, max_iter: int = 10
) -> np.ndarray:
    """Unit-length cell centres, one row each, trained on a share of the vectors."""
    _check_centroids(n_cells, vectors)
    usable = vectors.filter(F.col("embedding").isNotNull() & (l2_norm(F.col("embedding")) > 0))
    if train_fraction < 1.0:
        usable = usable.sample(train_fraction, seed=seed)
    features = usable.select(array_to_vector(l2_normalize(F.col("embedding"))).alias("features"))
    model = KMeans(k=n_cells, seed=seed, maxIter=max_iter, initMode="k-means||").fit(features)
    return np.nan_to_num(unit_rows(np.asarray(model.clusterCenters())))


def group_centroids(vectors: DataFrame, group: str, dim: int) -> np.ndarray:
    """Unit-length mean vector of each group, in the order of the groups; nothing is trained."""
    known = vectors.filter(F.col("embedding").isNotNull() & F.col(group).isNotNull())
    _check_centroids(known.select(group).distinct().count(), known)
    means = known.groupBy(group).agg(*[F.avg(F.col("embedding")[i].cast("double")) for i in range(dim)])
    return np.nan_to_num(unit_rows(np.array([list(r)[1:] for r in means.orderBy(group).collect()]).reshape(-1, dim)))


def assign_cells(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vectors`` with the number of the nearest cell; zero vectors go to cell 0."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = shared.value
        for batch in batches:
            rows = np.nan_to_num(unit_rows(matrix(batch.column("embedding"), centers.shape[1])))
            cell = np.empty(len(rows), np.int32)
            for chunk in query_chunks(len(rows), len(centers)):
                cell[chunk] = np.argmax(rows[chunk] @ centers.T, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("pmid"), batch.column("embedding"), pa.array(cell)],
                names=["pmid", "embedding", "cell"],
            )

    rows = vectors.filter(F.col("embedding").isNotNull()).select(
        F.col("pmid").cast("bigint").alias("pmid"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    return rows.mapInArrow(run, "pmid bigint, embedding array<float>, cell int")


def write_index(vectors: DataFrame, centroids: np.ndarray, path: str, files_per_cell: int = 8) -> None:
    """Store the index; a cell spans several files so that a hot one stays parallel."""
    spread = F.pmod(F.xxhash64("pmid"), F.lit(files_per_cell))
    assigned = assign_cells(vectors, centroids)
    assigned.repartition(F.col("cell"), spread).write.partitionBy("cell").parquet(f"{path}/cells")
    spark = vectors.sparkSession
    rows = [(i, c.tolist()) for i, c in enumerate(centroids)]
    spark.createDataFrame(rows, "cell int, centroid array<double>").write.parquet(f"{path}/centroids")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    stored = spark.read.parquet(f"{path}/centroids").orderBy("cell").toArrow()
    schema = "pmid bigint, embedding array<float>, cell int"
    return spark.read.schema(schema).parquet(f"{path}/cells"), matrix(stored["centroid"])


def probed_cells(block: QueryBlock, centroids: np.ndarray, n_probe: int) -> np.ndarray:
    """``n_probe`` nearest cells of every query, one row per query."""
    unit = np.nan_to_num(block.unit)
    parts = [
        np.argsort(-(unit[chunk] @ centroids.T), axis=1, kind="stable")[:, :n_probe]
        for chunk in query_chunks(len(unit), len(centroids))
    ]
    return np.concatenate(parts)


def probe_in_task(shared, k: int, bounds: np.ndarray | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, unit_queries, queries_of_cell = shared.value
        kept = NearestRows(len(query_ids), k, bounds)
        for batch in batches:
            cells = np.asarray(batch.column("cell"))
            pmids = np.asarray(batch.column("pmid"))
            vectors = unit_rows(matrix(batch.column("embedding"), unit_queries.shape[1]))
            for cell in np.unique(cells):
                probing = queries_of_cell.get(int(cell))
                if probing is None:
                    continue
                inside = np.flatnonzero(cells == cell)
                for chunk in query_chunks(len(probing), len(inside)):
                    some = probing[chunk]
                    kept.add(some, pmids[inside], distance_block(unit_queries[some], vectors[inside]))
        yield kept.to_batch(query_ids)

    return run


def probed_candidates(
    index: DataFrame, block: QueryBlock, owner: np.ndarray, cell: np.ndarray, n_cells: int, k: int, bounds: np.ndarray | None = None
) -> DataFrame:
    """Neighbours that tasks find when query ``owner`` of the block looks into ``cell``; other cells are not read."""
    order = np.argsort(cell, kind="stable")
    cells, starts = np.unique(cell[order], return_index=True)
    queries_of_cell = dict(zip(cells.tolist(), np.split(owner[order], starts[1:])))
    shared = index.sparkSession.sparkContext.broadcast((block.ids, block.unit, queries_of_cell))
    wanted = index if len(cells) == n_cells else index.filter(F.col("cell").isin([int(c) for c in cells]))
    return wanted.mapInArrow(probe_in_task(shared, k, bounds), NEIGHBOUR_SCHEMA)


def search(
    index: DataFrame, centroids: np.ndarray, queries: DataFrame, k: int = 1000, n_probe: int = 8
) -> DataFrame:
    """k nearest vectors among the ``n_probe`` cells nearest to each query."""
    n_probe = min(n_probe, len(centroids))
    passes = []
    for block in query_blocks(queries, k):
        owner = np.repeat(np.arange(len(block)), n_probe)
        probes = probed_cells(block, centroids, n_probe).ravel()
        passes.append(probed_candidates(index, block, owner, probes, len(centroids), k))
    if not passes:
        return merge_nearest(index.sparkSession.createDataFrame([], NEIGHBOUR_SCHEMA), k)
    return merge_nearest(reduce(DataFrame.union, passes), k)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours found, over all queries: one row."""
    found = exact.select("query_id", "pmid").join(
        approximate.select("query_id", "pmid", F.lit(1).alias("hit")), ["query_id", "pmid"], "left"
    )
    return found.agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
