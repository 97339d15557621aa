"""Exact nearest neighbours that leave out cells which cannot hold any.

Angles between unit vectors obey the triangle inequality: no vector of a cell is nearer
to a query than the angle to the cell's centre less the cell's radius. The cells nearest
to a query, as many as hold k vectors, bound its k-th distance; of the other cells only
those whose least possible distance is within that bound are read. The result is that of
``knn.nearest``; how much is skipped depends on how tight the cells are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import ivf
from paperloom.operators.knn import (
    BOUND_SLACK,
    NEIGHBOUR_SCHEMA,
    QueryBlock,
    kth_distances,
    matrix,
    merge_nearest,
    query_blocks,
    unit_rows,
)
from paperloom.session import shared_dir

# Angles from cosines close to one are off by up to the root of a double's precision.
ANGLE_SLACK = 1e-6
# Pairs of a query and a cell that the driver looks at together.
MAX_CHOICES = 8_000_000


def _radii(index: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cell, n, radius``: vectors of a cell and their greatest angle to its centre; zero vectors do not count."""
    shared = index.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = shared.value
        n, radius = np.zeros(len(centers), np.int64), np.zeros(len(centers))
        for batch in batches:
            rows, cell = unit_rows(matrix(batch.column("embedding"), centers.shape[1])), np.asarray(batch.column("cell"))
            angle = np.arccos(np.clip(np.einsum("ij,ij->i", rows, centers[cell]), -1, 1))
            angle[~centers[cell].any(axis=1)] = np.pi  # a centre without direction bounds nothing
            some = np.isfinite(rows).all(axis=1)
            n += np.bincount(cell[some], minlength=len(centers))
            np.maximum.at(radius, cell[some], angle[some])
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(n[held]), pa.array(radius[held])], names=["cell", "n", "radius"]
        )

    parts = index.mapInArrow(run, "cell int, n bigint, radius double")
    return parts.groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"))


def write_index(vectors: DataFrame, centroids: np.ndarray, path: str, files_per_cell: int = 8) -> None:
    """The folders of ``ivf.write_index``, and the radius of each cell."""
    ivf.write_index(vectors, centroids, path, files_per_cell)
    index, centers = ivf.read_index(vectors.sparkSession, path)
    _radii(index, centers).write.parquet(f"{path}/radii")


class CellBounds:
    """Centres and radii of all cells, on the driver within the bound of the centres."""

    def __init__(self, spark: SparkSession, path: str):
        self.index, self.centroids = ivf.read_index(spark, path)
        held = spark.read.parquet(f"{path}/radii").toArrow()
        self.n, self.radius = np.zeros(len(self.centroids), np.int64), np.full(len(self.centroids), -np.inf)
        cell = np.asarray(held["cell"])
        self.n[cell], self.radius[cell] = np.asarray(held["n"]), np.asarray(held["radius"])

    def angles(self, block: QueryBlock) -> np.ndarray:
        """Angle of each query, one row each, to each centre."""
        unit = np.nan_to_num(block.unit)
        return np.arccos(np.clip(unit @ self.centroids.T, -1, 1))

    def nearest_cells(self, angles: np.ndarray, k: int) -> np.ndarray:
        """Which cells hold the first k vectors by the angle of their centres."""
        order = np.argsort(angles, axis=1, kind="stable")
        held = self.n[order]
        near = np.zeros(angles.shape, bool)
        np.put_along_axis(near, order, np.cumsum(held, axis=1) - held < k, axis=1)
        return near

    def may_hold(self, angles: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Which cells may hold a vector within each query's limit; all of them if it has none."""
        least = 1 - np.cos(np.clip(angles - self.radius - ANGLE_SLACK, 0, np.pi))
        return (least <= limits[:, None]) & (self.n > 0) | np.isinf(limits)[:, None]


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 1000) -> DataFrame:
    """k nearest vectors of every query: ``query_id, pmid, rank, distance``, as ``knn.nearest`` gives them.

    The query set is read, and the nearest cells are searched, while the plan is built.
    Queries with fewer than k vectors at a distance, zero vectors among them, look into
    every cell.
    """
    cells = CellBounds(spark, path)
    n_cells, passes = len(cells.centroids), []
    for block in query_blocks(queries, k, max(1, MAX_CHOICES // max(1, n_cells))):
        angles = cells.angles(block)
        near = cells.nearest_cells(angles, k)
        folder = f"{shared_dir(spark).rstrip('/')}/nearest-{uuid.uuid4().hex}"
        ivf.probed_candidates(cells.index, block, *np.nonzero(near), n_cells, k).write.parquet(folder)
        found = spark.read.schema(NEIGHBOUR_SCHEMA).parquet(folder)
        limits = kth_distances(found, block.ids, k) + BOUND_SLACK
        more = cells.may_hold(angles, limits) & ~near
        passes += [found, ivf.probed_candidates(cells.index, block, *np.nonzero(more), n_cells, k, limits)]
    if not passes:
        return merge_nearest(spark.createDataFrame([], NEIGHBOUR_SCHEMA), k)
    return merge_nearest(reduce(DataFrame.union, passes), k)
