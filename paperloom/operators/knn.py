"""Exact nearest neighbours by cosine distance.

The vector table is read once, in Arrow batches, and scored as a matrix against
a block of queries whose size is checked. A task keeps k rows per query, so
the shuffle carries neighbours, never pairs.

Distances are rounded to ``DISTANCE_DECIMALS`` before ranking: the order of
additions differs between engines, and ties must fall to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators.topk import top_n_per_group
from paperloom.session import spread_small

DISTANCE_DECIMALS = 12
# Bounds of one query block: its matrix, and the neighbours one task keeps.
MAX_QUERY_BYTES = 64 << 20
MAX_KEPT_ROWS = 1_000_000
SCORE_CELLS = 1_000_000
# Products of another block shape may fall on the other side of a rounding edge.
BOUND_SLACK = 2 * 10.0**-DISTANCE_DECIMALS

NEIGHBOUR_SCHEMA = "query_id bigint, pmid bigint, distance double"
_NEIGHBOURS = pa.schema(
    [("query_id", pa.int64()), ("pmid", pa.int64()), ("distance", pa.float64())]
)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    """Rows of a list column as a double matrix; all must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), dtype=np.float64)
    rows = len(column)
    width = dim if dim is not None else (len(flat) // rows if rows else 0)
    if column.null_count or len(flat) != rows * width:
        raise ValueError(f"every vector must have {width} dimensions")
    lengths = np.diff(np.asarray(column.offsets))
    if rows and (lengths != width).any():
        raise ValueError(f"every vector must have {width} dimensions")
    return flat.reshape(rows, width)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row becomes NaN."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def distance_block(unit_queries: np.ndarray, unit_vectors: np.ndarray) -> np.ndarray:
    return np.round(1.0 - unit_queries @ unit_vectors.T, DISTANCE_DECIMALS) + 0.0


class NearestRows:
    """k nearest rows per query seen so far by one task."""

    def __init__(self, n_queries: int, k: int, bounds: np.ndarray | None = None):
        self.k = k
        self.limit = np.full(n_queries, np.inf) if bounds is None else bounds.copy()
        self.query = np.empty(0, np.int64)
        self.pmid = np.empty(0, np.int64)
        self.distance = np.empty(0, np.float64)
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending_rows = 0
        self.flush_at = max(n_queries * k, 200_000)

    def add(self, queries: np.ndarray, pmids: np.ndarray, distances: np.ndarray) -> None:
        """``distances`` has one row per entry of ``queries``; NaN counts as farthest."""
        distances = np.where(np.isnan(distances), np.inf, distances)
        if distances.shape[1] > self.k:
            # The k-th distance of any part of the rows bounds that of all rows.
            kth = np.partition(distances, self.k - 1, axis=1)[:, self.k - 1]
            self.limit[queries] = np.minimum(self.limit[queries], kth)
        q, v = np.nonzero(distances <= self.limit[queries][:, None])
        if len(q):
            self.pending.append((queries[q], pmids[v], distances[q, v]))
            self.pending_rows += len(q)
            if self.pending_rows > self.flush_at:
                self.compact()

    def compact(self) -> None:
        query = np.concatenate([self.query, *[p[0] for p in self.pending]])
        pmid = np.concatenate([self.pmid, *[p[1] for p in self.pending]])
        distance = np.concatenate([self.distance, *[p[2] for p in self.pending]])
        self.pending, self.pending_rows = [], 0
        order = np.lexsort((pmid, distance, query))
        query, pmid, distance = query[order], pmid[order], distance[order]
        position = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        last = position == self.k - 1
        self.limit[query[last]] = np.minimum(self.limit[query[last]], distance[last])
        keep = position < self.k
        self.query, self.pmid, self.distance = query[keep], pmid[keep], distance[keep]

    def to_batch(self, query_ids: np.ndarray) -> pa.RecordBatch:
        self.compact()
        distance = np.where(np.isinf(self.distance), np.nan, self.distance)
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[self.query]), pa.array(self.pmid), pa.array(distance)],
            schema=_NEIGHBOURS,
        )


def query_chunks(n_queries: int, n_vectors: int) -> Iterator[np.ndarray]:
    """Query index ranges that keep one score matrix small."""
    step = max(1, SCORE_CELLS // max(1, n_vectors))
    for start in range(0, n_queries, step):
        yield np.arange(start, min(start + step, n_queries))


class QueryBlock:
    """A bounded block of queries on the driver: ids and unit vectors."""

    def __init__(self, table: pa.Table):
        ids = np.asarray(table["query_id"])
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.unit = unit_rows(matrix(table["embedding"])[order]) if len(order) else np.empty((0, 0))

    def __len__(self) -> int:
        return len(self.ids)


def query_blocks(queries: DataFrame, k: int, most: int = MAX_KEPT_ROWS) -> Iterator[QueryBlock]:
    """The query set in blocks within the size bounds and of about ``most`` queries, one at a time."""
    rows = queries.select(F.col("query_id").cast("bigint").alias("query_id"), "embedding")
    size = rows.agg(F.count("*"), F.max(F.size("embedding"))).first()
    dim = max(1, size[1] or 0)
    per_block = max(1, min(MAX_QUERY_BYTES // (8 * dim), MAX_KEPT_ROWS // max(1, k), most))
    blocks = -(-size[0] // per_block)
    for b in range(blocks):
        table = rows.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).toArrow()
        if table.num_rows:
            yield QueryBlock(table)


def _nearest_in_task(block, k: int, bounds: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, unit_queries = block.value
        kept = NearestRows(len(query_ids), k, bounds)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            pmids = np.asarray(batch.column("pmid"))
            vectors = unit_rows(matrix(batch.column("embedding"), unit_queries.shape[1]))
            for chunk in query_chunks(len(query_ids), len(pmids)):
                kept.add(chunk, pmids, distance_block(unit_queries[chunk], vectors))
        yield kept.to_batch(query_ids)

    return run


def _candidates(vectors: DataFrame, block: QueryBlock, k: int, bounds: np.ndarray | None) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast((block.ids, block.unit))
    rows = vectors.filter(F.col("embedding").isNotNull()).select(
        F.col("pmid").cast("bigint").alias("pmid"), "embedding"
    )
    return spread_small(rows).mapInArrow(_nearest_in_task(shared, k, bounds), NEIGHBOUR_SCHEMA)


def kth_distances(candidates: DataFrame, query_ids: np.ndarray, k: int) -> np.ndarray:
    """k-th distance of each query among some of the rows: never below the final one."""
    kth = (
        top_n_per_group(candidates, ["query_id"], [F.col("distance"), F.col("pmid")], k)
        .groupBy("query_id")
        .agg(F.count("*").alias("n"), F.max("distance").alias("distance"))
        .filter((F.col("n") == k) & ~F.isnan("distance"))
        .toArrow()
    )
    bounds = np.full(len(query_ids), np.inf)
    bounds[np.searchsorted(query_ids, np.asarray(kth["query_id"]))] = np.asarray(kth["distance"])
    return bounds


def merge_nearest(candidates: DataFrame, k: int) -> DataFrame:
    """Final ranking of the neighbours the tasks kept; ``rank`` starts at 0."""
    best = top_n_per_group(
        candidates, ["query_id"], [F.col("distance"), F.col("pmid")], k, position="_position"
    )
    return best.select(
        "query_id", "pmid", (F.col("_position") - 1).cast("int").alias("rank"), "distance"
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 1000,
    prune_fraction: float = 0.0,
) -> DataFrame:
    """k nearest vectors of every query: ``query_id, pmid, rank, distance``.

    ``vectors`` has ``pmid, embedding``, ``queries`` has ``query_id, embedding``
    with one row per id. Query sets above the block bounds are scored in
    several passes. ``prune_fraction`` first scores that share of the
    vectors; the distances found bound the result, so tasks of the full pass
    drop what cannot be in it. The result is the same with and without; a
    hundredth pays where thousands of tasks would each send k rows per query.
    The query set is read while the plan is built.
    """
    passes = []
    for block in query_blocks(queries, k):
        bounds = None
        if prune_fraction:
            sample = _candidates(vectors.sample(prune_fraction, seed=7), block, k, None)
            bounds = kth_distances(sample, block.ids, k) + BOUND_SLACK
        passes.append(_candidates(vectors, block, k, bounds))
    if not passes:
        empty = vectors.sparkSession.createDataFrame([], NEIGHBOUR_SCHEMA)
        return merge_nearest(empty, k)
    return merge_nearest(reduce(DataFrame.union, passes), k)


def nearest_to_vector(vectors: DataFrame, query_vector: list[float], k: int = 5) -> DataFrame:
    """k nearest vectors of one query: ``pmid, rank, distance``."""
    one = vectors.sparkSession.createDataFrame(
        [(0, [float(x) for x in query_vector])], "query_id bigint, embedding array<double>"
    )
    return nearest(vectors, one, k).drop("query_id")


def distances_to_vector(vectors: DataFrame, query_vector: list[float]) -> DataFrame:
    """``pmid, distance`` of every vector, taken where it is read; narrow rows to join and rank."""
    query = unit_rows(np.array([query_vector], np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = unit_rows(matrix(batch.column("embedding"), query.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("pmid"), pa.array(distance_block(query, rows)[0])], names=["pmid", "distance"]
            )

    rows = vectors.filter(F.col("embedding").isNotNull()).select(F.col("pmid").cast("bigint").alias("pmid"), "embedding")
    return rows.mapInArrow(run, "pmid bigint, distance double")


def rank_within_query(scored: DataFrame, score: Column, ranges: int = 32) -> DataFrame:
    """0-based ``rank`` of every row by descending score, then id.

    Works for runs of any length: see ``numbering`` for how a query that holds
    most of the rows is split.
    """
    from paperloom.operators.numbering import row_numbers

    numbered = row_numbers(
        scored.withColumn("_score", score),
        order="_score",
        tie="pmid",
        group=["query_id"],
        descending=True,
        number="_n",
        ranges=ranges,
    )
    return numbered.withColumn("rank", (F.col("_n") - 1).cast("int")).drop("_n", "_score")


def similarity_to_variants(texts: DataFrame, base: str, variants: list[str]) -> DataFrame:
    """Cosine similarity of a row's base vector with each of its variant vectors."""
    from paperloom.functions.vectors import cosine_similarity

    return texts.select(
        "pmid", *[cosine_similarity(F.col(base), F.col(v)).alias(f"sim_{v}") for v in variants]
    )
