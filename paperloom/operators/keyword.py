"""Keyword search: boolean OR of the query's words, ranked by BM25.

Documents are scored where they are read, as a block against the query set,
and a task keeps k documents per query. Only word counts and the kept documents
are shuffled: a word that every document and many queries contain never
becomes rows of document and query pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators.knn import (
    MAX_KEPT_ROWS,
    MAX_QUERY_BYTES,
    NEIGHBOUR_SCHEMA,
    NearestRows,
    kth_distances,
    merge_nearest,
)
from paperloom.session import release_memory, shared_dir, spread_small

# BM25 parameters.
K1 = 1.2
B = 0.75
SCORE_DECIMALS = 12
BYTES_PER_TERM = 64
# Scores of one step: bounds what a task adds up at a time.
ADDED_CELLS = 250_000
# Words of one step: an Arrow batch holds millions, of which arrays of numbers are made.
STEP_WORDS = 500_000
ASKED = "pmid bigint, length bigint, words array<int>, tf array<int>"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct ``query_id, term`` pairs."""
    words = F.array_distinct(tokens(F.col("query")))
    return queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.explode(words).alias("term"))


def build_index(documents: DataFrame) -> DataFrame:
    """``pmid, words`` of ``documents(pmid, text)``; store it to search it often."""
    words = F.coalesce(tokens(F.col("text")), F.array().cast("array<string>"))
    return documents.select(F.col("pmid").cast("bigint").alias("pmid"), words.alias("words"))


class TermBlock:
    """A bounded block of queries on the driver: their ids, and per word who asks for it."""

    def __init__(self, table: pa.Table):
        self.query_ids, owner = np.unique(np.asarray(table["query_id"]), return_inverse=True)
        encoded = table["term"].combine_chunks().dictionary_encode()
        self.words = encoded.dictionary.to_pylist()
        codes = np.asarray(encoded.indices)
        self.owners = owner[np.argsort(codes, kind="stable")]
        self.n_owners = np.bincount(codes, minlength=len(self.words))


def term_blocks(terms: DataFrame, k: int) -> Iterator[TermBlock]:
    """The query set in blocks within the size bounds, one at a time."""
    most_terms = MAX_QUERY_BYTES // BYTES_PER_TERM
    most_queries = max(1, MAX_KEPT_ROWS // max(1, k))
    first = terms.limit(most_terms + 1).toArrow()
    if first.num_rows <= most_terms:
        block = TermBlock(first)
        if len(block.query_ids) <= most_queries:
            if first.num_rows:
                yield block
            return
    size = terms.agg(F.count("*"), F.count_distinct("query_id")).first()
    blocks = max(-(-size[0] // most_terms), -(-size[1] // most_queries))
    for b in range(blocks):
        table = terms.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).toArrow()
        if table.num_rows:
            yield TermBlock(table)


def word_slices(batch: pa.RecordBatch, column: str = "words") -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of at most ``STEP_WORDS`` words; a longer row is a part of its own."""
    ends = np.asarray(batch.column(column).offsets)
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, int(ends[start]) + STEP_WORDS, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def _asked_pairs(lists: pa.ListArray, number_of: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a word that is asked for and a document that holds it, and how often it does."""
    encoded = lists.flatten().dictionary_encode()
    number = np.array([number_of.get(w, -1) for w in encoded.dictionary.to_pylist()], np.int64)
    word = number[np.asarray(encoded.indices)]
    document = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    asked = word >= 0
    pairs, tf = np.unique(word[asked] * len(lists) + document[asked], return_counts=True)
    return pairs // max(1, len(lists)), pairs % max(1, len(lists)), tf


def _asked_rows(sized: DataFrame, block: TermBlock) -> DataFrame:
    """``pmid, length, words, tf`` of every document: numbers of the block's words in it, and how often it has them.

    Stored, so that documents are read and cut into words once for the counts and the scores.
    """
    spark = sized.sparkSession
    shared = spark.sparkContext.broadcast(block.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = {w: i for i, w in enumerate(shared.value)}
        for batch in batches:
            for part in word_slices(batch):
                word, document, tf = _asked_pairs(part.column("words"), number_of)
                order = np.argsort(document, kind="stable")
                ends = np.cumsum(np.bincount(document, minlength=part.num_rows))
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order], pa.int32())) for x in (word, tf)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("pmid"), part.column("length"), *lists], names=["pmid", "length", "words", "tf"]
                )
            part = batch = None  # a batch is not kept while the next one is read
            release_memory()

    path = f"{shared_dir(spark).rstrip('/')}/keyword-asked-{uuid.uuid4().hex}"
    sized.mapInArrow(run, ASKED).write.parquet(path)
    return spark.read.schema(ASKED).parquet(path)


def _frequencies(asked: DataFrame, n_words: int) -> tuple[np.ndarray, int, float]:
    """Documents per word of the block, number of documents, their mean length."""
    frequency = np.zeros(n_words, np.int64)
    counted = asked.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df")).toArrow()
    frequency[np.asarray(counted["word"])] = np.asarray(counted["df"])
    n_docs, total = asked.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return frequency, n_docs, (total / n_docs if n_docs else 0.0)


def _repeat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Numbers ``start, start + 1, ...`` of every range, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - before, lengths)


def _score_in_task(shared, k: int, bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, idf, mean_length = shared.value
        n_queries = len(block.query_ids)
        everyone = np.arange(n_queries)
        first_owner = np.cumsum(block.n_owners) - block.n_owners
        kept = NearestRows(n_queries, k, bounds)
        step = max(1, ADDED_CELLS // n_queries)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                n_docs = batch.num_rows
                word, tf = (np.asarray(batch.column(c).flatten()) for c in ("words", "tf"))
                document = np.repeat(np.arange(n_docs), np.diff(np.asarray(batch.column("words").offsets)))
                relative_length = np.asarray(batch.column("length"))[document] / mean_length
                weight = idf[word] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * relative_length))
                owners = block.n_owners[word]
                query = block.owners[_repeat_ranges(first_owner[word], owners)]
                scores = np.bincount(
                    query * n_docs + np.repeat(document, owners),
                    weights=np.repeat(weight, owners),
                    minlength=n_queries * n_docs,
                ).reshape(n_queries, n_docs)
                kept.add(everyone, np.asarray(batch.column("pmid")), -np.round(scores, SCORE_DECIMALS))
            batch = whole = None
            release_memory()
        yield kept.to_batch(block.query_ids)

    return run


def search_index(
    index: DataFrame, queries: DataFrame, k: int = 1000, prune_fraction: float = 0.0
) -> DataFrame:
    """Best ``k`` documents of every query: ``query_id, pmid, rank, score``.

    ``index`` comes from ``build_index``, ``queries`` has ``query_id, query``.
    ``prune_fraction`` works as in the vector search.
    """
    context = index.sparkSession.sparkContext
    sized = index.select("pmid", F.size("words").cast("bigint").alias("length"), "words")
    passes = []
    for block in term_blocks(query_terms(queries), k):
        asked = _asked_rows(sized, block)
        frequency, n_docs, mean_length = _frequencies(asked, len(block.words))
        idf = np.log(1 + (n_docs - frequency + 0.5) / (frequency + 0.5))
        shared = context.broadcast((block, idf, mean_length))
        # Only documents with a positive score count as found.
        bounds = np.full(len(block.query_ids), np.nextafter(0.0, -1.0))
        if prune_fraction:
            sample = asked.sample(prune_fraction, seed=7).mapInArrow(_score_in_task(shared, k, bounds), NEIGHBOUR_SCHEMA)
            bounds = np.minimum(bounds, kth_distances(sample, block.query_ids, k))
        passes.append(asked.mapInArrow(_score_in_task(shared, k, bounds), NEIGHBOUR_SCHEMA))
    if not passes:
        passes = [index.sparkSession.createDataFrame([], NEIGHBOUR_SCHEMA)]
    ranked = merge_nearest(reduce(DataFrame.union, passes), k)
    return ranked.select("query_id", "pmid", "rank", (-F.col("distance")).alias("score"))


def search(
    documents: DataFrame, queries: DataFrame, k: int = 1000, prune_fraction: float = 0.0
) -> DataFrame:
    """BM25 search of ``documents(pmid, text)`` for ``queries(query_id, query)``."""
    return search_index(build_index(spread_small(documents)), queries, k, prune_fraction)


def split_by_cache(queries: DataFrame, cached: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cached results of these queries, and the queries still to search.

    ``cached`` has one row per query that was searched, with a possibly empty
    list of ids.
    """
    hits = cached.join(queries.select("query_id"), "query_id", "left_semi")
    misses = queries.join(cached.select("query_id"), "query_id", "left_anti")
    return hits, misses
