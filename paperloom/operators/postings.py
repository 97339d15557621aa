"""Keyword index on disk: posting lists in folders by bucket of the word, so that a search reads its own words.

``postings`` holds a row per word and document with the frequency and the document's
length, sorted by word within each bucket; ``terms`` the documents of each word;
``corpus`` one row with the number and total length of the documents, written last: an
index without it is not complete. A search reads the buckets of its words only, sends
the postings of a word to tasks by document, and each task adds up the scores of a
bounded number of documents for all queries at once. A word that every document has is
split over all tasks, and pairs of queries and documents are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.keyword import (
    ADDED_CELLS,
    B,
    K1,
    SCORE_DECIMALS,
    TermBlock,
    _asked_pairs,
    _repeat_ranges,
    build_index,
    query_terms,
    term_blocks,
    word_slices,
)
from paperloom.operators.knn import NEIGHBOUR_SCHEMA, NearestRows, merge_nearest
from paperloom.session import release_memory

BUCKETS = 64
# Documents whose scores one task adds up, and whose postings share a file of a bucket.
DOCUMENTS_PER_TASK = 20_000
DOCUMENTS_PER_FILE = 2_000_000
# Bucket of the rows that hold a document's length, one per document.
LENGTHS = -1
POSTINGS = "term string, pmid bigint, tf int, length int, bucket int"
TERMS = "term string, df bigint, bucket int"


def bucket_of(term: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in word_slices(batch):
            yield _entries_of(part)
        part = batch = None  # a batch is not kept while the next one is read
        release_memory()


def _entries_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists = batch.column("words")
    words = lists.flatten().unique().to_pylist()
    word, document, tf = _asked_pairs(lists, {w: i for i, w in enumerate(words)})
    length = np.diff(np.asarray(lists.offsets))
    pmids = batch.column("pmid")
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(words, pa.string()).take(pa.array(word)), pa.nulls(len(lists), pa.string())]),
            pa.concat_arrays([pmids.take(pa.array(document)), pmids]),
            pa.array(np.concatenate([tf, length]), pa.int32()),
            pa.array(np.concatenate([length[document], length]), pa.int32()),
        ],
        names=["term", "pmid", "tf", "length"],
    )


def write_index(documents: DataFrame, folder: str, buckets: int = BUCKETS) -> None:
    """Index of ``documents(pmid, text)``; replaces one that is there. Null texts have no words."""
    spark, folder = documents.sparkSession, folder.rstrip("/")
    rows = build_index(documents).mapInArrow(_entries, "term string, pmid bigint, tf int, length int")
    spread = -(-documents.count() // DOCUMENTS_PER_FILE) or 1
    bucket = F.coalesce(bucket_of(F.col("term"), buckets), F.lit(LENGTHS))
    placed = rows.withColumn("bucket", F.when(F.col("term").isNull(), LENGTHS).otherwise(bucket))
    placed = placed.repartition((buckets + 1) * spread, "bucket", F.pmod(F.xxhash64("pmid"), F.lit(spread)))
    placed.sortWithinPartitions("bucket", "term", "pmid").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings")
    postings = spark.read.schema(POSTINGS).parquet(f"{folder}/postings")
    words = postings.filter(F.col("bucket") != LENGTHS).groupBy("bucket", "term").agg(F.count("*").alias("df"))
    words.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/terms")
    corpus = postings.filter(F.col("bucket") == LENGTHS).agg(
        F.count("*").alias("n_docs"), F.coalesce(F.sum("length"), F.lit(0)).alias("words"), F.lit(buckets).alias("buckets")
    )
    corpus.write.mode("overwrite").parquet(f"{folder}/corpus")


def asked_postings(spark: SparkSession, folder: str, words: list[str], buckets: int) -> tuple[DataFrame, DataFrame]:
    """``postings`` and ``terms`` of some words; other words' buckets are not read."""
    asked = spark.createDataFrame([(w,) for w in words], "term string").withColumn("bucket", bucket_of(F.col("term"), buckets))
    wanted = sorted({r.bucket for r in asked.select("bucket").distinct().collect()})
    found = []
    for name, schema in (("postings", POSTINGS), ("terms", TERMS)):
        table = spark.read.schema(schema).parquet(f"{folder}/{name}").filter(F.col("bucket").isin(wanted))
        found.append(table.join(F.broadcast(asked.select("term")), "term", "left_semi"))
    return found[0], found[1]


def _score(shared, k: int):
    def run(rows: pa.Table) -> pa.Table:
        block, idf, mean_length = shared.value
        n_queries = len(block.query_ids)
        number = {w: i for i, w in enumerate(block.words)}
        encoded = rows.column("term").combine_chunks().dictionary_encode()
        word = np.array([number[w] for w in encoded.dictionary.to_pylist()], np.int64)[np.asarray(encoded.indices)]
        pmids, document = np.unique(rows.column("pmid").to_numpy(), return_inverse=True)
        tf, length = rows.column("tf").to_numpy(), rows.column("length").to_numpy()
        weight = idf[word] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * (length / mean_length)))
        del encoded, rows, tf, length
        order = np.lexsort((word, document))
        word, document, weight = word[order], document[order], weight[order]
        first_owner = np.cumsum(block.n_owners) - block.n_owners
        # Only documents with a positive score count as found.
        kept = NearestRows(n_queries, k, np.full(n_queries, np.nextafter(0.0, -1.0)))
        step = max(1, ADDED_CELLS // n_queries)
        for start in range(0, len(pmids), step):
            n = min(step, len(pmids) - start)
            some = slice(*np.searchsorted(document, [start, start + n]))
            owners = block.n_owners[word[some]]
            query = block.owners[_repeat_ranges(first_owner[word[some]], owners)]
            at = query * n + np.repeat(document[some] - start, owners)
            scores = np.bincount(at, weights=np.repeat(weight[some], owners), minlength=n_queries * n)
            kept.add(np.arange(n_queries), pmids[start : start + n], -np.round(scores.reshape(n_queries, n), SCORE_DECIMALS))
        del word, document, weight, order
        release_memory()
        return pa.Table.from_batches([kept.to_batch(block.query_ids)])

    return run


def _found(spark: SparkSession, folder: str, block: TermBlock, corpus, k: int) -> DataFrame:
    postings, terms = asked_postings(spark, folder, block.words, corpus.buckets)
    df = {r.term: r.df for r in terms.select("term", "df").collect()}  # a row per asked word at most
    frequency = np.array([df.get(w, 0) for w in block.words])
    idf = np.log(1 + (corpus.n_docs - frequency + 0.5) / (frequency + 0.5))
    shared = spark.sparkContext.broadcast((block, idf, corpus.words / max(1, corpus.n_docs)))
    tasks = -(-corpus.n_docs // DOCUMENTS_PER_TASK) or 1
    dealt = postings.select("term", "pmid", "tf", "length", F.pmod(F.xxhash64("pmid"), F.lit(tasks)).alias("part"))
    return dealt.groupBy("part").applyInArrow(_score(shared, k), NEIGHBOUR_SCHEMA)


def search_index(spark: SparkSession, folder: str, queries: DataFrame, k: int = 1000) -> DataFrame:
    """Best ``k`` documents of every query by BM25 in a stored index: ``query_id, pmid, rank, score``."""
    folder = folder.rstrip("/")
    corpus = spark.read.parquet(f"{folder}/corpus").first()
    passes = [_found(spark, folder, block, corpus, k) for block in term_blocks(query_terms(queries), k)]
    if not passes:
        passes = [spark.createDataFrame([], NEIGHBOUR_SCHEMA)]
    ranked = merge_nearest(reduce(DataFrame.union, passes), k)
    return ranked.select("query_id", "pmid", "rank", (-F.col("distance")).alias("score"))
