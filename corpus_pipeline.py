"""From raw documents to piece ids: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import jaccard_join, line_dedup, mixing, pieces, quality_classifier
from paperloom.llm.common import stored, table

# The classifier, the join's classes and the pieces are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


# Whole texts go to Python workers in batches of this size.
BATCH_BYTES = "8m"


def in_small_batches(stage):
    """``stage`` in a session that sends rows to Python workers in small batches, so that neither side holds many texts."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of those that are not held out."""
    measured = stored(quality_classifier.text_statistics(docs), "stage-statistics")
    model = quality_classifier.fit(measured, table(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, model)


@in_small_batches
def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; ``n_chars`` follows the text."""
    cut = line_dedup.without_shared_lines(docs)
    kept = cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut
    return kept.select(docs.columns)


@in_small_batches
def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies. Rows without an id stay."""
    classes = jaccard_join.classes(docs)
    gone = classes.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("gone")).distinct()
    gone = stored(gone, "stage-copies")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


@in_small_batches
def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeated(docs)


@in_small_batches
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, piece_ids`` of each document; the text can be had back from the ids."""
    rows = pieces.encoded(docs, pieces.Codec.load())
    return rows.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_shared_lines),
    ("n-gram Jaccard join", one_of_each_class),
    ("mixing sources to target weights", mixed_to_weights),
    ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k + 1}")
    return docs
