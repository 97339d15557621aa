"""Files of public retrieval benchmarks: queries, judgments, corpora, questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import (
    ARTICLE_ID_FIELD_PATTERN,
    ID_FIELD_PATTERN,
    TEXT_FIELD_PATTERN,
    TITLE_FIELD_PATTERN,
    extract_field,
    urls_to_ids,
)
from paperloom.schemas import QUESTION_FILE

JUDGMENT_FILE = "query_id string, doc_id string, rel int"


def query_lines(lines: DataFrame) -> DataFrame:
    """``query_id, query, line_no`` of lines with both fields; a repeated id keeps its last text."""
    line = F.col("value")
    found = lines.select(
        extract_field(line, ID_FIELD_PATTERN).alias("query_id"),
        extract_field(line, TEXT_FIELD_PATTERN).alias("query"),
        "line_no",
    ).filter(F.col("query_id").isNotNull())
    return found.groupBy("query_id").agg(
        F.max_by("query", "line_no").alias("query"), F.min("line_no").alias("line_no")
    )


def corpus_lines(lines: DataFrame) -> DataFrame:
    """``doc_id, title, article_id, line_no`` of lines with an id; invalid JSON is fine.

    A repeated id keeps its last line, at the place of its first.
    """
    line = F.col("value")
    found = lines.select(
        extract_field(line, ID_FIELD_PATTERN).alias("doc_id"),
        extract_field(line, TITLE_FIELD_PATTERN).alias("title"),
        extract_field(line, ARTICLE_ID_FIELD_PATTERN).cast("bigint").alias("article_id"),
        "line_no",
    ).filter(F.col("doc_id").isNotNull())
    last = F.max_by(F.struct("title", "article_id"), "line_no").alias("last")
    return found.groupBy("doc_id").agg(last, F.min("line_no").alias("line_no")).select(
        "doc_id", "last.title", "last.article_id", "line_no"
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, line_no``; numbers grow along the file but are not dense."""
    return spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line_no"))


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    return query_lines(read_lines(spark, path))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return corpus_lines(read_lines(spark, path))


def read_judgments(spark: SparkSession, path: str) -> DataFrame:
    """``query_id, doc_id, rel, line_no`` of a tab-separated file with a header."""
    rows = spark.read.csv(path, sep="\t", header=True, enforceSchema=True, schema=JUDGMENT_FILE)
    return rows.withColumn("line_no", F.monotonically_increasing_id())


def question_rows(files: DataFrame) -> DataFrame:
    """``query_id, query, pmids, line_no`` of ``questions`` arrays; a repeated id keeps its first place and its last text."""
    questions = files.select(F.posexplode("questions").alias("line_no", "question")).select(
        F.col("question.id").alias("query_id"),
        F.struct(
            F.col("question.body").alias("query"), urls_to_ids(F.col("question.documents")).alias("pmids")
        ).alias("question"),
        F.col("line_no").cast("bigint").alias("line_no"),
    )
    last = questions.groupBy("query_id").agg(F.max_by("question", "line_no").alias("question"), F.min("line_no").alias("line_no"))
    return last.select("query_id", "question.query", "question.pmids", "line_no")


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    return question_rows(spark.read.schema(QUESTION_FILE).json(path, multiLine=True))
