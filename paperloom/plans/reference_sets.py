"""Reference sets: queries and judgments in terms of article ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.numbering import surrogate_ids
from paperloom.operators.skew import salted_join
from paperloom.session import exists
from paperloom.sources.tables import max_id_as_of

SAMPLE_SIZE = 100
# Fixed value: last file number of the article set the binary judgments were made on.
BINARY_FILE_LIMIT = 1219


@dataclass
class ReferenceSet:
    """``queries(query_id, query)``, ``qrels(query_id, pmid, rel)`` and the limits of its kind."""

    queries: DataFrame
    qrels: DataFrame
    allowed: DataFrame | None = None
    max_pmid: DataFrame | None = None
    sample: DataFrame | None = None

    def parts(self) -> dict[str, DataFrame]:
        return {n: df for n, df in vars(self).items() if df is not None}

    def save(self, folder: str) -> None:
        for name, df in self.parts().items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> ReferenceSet:
        found = {
            n: spark.read.parquet(f"{folder}/{n}")
            for n in cls.__dataclass_fields__
            if exists(spark, f"{folder}/{n}")
        }
        return cls(**found)

    def sampled(self) -> ReferenceSet:
        """The part of the set that belongs to the sampled queries."""
        keep = self.sample.select("query_id").distinct()
        return ReferenceSet(
            self.queries.join(keep, "query_id", "left_semi"),
            salted_join(self.qrels, keep, ["query_id"], "left_semi"),
            self.allowed,
            self.max_pmid,
            self.sample,
        )


def title_matches(documents: DataFrame, articles: DataFrame) -> DataFrame:
    """``doc_id, pmid`` of documents whose title equals an article's.

    Among articles with one title the smallest id counts. They are reduced
    first, so a title that many articles carry meets each document once.
    """
    by_title = articles.filter(F.col("title").isNotNull()).groupBy("title").agg(F.min("pmid").alias("pmid"))
    wanted = documents.filter(F.col("title").isNotNull()).select("doc_id", "title")
    return salted_join(wanted, by_title, ["title"]).select("doc_id", "pmid")


def missing_article_id(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col("article_id").isNull())


def document_ids(documents: DataFrame, articles: DataFrame) -> DataFrame:
    """``doc_id, pmid``: the explicit id, or for documents without one the title match."""
    matched = title_matches(missing_article_id(documents), articles)
    return merge_id_maps(documents.select("doc_id", F.col("article_id").alias("pmid")), matched)


def merge_id_maps(explicit: DataFrame, override: DataFrame) -> DataFrame:
    """Union of two maps ``doc_id -> pmid``; the second wins."""
    other = override.select("doc_id", F.col("pmid").alias("_pmid"))
    merged = explicit.join(other, "doc_id", "full_outer")
    return merged.select("doc_id", F.coalesce("_pmid", "pmid").alias("pmid")).filter(F.col("pmid").isNotNull())


def resolve_judgments(judgments: DataFrame, ids: DataFrame, surrogates: DataFrame) -> DataFrame:
    """``query_id, pmid, rel`` with article ids and integer query ids.

    Judgments of unknown documents or queries drop out. Where documents share
    an article, the last judgment in the file counts.
    """
    by_article = salted_join(judgments, ids.select("doc_id", "pmid"), ["doc_id"])
    numbered = salted_join(by_article, surrogates.select("query_id", "query_int"), ["query_id"])
    return (
        numbered.groupBy(F.col("query_int").alias("query_id"), F.col("pmid").cast("bigint").alias("pmid"))
        .agg(F.max_by("rel", "line_no").alias("rel"))
    )


def build_graded(
    queries: DataFrame, judgments: DataFrame, documents: DataFrame, articles: DataFrame
) -> ReferenceSet:
    """Graded set from ``reference_files`` frames; only mapped documents are allowed."""
    ids = document_ids(documents, articles)
    surrogates = surrogate_ids(queries, "line_no")
    qrels = resolve_judgments(judgments, ids, surrogates)
    numbered = surrogates.select(F.col("query_int").alias("query_id"), "query")
    return ReferenceSet(numbered, qrels, allowed=ids.select("pmid").distinct())


def sample_queries(queries: DataFrame, n: int = SAMPLE_SIZE, seed: int = 1) -> DataFrame:
    """Repeatable sample: the ids with the smallest seeded hash."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("query_id").cast("string")))
    return queries.select("query_id").orderBy(key, "query_id").limit(n)


def build_binary(
    questions: DataFrame,
    articles: DataFrame,
    file_limit: int = BINARY_FILE_LIMIT,
    sample_size: int = SAMPLE_SIZE,
    seed: int = 1,
) -> ReferenceSet:
    """Binary set from question rows, with the greatest id of its article files."""
    surrogates = surrogate_ids(questions, "line_no")
    numbered = surrogates.select(F.col("query_int").alias("query_id"), "query", "pmids")
    qrels = numbered.select("query_id", F.explode("pmids").alias("pmid"), F.lit(1).alias("rel")).distinct()
    queries = numbered.select("query_id", "query")
    return ReferenceSet(
        queries,
        qrels,
        max_pmid=max_id_as_of(articles, file_limit),
        sample=sample_queries(queries, sample_size, seed),
    )
