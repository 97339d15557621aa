"""Searches that end in article metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import article_url, author_line, citation, distance_line
from paperloom.operators import ivf, knn

SHOWN = 25
METADATA = ["title", "authors", "journal_name", "year", "volume", "issue", "pagination"]


def with_article(vectors: DataFrame, articles: DataFrame) -> DataFrame:
    """Vectors whose article exists; no shuffle when both are bucketed by ``pmid``."""
    return vectors.join(articles.select("pmid"), "pmid", "left_semi")


def attach_metadata(hits: DataFrame, articles: DataFrame) -> DataFrame:
    """Hits with the metadata of their article; Spark sees at run time how few the hits are."""
    return articles.select("pmid", *METADATA).join(hits, "pmid")


def search_with_metadata(
    vectors: DataFrame, articles: DataFrame, query_vector: list[float], k: int = SHOWN
) -> DataFrame:
    """``k`` nearest articles with their metadata, best first.

    Vectors without an article are left out before the ranking, so they never
    take a place in it. Vectors are scored where they are read; what is joined
    and shuffled is ``pmid, distance``.
    """
    scored = with_article(knn.distances_to_vector(vectors, query_vector), articles)
    hits = knn.merge_nearest(scored.withColumn("query_id", F.lit(0)), k).drop("query_id")
    found = attach_metadata(hits, articles)
    return found.select("distance", "pmid", *METADATA, "rank").orderBy("rank")


def display(hits: DataFrame, none_text: str | None = None) -> DataFrame:
    """Lines shown for a hit."""
    c = F.col
    return hits.select(
        "rank",
        "pmid",
        F.coalesce("title", F.lit(none_text or "")).alias("title"),
        article_url(c("pmid")).alias("url"),
        author_line(c("authors"), none_text or "").alias("author_line"),
        citation(
            c("journal_name"), c("volume"), c("issue"), c("pagination"), c("year"), c("pmid"), none_text
        ).alias("citation"),
        distance_line(c("distance")).alias("distance_line"),
    )


def search_queries(
    vectors: DataFrame, queries: DataFrame, k: int = 1000, index=None, n_probe: int | None = None
) -> DataFrame:
    """Run of a whole query set: exact, or over an ``(index, centroids)`` pair."""
    if index is None:
        found = knn.nearest(vectors, queries, k)
    else:
        cells, centroids = index
        found = ivf.search(cells, centroids, queries, k, n_probe or len(centroids))
    return found
