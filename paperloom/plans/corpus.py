"""The corpus from change files to stored vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.embedding import pending_texts
from paperloom.operators.changelog import ArticleStore
from paperloom.sources.change_files import read_changes
from paperloom.sources.tables import texts_to_embed


def update_articles(spark: SparkSession, xml_folder: str, store_folder: str, **options) -> int:
    """Apply all change files of a folder to the article store; gives the number of articles."""
    store = ArticleStore(spark, store_folder)
    store.upsert(read_changes(spark, xml_folder, **options))
    return store.articles().count()


def embed_pending(
    articles: DataFrame, done: DataFrame, embed: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Vectors of new and changed articles: ``pmid, text_hash, pub_date, embedding``.

    ``embed`` gets ``pmid, text_hash, pub_date, text`` and gives the first three back
    with ``embedding``, so no text is composed twice.
    """
    pending = pending_texts(texts_to_embed(articles), done)
    vectors = embed(pending.select("pmid", "text_hash", F.col("publication_date").alias("pub_date"), "text"))
    return vectors.select("pmid", "text_hash", "pub_date", "embedding")
