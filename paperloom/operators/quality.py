"""Checks on articles and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: str = "pmid") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def dimension_violations(vectors: DataFrame, dim: int) -> DataFrame:
    """Vectors that are missing or do not have ``dim`` dimensions."""
    size = F.size("embedding")
    return vectors.filter(F.col("embedding").isNull() | (size != dim)).select(
        "pmid", F.when(F.col("embedding").isNotNull(), size).alias("n_dims")
    )


def orphan_vectors(vectors: DataFrame, articles: DataFrame) -> DataFrame:
    """Ids of vectors without an article; they never appear in a search."""
    return vectors.select("pmid").join(articles.select("pmid"), "pmid", "left_anti")


def record_differences(actual: DataFrame, expected: DataFrame, key: str = "pmid") -> DataFrame:
    """Per expected record: whether it exists, and which columns differ (NULL-safe)."""
    columns = [c for c in expected.columns if c != key]
    found = actual.select(key, F.lit(True).alias("_found"), *[F.col(c).alias(f"_actual_{c}") for c in columns])
    joined = expected.join(found, key, "left")
    differing = F.array_compact(
        F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_actual_{c}")), F.lit(c)) for c in columns])
    )
    exists = F.coalesce("_found", F.lit(False))
    return joined.select(
        key, exists.alias("found"), F.when(exists, F.array_join(differing, ",")).alias("differing")
    )


def append_check(new: DataFrame, stored: DataFrame, dim: int) -> DataFrame:
    """What appending ``new`` to a vector table would break, and its final size: one row."""
    clashes = new.select("pmid").join(stored.select("pmid"), "pmid", "left_semi")
    repeated = duplicate_keys(new)
    n_stored = stored.agg(F.count("*"))
    n_clashes = clashes.agg(F.count("*"))
    n_repeated = repeated.agg(F.count("*"))
    return new.agg(
        F.count("*").alias("n_new"),
        F.count_if(F.coalesce(F.size("embedding") != dim, F.lit(True))).alias("n_wrong_dim"),
    ).select(
        "n_new",
        "n_wrong_dim",
        n_clashes.scalar().alias("n_existing"),
        n_repeated.scalar().alias("n_repeated"),
        (F.col("n_new") + n_stored.scalar()).alias("n_after"),
    )
