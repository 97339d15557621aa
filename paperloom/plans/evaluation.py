"""From query texts to a metric panel, in one lineage and without a loop over queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from paperloom.operators import keyword
from paperloom.operators.judgments import (
    RUN_DEPTH,
    keep_queries,
    prepare_binary,
    prepare_graded,
    run_from_lists,
)
from paperloom.operators.metrics import metric_panel
from paperloom.plans.reference_sets import ReferenceSet
from paperloom.plans.search import search_queries


def prepare(run: DataFrame, reference: ReferenceSet) -> tuple[DataFrame, DataFrame]:
    """Run and judgments as the kind of reference set asks for."""
    if reference.allowed is not None:
        return prepare_graded(run, reference.qrels, reference.allowed)
    if reference.max_pmid is not None:
        # Retrieved pairs become judgments only for the queries of the set.
        return prepare_binary(keep_queries(run, reference.queries), reference.qrels, reference.max_pmid)
    return run, reference.qrels


def evaluate(
    run: DataFrame, reference: ReferenceSet, tie_order: str = "rank", topics: str = "run"
) -> DataFrame:
    """Metric panel of a run against a reference set."""
    return metric_panel(*prepare(run, reference), tie_order=tie_order, topics=topics)


def evaluate_vector_search(
    reference: ReferenceSet,
    vectors: DataFrame,
    embed_queries: Callable[[DataFrame], DataFrame],
    k: int = RUN_DEPTH,
    index=None,
    n_probe: int | None = None,
) -> DataFrame:
    """Embed all queries, search the vectors, score the run."""
    run = search_queries(vectors, embed_queries(reference.queries), k, index, n_probe)
    return evaluate(run, reference)


def keyword_run(
    queries: DataFrame, documents: DataFrame, cached: DataFrame | None = None, k: int = RUN_DEPTH
) -> DataFrame:
    """Run of a query set: cached lists where present, a search for the others."""
    if cached is None:
        return keyword.search(documents, queries, k).select("query_id", "pmid", "rank")
    hits, misses = keyword.split_by_cache(queries, cached)
    searched = keyword.search(documents, misses, k).select("query_id", "pmid", "rank")
    return run_from_lists(hits).select("query_id", "pmid", "rank").unionByName(searched)


def evaluate_keyword_search(
    reference: ReferenceSet, documents: DataFrame, cached: DataFrame | None = None, k: int = RUN_DEPTH
) -> DataFrame:
    return evaluate(keyword_run(reference.queries, documents, cached, k), reference)
