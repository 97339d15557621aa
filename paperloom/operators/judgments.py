"""Runs and judgments: shapes, filters, and preparation for scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.skew import salted_join
from paperloom.operators.topk import top_n_per_group

RUN_DEPTH = 1000


def run_from_lists(lists: DataFrame, ids: str = "pmids") -> DataFrame:
    """Run rows from one list of ids per query, best first."""
    return lists.select("query_id", F.posexplode(ids).alias("rank", "pmid")).select(
        "query_id",
        F.col("pmid").cast("bigint").alias("pmid"),
        "rank",
        F.lit(0.0).alias("score"),
        F.lit("system").alias("system"),
    )


def run_as_lists(run: DataFrame, depth: int | None = None) -> DataFrame:
    """One list of ids per query, best first; all that was retrieved, or the first ``depth``."""
    if depth is None:
        top = run.withColumn("position", F.col("rank"))
    else:
        top = top_n_per_group(run, ["query_id"], [F.col("rank"), F.col("pmid")], depth)
    ordered = F.array_sort(F.collect_list(F.struct("position", "pmid")))
    return top.groupBy("query_id").agg(F.transform(ordered, lambda x: x.pmid).alias("pmids"))


def qrels_from_maps(maps: DataFrame, scores: str = "scores") -> DataFrame:
    """Judgment rows from one ``map<pmid, score>`` per query."""
    return maps.select("query_id", F.explode(scores).alias("pmid", "rel"))


def qrels_from_lists(lists: DataFrame, ids: str = "pmids") -> DataFrame:
    """Binary judgments from one list of relevant ids per query."""
    return lists.select("query_id", F.explode(ids).alias("pmid"), F.lit(1).alias("rel")).distinct()


def keep_allowed(run: DataFrame, allowed: DataFrame) -> DataFrame:
    """Run rows whose document is in the allowed set."""
    return salted_join(run, allowed.select("pmid").distinct(), ["pmid"], "left_semi")


def keep_up_to(run: DataFrame, max_pmid: int | DataFrame) -> DataFrame:
    """Run rows up to the greatest id, given as a number or a one-row frame."""
    limit = max_pmid.scalar() if isinstance(max_pmid, DataFrame) else F.lit(max_pmid)
    return run.filter(F.col("pmid") <= limit)


def keep_queries(df: DataFrame, query_ids: DataFrame) -> DataFrame:
    """Rows of the given (sampled) queries."""
    return salted_join(df, query_ids.select("query_id").distinct(), ["query_id"], "left_semi")


def retrieved_not_relevant(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Pairs of the run that no judgment calls relevant."""
    relevant = qrels.filter(F.col("rel") > 0).select("query_id", "pmid")
    return run.select("query_id", "pmid").join(relevant, ["query_id", "pmid"], "left_anti")


def with_retrieved_as_judged(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Relevant judgments, and every other retrieved pair with ``rel = 0``."""
    relevant = qrels.filter(F.col("rel") > 0).select("query_id", "pmid", "rel")
    others = retrieved_not_relevant(run, qrels).select("query_id", "pmid", F.lit(0).alias("rel"))
    return relevant.unionByName(others)


def prepare_graded(run: DataFrame, qrels: DataFrame, allowed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Run limited to the allowed documents, and the judgments as they are."""
    return keep_allowed(run, allowed), qrels


def prepare_binary(
    run: DataFrame, qrels: DataFrame, max_pmid: int | DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Judgments completed from the whole run, then the run cut at the greatest id."""
    return keep_up_to(run, max_pmid), with_retrieved_as_judged(run, qrels)
