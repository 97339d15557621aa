"""Scores of ranked runs against relevance judgments.

A run has ``query_id, pmid, rank`` (0-based), judgments ``query_id, pmid,
rel``; both hold a pair at most once. Counts are plain aggregates over the
whole run; rank-based metrics look at the first ``MAX_DEPTH`` rows of a query,
so no window grows beyond that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.topk import top_n_per_group

# Cut-offs and depths of the reported metrics.
CUTOFFS = [5, 10, 15, 20, 30, 100, 200, 500, 1000]
MAP_DEPTH = 10000
DEPTH = 1000
MAX_DEPTH = max(MAP_DEPTH, DEPTH)
GEOMETRIC_FLOOR = 1e-5


def _judged(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Run rows with ``rel``; NULL where the pair is not judged."""
    rel = qrels.select("query_id", "pmid", "rel")
    return run.select("query_id", "pmid", "rank").join(rel, ["query_id", "pmid"], "left")


def _positions(judged: DataFrame, order: list[Column]) -> DataFrame:
    """First rows of every query with 1-based ``r`` and running judgment counts."""
    top = top_n_per_group(judged, ["query_id"], order, MAX_DEPTH, position="r")
    so_far = Window.partitionBy("query_id").orderBy("r").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    relevant = F.coalesce(F.col("rel") > 0, F.lit(False))
    judged_not = F.coalesce(F.col("rel") <= 0, F.lit(False))
    return top.select(
        "query_id",
        "r",
        F.coalesce("rel", F.lit(0)).alias("gain"),
        relevant.alias("hit"),
        F.sum(relevant.cast("int")).over(so_far).alias("hits_so_far"),
        F.sum(judged_not.cast("int")).over(so_far).alias("misses_so_far"),
    )


def topic_judgments(qrels: DataFrame) -> DataFrame:
    """``n_rel`` relevant and ``n_nonrel`` judged non-relevant documents per topic."""
    return qrels.groupBy("query_id").agg(
        F.sum((F.col("rel") > 0).cast("bigint")).alias("n_rel"),
        F.sum((F.col("rel") <= 0).cast("bigint")).alias("n_nonrel"),
    )


def ideal_gains(qrels: DataFrame) -> DataFrame:
    """``ideal_k`` per topic: discounted gain of the best possible ranking."""
    best = top_n_per_group(
        qrels.filter(F.col("rel") > 0), ["query_id"], [F.col("rel").desc(), F.col("pmid")], max(CUTOFFS), position="r"
    )
    return best.groupBy("query_id").agg(
        *[F.expr(f"sum(CASE WHEN r <= {k} THEN rel / log2(r + 1) END) AS ideal_{k}") for k in CUTOFFS]
    )


def per_query_metrics(
    run: DataFrame, qrels: DataFrame, tie_order: str = "rank", topics: str = "run"
) -> DataFrame:
    """All metrics of every topic, one row each.

    ``tie_order='docid_desc'`` ranks by descending id for all metrics but NDCG;
    ``topics='qrels'`` also scores topics without a retrieved document.
    """
    if tie_order not in ("rank", "docid_desc"):
        raise ValueError("tie_order is 'rank' or 'docid_desc'")
    if topics not in ("run", "qrels"):
        raise ValueError("topics is 'run' or 'qrels'")
    judged = _judged(run, qrels)
    topic = topic_judgments(qrels)
    r, hit = F.col("r"), F.col("hit")
    by_rank = _positions(judged, [F.col("rank"), F.col("pmid")])
    gains = [
        F.expr(f"sum(CASE WHEN hit AND r <= {k} THEN gain / log2(r + 1) ELSE 0D END) AS gain_{k}")
        for k in CUTOFFS
    ]
    base = by_rank
    if tie_order == "docid_desc":
        base = _positions(judged, [F.col("pmid").desc()])
    base = base.join(topic, "query_id", "left")
    cap = F.least("n_rel", "n_nonrel")
    preferred = F.when(cap > 0, 1.0 - F.least("misses_so_far", cap) / F.greatest(cap, F.lit(1))).otherwise(1.0)
    sums = base.groupBy("query_id").agg(
        F.sum(F.when(hit & (r <= MAP_DEPTH), F.col("hits_so_far") / r).otherwise(0.0)).alias("ap_sum"),
        F.sum(F.when(hit & (r <= DEPTH), preferred).otherwise(0.0)).alias("bpref_sum"),
        F.count_if(hit & (r <= F.least(F.col("n_rel"), F.lit(DEPTH)))).alias("r_hits"),
        F.coalesce(1.0 / F.min(F.when(hit & (r <= DEPTH), r)), F.lit(0.0)).alias("recip_rank"),
        *[F.expr(f"count_if(hit AND r <= {k}) AS hits_{k}") for k in CUTOFFS],
        *(gains if tie_order == "rank" else []),
    )
    if tie_order != "rank":
        sums = sums.join(by_rank.groupBy("query_id").agg(*gains), "query_id")
    counts = judged.groupBy("query_id").agg(
        F.count("*").alias("num_ret"), F.count_if(F.col("rel") > 0).alias("num_rel_ret")
    )
    scored = counts.join(sums, "query_id")
    if topics == "qrels":
        scored = topic.filter(F.col("n_rel") > 0).select("query_id").join(scored, "query_id", "left").na.fill(0)
    full = scored.join(topic, "query_id", "left").join(ideal_gains(qrels), "query_id", "left")
    n_rel = F.nullif(F.col("n_rel"), F.lit(0))
    return full.select(
        "query_id",
        "num_ret",
        F.coalesce("n_rel", F.lit(0)).alias("num_rel"),
        "num_rel_ret",
        F.try_divide("ap_sum", n_rel).alias("ap"),
        F.try_divide("bpref_sum", n_rel).alias("bpref"),
        F.try_divide("r_hits", n_rel).alias("Rprec"),
        "recip_rank",
        *[F.expr(f"hits_{k} / {k} AS `P@{k}`") for k in CUTOFFS],
        *[F.expr(f"try_divide(gain_{k}, ideal_{k}) AS `NDCG@{k}`") for k in CUTOFFS],
    )


def metric_panel(
    run: DataFrame, qrels: DataFrame, tie_order: str = "rank", topics: str = "run"
) -> DataFrame:
    """Every metric over all topics: one row.

    Means run over the topics of the run (or of the judgments); topics without
    a relevant document are left out of means that divide by their number.
    ``num_rel`` counts the judgments of all topics.
    """
    per_query = per_query_metrics(run, qrels, tie_order, topics)
    all_relevant = qrels.agg(F.count_if(F.col("rel") > 0).alias("n"))
    floored = F.when(F.col("ap").isNotNull(), F.log(F.greatest(F.col("ap"), F.lit(GEOMETRIC_FLOOR))))
    averaged = [
        "bpref",
        "Rprec",
        "recip_rank",
        *[f"P@{k}" for k in CUTOFFS],
        *[f"NDCG@{k}" for k in CUTOFFS],
    ]
    panel = per_query.agg(
        F.coalesce(F.sum("num_ret"), F.lit(0)).alias("num_ret"),
        F.coalesce(F.sum("num_rel_ret"), F.lit(0)).alias("num_rel_ret"),
        F.count("*").alias("num_q"),
        F.avg("ap").alias("map"),
        F.exp(F.avg(floored)).alias("gm_map"),
        *[F.expr(f"avg(`{m}`) AS `{m}`") for m in averaged],
    )
    return panel.select(
        "num_ret",
        all_relevant.scalar().alias("num_rel"),
        *[f"`{c}`" for c in ("num_rel_ret", "num_q", "map", "gm_map", *averaged)],
    )


def long_form(panel: DataFrame) -> DataFrame:
    """``metric, value`` rows of a panel."""
    columns = [F.col(f"`{c}`").cast("double").alias(c) for c in panel.columns]
    return panel.select(*columns).unpivot([], [f"`{c}`" for c in panel.columns], "metric", "value")
