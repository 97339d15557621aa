"""Mixing of sources to target weights by hash-threshold histograms.

Each document has a fixed hash. A source whose target is t takes every document
whose hash lies under nested thresholds: the c-th copy of a document is taken if
its hash is below the c-th threshold, whose budget is what the copies before left
of t. Thresholds come from histograms of words by source and hash bucket; only
the one bucket that a threshold falls into is looked at again, with the next bits
of the hash. Documents are never sorted: a histogram is a plain aggregate that
combines before its shuffle, so a source with a third of all rows sends as little
as any other, and in the end each source has one threshold to filter by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import n_words, stored

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
# 60 bits of hash, looked at 12 bits at a time: 4096 buckets per source and level.
HASH_BITS = 60
LEVEL_BITS = 12
LEVELS = 3


def _size(text: str) -> Column:
    return n_words(F.col(text))


def _hash(doc_id: Column) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def sizes(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``doc_id, source, size, hash`` of every row; a null text has size 0, a null id the hash of the empty string."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        _size(text).alias("size"),
        _hash(F.col(doc_id)).alias("hash"),
    )


def targets(sized: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, target``: one row per source.

    Sources in code-point order, null last, have the weights in turn. A target stops
    at ``max_copies`` times its source's size; what is over goes to the others by
    weight. In the order of size per weight the stopped sources come first, so one
    pass of running sums finds them. The window holds one row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    order = Window.orderBy("cap_per_weight", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weighed = (
        per_source.withColumn("weight", weight)
        .withColumn("cap", (F.lit(max_copies) * F.col("source_size")).cast("double"))
        .withColumn("cap_per_weight", F.col("cap") / F.col("weight"))
        .withColumn("at", F.row_number().over(order))
        .withColumn(
            "per_weight",
            (
                F.sum(F.col("source_size").cast("double")).over(everything)
                - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
            )
            / F.sum("weight").over(after),
        )
    )
    # The first source that is not stopped fixes the share per weight of all that follow.
    first = F.when(F.col("cap_per_weight") > F.col("per_weight"), F.struct("at", "per_weight"))
    share = F.min(first).over(everything)["per_weight"]
    return weighed.withColumn("share", share).select(
        "source",
        "source_size",
        F.coalesce(F.least("cap", F.col("weight") * F.col("share")), F.col("cap")).alias("target"),
    )


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """``source, source_size, target, copies, threshold``: ``copies`` of every document, one more below the threshold."""
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    budgets = goals.withColumn("copies", whole)
    edge = budgets.select("source", (F.col("target") - F.col("copies") * F.col("source_size")).alias("left"))
    for level in range(1, LEVELS + 1):
        bucket = F.shiftright("hash", HASH_BITS - level * LEVEL_BITS)
        rows = sized.withColumn("bucket", bucket)
        if level > 1:
            inside = F.shiftright("bucket", LEVEL_BITS) == F.col("e.edge_bucket")
            rows = rows.alias("r").join(edge.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")) & inside, "left_semi")
        histogram = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
        edge = stored(_edge(histogram, edge), f"mix-edge-{level}")
    bits = HASH_BITS - LEVELS * LEVEL_BITS
    last = edge.select(
        F.col("source").alias("edge_source"),
        F.shiftleft(F.col("edge_bucket") + (F.col("left") * 2 >= F.col("in_bucket")).cast("long"), bits).alias("threshold"),
    )
    return budgets.join(last, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source")


def _edge(histogram: DataFrame, edge: DataFrame) -> DataFrame:
    """The bucket of each source in which its budget ends, and what is left for it there."""
    by_bucket = Window.partitionBy("h.source").orderBy("h.bucket").rowsBetween(Window.unboundedPreceding, 0)
    return (
        histogram.alias("h")
        .join(edge.select("source", "left").alias("e"), F.col("h.source").eqNullSafe(F.col("e.source")))
        .withColumn("up_to", F.sum("h.in_bucket").over(by_bucket))
        .filter((F.col("up_to") > F.col("left")) & (F.col("up_to") - F.col("in_bucket") <= F.col("left")))
        .select(
            "h.source",
            F.col("bucket").alias("edge_bucket"),
            "in_bucket",
            (F.col("left") - (F.col("up_to") - F.col("in_bucket"))).alias("left"),
        )
    )


def _copies(size: Column, hash_: Column, max_copies: int) -> Column:
    more = F.coalesce((hash_ < F.col("threshold")).cast("long"), F.lit(0))
    copies = F.least(F.lit(max_copies), F.col("copies") + more)
    return F.when(size > 0, copies).otherwise(F.lit(0)).cast("long")


def _fitted(docs: DataFrame, weights, max_copies: int, doc_id: str, source: str, text: str) -> tuple[DataFrame, DataFrame]:
    sized = stored(sizes(docs, doc_id, source, text), "mix-sizes")
    goals = stored(targets(sized, weights, max_copies), "mix-targets")
    return sized, stored(thresholds(sized, goals), "mix-thresholds").withColumnRenamed("source", "its_source")


def mixed(
    docs: DataFrame,
    weights=WEIGHTS,
    max_copies: int = MAX_COPIES,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs``.

    ``taken`` is the size times ``copies``, 0 to ``max_copies``. The sum of a source
    differs from its target by at most half of the documents that share the first 36
    bits of one hash, mostly one document; rows with the same id stay together. A size
    of 0 takes nothing, a null source is a source like any other, an empty table gives
    an empty one.
    """
    sized, per_source = _fitted(docs, weights, max_copies, doc_id, source, text)
    return (
        sized.join(per_source, F.col("source").eqNullSafe(F.col("its_source")))
        .withColumn("copies", _copies(F.col("size"), F.col("hash"), max_copies))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    )


def repeated(
    docs: DataFrame,
    weights=WEIGHTS,
    max_copies: int = MAX_COPIES,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The mix itself: each row of ``docs``, whatever its columns are called, as often as :func:`mixed` takes it."""
    _, per_source = _fitted(docs, weights, max_copies, doc_id, source, text)
    # The row travels in a struct, so that none of its columns can clash.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = lambda c: F.col("row").getField(c)
    joined = whole.join(per_source, own(source).cast("string").eqNullSafe(F.col("its_source")))
    keyed = joined.withColumns({"hash": _hash(own(doc_id)), "size": n_words(own(text))})
    limit = F.col("copies") + F.coalesce((F.col("hash") < F.col("threshold")).cast("long"), F.lit(0))
    copies = F.when(F.col("size") > 0, F.least(F.lit(max_copies), limit)).otherwise(F.lit(0))
    return keyed.select("row", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select("row.*")
