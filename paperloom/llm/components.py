"""Connected components as joins: the smallest id that links reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import stored


def _between(a: str, b: str, links: DataFrame) -> DataFrame:
    """The different links between two ids, each once, as ``a < b``; a link of an id with itself stays in the first round."""
    return links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def components(links: DataFrame, name: str) -> DataFrame:
    """``id, component_id`` of every id that occurs in the links ``a, b``.

    Each round points an id to its smallest neighbour if that is smaller, follows the
    pointers to their ends, and goes on with the links between different ends, of which
    there are at most half as many as ids. A link is joined in the rounds until its ends
    meet, not in all of them, so a dense group costs its links once. Tables are written
    to the shared folder; only a count reaches the driver.
    """
    left = stored(_between("a", "b", links.dropna(subset=["a", "b"])), f"{name}-links")
    found = None
    while True:
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("end")).toDF("id", "end")
        ends = stored(ends, f"{name}-ends")
        while True:
            jump = ends.toDF("at", "jump")
            after = ends.join(jump, F.col("end") == F.col("at")).select("id", F.col("jump").alias("end"), (F.col("jump") < F.col("end")).alias("fell"))
            after = stored(after, f"{name}-ends")
            ends = after.select("id", "end")
            if not after.filter("fell").limit(1).count():
                break
        if found is None:
            found = ends
        else:
            found = found.toDF("id", "was").join(ends.toDF("at", "end"), F.col("was") == F.col("at"), "left")
            found = stored(found.select("id", F.coalesce("end", "was").alias("end")), f"{name}-found")
        met = left.join(ends.toDF("a", "end_a"), "a").join(ends.toDF("b", "end_b"), "b").filter("end_a != end_b")
        left = stored(_between("end_a", "end_b", met), f"{name}-links")
        if not left.limit(1).count():
            return found.toDF("id", "component_id")
