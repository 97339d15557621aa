"""Joins on keys of which one may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(
    facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """``facts`` joined to a lookup that is unique in ``on``.

    Rows of ``facts`` with one key are spread over ``salts`` tasks; the narrow
    lookup side is repeated for them. ``how`` is inner, left, left_semi or
    left_anti. Where Spark finds the lookup small enough to broadcast, the salt
    is just one more equality.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    rest = [c for c in facts.columns if c not in on]
    spread = F.xxhash64(*rest) if rest else F.spark_partition_id().cast("bigint")
    salted = facts.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
