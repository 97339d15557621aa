"""First n rows of every group, safe when one group holds most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    n: int,
    position: str = "position",
    salts: int = 32,
) -> DataFrame:
    """Rows with 1-based ``position <= n`` in their group.

    Each group is first cut to n rows per salt, so that the last window never sees
    more than ``salts * n`` rows of one group. The salts bound the tasks that share
    one group; raise them with the rows.
    """
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    salted = Window.partitionBy(*group, "_salt").orderBy(*order)
    cut = (
        df.withColumn("_salt", salt)
        .withColumn("_part_position", F.row_number().over(salted))
        .filter(F.col("_part_position") <= n)
        .drop("_salt", "_part_position")
    )
    window = Window.partitionBy(*group).orderBy(*order)
    return cut.withColumn(position, F.row_number().over(window)).filter(F.col(position) <= n)
