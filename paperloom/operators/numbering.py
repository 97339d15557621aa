"""Row numbers and running totals without a single-task window.

Rows are cut into ranges of the order key. Each range is numbered on its own
and shifted by the number of rows in the ranges before it, so neither a global
number nor a hot group is ever sorted by one task.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_bounds(df: DataFrame, column: str, ranges: int) -> list:
    """Sorted cut points (``ranges - 1`` at most) from approximate quantiles."""
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(column, shares, 10000)).first()[0]
    return sorted(set(found or []))


def range_of(column: str, bounds: list) -> Column:
    """Number of the range a value falls in; a cut point has a range to itself.

    A value frequent enough to matter is always a cut point, which keeps it
    apart from other values.
    """
    if not bounds:
        return F.lit(0)
    return reduce(
        add,
        [
            (F.col(column) > b).cast("int") + (F.col(column) >= b).cast("int")
            for b in bounds
        ],
    )


def _with_ranges(df: DataFrame, order: str, descending: bool, tie: str | None, ranges: int) -> DataFrame:
    bounds = range_bounds(df, order, ranges)
    first = range_of(order, bounds)
    df = df.withColumn("_range", -first if descending else first)
    if tie is None:
        return df.withColumn("_subrange", F.lit(0))
    # Only single-valued (odd) ranges may be cut further by the tie-break.
    sub = F.when(F.pmod("_range", F.lit(2)) == 1, range_of(tie, range_bounds(df, tie, ranges)))
    return df.withColumn("_subrange", F.coalesce(sub, F.lit(0)))


def running_total(
    df: DataFrame,
    value: Column,
    order: str,
    tie: str | None = None,
    group: list[str] | None = None,
    descending: bool = False,
    total: str = "running_total",
    ranges: int = 32,
) -> DataFrame:
    """``total`` = sum of ``value`` over the group's rows up to and with this one.

    ``order`` (numeric or date) and ``tie`` must identify a row in its group,
    and must not be NULL.
    """
    group = group or []
    parts = [*group, "_range", "_subrange"]
    ranged = _with_ranges(df.withColumn("_value", value), order, descending, tie, ranges)
    sums = ranged.groupBy(*parts).agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_range", "_subrange").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sums.select(*parts, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    key = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*parts).orderBy(key, *([tie] if tie else [])).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    numbered = ranged.withColumn("_inside", F.sum("_value").over(inside))
    joined = numbered.join(offsets, parts, "inner")
    return joined.withColumn(total, F.col("_offset") + F.col("_inside")).select(*df.columns, total)


def row_numbers(
    df: DataFrame,
    order: str,
    tie: str | None = None,
    group: list[str] | None = None,
    descending: bool = False,
    number: str = "row_number",
    ranges: int = 32,
) -> DataFrame:
    """Dense 1-based numbers in the given order, per group or over all rows."""
    return running_total(
        df, F.lit(1).cast("bigint"), order, tie, group, descending, number, ranges
    )


def surrogate_ids(df: DataFrame, order: str, surrogate: str = "query_int") -> DataFrame:
    """Dense 0-based integer per row, in source order."""
    numbered = row_numbers(df, order, number="_n")
    return numbered.withColumn(surrogate, (F.col("_n") - 1).cast("int")).drop("_n")


def batch_ranges(df: DataFrame, order: str, batch_size: int) -> DataFrame:
    """Batches of ``batch_size`` consecutive rows with their 1-based row range."""
    batch = F.floor((F.col("_n") - 1) / batch_size)
    return (
        row_numbers(df, order, number="_n")
        .groupBy(batch.alias("batch"))
        .agg(F.min("_n").alias("first_row"), F.max("_n").alias("last_row"), F.count("*").alias("n_rows"))
    )


def batch_totals(batches: DataFrame, total: str = "running_total") -> DataFrame:
    """Rows processed up to and with each batch."""
    return running_total(batches, F.col("n_rows"), "batch", total=total)
