"""Isotonic calibration of raw scores from a histogram of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 2048


def fold(doc_id):
    """0: held out; 1: calibration; 2 to 4: fitting. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(0))


def one_label(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """``label_of, label``: one row per labelled document; several labels of one document give the greatest."""
    rows = labels.select(F.col(doc_id).alias("label_of"), F.col(label).cast("double").alias("label")).dropna()
    return rows.groupBy("label_of").agg(F.max("label").alias("label"))


def fit(scored: DataFrame, low: float, high: float, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """Knots (raw score, probability) of a rising curve through ``raw, label`` rows.

    Spark counts rows per bin of ``[low, high]``, so at most ``bins`` rows come to the
    driver, where neighbouring bins that fall are pooled. Without rows the curve is
    the straight line from 0 to 1.
    """
    width = (high - low) / bins
    at = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col("raw") - low) / width).cast("int")))
    rows = scored.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.sum("label").alias("hits")).collect()
    if not rows:
        return np.array([low, high]), np.array([0.0, 1.0])
    pools: list[list[float]] = []
    for row in sorted(rows):
        pools.append([row.n, row.hits, (low + (row.bin + 0.5) * width) * row.n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    n, hits, place = np.array(pools, float).T
    return place / n, hits / n


def apply(raw: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.interp(raw, *knots)
