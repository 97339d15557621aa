"""Quality classifier: random Fourier features, ridge from summed normal equations, isotonic calibration.

Statistics of each whole text are taken where it is read. Random Fourier features
make a ridge regression on them an approximate Gaussian-kernel ridge. Each partition
adds its labelled rows into one matrix; only matrices of a fixed size are shuffled,
and one of them reaches the driver to be solved.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from paperloom.llm import calibration
from paperloom.llm.common import SPACE_BYTES, released, stored

N_FOURIER = 256
SEED = 20
RIDGE = 1e-4
THRESHOLD = 0.3
LOW, HIGH = -0.5, 1.5
ROWS_AT_ONCE = 512
STATISTICS = 18

_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
_DIGITS = b"0123456789"
_HIGH_BYTES = bytes(range(128, 256))


def statistics(text: bytes) -> list[float]:
    """Lengths, character shares and repetition of one text; zeros for an empty one."""
    words = text.split()
    if not words:
        return [0.0] * STATISTICS
    n, m = len(text), len(words)
    lines = [x.strip(SPACE_BYTES) for x in text.split(b"\n")]
    lines = [x for x in lines if x]
    share = lambda chars: (n - len(text.translate(None, chars))) / n
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    letters = max(1e-9, share(_CAPITALS) + share(_SMALL))
    return [
        np.log1p(m),
        np.log1p(n / m),
        np.log1p(n / len(lines)),
        np.log1p(len(lines)),
        share(_SYMBOLS),
        share(_CAPITALS) / letters,
        share(_DIGITS),
        share(_HIGH_BYTES),
        share(b".,;:"),
        share(b"!?"),
        share(b"\"'()[]{}=/_-+~^`@\\"),
        len(counts) / m,
        np.log1p(m) * len(counts) / m,
        counts.most_common(1)[0][1] / m,
        sum(k * (k - 1) for k in counts.values()) / max(1, m * (m - 1)),
        1 - len(pairs) / max(1, m - 1),
        sum(a == b for a, b in zip(words, words[1:])) / m,
        1 - len(set(lines)) / len(lines),
    ]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return fourier(rows, self.mean, self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return calibration.apply(self.raw(rows), self.knots) if len(rows) else np.zeros(0)


def fourier(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray, n: int = N_FOURIER) -> np.ndarray:
    """Random features of standardised rows, a constant and the rows themselves."""
    x = np.clip((rows - mean) / scale, -6, 6)
    rng = np.random.default_rng(SEED)
    w = rng.normal(size=(x.shape[1], n)) / np.sqrt(x.shape[1])
    b = rng.uniform(0, 2 * np.pi, n)
    return np.hstack([np.sqrt(2 / n) * np.cos(x @ w + b), np.ones((len(x), 1)), 0.1 * x])


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, statistics`` of every row."""
    schema = StructType([StructField("doc_id", LongType()), StructField("statistics", ArrayType(DoubleType()))])

    def measured(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                rows = [statistics(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.float64()))], schema.names)

    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("body")).mapInArrow(released(measured), schema)


def fit(measured: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Model from stored ``doc_id, statistics`` and the labels of rows that are not held out.

    Two parts in three of the labelled rows fit the ridge, the rest calibrate it. Without
    labelled rows every score is 0.5.
    """
    columns = [F.col("statistics")[i] for i in range(STATISTICS)]
    moments = measured.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    moments = np.array([x or 0.0 for x in moments], float)
    mean, scale = moments[:STATISTICS], np.maximum(moments[STATISTICS:], 1e-6)
    own = calibration.one_label(labels, label)
    known = measured.join(own, F.col("doc_id") == F.col("label_of")).withColumn("fold", calibration.fold(F.col("doc_id")))
    known = stored(known.filter("fold > 0").select("statistics", "label", "fold"), "quality-known")
    size = N_FOURIER + 1 + STATISTICS
    schema = StructType([StructField("line", IntegerType()), StructField("sums", ArrayType(DoubleType()))])

    def summed(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(-1, STATISTICS)
            z = fourier(x, mean, scale)
            total += z.T @ np.column_stack([z, batch.column(1).to_numpy()])
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], schema.names
            )

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"line": rows.line[:1], "sums": [np.sum(np.stack(rows.sums.to_list()), axis=0)]})

    equations = known.filter("fold > 1").select("statistics", "label").mapInArrow(summed, schema)
    lines = equations.groupBy("line").applyInPandas(added, schema).collect()
    weights = np.zeros(size)
    if lines:
        matrix = np.array([r.sums for r in sorted(lines)])
        rows = max(1.0, matrix[N_FOURIER, N_FOURIER])
        weights = np.linalg.solve(matrix[:, :-1] + RIDGE * rows * np.eye(size), matrix[:, -1])
    else:
        weights[N_FOURIER] = 0.5
    model = Model(mean, scale, weights, (np.array([0.0, 1.0]), np.array([0.0, 1.0])))

    def raw(batches):
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(-1, STATISTICS)
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(x)), batch.column(1)], ["raw", "label"])

    calibrating = known.filter("fold = 1").select("statistics", "label").mapInArrow(raw, "raw double, label double")
    return Model(mean, scale, weights, calibration.fit(calibrating, LOW, HIGH))


def scores(measured: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every measured row."""

    def scored(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(-1, STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    rows = measured.mapInArrow(scored, "doc_id long, score double")
    return rows.select(
        "doc_id",
        (calibration.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model predicts to be good, as they are; no shuffle.

    A null text is judged as an empty one; repeated rows are judged alike; an empty
    table gives an empty one. Columns may have any names.
    """
    verdict = "_".join(["good", *docs.columns])  # no column is called so
    carried = docs.select("*", F.coalesce(F.col(text), F.lit("")).cast("binary").alias(f"{verdict}_body"))
    schema = StructType([*docs.schema.fields, StructField(verdict, BooleanType())])
    n = len(docs.columns)

    def judged(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                x = np.array([statistics(t) for t in part.column(n).to_pylist()], float).reshape(-1, STATISTICS)
                columns = [part.column(i) for i in range(n)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(model.score(x) >= threshold)], schema.names)

    return carried.mapInArrow(released(judged), schema).filter(F.col(f"`{verdict}`")).drop(verdict)
