"""Column functions over ``array<float>`` vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType

HALF_MAX = 65504.0


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, v: total + v)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine_distance(a: Column, b: Column) -> Column:
    """Cosine distance in double precision.

    A zero vector gives NaN, which sorts after every number; vectors of
    different length are an error.
    """
    raw = F.lit(1.0) - F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))
    same_size = F.when(
        F.size(a) != F.size(b), F.raise_error(F.lit("vectors differ in length")).cast("double")
    )
    return F.when(
        a.isNotNull() & b.isNotNull(),
        F.coalesce(same_size, raw, F.lit(float("nan"))),
    )


def cosine_similarity(a: Column, b: Column) -> Column:
    return F.lit(1.0) - cosine_distance(a, b)


def l2_normalize(v: Column) -> Column:
    """Unit-length copy of ``v``; a zero vector stays as it is."""
    norm = l2_norm(v)
    return F.when(norm == 0.0, F.transform(v, lambda x: x.cast("double"))).otherwise(
        F.transform(v, lambda x: x.cast("double") / norm)
    )


def vector_to_literal(v: Column) -> Column:
    """``[a,b,...]`` text form of a vector."""
    return F.concat(
        F.lit("["), F.array_join(F.transform(v, lambda x: x.cast("string")), ","), F.lit("]")
    )


def literal_to_vector(text: Column, element: str = "float") -> Column:
    inner = F.regexp_replace(text, r"^\s*\[|\]\s*$", "")
    return F.when(F.trim(inner) == "", F.array().cast(f"array<{element}>")).otherwise(
        F.transform(F.split(inner, ","), lambda x: F.trim(x).cast(element))
    )


def to_half(x: Column) -> Column:
    """Round one number to IEEE binary16 (ties to even), kept as a float."""
    value = x.cast("double")
    size = F.abs(value)
    exponent = F.greatest(F.floor(F.log2(size)), F.lit(-14))
    step = F.pow(F.lit(2.0), exponent - 10)
    rounded = F.rint(value / step) * step
    checked = F.when(
        F.abs(rounded) > HALF_MAX,
        F.raise_error(F.lit("value out of half-precision range")).cast("double"),
    ).otherwise(rounded)
    return F.when((size == 0) | F.isnan(value), value).otherwise(checked).cast("float")


def half_precision(v: Column) -> Column:
    return F.transform(v, to_half)


@F.arrow_udf(BinaryType())
def pack_half(vectors: pa.Array) -> pa.Array:
    """Vectors as IEEE binary16, two bytes a component, little-endian; null stays null.

    Rounds as :func:`to_half` does; a number that becomes infinite is an error.
    """
    numbers = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        halves = numbers.astype("<f2")
    if (np.isinf(halves) & np.isfinite(numbers)).any():
        raise ValueError("value out of half-precision range")
    ends = 2 * np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(vectors), 0).to_numpy())])
    offsets, bits = pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(halves.tobytes())
    packed = pa.Array.from_buffers(pa.binary(), len(vectors), [None, offsets, bits])
    return pc.if_else(vectors.is_null(), pa.scalar(None, pa.binary()), packed)


@F.arrow_udf(ArrayType(FloatType()))
def unpack_half(packed: pa.Array) -> pa.Array:
    """Vectors that :func:`pack_half` made, as floats."""
    rows = packed.to_pylist()
    numbers = np.frombuffer(b"".join(r or b"" for r in rows), "<f2").astype(np.float32)
    ends = np.concatenate([[0], np.cumsum([len(r or b"") // 2 for r in rows])]).astype(np.int32)
    mask = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers), mask=mask)


def require_dimension(v: Column, dim: int) -> Column:
    """``v`` itself, or a failed job when its length is not ``dim``."""
    message = F.concat(F.lit(f"expected {dim} dimensions, got "), F.size(v).cast("string"))
    return F.when(F.size(v) != dim, F.raise_error(message).cast("array<float>")).otherwise(v)


def to_wide(df: DataFrame, dim: int, vector: str = "embedding", prefix: str = "embedding_") -> DataFrame:
    """One column per dimension, in place of the vector column."""
    others = [c for c in df.columns if c != vector]
    return df.select(*others, *[F.get(F.col(vector), i).alias(f"{prefix}{i}") for i in range(dim)])


def wide_columns(columns: list[str], prefix: str = "embedding_") -> list[str]:
    """Dimension columns ordered by their numeric suffix, not by their name."""
    found = [c for c in columns if c.startswith(prefix) and c[len(prefix):].isdigit()]
    return sorted(found, key=lambda c: int(c[len(prefix):]))


def from_wide(df: DataFrame, prefix: str = "embedding_", vector: str = "embedding") -> DataFrame:
    dims = wide_columns(df.columns, prefix)
    others = [c for c in df.columns if c not in set(dims)]
    return df.select(*others, F.array(*dims).cast("array<float>").alias(vector))
