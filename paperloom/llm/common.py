"""Tables and column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import shared_dir

# White space as the contracts define it: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage: a lost executor costs no recomputation of what is stored.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(run):
    """``run``, giving memory back when its task ends: workers are kept for later stages, beside which it would count."""

    def released_after(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return released_after


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null, without making the words."""
    one_each = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.length(F.translate(one_each, " \t\n\x0b\x0c\r", "")).cast("long")


def keep_recent(known: dict, recent: set, limit: int, longest: int) -> None:
    """Empties a memory of words above ``limit``, but for those of the last batch; words over ``longest`` are not kept."""
    if len(known) > limit:
        kept = {w: known[w] for w in recent if len(w) <= longest} if 2 * len(recent) <= limit else {}
        known.clear()
        known.update(kept)


def int_lists(parts: list[bytes]) -> pa.ListArray:
    """Lists of 32-bit integers from their bytes."""
    offsets = [0]
    for own in parts:
        offsets.append(offsets[-1] + len(own) // 4)
    flat = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))
