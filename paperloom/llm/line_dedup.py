"""Line dedup: lines that many documents share stay in the first of them only.

Normalised lines are hashed to 128 bits where the text is read; counting documents
per hash is a plain aggregate (least and greatest id), so a line that a third of all
documents hold sends one row per task. The hashes to drop come back to their
documents by one join on the id, and each text is put together again in line order.
"""

from __future__ import annotations

from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from paperloom.llm.common import SPACE_BYTES, released, stored

MIN_CHARS = 10
ROWS_AT_ONCE = 512


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Hash of a line without outer white space and in ASCII lower case; None below ``min_chars`` code points."""
    key = line.strip(SPACE_BYTES).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return blake2b(key, digest_size=16).digest()


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, keys``: per document the hashes of the lines that it loses; documents that lose none are not listed."""

    def hashed(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                ids, keys = [], []
                for one, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = {line_key(line, min_chars) for line in body.split(b"\n")}
                    own.discard(None)
                    ids.extend([one] * len(own))
                    keys.extend(own)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
    lines = stored(
        rows.dropna().mapInArrow(hashed, StructType([StructField("doc_id", LongType()), StructField("key", BinaryType())])),
        "line-keys",
    )
    keepers = (
        lines.groupBy("key")
        .agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
        .filter(F.col("keeper") < F.col("last"))
    )
    return (
        lines.join(keepers.select("key", "keeper"), "key")
        .filter(F.col("doc_id") != F.col("keeper"))
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("keys"))
    )


def without_shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``text`` cut, and ``n_lines`` (before) and ``n_dropped``.

    A null or empty text is one empty line and comes back as the empty text. A row
    without an id keeps all its lines and does not count as a holder. Rows that repeat
    an id are one document. Other columns are carried; ones named ``n_lines`` or
    ``n_dropped`` are replaced.
    """
    lost = "_".join(["lost", *docs.columns])  # no column is called so
    dropped = shared_lines(docs, min_chars, doc_id, text).toDF("loser", lost)
    carried = docs.drop("n_lines", "n_dropped").withColumn(text, F.coalesce(F.col(text), F.lit("")))
    fields = carried.schema.fields
    out = StructType([*fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    at = carried.columns.index(text)

    def cut(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                texts, n_lines, n_dropped = [], [], []
                for body, keys in zip(part.column(at).to_pylist(), part.column(len(fields)).to_pylist()):
                    lines = body.encode().split(b"\n")
                    gone = set(keys or ())
                    kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
                    texts.append(b"\n".join(kept).decode() if gone else body)
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(kept))
                columns = [part.column(i) for i in range(len(fields))]
                columns[at] = pa.array(texts, part.column(at).type)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], out.names
                )

    joined = carried.join(dropped, carried[doc_id] == dropped["loser"], "left")
    joined = joined.select(*[carried[f"`{c}`"] for c in carried.columns], dropped[lost])
    return joined.mapInArrow(released(cut), out)
