"""Texts to vectors: the embedder contract and a built-in hashed embedder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import null_to_empty
from paperloom.operators.keyword import tokens, word_slices
from paperloom.session import release_memory, spread_small

# Fixed value: prompt name used for query texts.
QUERY_PROMPT = "query"
MODEL_BATCH = 32
# Hashes a task remembers before it starts over.
MAX_KNOWN_WORDS = 200_000


class Embedder(Protocol):
    """What a caller's model must offer; loaded once per Python worker."""

    def encode(self, texts: list[str], batch_size: int, prompt_name: str | None) -> np.ndarray: ...


def vector_array(rows: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as a list column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


# The model this worker loaded last, with the name of the job it belongs to.
_loaded: dict[str, Embedder] = {}


def _model(job: str, load_model: Callable[[], Embedder]) -> Embedder:
    """The job's model; tasks that share a worker share it, a new job's model replaces it."""
    if job not in _loaded:
        _loaded.clear()
        _loaded[job] = load_model()
    return _loaded[job]


def embed_texts(
    df: DataFrame,
    load_model: Callable[[], Embedder],
    key: str = "pmid",
    text: str = "text",
    prompt_name: str | None = None,
    batch_size: int = MODEL_BATCH,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``key``, the ``carry`` columns and ``embedding`` of every row; a NULL text is embedded as the empty text.

    The key may be any column; Arrow batches bound what a task holds.
    """
    names = [key, *carry]
    source = df.select(*names, null_to_empty(F.col(text)).alias("_text"))
    types = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in names)
    job = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = np.asarray(
                _model(job, load_model).encode(
                    batch.column("_text").to_pylist(), batch_size=batch_size, prompt_name=prompt_name
                ),
                dtype=np.float32,
            )
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, vector_array(out)], names=[*names, "embedding"])

    return source.mapInArrow(run, f"{types}, embedding array<float>")


def embed_queries(
    queries: DataFrame, load_model: Callable[[], Embedder], prompt_name: str | None = QUERY_PROMPT
) -> DataFrame:
    """``query_id, embedding`` of a whole query set."""
    return embed_texts(queries, load_model, "query_id", "query", prompt_name)


def word_bucket(word: str, dim: int) -> int:
    """Dimension a word counts in: its MD5 hash, first 32 bits."""
    return int.from_bytes(hashlib.md5(word.encode("utf-8")).digest()[:4], "big") % dim


def _hashed_units(lists: pa.ListArray, dim: int, known: dict[str, int]) -> np.ndarray:
    """Unit vector of every list of words; ``known`` remembers words from one call to the next."""
    encoded = lists.flatten().dictionary_encode()
    if len(known) > MAX_KNOWN_WORDS:
        known.clear()
    buckets = np.empty(len(encoded.dictionary), np.int64)
    for i, word in enumerate(encoded.dictionary.to_pylist()):
        bucket = known.get(word)
        if bucket is None:
            bucket = known[word] = word_bucket(word, dim)
        buckets[i] = bucket
    row = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    cells = row * dim + buckets[np.asarray(encoded.indices)]
    counts = np.bincount(cells, minlength=len(lists) * dim).reshape(len(lists), dim)
    norms = np.sqrt((counts * counts).sum(axis=1))
    return (counts / np.where(norms == 0, 1, norms)[:, None]).astype(np.float32)


def hashed_embedding(
    df: DataFrame, key: str = "pmid", text: str = "text", dim: int = 64, carry: Sequence[str] = ()
) -> DataFrame:
    """Unit vector of hashed word counts per row: ``key``, the ``carry`` columns and ``embedding``.

    Needs no model and no shuffle; a text without words gives a zero vector.
    """
    words = F.coalesce(tokens(F.col(text)), F.array().cast("array<string>"))
    names = [key, *carry]
    source = spread_small(df.select(*names, text)).select(*names, words.alias("_words"))
    types = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for part in word_slices(batch, "_words"):
                unit = _hashed_units(part.column("_words"), dim, known)
                columns = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, vector_array(unit)], names=[*names, "embedding"])
            part = columns = batch = None  # a batch is not kept while the next one is read
            release_memory()

    return source.mapInArrow(run, f"{types}, embedding array<float>")


def text_hash(text: Column) -> Column:
    return F.md5(null_to_empty(text))


def pending_texts(texts: DataFrame, done: DataFrame) -> DataFrame:
    """Texts without a vector, or whose text changed since: ``pmid, text, text_hash``.

    ``done`` lists ``pmid, text_hash`` of the vectors that exist.
    """
    hashed = texts.withColumn("text_hash", text_hash(F.col("text")))
    return hashed.join(done.select("pmid", "text_hash"), ["pmid", "text_hash"], "left_anti")
