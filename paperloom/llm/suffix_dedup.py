"""Removal of repeated byte strings by suffix buckets and ranks.

Every string of ``LENGTH`` bytes is a suffix cut to that length. A cover sample picks
positions so that equal strings hold a sample position at the same place; here it is
chosen by content (the smallest hash of the short grams in the string), which needs
one position in about ninety where a periodic difference cover needs one in seven.
Suffixes fall into the bucket of their sample's gram, so equal ones share a bucket.

Neighbouring suffixes with one sample form a segment. Segments that occur again as a
whole are found by a fingerprint; only buckets with different segments are sorted, a
block of buckets at a time, and their long ties are resolved by ranks of sampled
lengths: a rank of 2n bytes is a pair of ranks of n bytes. Memory is bounded by the
block and by the largest bucket's different segments.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from paperloom.llm.common import stored
from paperloom.llm.shingles import _power, mixed

LENGTH = 200
GRAM = 32
ROWS_AT_ONCE = 128
BLOCK_BYTES = 6_000_000
# A segment's place is its first byte and, in the lower bits, its number of suffixes.
LOW_BITS = 32
_PLACE = np.uint64((1 << 28) - 1)
_TABLES = [np.random.default_rng(s).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1) for s in (11, 12)]


def _sums(letters: np.ndarray, table: np.ndarray, power: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[letters] * power[: len(letters)], dtype=np.uint64)])


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def segments(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``bucket, f1, f2, low, n`` of the segments of one text: ``n`` suffixes from ``low`` on share a sample."""
    if len(text) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    letters = np.frombuffer(text, np.uint8)
    power, inverse = _power(len(letters) + 1)
    sums = [_sums(letters, t, power) for t in _TABLES]
    grams = mixed((sums[0][gram:] - sums[0][:-gram]) * inverse[: len(letters) - gram + 1])
    places = np.arange(len(grams), dtype=np.uint64)
    sample = _window_least((grams & ~_PLACE) | places, length - gram + 1) & _PLACE
    low = np.concatenate([[0], np.nonzero(sample[1:] != sample[:-1])[0] + 1])
    n = np.diff(np.concatenate([low, [len(sample)]]))
    end = low + n + length - 1
    prints = [mixed((s[end] - s[low]) * inverse[low] + (end - low).astype(np.uint64)) for s in sums]
    return (grams[sample[low]].view(np.int64), *(p.view(np.int64) for p in prints), low, n)


def _marks(batches):
    """Sorted ``bucket, f1, f2, doc, tag, place`` rows to whole repeats (``part`` null) and one row per
    different segment of a bucket that has several (``part`` 1, or 0 if it is a whole repeat)."""
    out = {name: [] for name in ("bucket", "doc", "tag", "place", "part")}

    def put(row, part):
        for name, value in zip(out, (row[0], *row[3:], part)):
            out[name].append(value)

    first = None  # the first row of the current run of equal segments
    count, held = 0, None  # its rows; the bucket's first segment, kept until a second one shows

    def finish():
        nonlocal held
        if first is None:
            return
        part = 0 if count > 1 else 1
        if first[0] == bucket_of and several:
            put(first, part)
        else:
            held = (first, part)

    bucket_of, several = None, False
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if first is not None and row[:3] == first[:3]:
                count += 1
                if count == 2:
                    put(first, None)
                put(row, None)
                continue
            finish()
            if row[0] != bucket_of:
                bucket_of, several, held = row[0], False, None
            elif not several:
                several = True
                put(*held)
            first, count = row, 1
        if len(out["part"]) > 50_000:
            yield pa.RecordBatch.from_pydict(out, _MARKS)
            out = {name: [] for name in out}
    finish()
    yield pa.RecordBatch.from_pydict(out, _MARKS)


_MARKS = pa.schema([*[(name, pa.int64()) for name in ("bucket", "doc", "tag", "place")], ("part", pa.int32())])


def repeated_suffixes(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, which of its strings of ``length`` bytes start anywhere else in the texts too."""
    letters = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    starts = np.cumsum([0] + [len(t) for t in texts])
    rank, size = letters, 1
    while size * 2 <= length:
        pair = rank[:-size] * (rank.max() + 1) + rank[size:]
        rank, size = np.unique(pair, return_inverse=True)[1].ravel(), size * 2
    own = np.concatenate([np.arange(s, e - length + 1) for s, e in zip(starts[:-1], starts[1:])])
    whole = rank[own] * (rank.max() + 1) + rank[own + length - size]
    _, at, n = np.unique(whole, return_inverse=True, return_counts=True)
    return np.split(n[at.ravel()] > 1, np.cumsum([len(t) - length + 1 for t in texts])[:-1])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turns = np.nonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))[0]
    return turns[::2], turns[1::2]


def repeated_starts(bodies: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc, tag, low, n``: the strings from ``low`` to ``low + n - 1`` of a text start somewhere else too.

    ``bodies`` has ``doc_id, tag, body``; the tag, a hash of the text, tells texts of one id apart.
    """

    def cut(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                found = [segments(t, length) for t in part.column(2).to_pylist()]
                doc, tag = (np.repeat(part.column(i).to_numpy(), [len(f[0]) for f in found]) for i in (0, 1))
                bucket, f1, f2, low, n = (np.concatenate(x) for x in zip(*found))
                place = low << LOW_BITS | n
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket, f1, f2, doc, tag, place)], ["bucket", "f1", "f2", "doc", "tag", "place"])

    rows = bodies.select("doc_id", "tag", "body").mapInArrow(cut, "bucket long, f1 long, f2 long, doc long, tag long, place long")
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "f1", "f2", "doc", "place")
    marks = stored(ordered.mapInArrow(_marks, "bucket long, doc long, tag long, place long, part int"), "suffix-marks")
    asked = marks.filter("part is not null").groupBy("doc", F.col("tag").alias("doc_tag")).agg(F.collect_list(F.struct("bucket", "place", "part")).alias("asked"))

    def fetched(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                rows = [
                    (x["bucket"], doc, tag, x["place"], x["part"], body[(low := x["place"] >> LOW_BITS) : low + (x["place"] & n_mask) + length - 1])
                    for doc, tag, body, wanted in zip(*(part.column(i).to_pylist() for i in range(4)))
                    for x in wanted
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    n_mask = (1 << LOW_BITS) - 1
    names = ["bucket", "doc", "tag", "place", "part", "bytes"]
    types = [*[pa.int64()] * 4, pa.int32(), pa.binary()]
    same = (F.col("doc_id") == F.col("doc")) & (F.col("tag") == F.col("doc_tag"))
    joined = bodies.join(asked, same).select("doc", "tag", "body", "asked")
    pieces = joined.mapInArrow(fetched, "bucket long, doc long, tag long, place long, part int, bytes binary")

    def sorted_(batches):
        block, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if row[0] != last and size > BLOCK_BYTES:
                    yield from compared(block)
                    block, size = [], 0
                last = row[0]
                block.append(row)
                size += len(row[5])
        if block:
            yield from compared(block)

    def compared(block):
        out = {"doc": [], "tag": [], "low": [], "n": []}
        for _, doc, tag, place, part, _, flags in ((*r, f) for r, f in zip(block, repeated_suffixes([r[5] for r in block], length))):
            if part:
                for start, end in zip(*_runs(flags)):
                    for name, value in zip(out, (doc, tag, (place >> LOW_BITS) + int(start), int(end - start))):
                        out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, pa.schema([(k, pa.int64()) for k in out]))

    parts = pieces.repartition("bucket").sortWithinPartitions("bucket", "doc", "tag", "place").mapInArrow(sorted_, "doc long, tag long, low long, n long")
    place = F.col("place")
    whole = marks.filter("part is null").select("doc", "tag", F.shiftright(place, LOW_BITS).alias("low"), place.bitwiseAND(F.lit(n_mask)).alias("n"))
    return whole.union(parts)


def without_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes) for every row of ``docs``.

    Each byte that a repeated string covers goes; strings are judged on the input. A null
    text is empty, an empty table gives none. A row without an id is left as it is and no
    match for others. Rows that repeat an id are documents of their own, so repeated rows
    lose their strings of ``length`` bytes altogether. Other columns do not matter.
    """
    bodies = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    bodies = bodies.select("doc_id", F.xxhash64("body").alias("tag"), "body")
    starts = repeated_starts(bodies.filter("doc_id is not null"), length)
    gone = starts.groupBy("doc", F.col("tag").alias("doc_tag")).agg(F.collect_list(F.struct("low", "n")).alias("gone"))
    schema = StructType(
        [StructField(n, LongType()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")] + [StructField("kept", BinaryType())]
    )

    def cut(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part, rows = batch.slice(start, ROWS_AT_ONCE), []
                for doc, body, spans in zip(*(part.column(i).to_pylist() for i in range(3))):
                    covered = np.zeros(len(body) + 1, np.int32)
                    for x in spans or ():
                        covered[x["low"]] += 1
                        covered[x["low"] + x["n"] + length - 1] -= 1
                    removed = np.cumsum(covered)[:-1] > 0
                    kept = np.frombuffer(body, np.uint8)[~removed].tobytes() if spans else body
                    rows.append((doc, len(body), int(removed.sum()), len(_runs(removed)[0]), kept))
                types = [*[pa.int64()] * 4, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], schema.names)

    same = (F.col("doc_id") == F.col("doc")) & (F.col("tag") == F.col("doc_tag"))
    joined = bodies.join(gone, same, "left").select("doc_id", "body", "gone")
    return joined.mapInArrow(cut, schema)
