"""Toxicity by compression distance: which of two zstandard dictionaries shortens a window more.

The ordinary dictionary is trained on ordinary text. The toxic one adds the byte
sequences that are many times as frequent in toxic documents, so a window of plain
text compresses alike under both and a toxic one is shorter under the second. The
saved bytes of a document's best windows, calibrated on labelled rows, are its score.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm import calibration
from paperloom.llm.common import stored

# Bounds of the training sample: documents of either kind, and bytes of both.
SAMPLE_DOCUMENTS = 4000
SAMPLE_BYTES = 12_000_000

GRAM = 5
MIN_CONTRAST = 40.0
MIN_SHARE = 0.01
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 4_096
WINDOW_WORDS = 8
# Savings up to this are chance.
CHANCE_BYTES = 2
MAX_RAW = 6.0
LEVEL = 12
THRESHOLD = 0.5
ROWS_AT_ONCE = 512
_PUNCTUATION = b".,;:!?\"'()"


def _words(text: bytes) -> list[bytes]:
    return [w.strip(_PUNCTUATION) for w in text.lower().split()]


def _windows(words: list[bytes]) -> list[bytes]:
    return [b" " + b" ".join(words[i : i + WINDOW_WORDS]) + b" " for i in range(0, len(words), WINDOW_WORDS)]


def _grams(padded: bytes) -> np.ndarray:
    """Every run of ``GRAM`` bytes as a number."""
    letters = np.frombuffer(padded, np.uint8).astype(np.uint64)
    n = max(0, len(letters) - GRAM + 1)
    number = np.zeros(n, np.uint64)
    for k in range(GRAM):
        number = (number << np.uint64(8)) | letters[k : k + n]
    return number


def _document_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.unique(_grams(t)) for t in texts]), return_counts=True)


@dataclass
class Dictionaries:
    """Contents of both dictionaries; compressors are made once per worker."""

    ordinary: bytes
    toxic: bytes
    _made: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "_made": None}

    def raw(self, text: bytes) -> float:
        """What the toxic dictionary saves in the windows of a text, few long savings before many short ones.

        Squares of saved bytes, against the square root of the text's windows; 0 for an empty text.
        """
        if self._made is None:
            # Filler of the same length keeps the distances of ordinary matches alike.
            self._made = _compressor(self.ordinary + b"\x01" * len(self.toxic)), _compressor(self.ordinary + self.toxic)
        plain, toxic = (c.compress for c in self._made)
        saved = [len(plain(w)) - len(toxic(w)) for w in _windows(_words(text))]
        return float(np.log1p(sum(x * x for x in saved if x > CHANCE_BYTES) / np.sqrt(len(saved) + 5)))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def train(toxic: list[bytes], ordinary: list[bytes]) -> Dictionaries:
    """Dictionaries from two lists of texts. Without toxic or ordinary texts nothing is ever saved."""
    toxic, ordinary = ([b" " + b" ".join(_words(t)) + b" " for t in dict.fromkeys(x)] for x in (toxic, ordinary))
    windows = [w for t in ordinary for w in _windows(t.split())]
    windows = windows[:: max(1, len(windows) // 40_000)]
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, windows, k=64, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        base = b"".join(windows)[-ORDINARY_BYTES:]
    if not toxic or not ordinary:
        return Dictionaries(base or b" " * 16, b"")
    grams, in_toxic = _document_counts(toxic)
    known, in_ordinary = _document_counts(ordinary)
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    other = np.where(known[at] == grams, in_ordinary[at], 0)
    contrast = (in_toxic / len(toxic)) / ((other + 1) / len(ordinary))
    telling = set(grams[(contrast >= MIN_CONTRAST) & (in_toxic >= max(3, MIN_SHARE * len(toxic)))].tolist())
    # Words that hold telling sequences, the most frequent last: near matches are cheaper.
    found: Counter = Counter()
    for text in toxic:
        found.update(set(text.split()))
    found = Counter({w: n for w, n in found.items() if not telling.isdisjoint(_grams(b" " + w + b" ").tolist())})
    content = b""
    for word, n in found.most_common():
        if n >= 3 and len(content) + len(word) + 1 <= TOXIC_BYTES:
            content = b" " + word + content
    return Dictionaries(base or b" " * 16, content + b" ")


def sample(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text") -> tuple[list, list]:
    """Toxic and ordinary texts for training: the first by hash, up to the bounds above, held-out and calibration rows apart."""
    sizes = docs.select(F.col(doc_id).alias("sample_of"), F.coalesce(F.octet_length(text), F.lit(0)).alias("n_bytes"))
    known = sizes.join(calibration.one_label(labels, label), F.col("sample_of") == F.col("label_of"))
    known = known.filter(calibration.fold(F.col("sample_of")) > 1)
    chosen: dict[int, int] = {}
    for kind in (1, 0):
        rows = known.filter(F.col("label") == kind).orderBy(F.xxhash64("sample_of"), "sample_of")
        used = 0
        for row in rows.select("sample_of", "n_bytes").limit(SAMPLE_DOCUMENTS).collect():
            if used + row.n_bytes <= SAMPLE_BYTES // 2:
                used += row.n_bytes
                chosen[row.sample_of] = kind
    ids = docs.sparkSession.createDataFrame(list(chosen.items()), "sample_of long, kind int")
    found = docs.join(F.broadcast(ids), F.col(doc_id) == F.col("sample_of")).select("sample_of", "kind", F.col(text).alias("body"))
    rows = sorted(found.dropna().collect())
    return tuple([r.body.encode() for r in rows if r.kind == kind] for kind in (1, 0))


def scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Every window of every whole text is compressed; null and empty texts save nothing.
    Rows that repeat are scored alike; a null id is held out.
    """
    dictionaries = train(*sample(docs, labels, label, doc_id, text))

    def measured(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                raw = [dictionaries.raw(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.float64())], ["doc_id", "raw"])

    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("body"))
    rows = stored(rows.mapInArrow(measured, "doc_id long, raw double"), "toxicity-raw")
    known = rows.join(calibration.one_label(labels, label), F.col("doc_id") == F.col("label_of"))
    xs, ys = calibration.fit(known.filter(calibration.fold(F.col("doc_id")) == 1), 0.0, MAX_RAW, 256)

    def scored(batches):
        for batch in batches:
            values = calibration.apply(batch.column(1).to_numpy(), (xs, ys))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "score"])

    return rows.mapInArrow(scored, "doc_id long, score double").select(
        "doc_id",
        (calibration.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
