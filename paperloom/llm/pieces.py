"""Encoding into the pieces of a vocabulary by best score, and back.

An Aho-Corasick automaton over the pieces runs over a text once; at each position its
output links give every piece that ends there, and each relaxes the best score of
that position. White space is written as the piece vocabulary has it (U+2581), with
one before the text. Characters without a piece become byte pieces.
"""

from __future__ import annotations

import re
from array import array

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
# A character without a piece costs this much more than the worst piece, per byte.
BYTE_PENALTY = 10.0
# Words remembered per worker; a full memory is emptied.
REMEMBERED = 200_000
ROWS_AT_ONCE = 256


class Codec:
    """Encoder and decoder; travels to tasks as a list of pieces, the automaton is built there."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int]):
        """``pieces`` and ``scores`` by id, None for ids that no text may produce; ``byte_ids`` by byte."""
        self.pieces, self.scores, self.byte_ids = pieces, scores, byte_ids
        self._automaton = None

    @classmethod
    def load(cls, path: str = MODEL) -> Codec:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)
        pieces = [None if special(i) else model.id_to_piece(i) for i in ids]
        return cls(pieces, [model.get_score(i) for i in ids], [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def __getstate__(self):
        return {"pieces": self.pieces, "scores": self.scores, "byte_ids": self.byte_ids, "_automaton": None}

    def _build(self) -> None:
        self._automaton = ahocorasick.Automaton()
        for i, piece in enumerate(self.pieces):
            if piece:
                self._automaton.add_word(piece, (len(piece), (i,), self.scores[i]))
        self._automaton.make_automaton()
        self._single = frozenset(p for p in self.pieces if p and len(p) == 1)
        # No piece spans the change from a word to white space, so words can be encoded one by one;
        # lines too, where no piece holds a line feed.
        spanned = any("\n" in p for p in self.pieces if p)
        self._units = re.compile(f" *[^ {SPACE_MARK}]+|{SPACE_MARK}| +" if spanned else f" *[^ \n{SPACE_MARK}]+|{SPACE_MARK}|\n| +")
        self._unknown = min(s for p, s in zip(self.pieces, self.scores) if p) - BYTE_PENALTY
        self._known: dict[str, tuple] = {}
        self._bytes = [p.replace(SPACE_MARK, " ").encode() if p else b"" for p in self.pieces]
        for b, i in enumerate(self.byte_ids):
            self._bytes[i] = bytes([b])

    def _ways(self, unit: str):
        """Pieces by the position where they end, and bytes for characters that are no piece; each position has a way of length 1."""
        found = self._automaton.iter(unit)
        if self._single.issuperset(unit):
            return found
        raw = [(end, c.encode("utf-8", "surrogatepass")) for end, c in enumerate(unit) if c not in self._single]
        spelled = [(end, (1, tuple(self.byte_ids[b] for b in x), self._unknown * len(x))) for end, x in raw]
        return sorted([*found, *spelled], key=lambda way: way[0])

    def _best(self, unit: str) -> tuple[list[int], float]:
        """Ids and score of the best way through one unit; of equal ways the one with the longer last piece."""
        n, at = len(unit), 0
        best, back = [0.0] * (n + 1), [(0, ())] * (n + 1)
        for end, (length, ids, score) in self._ways(unit):
            total = best[end + 1 - length] + score
            if end == at:
                at = end + 1
            elif total <= best[at]:
                continue
            best[at], back[at] = total, (length, ids)
        parts, at = [], n
        while at:
            length, ids = back[at]
            parts.append(ids)
            at -= length
        return [i for ids in reversed(parts) for i in ids], best[n]

    def encode(self, text: str) -> tuple[array, float]:
        """Piece ids and their summed score; an empty text has none."""
        if self._automaton is None:
            self._build()
        ids, total, known = array("i"), 0.0, self._known
        if not text:
            return ids, total
        for unit in self._units.findall(" " + text):
            found = known.get(unit)
            if found is None:
                if unit == SPACE_MARK:  # the mark itself, which decoding must not take for a space
                    raw = unit.encode()
                    found = array("i", [self.byte_ids[b] for b in raw]), self._unknown * len(raw)
                else:
                    some, score = self._best(unit.replace(" ", SPACE_MARK))
                    found = array("i", some), score
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(unit) < 64:
                    known[unit] = found
            ids += found[0]
            total += found[1]
        return ids, total

    def decode(self, ids) -> str:
        if self._automaton is None:
            self._build()
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def encoded(docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece_ids, score, decoded`` for every row; a null text is an empty one and has no pieces."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                ids, scores, texts = [], [], []
                for body in part.column(1).to_pylist():
                    own, score = codec.encode(body)
                    ids.append(memoryview(own))
                    scores.append(score)
                    texts.append(codec.decode(own))
                offsets = [0]
                for own in ids:
                    offsets.append(offsets[-1] + len(own))
                flat = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(ids))])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(scores, pa.float64()), pa.array(texts, pa.string())],
                    ["doc_id", "piece_ids", "score", "decoded"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return rows.mapInArrow(run, "doc_id long, piece_ids array<int>, score double, decoded string")
