"""Alignment of two tokenizers' tokens of the same text, and which ids go together in a corpus.

A byte offset at which a token of either side ends is a shared cut. Cuts are found by
divide and conquer: of a stretch of tokens the end nearest to the middle that the other
side has too, sought by bisection, divides it, and both halves are treated alike; a
stretch without an inner cut is a group. All stretches of a batch of texts are treated
at once, level by level, on arrays.

Tokens that share a group are linked. How many documents hold an id pair linked is one
aggregate over the pairs of each document. Its most frequent entries, a bounded number,
are broadcast and looked up where the documents are read; the few occurrences of the
other pairs are joined, and none of those pairs can be frequent.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from paperloom.llm.byte_bpe import LONGEST_REMEMBERED, Codec
from paperloom.llm.common import keep_recent, stored

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
ROWS_AT_ONCE = 512
# Words remembered per worker; a full memory keeps the last batch's.
REMEMBERED = 200_000
# Runs of one kind of characters, and the endings that the first side's words split off inside a run of letters.
RUN = re.compile(r" ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+")
ENDING = re.compile(r"'(?:s|t|re|ve|m|ll|d)(?=[^\W\d_])")
# Pieces that cross their borders and are looked for in every text; with more of them no text is encoded by such words.
CROSSING = 50
# Links of one group up to which they are made one by one; above, each pair of ids once.
LINKS_ONE_BY_ONE = 4096
# Entries of the pair counts that travel to every worker: 17 bytes each.
BROADCAST_PAIRS = 1_000_000


class PieceEncoder:
    """Ids of a sentencepiece model; travels to tasks as the model's bytes."""

    def __init__(self, model: bytes):
        self.model, self._processor = model, None

    @classmethod
    def load(cls, path: str = MODEL) -> PieceEncoder:
        with open(path, "rb") as f:
            return cls(f.read())

    def size(self) -> int:
        return sentencepiece.SentencePieceProcessor(model_proto=self.model).get_piece_size()

    def __getstate__(self):
        return {"model": self.model, "_processor": None}

    def _build(self) -> None:
        self._processor = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        ids = range(self._processor.get_piece_size())
        pieces = [self._processor.id_to_piece(i) for i in ids]
        as_bytes = lambda i: bytes([int(pieces[i][3:-1], 16)]) if self._processor.is_byte(i) else pieces[i].replace(SPACE_MARK, " ").encode()
        self.tokens = [as_bytes(i) for i in ids]
        # If a space only ever starts a piece, a text can be encoded from word to word.
        self._by_word = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self._runs = re.compile(" *[^ ]+| +")
        # No merge crosses the borders of the first side's words in a text without a piece of several kinds of characters.
        spelled = [p.replace(SPACE_MARK, " ") for i, p in enumerate(pieces) if not self._processor.is_byte(i) and not self._processor.is_control(i) and not self._processor.is_unknown(i)]
        inside = [c for c in set().union(*spelled) if c.isspace() and c != " "]
        self._crossing = inside + [p.lstrip(" ") for p in spelled if len(RUN.findall(p)) > 1 and not any(c in p for c in inside)]
        self._by_run = self._by_word and "\n" not in inside and len(self._processor.encode("\n")) == 2 and len(self._crossing) <= CROSSING
        self._of_run: dict[str, bytes] = {}
        self._space = {"": np.array([self._processor.piece_to_id(SPACE_MARK)], np.int32).tobytes()}
        self._known: dict[str, bytes] = dict(self._space)

    def _words(self, text: str) -> list[str]:
        """Parts of a text that are encoded by themselves, without the space before each."""
        if not self._by_word or SPACE_MARK in text:
            return [text]
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in self._runs.findall(" " + text)]
        return text.split(" ")

    def by_run(self, text: str) -> bool:
        """Whether a text can be encoded by the words of ``byte_bpe.PATTERN``, as no piece crosses their borders in it."""
        if not self._by_run or not text or text[0] == " " or "  " in text or SPACE_MARK in text or any(p in text for p in self._crossing):
            return False
        return "'" not in text or not ENDING.search(text)

    def encode_words(self, split: list[list[str]], recent: set[str]) -> list[bytes]:
        """Ids of each list of such words, of which ``recent`` are the different ones."""
        known, fresh = self._of_run, list(recent.difference(self._of_run))
        # The model puts a space before each; a word without one is kept from it by a line feed, which merges with nothing.
        ids = self._processor.encode([w[1:] if w[0] == " " else "\n" + w for w in fresh], num_threads=1)
        ends = (4 * np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))).tolist()
        flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1] // 4 if ends else 0).tobytes()
        known.update((w, flat[start if w[0] == " " else start + 8 : end]) for w, start, end in zip(fresh, [0, *ends], ends))
        known[" "] = self._space[""]
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in fresh:
            if len(w) > LONGEST_REMEMBERED:
                del known[w]
        keep_recent(known, recent, REMEMBERED, LONGEST_REMEMBERED)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, before which the model puts a space, as the bytes of 32-bit integers."""
        if self._processor is None:
            self._build()
        known, split = self._known, [self._words(t) if t else [] for t in texts]
        recent = set().union(*split)
        fresh = list(recent.difference(known))
        ids = self._processor.encode(fresh, num_threads=1)
        ends = (4 * np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))).tolist()
        flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1] // 4 if ends else 0).tobytes()
        known.update(zip(fresh, [flat[start:end] for start, end in zip([0, *ends], ends)]))
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in fresh:
            if len(w) > LONGEST_REMEMBERED:
                del known[w]
        keep_recent(known, recent, REMEMBERED, LONGEST_REMEMBERED)
        known.update(self._space)
        return out


def groups_between_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lo_a, hi_a, lo_b, hi_b) -> np.ndarray:
    """Rows ``lo_a, hi_a, lo_b, hi_b`` of the groups in order, from stretches of tokens whose ends are shared.

    Stretches are not empty and ascend, as ``ends_a`` and ``ends_b`` do over all of them, so that
    ends are sought among all of the other side's. A stretch of the first side has one of the
    other by its ends, so only the first side's are divided.
    """
    # Places of the other side's ends by offset; they are looked up instead of sought.
    place_of = np.full(max([0, *ends_a[-1:], *ends_b[-1:]]) + 1, -1, np.int32)
    place_of[ends_b] = np.arange(len(ends_b), dtype=np.int32)
    sought = place_of[ends_a]
    found_in_b = sought >= 0
    # Places of the shared ends, and how many of them lie before each place.
    shared = np.append(np.flatnonzero(found_in_b), [len(ends_a)] * 2).astype(np.int32)
    before = np.concatenate([[0], np.cumsum(found_in_b)]).astype(np.int32)
    starts_group = np.zeros(len(ends_a) + 1, bool)
    starts_group[lo_a] = True
    first, end = np.asarray(lo_a, np.int32), np.asarray(hi_a, np.int32)
    while len(first):
        divisible = end - first > 1
        first, end = first[divisible], end[divisible]
        last, middle = end - 2, first + (end - first - 2) // 2
        # The shared end nearest to the middle is the next one from there or the one before.
        n_before = before[middle]
        above, below = shared[n_before], shared[n_before - 1]
        under = (n_before > 0) & (below >= first)
        over = (above <= last) & (~under | (above - middle < middle - below))
        cut = over | under
        at = np.where(over, above, below)[cut] + np.int32(1)
        starts_group[at] = True
        first, end = np.concatenate([first[cut], at]), np.concatenate([at, end[cut]])
    starts = np.flatnonzero(starts_group)
    stretch = np.searchsorted(lo_a, starts, side="right") - 1
    from_b = np.where(starts == np.asarray(lo_a)[stretch], np.asarray(lo_b)[stretch], sought[starts - 1] + 1)
    to_a, to_b = np.asarray(hi_a)[stretch], np.asarray(hi_b)[stretch]
    goes_on = np.flatnonzero(stretch[1:] == stretch[:-1])
    to_a[goes_on], to_b[goes_on] = starts[goes_on + 1], from_b[goes_on + 1]
    return np.array([starts, to_a, from_b, to_b], np.int64).T


def _encoded(first: Codec, second: PieceEncoder, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
    """Ids of both sides, by the words of the first where those are whole for the second too."""
    split, alike = zip(*[first.split(" " + t) for t in texts])
    together = [k for k, t in enumerate(texts) if alike[k] and second.by_run(t)]
    recent = set().union(*[split[k] for k in together])
    rows_b = [b""] * len(texts)
    for k, ids in zip(together, second.encode_words([split[k] for k in together], recent)):
        rows_b[k] = ids
    others = sorted(set(range(len(texts))).difference(together))
    for k, ids in zip(others, second.encode([texts[k] for k in others])):
        rows_b[k] = ids
    return first.encode_words(split, recent.union(*[split[k] for k in others])), rows_b


def _gives_back(rows: list[bytes], alphabet: np.ndarray, sizes: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Whether the tokens of each row are its text, byte by byte; all tokens one after the other are the ``alphabet``."""
    ids = np.frombuffer(b"".join(rows), np.int32)
    to_row = np.cumsum([0] + [len(own) // 4 for own in rows])
    to_byte = np.concatenate([[0], np.cumsum(sizes[ids])])
    n, want = np.diff(to_byte[to_row]), np.fromiter(map(len, texts), np.int64, len(texts))
    same = n == want
    some = np.repeat(same, np.diff(to_row))
    ids, sizes, starts = ids[some], sizes[ids[some]], (np.cumsum(sizes) - sizes)[ids[some]]
    spelled = alphabet[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    given = np.frombuffer(b"".join(t for t, ok in zip(texts, same) if ok), np.uint8)
    wrong = np.flatnonzero(spelled != given)
    same[np.flatnonzero(same)[np.searchsorted(np.cumsum(want[same]), wrong, side="right")]] = False
    return same


def _links(a, b, groups, doc, size_b: int, size: int):
    """``doc, pair, times`` of the different id pairs that each document holds linked."""
    width_a, width_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    few = width_a * width_b <= LINKS_ONE_BY_ONE
    own, wide = groups[few], width_b[few]
    n = width_a[few] * wide
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(wide, n)
    pair = a[np.repeat(own[:, 0], n) + k // wide].astype(np.int64) * size_b + b[np.repeat(own[:, 2], n) + k % wide]
    keys, times = [np.repeat(doc[few], n) * size + pair], [np.ones(len(pair), np.int64)]
    for g in np.flatnonzero(~few):
        ids_a, n_a = np.unique(a[groups[g, 0] : groups[g, 1]], return_counts=True)
        ids_b, n_b = np.unique(b[groups[g, 2] : groups[g, 3]], return_counts=True)
        keys.append((doc[g] * size + ids_a[:, None].astype(np.int64) * size_b + ids_b).ravel())
        times.append(np.outer(n_a, n_b).ravel())
    keys, times = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    keys, times = keys[starts], np.add.reduceat(times, starts) if len(starts) else times
    return keys // size, keys % size, times


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
)


def aligned(
    docs: DataFrame, first: Codec, second: PieceEncoder, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``, with the tokens of its text in both vocabularies and how they fall together.

    ``n_a, n_b`` tokens, ``n_groups`` groups, ``n_links`` links; ``groups`` as
    ``a1,a2|b1;a3|b2,b3`` in decimal ids; ``pairs`` the different id pairs that are linked,
    as ``a * size of the second vocabulary + b``, and ``times`` how many links each has.
    Texts that are null, empty or not given back byte by byte by both vocabularies have no
    tokens. Rows that repeat an id or have none are documents like any other; an empty table
    gives an empty one; other columns are not looked at. Special strings are plain text.
    """

    def columns(ids, texts, sizes_a, sizes_b, alphabet):
        rows_a, rows_b = _encoded(first, second, texts)
        whole = [b" " + t.encode() for t in texts]
        same = _gives_back(rows_b, alphabet, sizes_b, whole)  # the first side's bytes are the text's, as a byte-level encoding
        for k, t in enumerate(texts):
            if not t or not same[k]:
                rows_a[k] = rows_b[k] = b""
        a, b = (np.frombuffer(b"".join(rows), np.int32) for rows in (rows_a, rows_b))
        to_a, to_b = (np.cumsum([0] + [len(own) // 4 for own in rows]) for rows in (rows_a, rows_b))
        some = np.flatnonzero(to_a[1:] > to_a[:-1])
        groups = groups_between_cuts(
            np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b]), to_a[some], to_a[some + 1], to_b[some], to_b[some + 1]
        )
        n_groups = np.diff(np.searchsorted(groups[:, 0], to_a))
        doc = np.repeat(np.arange(len(texts)), n_groups)
        per_group = (groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2])
        so_far, to_group = np.concatenate([[0], np.cumsum(per_group)]), np.concatenate([[0], np.cumsum(n_groups)])
        # Every token as its entry of a list of strings with the mark that follows it.
        n_a, n_b = len(first.tokens), len(second.tokens)
        out, g_a = np.zeros(len(a) + len(b), np.int64), np.repeat(np.arange(len(groups)), groups[:, 1] - groups[:, 0])
        g_b = np.repeat(np.arange(len(groups)), groups[:, 3] - groups[:, 2])
        code_a, code_b = a.astype(np.int64), b.astype(np.int64) + 2 * n_a
        code_a[groups[:, 1] - 1] += n_a
        code_b[groups[:, 3] - 1] += n_b
        code_b[to_b[some + 1] - 1] += n_b
        out[np.arange(len(a)) + groups[g_a, 2]] = code_a
        out[np.arange(len(b)) + groups[g_b, 1]] = code_b
        spelled = _joined(_names(n_a, n_b).take(pa.array(out)), to_a + to_b)
        holder, pair, times = _links(a, b, groups, doc, n_b, n_a * n_b)
        lists = lambda x: pa.ListArray.from_arrays(pa.array(np.searchsorted(holder, np.arange(len(texts) + 1)), pa.int32()), pa.array(x, pa.int64()))
        numbers = [np.diff(to_a), np.diff(to_b), n_groups, so_far[to_group[1:]] - so_far[to_group[:-1]]]
        return [ids, *[pa.array(x, pa.int64()) for x in numbers], spelled, lists(pair), lists(times)]

    def run(batches):
        first.encode([]), second.encode([])  # builds their tables
        sizes = [np.array([len(t) for t in x.tokens], np.int64) for x in (first, second)]
        alphabet = np.frombuffer(b"".join(second.tokens), np.uint8)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays(columns(part.column(0), part.column(1).to_pylist(), *sizes, alphabet), names)

    names = [c.split()[0] for c in ALIGNED.split(", ")]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return rows.mapInArrow(run, ALIGNED)


def _joined(strings: pa.LargeStringArray, ends: np.ndarray) -> pa.StringArray:
    """One string for the strings between each two of ``ends``, which are what they are in memory already."""
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(strings) + 1) if len(strings) else np.zeros(1, np.int64)
    whole = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(offsets[ends].tobytes()), data or pa.py_buffer(b""))
    return whole.cast(pa.string())


_name_lists: dict[tuple[int, int], pa.LargeStringArray] = {}


def _names(n_a: int, n_b: int) -> pa.LargeStringArray:
    """Decimal ids of either side with each mark that can follow them."""
    if (n_a, n_b) not in _name_lists:
        ids_a, ids_b = list(map(str, range(n_a))), list(map(str, range(n_b)))
        every = [i + mark for ids, marks in ((ids_a, ",|"), (ids_b, (",", ";", ""))) for mark in marks for i in ids]
        _name_lists[n_a, n_b] = pa.array(every, pa.large_string())
    return _name_lists[n_a, n_b]


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best`` over the ``pairs`` of all rows: documents that hold it, and whether its first id has no pair with more.

    A pair counts once a row, so the aggregate combines before its shuffle; the greatest
    counts are one row per id of the first vocabulary.
    """
    counts = stored(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    id_a = lambda pair: F.floor(pair / F.lit(size_b)).cast("long")
    most = counts.groupBy(id_a(F.col("pair")).alias("id_a")).agg(F.max("n").alias("most"))
    joined = counts.join(F.broadcast(most), id_a(F.col("pair")) == F.col("id_a"))
    return stored(joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def scored(rows: DataFrame, size_b: int, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``rows`` of :func:`aligned`, stored ones, with ``n_best`` and ``count_sum`` in place of ``pairs`` and ``times``.

    ``count_sum`` adds each link's :func:`pair_counts`; ``n_best`` counts the links whose
    pair is a best one. Rows without links have 0 of both.
    """
    spark = rows.sparkSession
    counts = pair_counts(rows, size_b)
    # Documents that hold a pair, by number of binary digits: the frequent pairs are those of at least so many digits.
    digits = F.length(F.bin("n"))
    by_digits = sorted(((r.digits, r.n) for r in counts.groupBy(digits.alias("digits")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = 65, 0
    for n_digits, n in by_digits:
        total += n
        if total > broadcast_pairs:
            break
        least = n_digits
    frequent = counts.filter(digits >= least).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(frequent[c].to_numpy() for c in ("pair", "n", "best")))

    def looked_up(batches):
        known, n, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            row = np.repeat(np.arange(batch.num_rows), pairs.value_lengths().to_numpy())
            pair, times = pairs.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], row[hit], times[hit] * best[at[hit]])
            np.add.at(sums[1], row[hit], times[hit] * n[at[hit]])
            starts = pa.array(np.searchsorted(row[~hit], np.arange(batch.num_rows + 1)), pa.int32())
            rest = [pa.ListArray.from_arrays(starts, pa.array(x[~hit])) for x in (pair, times)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in plain], pa.array(sums[0]), pa.array(sums[1]), *rest], out.names)

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    plain = [c for c in numbered.columns if c not in ("pairs", "times")]
    out = StructType([numbered.schema[c] for c in plain])
    out = out.add("n_best", LongType()).add("count_sum", LongType()).add("rest", ArrayType(LongType())).add("rest_times", ArrayType(LongType()))
    partly = stored(numbered.mapInArrow(looked_up, out), "alignment-counted")
    rare = partly.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("x")).select("row", F.col("x.rest").alias("pair"), F.col("x.rest_times").alias("times"))
    more = rare.join(counts.filter(digits < least), "pair").groupBy(F.col("row").alias("its_row")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    whole = partly.join(more, F.col("row") == F.col("its_row"), "left")
    add = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c)
    return whole.select(*[c for c in plain if c != "row"], add("n_best", "more_best"), add("count_sum", "more_sum"))
