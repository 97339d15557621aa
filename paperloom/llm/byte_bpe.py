"""Byte-level BPE by speculating and verifying.

A word's tokens are first proposed by greedy longest match, which needs no merge order.
A proposal is the true encoding if no merge would ever have crossed a border between
two neighbours, and that depends on the two alone: going back in time, the parts next
to the border are undone in the reverse order of their merges, and at every step the
merge of the two parts must come too late. All different pairs of neighbours of a batch
are tested at once on arrays. Only words with a pair that fails are merged one merge
after the other.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from paperloom.llm.common import int_lists, keep_recent

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# How texts are split into words before any merge. Characters that the vocabulary's own
# splitter sees differently (rare digits, new letters) are found by trial, and it splits their texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""
# Words remembered per worker, and the longest of them; a full memory keeps the last batch's.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64
ROWS_AT_ONCE = 256
NEVER = 1 << 40


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder; travels to tasks as lists of tokens and merges, its tables are built there."""

    def __init__(self, tokens: list[bytes], merges: list[tuple[int, int, int]], special: dict[str, int]):
        """``tokens`` by id; ``merges`` as left, right and made id in the order of rank; ``special`` strings with their ids."""
        self.tokens, self.merges, self.special = tokens, merges, special
        self._known = None

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Codec:
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        alphabet, ids = byte_alphabet(), whole["model"]["vocab"]
        special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
        for token, i in ids.items():
            tokens[i] = bytes(alphabet[c] for c in token)
        for token, i in special.items():
            tokens[i] = token.encode()
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in whole["model"]["merges"]]
        return cls(tokens, merges, special)

    def __getstate__(self):
        return {"tokens": self.tokens, "merges": self.merges, "special": self.special, "_known": None}

    def _build(self) -> None:
        size = len(self.tokens)
        left, right, made = np.array(self.merges or np.zeros((0, 3)), np.int64).reshape(-1, 3).T
        keys = left * size + right
        order = np.argsort(keys)
        self._keys, self._ranks = np.append(keys[order], NEVER), np.append(order, NEVER + 1)
        self._born = np.full(size, -1)
        self._born[made] = np.arange(len(made))
        self._left, self._right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self._left[made], self._right[made] = left, right
        self._rank = {(a, b): rank for rank, (a, b, _) in enumerate(self.merges)}
        self._lengths = np.array([len(t) for t in self.tokens])
        self._made = made
        self._byte_ids = {t[0]: i for i, t in enumerate(self.tokens) if len(t) == 1 and i not in self.special.values()}
        self._byte_table = np.full(256, -1)
        self._byte_table[list(self._byte_ids)] = list(self._byte_ids.values())
        # A token may be proposed if merging its own bytes gives it.
        sound = np.zeros(size, bool)
        sound[list(self._byte_ids.values())] = True
        below = self._compatible(left, right, joined=True)
        for a, b, c, ok in zip(left.tolist(), right.tolist(), made.tolist(), below.tolist()):
            sound[c] = ok and sound[a] and sound[b]
        self._automaton = ahocorasick.Automaton()
        for i in np.flatnonzero(sound).tolist():
            self._automaton.add_word(self.tokens[i].decode("latin-1"), i)
        self._automaton.make_automaton()
        self._pattern = re.compile(PATTERN)
        self._splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self._tested, self._odd = set(), set()
        marks = sorted(self.special, key=len, reverse=True)
        self._marks = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        self._known: dict[str, bytes] = {}

    def _compatible(self, a: np.ndarray, b: np.ndarray, joined: bool = False) -> np.ndarray:
        """Whether no merge crosses the border of tokens ``a`` and ``b``; if ``joined``, none before theirs."""
        a, b = a.copy(), b.copy()
        size, ok = len(self.tokens), np.ones(len(a), bool)
        # Ranks of the merges that take up the parts at the border.
        taken_a, taken_b = np.full(len(a), NEVER), np.full(len(a), NEVER)
        live, first = np.arange(len(a)), joined
        while len(live):
            x, y = a[live], b[live]
            at = np.searchsorted(self._keys, x * size + y)
            rank = np.where(self._keys[at] == x * size + y, self._ranks[at], NEVER + 1)
            # Of equal merges the leftmost comes first.
            crossed = (rank < taken_a[live]) & (rank <= taken_b[live])
            if first:
                crossed, first = np.zeros(len(live), bool), False
                taken_a[:], taken_b[:] = rank, rank
            ok[live[crossed]] = False
            born_x, born_y = self._born[x], self._born[y]
            undo_x = born_x > born_y
            on = ~crossed & (np.maximum(born_x, born_y) >= 0)
            one, other = live[on & undo_x], live[on & ~undo_x]
            taken_a[one], a[one] = born_x[on & undo_x], self._right[x[on & undo_x]]
            taken_b[other], b[other] = born_y[on & ~undo_x], self._left[y[on & ~undo_x]]
            live = live[on]
        return ok

    def _rank_at(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the merge of the token at each place with the next one of its word; ``NEVER`` if there is none."""
        after = np.minimum(at + 1, len(ids) - 1)
        pair = ids[at] * len(self.tokens) + ids[after]
        place = np.searchsorted(self._keys, pair)
        return np.where((after > at) & (word[after] == word[at]) & (self._keys[place] == pair), self._ranks[place], NEVER)

    def _merged(self, raw: bytes) -> list[int]:
        """Tokens of one word by its merges."""
        return np.frombuffer(self._merged_words([raw])[0], np.int32).tolist()

    def _merged_words(self, raw: list[bytes]) -> list[bytes]:
        """Tokens of each word by its merges, lowest rank and leftmost first; one merge of every short word at a time."""
        n = np.fromiter((len(r) if len(r) <= LONGEST_REMEMBERED else 0 for r in raw), np.int64, len(raw))
        word = np.repeat(np.arange(len(raw)), n)
        ids = self._byte_table[np.frombuffer(b"".join(r for r, size in zip(raw, n) if size), np.uint8)]
        rank, done = self._rank_at(ids, word, np.arange(len(ids))), [(ids[:0], word[:0])]
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            n, lowest = np.diff(np.append(starts, len(ids))), np.minimum.reduceat(rank, starts)
            on = lowest < NEVER
            of_on = np.repeat(on, n)
            done.append((ids[~of_on], word[~of_on]))
            ids, word, rank, n, lowest = ids[of_on], word[of_on], rank[of_on], n[on], lowest[on]
            hits = np.flatnonzero(rank == np.repeat(lowest, n))
            own = word[hits]
            merging = hits[np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])[: len(hits)])]
            ids[merging] = self._made[lowest]
            kept = np.ones(len(ids), bool)
            kept[merging + 1] = False
            ids, word, rank = ids[kept], word[kept], rank[kept]
            merged = merging - np.arange(len(merging))
            changed = np.concatenate([merged, merged[merged > 0] - 1])
            rank[changed] = self._rank_at(ids, word, changed)
        ids, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        whole, ends = ids[order].astype(np.int32).tobytes(), (4 * np.cumsum(np.bincount(word, minlength=len(raw)))).tolist()
        return [
            whole[start:end] if len(r) <= LONGEST_REMEMBERED else array("i", self._merged_by_heap(list(map(self._byte_ids.__getitem__, r)))).tobytes()
            for r, start, end in zip(raw, [0, *ends], ends)
        ]

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        """The same in n log n steps, for words of any length."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(k):
            if k >= 0 and after[k] < len(ids):
                rank = self._rank.get((ids[k], ids[after[k]]))
                if rank is not None:
                    heapq.heappush(heap, (rank, k))

        for k in range(len(ids) - 1):
            offer(k)
        while heap:
            rank, k = heapq.heappop(heap)
            x, y, made = self.merges[rank]
            gone = after[k]
            if ids[k] != x or gone >= len(ids) or ids[gone] != y:
                continue
            ids[k], ids[gone], after[k] = made, -1, after[gone]
            if after[k] < len(ids):
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [i for i in ids if i >= 0]

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        longest = self._automaton.iter_long
        proposed = [[i for _, i in longest(r.decode("latin-1"))] for r in raw]
        n, size = np.fromiter(map(len, proposed), np.int64, len(words)), len(self.tokens)
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, n.sum())
        word = np.repeat(np.arange(len(words)), n)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pairs, place = np.unique(flat[inside] * size + flat[inside + 1], return_inverse=True)
        good = self._compatible(pairs // size, pairs % size)
        covered = np.bincount(word, weights=self._lengths[flat], minlength=len(words))
        failing = np.zeros(len(words), bool)
        failing[word[inside[~good[place]]]] = True
        failing[covered != np.fromiter(map(len, raw), np.int64, len(words))] = True
        ids, ends = flat.astype(np.int32).tobytes(), (4 * np.cumsum(n)).tolist()
        self._known.update((w, ids[start:end]) for w, start, end in zip(words, [0, *ends], ends))
        wrong = np.flatnonzero(failing).tolist()
        self._known.update(zip((words[k] for k in wrong), self._merged_words([raw[k] for k in wrong])))

    def _words(self, text: str) -> list[str]:
        fresh = set(text) - self._tested
        for c in fresh:
            probe = f"a{c}b1{c}{c} {c}!{c}"
            if [s for _, s in self._splitter.pre_tokenize_str(probe)] != [m.span() for m in self._pattern.finditer(probe)]:
                self._odd.add(c)
        self._tested |= fresh
        if self._odd and not self._odd.isdisjoint(text):
            return [text[a:b] for _, (a, b) in self._splitter.pre_tokenize_str(text)]
        return self._pattern.findall(text)

    def encode(self, texts: list[str], special: bool = True) -> list[bytes]:
        """Token ids of each text as the bytes of 32-bit integers; without ``special``, special strings are plain text."""
        if self._known is None:
            self._build()
        known, split = self._known, []
        for text in texts:
            parts = self._marks.split(text) if special and self._marks else [text]
            words = [self._words(p) if k % 2 == 0 else p for k, p in enumerate(parts)]
            split.append(words)
        recent = set().union(*[own for words in split for own in words[::2]])
        fresh = list(recent.difference(known))
        self._learn(fresh)
        mark = {t: np.array([i], np.int32).tobytes() for t, i in self.special.items()}
        out = [b"".join([mark[p] if k % 2 else b"".join(map(known.__getitem__, p)) for k, p in enumerate(words)]) for words in split]
        for w in fresh:
            if len(w) > LONGEST_REMEMBERED:
                del known[w]
        keep_recent(known, recent, REMEMBERED, LONGEST_REMEMBERED)
        return out

    def split(self, text: str) -> tuple[list[str], bool]:
        """Words of a text, and whether they are those of ``PATTERN``; special strings are plain text."""
        if self._known is None:
            self._build()
        return self._words(text), not self._odd or self._odd.isdisjoint(text)

    def encode_words(self, split: list[list[str]], recent: set[str]) -> list[bytes]:
        """Token ids of each list of words of :meth:`split`; ``recent`` are the different ones of them."""
        known, fresh = self._known, list(recent.difference(self._known))
        self._learn(fresh)
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in fresh:
            if len(w) > LONGEST_REMEMBERED:
                del known[w]
        keep_recent(known, recent, REMEMBERED, LONGEST_REMEMBERED)
        return out

    def decode(self, ids) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


def encoded(docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, token_ids, decoded`` for every row of ``docs``, rows that repeat an id or have none included.

    A null text is an empty one; it has no tokens and decodes to an empty text. An empty
    table gives an empty one. A word of any length is encoded whole. Other columns are
    not looked at. Special strings in a text become their special token.
    """

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                ids = codec.encode(part.column(1).to_pylist())
                texts = [codec.decode(memoryview(own).cast("i")) for own in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), int_lists(ids), pa.array(texts, pa.string())], ["doc_id", "token_ids", "decoded"]
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return rows.mapInArrow(run, "doc_id long, token_ids array<int>, decoded string")
