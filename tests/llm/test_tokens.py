"""Token operators against the tokenizers' own libraries and brute force on small tables with edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from paperloom.llm import byte_bpe, registered, token_alignment

SCHEMA = "doc_id long, text string, lang string, token_ids string, row string, groups string"


def _sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@pytest.fixture(scope="module")
def bodies():
    rng = random.Random(4)
    codec = byte_bpe.Codec.load()
    tokens = [t.decode() for t in codec.tokens if t.isascii()]
    pool = "aaeth  \n\t's 'll19!?.-ßéñ日本語​́\xa0　\x85\x1c՘࢏😀½²"
    out = [None, "", " ", "   ", "x", "<|endoftext|>", "a<|endoftext|> b</s><unk><0x41>", "a▁b", "日本語" * 700]
    out += ["a" * k for k in (2, 3, 7, 64, 65, 500)] + [" " * 70 + "x", "the house " * 800, "the house", "the house"]
    out += ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    out += ["".join(rng.choice(tokens) for _ in range(12)).replace(" ", rng.choice(["", " "])) for _ in range(200)]
    return out + ["".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(20)) for _ in range(20)]


@pytest.fixture(scope="module")
def docs(spark, bodies):
    rows = [(i if i > 2 else [None, 5, 5][i], t, "l", "t", "r", "g") for i, t in enumerate(bodies)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(byte_bpe.VOCABULARY)


def test_encoding_is_the_librarys(docs, bodies, library):
    want = Counter()
    for i, t in enumerate(bodies):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[(i if i > 2 else [None, 5, 5][i], tuple(ids), library.decode(ids, skip_special_tokens=False))] += 1
    rows = byte_bpe.encoded(docs, byte_bpe.Codec.load()).collect()
    assert Counter((r.doc_id, tuple(r.token_ids), r.decoded) for r in rows) == want


def test_speculation_is_verified(library):
    """Some proposals fail and are merged; pairs that pass are what merging gives."""
    codec = byte_bpe.Codec.load()
    codec.encode([])
    rng = np.random.default_rng(1)
    some = [i for i, t in enumerate(codec.tokens) if len(t) > 2]
    a, b = rng.choice(some, 4000), rng.choice(some, 4000)
    passed = codec._compatible(a, b)
    merged = [codec._merged(codec.tokens[x] + codec.tokens[y]) for x, y in zip(a, b)]
    assert passed.tolist() == [m == [x, y] for m, x, y in zip(merged, a, b)]
    assert 0 < passed.sum() < 4000
    words = [codec.tokens[x] + codec.tokens[y] for x, y in zip(a, b)] + [b"", b"a", b"ab" * 31, b"ab" * 33]
    together = [np.frombuffer(own, np.int32).tolist() for own in codec._merged_words(words)]
    assert together == [codec._merged_by_heap([codec._byte_ids[x] for x in w]) for w in words]
    long = list(codec.tokens[some[5]] + codec.tokens[some[9]]) * 30
    assert codec._merged_by_heap([codec._byte_ids[x] for x in long]) == codec._merged(bytes(long))


def _aligned(text, library, pieces, codec):
    """Tokens and groups of one text by walking both sides; empty if the bytes differ."""
    a = library.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
    b = pieces.encode(text) if text else []
    spell = lambda i: bytes([int(pieces.id_to_piece(i)[3:-1], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
    as_a, as_b = [codec.tokens[i] for i in a], [spell(i) for i in b]
    want = (" " + (text or "")).encode()
    if not text or b"".join(as_a) != want or b"".join(as_b) != want:
        return [], [], []
    ends_a, ends_b = np.cumsum([len(x) for x in as_a]).tolist(), np.cumsum([len(x) for x in as_b]).tolist()
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(cut) + 1, ends_b.index(cut) + 1
        groups.append((a[i:k], b[j:m]))
        i, j = k, m
    return a, b, groups


@pytest.mark.parametrize("broadcast_pairs", [token_alignment.BROADCAST_PAIRS, 20, 0])
def test_alignment_and_counts(spark, docs, bodies, library, broadcast_pairs):
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=token_alignment.MODEL)
    codec, second = byte_bpe.Codec.load(), token_alignment.PieceEncoder.load()
    brute = [_aligned(t, library, pieces, codec) for t in bodies]
    library.encode_special_tokens = False
    links = [Counter((x, y) for ga, gb in groups for x in ga for y in gb) for _, _, groups in brute]
    counts = Counter(p for own in links for p in own)
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(n, most.get(x, 0))
    want = Counter()
    for i, ((a, b, groups), own) in enumerate(zip(brute, links)):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in own.items() if counts[p] == most[p[0]])
        total = sum(n * counts[p] for p, n in own.items())
        want[(i if i > 2 else [None, 5, 5][i], len(a), len(b), len(groups), sum(own.values()), best, total, text)] += 1
    rows = token_alignment.aligned(docs, codec, second).cache()
    got = token_alignment.scored(rows, second.size(), broadcast_pairs).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got) == want
    assert sum(n > 0 for n in want.values()) > 100 and max(len(x) for _, _, g in brute for x, _ in g) > 10


def test_groups_of_many_links_are_counted_by_ids(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 5, 90), rng.integers(0, 7, 130)
    groups, doc = np.array([[0, 40, 0, 60], [40, 41, 60, 61], [41, 90, 61, 130]]), np.array([0, 1, 1])
    want = token_alignment._links(a, b, groups, doc, 10, 100)
    monkeypatch.setattr(token_alignment, "LINKS_ONE_BY_ONE", 10)
    got = token_alignment._links(a, b, groups, doc, 10, 100)
    assert all(np.array_equal(x, y) for x, y in zip(got, want)) and want[2].sum() == 40 * 60 + 1 + 49 * 69


def test_token_queries(spark, tmp_path, bodies, docs, library):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = registered.op11_byte_bpe(spark, str(tmp_path)).collect()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(bodies)}
    for r in rows:
        if r.doc_id is not None and r.doc_id > 5:
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids[r.doc_id]), _sha(",".join(map(str, ids[r.doc_id]))), _sha(bodies[r.doc_id]))
    aligned = registered.op13_token_alignment(spark, str(tmp_path)).collect()
    assert len(rows) == len(aligned) == len(bodies)
    assert {r.groups_sha256 == "" for r in aligned if r.n_a == 0} == {True} == {len(r.groups_sha256) == 64 for r in aligned if r.n_a}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    codec, second = byte_bpe.Codec.load(), token_alignment.PieceEncoder.load()
    assert byte_bpe.encoded(none, codec).count() == 0
    assert token_alignment.scored(token_alignment.aligned(none, codec, second), second.size()).count() == 0


def test_full_memory_keeps_the_last_batch(monkeypatch):
    """Words of the last batch are not learnt again when a memory is full; ids are the same as without a memory."""
    codec, second = byte_bpe.Codec.load(), token_alignment.PieceEncoder.load()
    texts = [" ".join(f"word{k}" for k in range(start, start + 12)) for start in range(0, 60, 6)] + ["x" * 70]
    want = [(codec.encode([t]), second.encode([t])) for t in texts]
    for module in (byte_bpe, token_alignment):
        monkeypatch.setattr(module, "REMEMBERED", 40)
    codec, second = byte_bpe.Codec.load(), token_alignment.PieceEncoder.load()
    for t, (a, b) in zip(texts, want):
        assert codec.encode([t]) == a and second.encode([t]) == b
        assert len(codec._known) <= 40 and len(second._known) <= 41
        assert set(second._known) >= {"", *(w for w in t.split() if len(w) < 64)}
    # More words than half the memory: it is emptied.
    codec.encode([" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(100))])
    assert not codec._known


def test_groups_by_looked_up_ends():
    """Cuts of two sides that end at different offsets, and sides without tokens."""
    ends_a, ends_b = np.array([2, 3, 5, 9, 11]), np.array([1, 3, 4, 5, 9, 10, 11])
    got = token_alignment.groups_between_cuts(ends_a, ends_b, np.array([0, 3]), np.array([3, 5]), np.array([0, 4]), np.array([4, 7]))
    assert got.tolist() == [[0, 2, 0, 2], [2, 3, 2, 4], [3, 4, 4, 5], [4, 5, 5, 7]]
    none = np.zeros(0, np.int64)
    assert token_alignment.groups_between_cuts(none, none, none, none, none, none).shape == (0, 4)


def test_both_sides_are_encoded_by_the_same_words():
    """Borders that a piece or a run of spaces crosses are left to whole texts; words beside marks are learnt once."""
    codec, second = byte_bpe.Codec.load(), token_alignment.PieceEncoder.load()
    texts = ["house. house, house\nhouse (house)", "don'tfoo it's 'sfoo ..'s", "x²", "².", "a². b", "  two", "two  spaces", "end ", "\n\n\nx \n \ny", ");\r\n }\r x", "a▁b", "", " ", "日本 x9y_z"]
    rng = random.Random(8)
    texts += ["".join(rng.choice("ab'st  .²\n\t\r\x85;}(09_é") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    pieces = sentencepiece.SentencePieceProcessor(model_file=token_alignment.MODEL)
    second.encode([])
    a, b = token_alignment._encoded(codec, second, texts)
    assert [np.frombuffer(x, np.int32).tolist() for x in b] == pieces.encode(texts)
    assert a == byte_bpe.Codec.load().encode([" " + t for t in texts], special=False)
    assert 100 < sum(map(second.by_run, texts)) < 2900 and second.by_run(texts[0])
    assert not any(map(second.by_run, ["don'tfoo", "x².", "² .\r", "two  spaces", " x", "", "a▁b"]))
    second = token_alignment.PieceEncoder.load()
    second.encode([])
    token_alignment._encoded(codec, second, texts[:1])
    assert set(second._of_run) == {" ", "house", " house", ".", ",", "\n", " (", ")"} and set(second._known) == {""}
