"""Removal of repeated strings and of near-equal vectors where ids repeat or are missing."""

import random
from collections import Counter

import numpy as np

from paperloom.llm import embedding_dedup, suffix_dedup
from paperloom.llm.common import stored

LENGTH = 200


def brute_removed(texts):
    """Of each text, how many bytes its repeated strings cover."""
    seen = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    removed = []
    for t in texts:
        gone = set()
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i : i + LENGTH]] > 1:
                gone.update(range(i, i + LENGTH))
        removed.append(len(gone))
    return removed


def test_suffixes_of_repeated_and_missing_ids(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    passage = word(330)
    rows = [(7, word(150) + passage + word(90)), (7, word(40) + passage), (7, word(260)), (8, word(500))]
    rows += [(9, rows[3][1]), (9, rows[3][1]), (10, None), (11, ""), (7, word(211))]
    # One passage in many documents, with neighbours of its own in each.
    rows += [(100 + i, word(rng.randrange(60)) + passage[20:] + word(rng.randrange(60))) for i in range(300)]
    keyed = [(i, (t or "").encode()) for i, t in rows]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows + [(None, passage), (None, None)]], "doc_id long, text string, doc int, tag int")
    got = suffix_dedup.without_repeats(docs.repartition(5)).collect()
    want = [(i, len(t), n) for (i, t), n in zip(keyed, brute_removed([t for _, t in keyed]))] + [(None, len(passage), 0), (None, 0, 0)]
    assert Counter((r.doc_id, r.n_bytes, r.n_removed) for r in got) == Counter(want)
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in got)


def _vectors(spark, rows):
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id long, embedding array<double>, label int, node int, h1 int")
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.deduplicated(docs).collect()), key=str)


def test_vectors_of_repeated_and_missing_ids(spark):
    near = [1.0, 0.1]
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (4, near, 0), (None, near, 0), (5, near, None)]
    want = [(1, 0, 1, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (4, 2, 1, False), (None, 0, None, True), (5, 0, 5, True)]
    assert _vectors(spark, rows) == sorted(want, key=str)


def test_vectors_at_the_threshold_and_none(spark):
    at = lambda c: [c, float(np.sqrt(1 - c * c))]
    rows = [(3, [1.0, 0.0], 0), (2, at(0.9301), 0), (9, at(0.9299), 1), (8, [1.0, 0.0], 1)]
    assert _vectors(spark, rows) == [(2, 1, 2, True), (3, 1, 2, False), (8, 0, 8, True), (9, 0, 9, True)]
    assert _vectors(spark, [(1, None, 0), (2, [0.0, 0.0], 0), (3, [], 0)]) == [(i, 0, i, True) for i in (1, 2, 3)]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.deduplicated(empty).count() == 0


def _brute(x, labels, threshold=0.93):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= threshold) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    for _ in range(len(x)):
        after = np.array([min(root[i], root[own].min(initial=len(x))) for i, own in enumerate(near)])
        if (after == root).all():
            break
        root = after
    return near.sum(1), root


def test_links_of_a_dense_group_are_no_rows(spark, monkeypatch):
    """Every link is counted, over blocks and behind trees, and no table has more rows than vectors need."""
    written = []

    def counted(df, name):
        table = stored(df, name)
        written.append((name, table.count()))
        return table

    monkeypatch.setattr(embedding_dedup, "stored", counted)
    rng = np.random.default_rng(7)
    group = rng.normal(size=24) + 0.15 * rng.normal(size=(260, 24))
    x = np.concatenate([group, rng.normal(size=(120, 24)), rng.normal(size=24) + 0.27 * rng.normal(size=(60, 24))]).astype(np.float32)
    x[300:310] = x[5]
    labels = np.where(np.arange(len(x)) % 40 == 39, 1, 0)
    n_links, root = _brute(x.astype(float), labels)
    assert n_links.max() > 200 and len(set(root[380:])) < 60
    rows = [(i, v.tolist(), int(labels[i])) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for whole, block, leaf in ((10_000, 10_000, 256), (10_000, 100, 256), (50, 40, 40)):
        monkeypatch.setattr(embedding_dedup, "WHOLE_ROWS", whole)
        monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", block)
        monkeypatch.setattr(embedding_dedup, "LEAF_ROWS", leaf)
        written.clear()
        got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.deduplicated(table).collect()}
        assert got == {i: (n_links[i], root[i]) for i in range(len(x))}
        assert max(n for _, n in written) < 20 * len(x) < n_links.sum() / 2
