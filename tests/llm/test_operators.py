"""The training-data operators against brute force on small tables with edge cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from paperloom.llm import (
    components,
    embedding_dedup,
    jaccard_join,
    line_dedup,
    mixing,
    pieces,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    toxicity,
    url_filter,
)
from paperloom.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size string"


def _prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "tion", "ering", "ble", "est", "house", "ouen", "lyat"]) + rng.choice(["", "s", "ed"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    base = _prose(rng, 150)
    words = base.split()
    shared = "A line that Many documents hold\n"
    near = [" ".join(w if k != 10 * i else "changed" for k, w in enumerate(words)) for i in range(1, 9)]
    out = [base, base, *near, None, "", "   \n\t", "one two", "One  TWO", "short", _prose(rng, 4000)]
    out += [shared + _prose(rng, 60) + f"\n  {shared.upper()}" for _ in range(4)]
    out += [_prose(rng, 80) + base[:250] + "é▁ü" + _prose(rng, 30) for _ in range(3)]
    out += ["a" * 450, "xyz " * 300, "*&# " * 80, "日本語" * 40]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None, [None, "s0", "s1", "s2"][min(3, i % 7)], None, "k", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df):
    return {r.doc_id: r for r in df.collect()}


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_rules_measure(docs, texts, none):
    got = _by_id(quality_rules.judged(docs))
    for i, text in enumerate(texts):
        words = _words(text)
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        n = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if _words(x)]
        row = got[i]
        assert (row.n_words, row.word_chars, row.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.base_failed == (len(words) < 50 or 2 * len(covered) > len(words))
        assert not (row.kept and row.base_failed)
    assert got[0].kept and not got[texts.index("*&# " * 80)].kept
    assert quality_rules.judged(none).count() == 0


def test_mix_reaches_targets(spark, docs, texts, none):
    rows = mixing.mixed(docs).collect()
    assert len(rows) == len(texts)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert own[0].source_size == sum(r.size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
        assert own[0].target <= 3 * own[0].source_size and all(r.taken <= 3 * r.size for r in own)
    assert sum(r.target for r in {r.source: r for r in rows}.values()) == pytest.approx(sum(r.size for r in rows))
    assert sorted(map(tuple, mixing.mixed(docs).drop("source").collect())) == sorted(tuple(x for k, x in enumerate(r) if k != 1) for r in rows)
    repeated = Counter(r.doc_id for r in mixing.repeated(docs).collect())
    assert repeated == Counter({r.doc_id: r.copies for r in rows if r.copies})
    assert mixing.repeated(docs).columns == docs.columns
    assert mixing.mixed(none).count() == 0


def test_lines(docs, texts, none):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    held = {}
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(i)
    got = _by_id(line_dedup.without_shared_lines(docs))
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(held[key(x)]) < 2 or i == min(held[key(x)])]
        assert (got[i].text, got[i].n_lines, got[i].n_dropped) == ("\n".join(kept), len(lines), len(lines) - len(kept))
    assert got[0].key == "k" and line_dedup.without_shared_lines(none).count() == 0


def test_jaccard_classes(docs, texts, none):
    sets = []
    for t in texts:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in _words(t)]
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    got = _by_id(jaccard_join.classes(docs))
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(texts))] == [(len(s), c) for s, c in zip(sets, label)]
    assert jaccard_join.classes(none).count() == 0


def test_large_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", 4)
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 7)
    rng = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(w if rng.random() > 0.008 else f"x{rng.random()}" for w in words)) for i in range(40)]
    sets = [{tuple(t.split()[k : k + 5]) for k in range(296)} for _, t in rows]
    label = list(range(40))
    for _ in range(40):
        for i in range(40):
            for j in range(40):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    got = _by_id(jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [got[i].component_id for i in range(40)] == label


def test_all_links_of_a_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 15)
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(w if rng.random() > 0.012 else f"x{rng.random()}" for w in words)) for i in range(40)]
    rows += [(40, rows[3][1]), (41, rows[3][1].upper()), (42, None), (43, "lone")]
    sets = [{tuple(t.lower().split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} if t else set() for _, t in rows]
    near = [{j for j, b in enumerate(sets) if i != j and a and b and 100 * len(a & b) >= 80 * len(a | b)} for i, a in enumerate(sets)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_links for r in jaccard_join.n_links(table).collect()} == {i: len(x) for i, x in enumerate(near)}
    got = sorted((r.a, r.b, r.a_copies, r.b_copies) for r in jaccard_join.links(table).collect())
    first = [i for i, a in enumerate(sets) if a not in sets[:i]]
    want = [(i, j, sets.count(sets[i]), sets.count(sets[j])) for i in first for j in near[i] if i < j and j in first]
    assert got == sorted(want) and 40 < len(want) < 780


def test_suffixes(docs, texts, none):
    bodies = [(t or "").encode() for t in texts]
    n = Counter(b[k : k + 200] for b in bodies for k in range(len(b) - 199))
    got = _by_id(suffix_dedup.without_repeats(docs))
    for i, b in enumerate(bodies):
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 199):
            if n[b[k : k + 200]] > 1:
                gone[k : k + 200] = 1
        assert got[i].n_removed == gone.sum() and got[i].n_spans == (np.diff(np.concatenate([[0], gone])) == 1).sum()
        assert bytes(got[i].kept) == bytes(x for x, g in zip(b, gone) if not g)
    assert suffix_dedup.without_repeats(none).count() == 0


def test_pieces_round_trip_and_optimum(docs, texts, none):
    codec = pieces.Codec.load()
    for row in pieces.encoded(docs, codec).collect():
        assert row.decoded == (texts[row.doc_id] or "") and (len(row.piece_ids) > 0) == bool(texts[row.doc_id])
    assert pieces.encoded(none, codec).count() == 0
    codec.encode("x")
    score = {p: s for p, s in zip(codec.pieces, codec.scores) if p}
    for word in ("▁theering", "▁ouen", "tion▁", "▁qz", "▁▁▁▁x"):
        best = [0.0] + [None] * len(word)
        for e in range(1, len(word) + 1):
            ways = [best[s] + score[word[s:e]] for s in range(e) if best[s] is not None and word[s:e] in score]
            best[e] = max(ways, default=None)
        assert codec._best(word)[1] == pytest.approx(best[-1])
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert model.decode(list(codec.encode("Die Häuser\nund das")[0])) == "Die Häuser\nund das"


def test_urls(spark):
    page = lambda *hosts: "".join(f'<a HREF="http://{h}/x">' for h in hosts)
    rows = [
        (0, "http://A.good.com/fr/1?x=/de/", page("friend.net", "x.net")),
        (1, "https://bad.com/de/2", None),
        (2, "http://spam.net/", page("bad.com")),
        (3, "//friend.net/a", None),
        (4, "http://friend.net/b#c", ""),
        (5, None, page("bad.com")),
        (6, "http://example.org/en/17", None),
        (7, "http://example.org/en/2", None),
        (8, "http://xexample.org", None),
        (9, "http://notcom/de/", None),
    ]
    got = {r.page_id: r for r in url_filter.judged(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i].verdict for i in range(10)] == ["allow", "block", "block", "allow", "allow", "allow", "block", "allow", "allow", "allow"]
    assert (got[0].host, got[0].path, got[0].rule) == ("a.good.com", "/fr/1", "com/fr/")
    assert (got[5].host, got[5].path, got[5].rule) == ("", "", None) and got[6].rule == "example.org/en/1"
    assert got[4].trust == pytest.approx(0.15 * 0.85 / 2, rel=1e-3) and got[2].distrust == pytest.approx(0.15 * 0.85, rel=1e-3)


def test_urls_far_from_seeds(spark):
    """Hosts 1 to 30 links before a blocked seed, each with a second host that links to the next, and a cycle with a seed."""
    page = lambda host: f'<a href="http://{host}/">'
    chain = [f"h{k}.net" for k in range(30)] + ["bad.com"]
    rows = [(k, f"http://{a}/", page(b)) for k, (a, b) in enumerate(zip(chain, chain[1:]))]
    rows += [(100 + k, f"http://x{k}.net/", page(b)) for k, b in enumerate(chain[1:])]
    rows += [(200, "http://bad.com/de/", None), (201, "http://round.com/de/", page("back.net")), (202, "http://back.net/", page("round.com"))]
    got = {r.page_id: r for r in url_filter.judged(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(30):
        assert got[k].verdict == "block" and got[k].distrust == pytest.approx(0.15 * 0.425 ** (30 - k), rel=1e-4)
    assert got[201].distrust == pytest.approx(0.15 / (1 - 0.85**2), rel=1e-4)
    assert got[202].distrust == pytest.approx(0.15 * 0.85 / (1 - 0.85**2), rel=1e-4)


def test_vectors_of_one_dense_group(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=64) / 8 + 0.274 / 8 * rng.normal(size=(1200, 64))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.93
    np.fill_diagonal(close, False)
    assert 0.2 < close.mean() < 0.8
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = embedding_dedup.deduplicated(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sum(r.n_links for r in got) >= 0.9995 * close.sum()


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAF_ROWS", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, 300)] + 0.12 * rng.normal(size=(300, 16))
    x[10:20] = x[0]
    rows = [(i, v.tolist(), i % 3 if i < 250 else 0) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, x[0].tolist(), None), (905, [1.0], 1)]
    got = {r.vec_id: r for r in embedding_dedup.deduplicated(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows[:300]])
    close = (unit @ unit.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(close, False)
    found = np.array([got[i].n_links for i in range(300)])
    assert (found <= close.sum(1)).all() and found.sum() >= 0.98 * close.sum()
    assert all(got[i].n_links == 0 and got[i].kept for i in range(900, 906)) and len(got) == 306


def test_classifiers(spark, none):
    rng = random.Random(4)
    good = [(i, _prose(rng, 80) + ".", None, None) for i in range(200)]
    bad = [(i, " ".join(w.upper() + "%%!" for w in _prose(rng, 80).split()), None, None) for i in range(200, 260)]
    rude = [(i, _prose(rng, 40) + " grumblefrotz snarkwort " + _prose(rng, 40), None, None) for i in range(260, 320)]
    docs = spark.createDataFrame([*good, *bad, *rude, (400, None, None, None), (401, "", None, None), (None, "x", None, None)], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(not 200 <= i < 260), int(i >= 260)) for i in range(320)] + [(3, None, 0)], "doc_id long, quality int, toxic int")
    measured = quality_classifier.text_statistics(docs).cache()
    model = quality_classifier.fit(measured, labels)
    by_quality = _by_id(quality_classifier.scores(measured, model))
    by_toxic = _by_id(toxicity.scores(docs, labels))
    held = [i for i in range(320) if by_quality[i].held_out]
    assert 40 < len(held) < 90 and by_quality[None].held_out
    assert all(by_quality[i].predicted == (not 200 <= i < 260) for i in held)
    assert all(by_toxic[i].predicted == (i >= 260) for i in held)
    assert all(0 <= by[i].score <= 1 for by in (by_quality, by_toxic) for i in (400, 401, None))
    kept = {r.doc_id for r in quality_classifier.accepted(docs, model).collect()}
    assert kept == {i for i, r in by_quality.items() if r.predicted}
    empty = none.select("doc_id", "text")
    assert toxicity.scores(empty, labels.limit(0)).count() == 0
    assert quality_classifier.scores(measured, quality_classifier.fit(measured, labels.limit(0))).count() == 323


def test_digest_of_pieces_is_stable():
    ids, score = pieces.Codec.load().encode("the house")
    assert hashlib.sha256(bytes(ids)).hexdigest() == hashlib.sha256(bytes(pieces.Codec.load().encode("the house")[0])).hexdigest() and score < 0


def test_columns_with_clashing_names(spark):
    """Columns that the operators use for themselves are carried like any other, from empty tables too."""
    names = ["its_source", "copies", "threshold", "row", "hash", "loser", "lost_keys", "body", "good"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in names)
    line = "a line that both of them hold"
    rows = [(i, t, s, *names) for i, (t, s) in enumerate([(line, "x"), (f"{line}\nand one", "y"), (None, None), ("", "x")])]
    rows += [(None, line, "x", *names), (1, f"{line}\nand one", "y", *names)]
    docs = spark.createDataFrame(rows, schema)
    cut = line_dedup.without_shared_lines(docs)
    assert cut.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text, r.n_dropped, r.good) for r in cut.collect()) == [
        (-1, line, 0, "good"), (0, line, 0, "good"), (1, "and one", 1, "good"), (1, "and one", 1, "good"), (2, "", 0, "good"), (3, "", 0, "good")
    ]
    mix = mixing.repeated(docs)
    assert mix.columns == docs.columns and {r.good for r in mix.collect()} == {"good"}
    taken = {}
    for r in mixing.mixed(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.copies * (r["size"] > 0)
    assert Counter(r.doc_id for r in mix.collect()) == Counter({k: n for k, n in taken.items() if n})
    assert mixing.repeated(docs.limit(0)).count() == line_dedup.without_shared_lines(docs.limit(0)).count() == 0


def test_links_count_rows(spark):
    """Repeated rows count as often; null ids are alone."""
    rng = random.Random(9)
    base, other = _prose(rng, 60), _prose(rng, 60)
    near = base + " end"
    rows = [(1, base), (1, base), (2, base), (3, near), (4, other), (6, other), (None, base), (5, None)]
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.component_id, r.n_links) for r in got) == Counter(
        [(1, 1, 3), (1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 4, 1), (6, 4, 1), (None, None, 0), (5, 5, 0)]
    )


def test_components_join_a_link_once(spark, monkeypatch):
    """Links of a dense group are not carried through every round; a long path, links to itself and lone pairs are right."""
    written = {}

    def counted(df, name):
        table = stored(df, name)
        written.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(components, "stored", counted)
    rng = random.Random(3)
    group, path = rng.sample(range(100, 200), 40), rng.sample(range(200, 300), 60)
    links = [(a, b) for a in group for b in group if a != b] + [*zip(path, path[1:]), (7, 7), (9, 8), (None, 5)]
    found = components.components(spark.createDataFrame(links, "a long, b long"), "dense")
    want = {x: min(own) for own in (group, path, [7], [8, 9]) for x in own}
    assert {r.id: r.component_id for r in found.collect()} == want and found.count() == len(want)
    first, *others = written["dense-links"]
    assert first == 40 * 39 // 2 + 59 + 2 and sum(others) < 60


def test_edges_of_a_group_grow_with_its_sets(spark, monkeypatch):
    """A group whose lists are long is tied by few edges a set, and no pair is joined to find the sizes of its sets."""
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", 4)
    rng = random.Random(5)
    prefixes = [sorted(rng.sample(range(60), 54)) for _ in range(120)]
    reps = spark.createDataFrame([(i, 250, own) for i, own in enumerate(prefixes)], "rep long, n long, prefix array<long>")
    edges = jaccard_join.candidates(reps.repartition(5))
    assert "Join" not in edges._jdf.queryExecution().toString()
    pairs = [(r.a, r.b) for r in edges.collect()]
    assert len(set(pairs)) == len(pairs) < 4 * 120
    assert {x for p in pairs for x in p} == set(range(120))


def test_a_line_of_many_texts_joins_no_group(spark, monkeypatch):
    """Texts that share a line that no task has seen often stay apart; near copies with the line are tied, sketches of two lengths too."""
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", 4)
    monkeypatch.setattr(jaccard_join, "frequent_shingles", lambda bodies: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    rng = random.Random(8)
    words = lambda n: [f"w{rng.random()}" for _ in range(n)]
    line, base = words(40), words(200)
    rows = [(i, " ".join(words(rng.randrange(60, 200)) + line + words(30))) for i in range(60)]
    copies = [line + [w if rng.random() > 0.005 else f"x{rng.random()}" for w in base] + words(k % 2 * 40) for k in range(14)]
    rows += [(100 + k, " ".join(own)) for k, own in enumerate(copies)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    near = {i: {j for j, b in sets.items() if i != j and 100 * len(a & b) >= 80 * len(a | b)} for i, a in sets.items()}
    assert {len(x) > 256 for i, x in sets.items() if i >= 100} == {True, False} and not any(near[i] for i in range(60))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, reps, _ = jaccard_join._representatives(jaccard_join._bodies(docs, "doc_id", "text"), 80)
    tied = {x for r in jaccard_join.candidates(reps).collect() for x in (r.a, r.b)}
    first = [i for i, own in sets.items() if own not in [sets[j] for j in sets if j < i]]
    linked = {i for i in first if any(sets[j] != sets[i] for j in near[i])}
    assert linked <= tied <= set(range(100, 114)) and len(linked) > 8
    got = _by_id(jaccard_join.classes(docs))
    assert {i: r.n_links for i, r in got.items()} == {i: len(x) for i, x in near.items()}
    label = {i: i for i in sets}
    for _ in copies:
        label = {i: min([label[i], *(label[j] for j in near[i])]) for i in sets}
    assert {i: r.component_id for i, r in got.items()} == label


def test_sketches_never_part_linked_sets():
    rng = np.random.default_rng(1)
    for n in (5, 40, 230, 256, 257, 500, 900):
        own = rng.integers(-(2**63), 2**63 - 1, n)
        for part in (0.8, 0.85, 0.95):
            other = np.append(own[: -(-n * 4 // 5)], rng.integers(-(2**63), 2**63 - 1, int(n * (1 - part) * 0.2)))
            common = -(-n * 4 // 5)
            if 100 * common < 80 * (n + len(other) - common):
                continue
            x, y = jaccard_join.sketch(own), jaccard_join.sketch(other)
            a, b = jaccard_join._folded([x, y], min(len(x), len(y)))
            assert np.bitwise_count(a ^ b).sum() <= jaccard_join.most_apart(n, len(other))
            ties = list(jaccard_join._tied(np.array([3, 2]), np.array([n, len(other)]), [x, y], 80))
            assert ties == [(2, 3)]
    apart = [jaccard_join.sketch(rng.integers(-(2**63), 2**63 - 1, 300)) for _ in range(50)]
    assert not list(jaccard_join._tied(np.arange(50), np.full(50, 300), apart, 80))
