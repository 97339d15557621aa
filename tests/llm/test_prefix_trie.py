"""The prefix trie against a trie of Python dictionaries on small tables with edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paperloom.llm import prefix_trie, registered

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth string, rep long"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(paths):
    """Rows of the trie of ``{conv: [(role, text), ...]}``."""
    members = defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    done = {}
    for p in sorted(members, key=len, reverse=True):
        words = len([w for w in p[-1][1].translate({c: " " for c in range(9, 14)}).split(" ") if w]) if p else 0
        below = [done[x] for x in children[p]]
        done[p] = (sum(x[0] for x in below) or 1, sum(x[1] for x in below) + (len(members[p]) - 1) * words)
    return Counter(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *done[p],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [x[2] for x in sorted(turns, key=lambda x: x[:2])] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "d", 1) for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    texts = ["hello there", "a\tb \n c", None, "", "  ", "the house is red", "x" * 5000, "é ü\x0b\x1c日本"]
    out = []
    for c in range(0, 90):
        n = rng.choice([1, 1, 2, 3, 4, 6, 9])
        out += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts[: rng.choice([2, 8])])) for t in range(n)]
    out += [(200, None, "system", "first of all"), (200, 3, "user", "x"), (201, 0, "user", "only one")]
    # One conversation stored again after each turn, copies, and a long one.
    out += [(300 + k, t, "user", f"turn {t}") for k in range(12) for t in range(k + 1)]
    out += [(c, t, "user", "same words") for c in range(400, 440) for t in range(5)]
    out += [(500, t, "user", f"step {t}") for t in range(40)] + [(501, t, "user", f"step {t}" if t < 27 else "other") for t in range(33)]
    out += [(None, 1, "user", "nobody's")]
    return out


def test_trie_is_the_one_of_dictionaries(spark, rows, tmp_path):
    _frame(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    got = registered.op12_prefix_trie(spark, str(tmp_path))
    assert got.columns == list(COLUMNS)
    assert Counter(map(tuple, got.collect())) == brute(rebuilt(rows))


def test_operator_keeps_sequences_as_they_are(spark, rows):
    rng = random.Random(7)
    paths = {c: [("u", rng.choice("ab"))] * rng.randint(0, 3) + [("u", rng.choice("abc")) for _ in range(rng.randint(0, 6))] for c in range(60)}
    turns = [(c, t, role, text) for c, path in paths.items() for t, (role, text) in enumerate(path)]
    members = spark.createDataFrame([(c,) for c in paths], "conv long")
    frame = _frame(spark, turns)
    got = prefix_trie.trie(prefix_trie.numbered(frame), members)
    assert Counter(map(tuple, got.collect())) == brute(paths)


def test_tied_turns_and_chunks(spark, monkeypatch):
    """Repeated turn numbers have one order however rows arrive; chunks do not show."""
    rows = [(1, 5, "user", f"same turn {k}") for k in range(20)] + [(1, None, "user", "x"), (1, None, "user", "x")]
    one = prefix_trie.numbered(_frame(spark, rows)).orderBy("depth").collect()
    assert [r.depth for r in one] == list(range(1, 23)) and [r.words for r in one[:2]] == [1, 1]
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    assert prefix_trie.numbered(_frame(spark, rows[::-1])).orderBy("depth").collect() == one
    paths = {c: [("u", f"t{d}") for d in range(30 + c)] for c in range(3)}
    turns = _frame(spark, [(c, t, *x) for c, path in paths.items() for t, x in enumerate(path)])
    got = prefix_trie.trie(prefix_trie.numbered(turns), spark.createDataFrame([(c,) for c in paths], "conv long"))
    assert Counter(map(tuple, got.collect())) == brute(paths)


def test_no_turns(spark):
    none = prefix_trie.numbered(_frame(spark, []))
    assert prefix_trie.trie(none, none.select("conv")).count() == 0
    alone = prefix_trie.trie(none, spark.createDataFrame([(7,), (9,)], "conv long")).collect()
    assert [tuple(r)[:7] for r in alone] == [(7, 0, None, 2, 0, 1, 0)]
    assert alone[0].ends_sha256 == hashlib.sha256(b"7,9").hexdigest()


def test_two_fattest_and_bucketed_prefixes(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    want = {(a, b): max(range(a + 1, b + 1), key=lambda f: f & -f) for a, b in pairs}
    assert {(r.a, r.b): r.f for r in frame.withColumn("f", prefix_trie.two_fattest(F.col("a"), F.col("b"))).collect()} == want
    turns = prefix_trie.numbered(_frame(spark, [(c, t, "u", "x") for c in range(50) for t in range(5)]))
    known = prefix_trie.prefixes(turns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = spark.createDataFrame([(c, 2) for c in range(50)], "c long, f long")
        plan = prefix_trie._at(asked, known, F.col("c"), F.col("f"), x="p1")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1
