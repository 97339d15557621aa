import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import ivf, keyword, knn
from paperloom.operators.judgments import run_from_lists
from paperloom.operators.keyword import B, K1
from paperloom.plans import search
from paperloom.sources.vector_tables import save_bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 6)).astype(np.float32)
    v[50] = v[40]
    v[51] = v[40]
    v[7] = 0
    q = rng.normal(size=(9, 6)).astype(np.float32)
    q[3] = v[40]
    vectors = spark.createDataFrame(
        [(i, [float(x) for x in r]) for i, r in enumerate(v)], "pmid bigint, embedding array<float>"
    ).repartition(5)
    queries = spark.createDataFrame(
        [(100 + i, [float(x) for x in r]) for i, r in enumerate(q)], "query_id int, embedding array<float>"
    )
    return v, q, vectors, queries


def brute(v, q, k):
    v, q = v.astype(float), q.astype(float)
    out = {}
    with np.errstate(invalid="ignore"):
        for i, x in enumerate(q):
            d = np.round(1 - v @ x / (np.linalg.norm(v, axis=1) * np.linalg.norm(x)), 12) + 0.0
            order = sorted(range(len(v)), key=lambda j: (np.isnan(d[j]), d[j], j))[:k]
            out[100 + i] = order
    return out


def as_lists(run):
    out = {}
    for r in run.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.pmid)
        assert r["rank"] == len(out[r.query_id]) - 1
    return out


@pytest.mark.parametrize("k", [1, 4, 299, 300, 1200])
def test_nearest_matches_brute_force(spark, data, k):
    v, q, vectors, queries = data
    assert as_lists(knn.nearest(vectors, queries, k)) == brute(v, q, k)


def test_ties_and_zero_vectors(spark, data):
    v, q, vectors, queries = data
    found = as_lists(knn.nearest(vectors, queries, 300))
    assert found[103][:3] == [40, 50, 51]
    assert all(ids[-1] == 7 for ids in found.values())
    assert knn.nearest(vectors, queries, 300).filter(F.isnan("distance")).count() == len(q)


def test_several_query_blocks(spark, data, monkeypatch):
    v, q, vectors, queries = data
    monkeypatch.setattr(knn, "MAX_KEPT_ROWS", 12)
    assert as_lists(knn.nearest(vectors, queries, 4)) == brute(v, q, 4)


def test_small_score_blocks(spark, data, monkeypatch):
    v, q, vectors, queries = data
    kept = knn.NearestRows(2, 3)
    kept.flush_at = 5
    rng = np.random.default_rng(1)
    d = np.round(rng.random((2, 400)), 2)
    for start in range(0, 400, 7):
        kept.add(np.array([0, 1]), np.arange(start, min(start + 7, 400)), d[:, start : start + 7])
    batch = kept.to_batch(np.array([10, 11])).to_pydict()
    for i in (0, 1):
        expected = sorted(range(400), key=lambda j: (d[i, j], j))[:3]
        assert [p for p, x in zip(batch["pmid"], batch["query_id"]) if x == 10 + i] == expected


def test_pruning_keeps_the_result(spark, data):
    v, q, vectors, queries = data
    assert as_lists(knn.nearest(vectors, queries, 5, prune_fraction=0.4)) == brute(v, q, 5)
    assert as_lists(knn.nearest(vectors, queries, 290, prune_fraction=0.1)) == brute(v, q, 290)


def test_empty_query_set_and_wrong_dimension(spark, data):
    _, _, vectors, queries = data
    assert knn.nearest(vectors, queries.limit(0), 5).count() == 0
    other = spark.createDataFrame([(1, [1.0, 2.0])], "query_id int, embedding array<float>")
    with pytest.raises(Exception, match="dimensions"):
        knn.nearest(vectors, other, 5).collect()


def test_search_plan(spark, data):
    _, _, vectors, queries = data
    p = plan(knn.nearest(vectors, queries, 10))
    assert "WindowGroupLimit" in p and "MapInArrow" in p
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_ivf(spark, data, tmp_path):
    v, q, vectors, queries = data
    centroids = ivf.train_centroids(vectors, 6)
    path = str(tmp_path / "index")
    ivf.write_index(vectors, centroids, path, files_per_cell=2)
    cells, stored = ivf.read_index(spark, path)
    assert np.allclose(stored, centroids) and cells.count() == 300
    exact = knn.nearest(vectors, queries, 10)
    assert as_lists(ivf.search(cells, stored, queries, 10, n_probe=6)) == brute(v, q, 10)
    shares = [
        ivf.recall(ivf.search(cells, stored, queries, 10, n_probe=p), exact).first().recall for p in (1, 3, 6)
    ]
    assert shares == sorted(shares) and shares[-1] == 1.0
    assert "PartitionFilters: [isnotnull" in plan(ivf.search(cells, stored, queries.limit(1), 10, n_probe=1)) or (
        "cell" in plan(ivf.search(cells, stored, queries.limit(1), 10, n_probe=1)).split("PartitionFilters:")[1][:80]
    )


def test_search_leaves_out_orphans_before_the_limit(spark, data):
    v, q, vectors, _ = data
    articles = spark.range(0, 300, 3).select(
        F.col("id").alias("pmid"), *[F.lit("x").alias(c) for c in search.METADATA]
    )
    hits = search.search_with_metadata(vectors, articles, q[0].tolist(), 25)
    expected = [p for p in brute(v, q, 300)[100] if p % 3 == 0][:25]
    rows = hits.collect()
    assert [r.pmid for r in rows] == expected
    # Vectors are scored where they are read: nothing is shuffled before.
    shuffled = [line for line in plan(hits).splitlines() if "Exchange" in line]
    assert shuffled and not any("embedding" in line for line in shuffled)
    shown = search.display(hits).first()
    assert shown.url.endswith(f"/{expected[0]}/") and shown.distance_line.startswith("Semantic distance: ")


def test_bucketed_tables_join_without_shuffle(spark, data):
    _, _, vectors, _ = data
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        a = save_bucketed(vectors, "bucketed_vectors", buckets=4)
        b = save_bucketed(vectors.select("pmid", F.lit("t").alias("title")), "bucketed_articles", buckets=4)
        joined = search.with_article(a, b)
        assert joined.count() == 300
        assert "Exchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rank_of_a_hot_query(spark):
    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id") % 50 + 2).alias("query_id"),
        F.col("id").alias("pmid"),
        # Half of the scores are one value.
        F.when(F.col("id") % 2 == 0, 7).otherwise((F.col("id") * 31) % 113).alias("score"),
    )
    got = {(r.query_id, r.pmid): r["rank"] for r in knn.rank_within_query(rows, F.col("score"), ranges=8).collect()}
    by_query = {}
    for r in rows.collect():
        by_query.setdefault(r.query_id, []).append((-r.score, r.pmid))
    expected = {(q, p): i for q, items in by_query.items() for i, (_, p) in enumerate(sorted(items))}
    assert got == expected


WORDS = "alpha beta gamma delta the of and x1 é".split()


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(9)
    docs = [(i, " ".join(rng.choice(WORDS, size=rng.integers(0, 30))).title()) for i in range(120)]
    docs[5] = (5, None)
    docs[6] = (6, docs[7][1])
    queries = [(1, "alpha, the"), (2, "É beta beta"), (3, "unknown"), (4, ""), (5, "of and x1 gamma")]
    return (
        docs, queries,
        spark.createDataFrame(docs, "pmid bigint, text string").repartition(4),
        spark.createDataFrame(queries, "query_id int, query string"),
    )


def bm25(docs, queries, k):
    split = {i: (t or "").lower().split() for i, t in docs}
    mean = sum(map(len, split.values())) / len(split)
    out = {}
    for q, text in queries:
        scores = {}
        for w in set(text.lower().replace(",", " ").split()):
            holders = [i for i, ws in split.items() if w in ws]
            idf = np.log(1 + (len(split) - len(holders) + 0.5) / (len(holders) + 0.5))
            for i in holders:
                tf = split[i].count(w)
                norm = tf + K1 * (1 - B + B * len(split[i]) / mean)
                scores[i] = scores.get(i, 0) + idf * tf * (K1 + 1) / norm
        best = sorted(scores.items(), key=lambda t: (-round(t[1], 9), t[0]))[:k]
        if best:
            out[q] = [(i, round(s, 6)) for i, s in best]
    return out


@pytest.mark.parametrize(
    "small_blocks,share",
    [(False, 0.0), (True, 0.0), (False, 0.5)],
)
def test_keyword_search_matches_brute_force(spark, texts, monkeypatch, small_blocks, share):
    docs, queries, documents, query_df = texts
    if small_blocks:
        monkeypatch.setattr(keyword, "MAX_KEPT_ROWS", 14)
        monkeypatch.setattr(keyword, "ADDED_CELLS", 20)
    found = {}
    for r in keyword.search(documents, query_df, 7, share).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.pmid, round(r.score, 6)))
    assert found == bm25(docs, queries, 7)


def test_cache_split(spark):
    queries = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "query_id int, query string")
    cached = spark.createDataFrame([(1, [5, 4]), (2, []), (9, [1])], "query_id int, pmids array<bigint>")
    hits, misses = keyword.split_by_cache(queries, cached)
    assert [r.query_id for r in misses.collect()] == [3]
    rows = [(r.query_id, r.pmid, r["rank"]) for r in run_from_lists(hits).collect()]
    assert sorted(rows) == [(1, 4, 1), (1, 5, 0)]


def test_query_chunks_bound_a_score_matrix():
    chunks = list(knn.query_chunks(1000, 10_000))
    assert np.concatenate(chunks).tolist() == list(range(1000))
    assert max(len(c) for c in chunks) * 10_000 * 8 <= 8_000_000
