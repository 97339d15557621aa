import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import judgments as J, metrics as M
from paperloom.operators.topk import top_n_per_group
from paperloom.plans.evaluation import evaluate
from paperloom.plans.reference_sets import ReferenceSet


def make_run(spark, lists):
    rows = [(q, p, r) for q, ps in lists.items() for r, p in enumerate(ps)]
    return spark.createDataFrame(rows, "query_id int, pmid bigint, rank int")


def make_qrels(spark, maps):
    rows = [(q, p, r) for q, m in maps.items() for p, r in m.items()]
    return spark.createDataFrame(rows, "query_id int, pmid bigint, rel int")


def panel(run, qrels, **kw):
    return M.metric_panel(run, qrels, **kw).first().asDict()


def expected_topic(ranked, judged):
    """Metrics of one topic, computed the long way."""
    n_rel = sum(r > 0 for r in judged.values())
    n_non = sum(r <= 0 for r in judged.values())
    hits = misses = 0
    ap = bpref = 0.0
    first = 0.0
    for i, p in enumerate(ranked, 1):
        if judged.get(p, 0) > 0:
            hits += 1
            ap += hits / i
            first = first or 1 / i
            cap = min(n_rel, n_non)
            bpref += 1 - min(misses, cap) / cap if cap else 1
        elif p in judged:
            misses += 1
    out = {"map": ap / n_rel, "bpref": bpref / n_rel, "recip_rank": first}
    out["Rprec"] = sum(judged.get(p, 0) > 0 for p in ranked[:n_rel]) / n_rel
    ideal = sorted((r for r in judged.values() if r > 0), reverse=True)
    for k in M.CUTOFFS:
        out[f"P@{k}"] = sum(judged.get(p, 0) > 0 for p in ranked[:k]) / k
        gain = sum(max(judged.get(p, 0), 0) / math.log2(i + 2) for i, p in enumerate(ranked[:k]))
        out[f"NDCG@{k}"] = gain / sum(r / math.log2(i + 2) for i, r in enumerate(ideal[:k]))
    return out


def test_hand_case(spark):
    run = make_run(spark, {1: [10, 11, 12, 13], 2: [20]})
    qrels = make_qrels(spark, {1: {10: 2, 11: 0, 12: 1, 99: 1}, 3: {5: 1}})
    got = panel(run, qrels)
    assert (got["num_ret"], got["num_rel"], got["num_rel_ret"], got["num_q"]) == (5, 4, 2, 2)
    # Topic 2 has no judgments: left out where the number of relevant documents divides.
    assert got["map"] == pytest.approx((1 / 1 + 2 / 3) / 3)
    assert got["gm_map"] == pytest.approx((1 / 1 + 2 / 3) / 3)
    assert got["bpref"] == pytest.approx((1 + 0) / 3)
    assert got["Rprec"] == pytest.approx(2 / 3)
    assert got["recip_rank"] == pytest.approx(0.5)
    assert got["P@5"] == pytest.approx(0.4 / 2)
    ideal = 2 + 1 / math.log2(3) + 1 / 2
    assert got["NDCG@5"] == pytest.approx((2 + 1 / 2) / ideal)
    assert panel(run, qrels, topics="qrels")["map"] == pytest.approx((1 / 1 + 2 / 3) / 3 / 2)
    assert panel(run, qrels, topics="qrels")["num_q"] == 2


def random_case(seed, topics=6, depth=40):
    rng = np.random.default_rng(seed)
    lists = {q: rng.permutation(80)[: rng.integers(1, depth)].tolist() for q in range(topics)}
    maps = {
        q: {int(p): int(rng.integers(0, 3)) for p in rng.permutation(80)[:25]} | {81: 1} for q in range(topics)
    }
    return lists, maps


@pytest.mark.parametrize("tie_order", ["rank", "docid_desc"])
def test_against_long_way(spark, tie_order):
    lists, maps = random_case(4)
    got = panel(make_run(spark, lists), make_qrels(spark, maps), tie_order=tie_order)
    by_rank = [expected_topic(lists[q], maps[q]) for q in lists]
    base = by_rank
    if tie_order == "docid_desc":
        base = [expected_topic(sorted(lists[q], reverse=True), maps[q]) for q in lists]
    for name in base[0]:
        source = by_rank if name.startswith("NDCG") else base
        assert got[name] == pytest.approx(np.mean([t[name] for t in source])), name
    assert got["gm_map"] == pytest.approx(np.exp(np.mean([math.log(max(t["map"], 1e-5)) for t in base])))
    assert got["P@1000"] == pytest.approx(got["num_rel_ret"] / (1000 * got["num_q"]))


def test_perfect_and_empty_runs(spark):
    _, maps = random_case(8)
    perfect = {q: sorted((p for p in m if m[p] > 0), key=lambda p: -m[p]) for q, m in maps.items()}
    got = panel(make_run(spark, perfect), make_qrels(spark, maps))
    for name in ("map", "bpref", "Rprec", "recip_rank", "P@5", "NDCG@10", "NDCG@1000"):
        assert got[name] == pytest.approx(1.0), name
    none = panel(make_run(spark, perfect).limit(0), make_qrels(spark, maps))
    assert none["num_q"] == 0 and none["num_ret"] == 0 and none["map"] is None
    assert none["num_rel"] == sum(r > 0 for m in maps.values() for r in m.values())


def test_metrics_reject_unknown_options(spark):
    run, qrels = make_run(spark, {1: [1]}), make_qrels(spark, {1: {1: 1}})
    with pytest.raises(ValueError):
        M.metric_panel(run, qrels, tie_order="score")
    with pytest.raises(ValueError):
        M.metric_panel(run, qrels, topics="all")


def test_long_form(spark):
    rows = M.long_form(M.metric_panel(make_run(spark, {1: [1]}), make_qrels(spark, {1: {1: 1}}))).collect()
    assert len(rows) == 4 + 5 + 18 and {r.metric: r.value for r in rows}["P@5"] == 0.2


def test_deep_group_is_cut_exactly(spark):
    df = spark.range(20000).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    got = [r.v for r in top_n_per_group(df, ["g"], [F.col("v").desc()], 1500, salts=4).collect()]
    assert sorted(got) == list(range(18500, 20000))


def test_graded_preparation(spark):
    run = make_run(spark, {1: [9, 1, 8, 2], 2: [3]})
    reference = ReferenceSet(
        spark.createDataFrame([(1, "a"), (2, "b")], "query_id int, query string"),
        make_qrels(spark, {1: {1: 1, 2: 2}, 2: {4: 1}}),
        allowed=spark.createDataFrame([(1,), (2,), (4,)], "pmid bigint"),
    )
    got = evaluate(run, reference).first()
    # Query 2 loses its only document and with it its place among the topics.
    assert got["num_ret"] == 2 and got["num_q"] == 1 and got["recip_rank"] == 1.0


def test_binary_preparation(spark):
    run = make_run(spark, {1: [9, 1, 50, 2], 7: [3]})
    reference = ReferenceSet(
        spark.createDataFrame([(1, "a")], "query_id int, query string"),
        make_qrels(spark, {1: {1: 1, 2: 1, 60: 1}}),
        max_pmid=spark.createDataFrame([(20,)], "max_pmid bigint"),
    )
    got = evaluate(run, reference).first()
    assert got["num_ret"] == 3 and got["num_rel"] == 3 and got["num_q"] == 1
    # Document 50 is cut from the run but counts among the judged: N = 2, R = 3.
    assert got["bpref"] == pytest.approx((1 - 1 / 2 + 1 - 1 / 2) / 3)


def test_shapes(spark):
    run = make_run(spark, {1: [5, 4, 6], 2: [1]})
    lists = J.run_as_lists(run)
    assert {r.query_id: r.pmids for r in lists.collect()} == {1: [5, 4, 6], 2: [1]}
    back = J.run_from_lists(lists)
    assert back.columns == ["query_id", "pmid", "rank", "score", "system"]
    assert back.select("query_id", "pmid", "rank").exceptAll(run).count() == 0
    maps = spark.sql("SELECT 1 AS query_id, map(7L, 2, 8L, 0) AS scores")
    assert sorted(map(tuple, J.qrels_from_maps(maps).collect())) == [(1, 7, 2), (1, 8, 0)]
    assert sorted(map(tuple, J.qrels_from_lists(lists).collect())) == [(1, 4, 1), (1, 5, 1), (1, 6, 1), (2, 1, 1)]
    assert J.keep_up_to(run, 4).count() == 2
