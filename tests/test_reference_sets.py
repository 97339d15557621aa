import json

import pytest
from pyspark.sql import functions as F

from paperloom.functions.text import DOCUMENT_URL_PREFIX
from paperloom.operators.numbering import batch_ranges, batch_totals, row_numbers, surrogate_ids
from paperloom.operators.skew import salted_join
from paperloom.plans import reference_sets as R
from paperloom.sources import reference_files as files, runs


@pytest.fixture
def graded(spark, tmp_path):
    (tmp_path / "queries.jsonl").write_text(
        '{"_id": "q1", "text": "first one", "metadata": {}}\n'
        'not a query\n'
        '{"_id": "q2", "text": "second, with comma", "metadata": {}}\n', encoding="utf-8")
    (tmp_path / "test.tsv").write_text(
        "query-id\tcorpus-id\tscore\nq1\ta\t2\nq1\tb\t1\nq1\tc\t0\nq1\td\t2\nq2\te\t1\nqx\ta\t1\nq2\tzz\t1\n")
    (tmp_path / "corpus.jsonl").write_text(
        '{"_id": "a", "title": "With id", "metadata": {"pubmed_id": "11"}}\n'
        '{"_id": "b", "title": "Same id", "metadata": {"pubmed_id": "11"}}\n'
        '{"_id": "c", "title": "Two articles", "text": "bad "quotes"", "metadata": {}}\n'
        '{"_id": "d", "title": "Nowhere", "metadata": {}}\n'
        '{"_id": "e", "title": "One article", "metadata": {}}\n'
        '{"broken": true}\n', encoding="utf-8")
    articles = spark.createDataFrame(
        [(11, "With id"), (22, "Two articles"), (21, "Two articles"), (31, "One article"), (41, None)],
        "pmid bigint, title string")
    return tmp_path, articles


def test_graded_set(spark, graded, tmp_path):
    folder, articles = graded
    queries = files.read_queries(spark, f"{folder}/queries.jsonl")
    documents = files.read_corpus(spark, f"{folder}/corpus.jsonl")
    judgments = files.read_judgments(spark, f"{folder}/test.tsv")
    assert {(r.doc_id, r.article_id) for r in documents.collect()} == {
        ("a", 11), ("b", 11), ("c", None), ("d", None), ("e", None)}
    assert sorted(r.doc_id for r in R.missing_article_id(documents).collect()) == ["c", "d", "e"]
    reference = R.build_graded(queries, judgments, documents, articles)
    reference.save(str(tmp_path / "saved"))
    loaded = R.ReferenceSet.load(spark, str(tmp_path / "saved"))
    assert sorted(map(tuple, loaded.queries.collect())) == [(0, "first one"), (1, "second, with comma")]
    # Documents a and b share an article: the later judgment counts.
    assert sorted(map(tuple, loaded.qrels.collect())) == [(0, 11, 1), (0, 21, 0), (1, 31, 1)]
    assert sorted(r.pmid for r in loaded.allowed.collect()) == [11, 21, 31]
    assert loaded.max_pmid is None and loaded.sample is None


def test_binary_set(spark, tmp_path):
    questions = [
        {"id": "55f", "body": "Is it?", "documents": [DOCUMENT_URL_PREFIX + "5", DOCUMENT_URL_PREFIX + "6"], "type": "x"},
        {"id": "55a", "body": "Why?", "documents": [DOCUMENT_URL_PREFIX + "7"]},
        {"id": "99z", "body": "No documents", "documents": []},
    ]
    (tmp_path / "q.json").write_text(json.dumps({"questions": questions}, indent=1))
    articles = spark.createDataFrame([(5, 1219), (6, 1219), (70, 1220), (8, None)], "pmid bigint, file_number int")
    reference = R.build_binary(files.read_questions(spark, f"{tmp_path}/q.json"), articles, sample_size=2)
    assert sorted(map(tuple, reference.queries.collect())) == [(0, "Is it?"), (1, "Why?"), (2, "No documents")]
    assert sorted(map(tuple, reference.qrels.collect())) == [(0, 5, 1), (0, 6, 1), (1, 7, 1)]
    assert reference.max_pmid.first().max_pmid == 6
    sample = sorted(r.query_id for r in reference.sample.collect())
    assert len(sample) == 2 and sample == sorted(r.query_id for r in reference.sample.collect())
    part = reference.sampled()
    assert sorted(r.query_id for r in part.queries.collect()) == sample
    assert {r.query_id for r in part.qrels.collect()} <= set(sample)


def test_id_map_merge(spark):
    explicit = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "doc_id string, pmid bigint")
    override = spark.createDataFrame([("b", 20), ("d", 4)], "doc_id string, pmid bigint")
    assert sorted(map(tuple, R.merge_id_maps(explicit, override).collect())) == [("a", 1), ("b", 20), ("d", 4)]


def test_hot_title(spark):
    documents = spark.range(2000).select(
        F.concat(F.lit("d"), "id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("title"))
    articles = spark.range(3000).select(
        F.col("id").alias("pmid"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("title"))
    matches = R.title_matches(documents, articles)
    hot = documents.filter("title = 'hot'").count()
    cold = [i for i in range(2000) if i % 3 == 2 and i % 2 == 1]
    assert matches.count() == hot + len(cold)
    assert matches.filter("pmid = 0").count() == hot


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    facts = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    keys_only = facts.select("k")
    lookup = spark.range(2, 20).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    for left in (facts, keys_only):
        expected = sorted(map(tuple, left.join(lookup, ["k"], how).collect()), key=str)
        assert sorted(map(tuple, salted_join(left, lookup, ["k"], how).collect()), key=str) == expected
    with pytest.raises(ValueError):
        salted_join(facts, lookup, ["k"], "full")


def test_numbering(spark):
    df = spark.range(0, 5000, 3).select(((F.col("id") * 7919) % 5003).alias("pmid")).repartition(7)
    order = sorted(r.pmid for r in df.collect())
    got = {r.pmid: r.row_number for r in row_numbers(df, "pmid", ranges=9).collect()}
    assert got == {p: i + 1 for i, p in enumerate(order)}
    down = {r.pmid: r.row_number for r in row_numbers(df, "pmid", descending=True, ranges=5).collect()}
    assert down == {p: len(order) - i for i, p in enumerate(order)}
    batches = batch_totals(batch_ranges(df, "pmid", 100)).orderBy("batch").collect()
    assert [b.first_row for b in batches][:3] == [1, 101, 201]
    assert batches[-1].last_row == batches[-1].running_total == len(order)
    assert sum(b.n_rows for b in batches) == len(order)
    few = surrogate_ids(spark.createDataFrame([("b", 90), ("a", 5)], "q string, line_no bigint"), "line_no")
    assert {r.q: r.query_int for r in few.collect()} == {"a": 0, "b": 1}
    assert row_numbers(df.limit(0), "pmid").count() == 0


def test_result_files_and_stored_runs(spark, tmp_path):
    cache = tmp_path / "cache"
    cache.mkdir()
    (cache / "PubResults_query3.txt").write_text("12\n5\n9")
    (cache / "PubResults_query4.txt").write_text("")
    (cache / "PubQuery_query3.txt").write_text("a OR b")
    cached = runs.read_result_files(spark, str(cache))
    assert {r.query_id: r.pmids for r in cached.collect()} == {3: [12, 5, 9], 4: []}

    def run(system, pmid):
        return spark.createDataFrame([(1, pmid, 0, 0.0, system)], "query_id int, pmid bigint, rank int, score double, system string")

    folder = str(tmp_path / "runs")
    assert runs.read_run(spark, folder, "x").count() == 0
    runs.save_run(run("x", 1), folder)
    runs.save_run(run("y", 2), folder)
    runs.save_run(run("x", 3), folder)
    assert [r.pmid for r in runs.read_run(spark, folder, "x").collect()] == [3]
    assert [r.pmid for r in runs.read_run(spark, folder, "y").collect()] == [2]
