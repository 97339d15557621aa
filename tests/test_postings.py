"""The stored keyword index against the search that reads all documents."""

import glob

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.operators import keyword, postings

TEXTS = ["the cat and the dog", "The DOG", None, "", "a bird", "the the the the cat", "été à la mer", "dog " * 300]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(90)]
    return spark.createDataFrame(rows, "pmid long, text string").repartition(3)


@pytest.fixture(scope="module")
def queries(spark):
    asked = ["the cat", "dog dog", "bird été", "nothing of it", "", "the dog a"]
    return spark.createDataFrame(list(enumerate(asked)), "query_id long, query string")


def _rows(df):
    return sorted((r.query_id, r.rank, r.pmid, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("k, per_task", [(5, 20_000), (1000, 7)])
def test_stored_index_finds_what_a_scan_finds(spark, documents, queries, tmp_path, monkeypatch, k, per_task):
    monkeypatch.setattr(postings, "DOCUMENTS_PER_TASK", per_task)
    monkeypatch.setattr(postings, "DOCUMENTS_PER_FILE", 40)
    postings.write_index(documents, f"{tmp_path}/index", buckets=8)
    found = _rows(postings.search_index(spark, f"{tmp_path}/index", queries, k))
    assert found == _rows(keyword.search(documents, queries, k)) and {r[0] for r in found} == {0, 1, 2, 5}


def test_only_buckets_of_asked_words_are_read(spark, documents, tmp_path):
    """Other buckets' files can be unreadable."""
    postings.write_index(documents, f"{tmp_path}/index")
    asked = spark.createDataFrame([("bird",)], "term string").select(postings.bucket_of(F.col("term"))).first()[0]
    others = [f for f in glob.glob(f"{tmp_path}/index/*/bucket=*/*.parquet") if f"bucket={asked}/" not in f]
    for name in others:
        with open(name, "wb") as f:
            f.write(b"not parquet")
    rows, terms = postings.asked_postings(spark, f"{tmp_path}/index", ["bird"], postings.BUCKETS)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows.count() == terms.first().df == 11 and len(others) > 5
    query = spark.createDataFrame([(1, "bird")], "query_id long, query string")
    assert postings.search_index(spark, f"{tmp_path}/index", query, 100).count() == 11


def test_empty_corpus(spark, queries, tmp_path):
    postings.write_index(spark.createDataFrame([], "pmid long, text string"), f"{tmp_path}/index")
    assert postings.search_index(spark, f"{tmp_path}/index", queries, 5).count() == 0


def test_entries_come_in_steps_of_words():
    texts = [["a", "b"] * 200_000, ["a"] * 200_000, [], ["c", "a"]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts)], names=["pmid", "words"])
    parts = list(postings._entries(iter([batch])))
    assert len(parts) == 2
    found = {(r["term"], r["pmid"], r["tf"], r["length"]) for p in parts for r in p.to_pylist()}
    assert found == {
        ("a", 0, 200_000, 400_000), ("b", 0, 200_000, 400_000), ("a", 1, 200_000, 200_000), ("c", 3, 1, 2), ("a", 3, 1, 2),
        (None, 0, 400_000, 400_000), (None, 1, 200_000, 200_000), (None, 2, 0, 0), (None, 3, 2, 2),
    }


def test_scan_cuts_documents_into_words_once(spark, tmp_path):
    """Counts and scores come from one reading of the documents."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    documents = spark.createDataFrame([(i, "a " * (i + 1) + "b") for i in range(30)], "pmid long, text string")
    counted = keyword.build_index(documents).mapInArrow(seen, "pmid bigint, words array<string>")
    found = keyword.search_index(counted, spark.createDataFrame([(1, "a"), (2, "c b")], "query_id long, query string"), 3).collect()
    assert len(found) == 6 and read.value == 30
