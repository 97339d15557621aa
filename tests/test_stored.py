"""Tables, files and indexes that queries write and read: what is read, what is found."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_DIR
from paperloom.operators import hyperplanes, ivf, knn
from paperloom.plans.registered import inputs as I
from paperloom.plans.registered import stored_queries as Q
from paperloom.sources import change_files, tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hyperplanes_find_most_neighbours(spark):
    exact = knn.nearest(I.vectors(spark, SF_DIR), Q._asking(spark, SF_DIR), Q.K)
    assert ivf.recall(Q.knn_hyperplanes(spark, SF_DIR), exact).first().recall >= 0.9


def test_hyperplane_search_filters_buckets(spark, tmp_path):
    hyperplanes.write_index(I.vectors(spark, SF_DIR), str(tmp_path / "index"), 2, 4)
    one = Q._asking(spark, SF_DIR).limit(1)
    plan = plan_of(hyperplanes.search(spark, str(tmp_path / "index"), one, 3))
    assert "PushedFilters: [IsNotNull(cell), In(cell" in plan or "PushedFilters: [In(cell" in plan


def test_hyperplanes_null_zero_repeated_and_empty(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "pmid bigint, embedding array<float>")
    queries = spark.createDataFrame([(7, [2.0, 0.0])], "query_id bigint, embedding array<double>")
    path = str(tmp_path / "few")
    hyperplanes.write_index(vectors, path, 3, 2)
    found = [(r.pmid, r.distance) for r in hyperplanes.search(spark, path, queries, 2).orderBy("rank").collect()]
    assert found == [(1, 0.0), (2, 0.0)]
    assert hyperplanes.search(spark, path, queries.limit(0), 2).count() == 0
    hyperplanes.write_index(vectors.limit(0), path, 3, 2)
    assert hyperplanes.search(spark, path, queries, 2).count() == 0


def test_cells_repeat_signs():
    rows = np.random.default_rng(1).normal(size=(20, 8))
    cells = hyperplanes.cells_of(rows, 3, 4)
    directions = hyperplanes.directions(3, 4, 8).reshape(3, 4, 8)
    for row, own in zip(rows, cells):
        assert own.tolist() == [t * 16 + sum(1 << b for b in range(4) if row @ directions[t, b] > 0) for t in range(3)]
    probes = hyperplanes.probed_cells(cells, 4)
    assert all(len(set(p)) == 15 and all(bin(x % 16 ^ o % 16).count("1") <= 1 for x, o in zip(p, np.repeat(c, 5))) for p, c in zip(probes, cells))


def test_bucketed_tables_join_without_exchange(spark):
    joined = Q.colocated_join(spark, SF_DIR)
    assert joined.count() > 0
    assert "Exchange" not in plan_of(joined)


def test_date_range_reads_some_files(spark, tmp_path):
    path = str(tmp_path / "by-date")
    articles = I.articles(spark, SF_DIR).filter("publication_date is not null")
    tables.write_by_date(articles, path, files=8)
    stored = spark.read.parquet(path)
    asked = tables.date_range(stored, "1995-03-01", "1996-12-31")
    read = asked.select(F.input_file_name().alias("f")).distinct().count()
    assert 0 < read < stored.select(F.input_file_name().alias("f")).distinct().count()
    assert "GreaterThanOrEqual(publication_date" in plan_of(asked)


def test_change_files_keep_names_and_order(spark, tmp_path):
    rows = [("b.xml.gz", 2, "<PubmedArticle>2</PubmedArticle>"), ("b.xml.gz", 1, "<x>\n<PubmedArticle>1</PubmedArticle>\n"), ("a.xml.gz", 5, "<PubmedArticle>3</PubmedArticle>")]
    change_files.write_change_files(spark.createDataFrame(rows, "file_name string, place bigint, text string"), str(tmp_path / "out"))
    assert [r.file_name for r in change_files.list_change_files(spark, str(tmp_path / "out")).collect()] == ["a.xml.gz", "b.xml.gz"]
    chunks = change_files.read_chunks(spark, str(tmp_path / "out")).filter("chunk like '%Article>_%'").orderBy("file_name", "pos")
    assert [r.chunk.strip()[-1] for r in chunks.collect()] == ["3", "1", "2"]
