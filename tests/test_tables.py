import hashlib
import sys

import pyarrow as pa
from paperloom.operators import keyword
import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from paperloom import embedding as E
from paperloom.plans.corpus import embed_pending, update_articles
from paperloom.functions import vectors as V
from paperloom.operators import quality
from paperloom.sources import tables, vector_tables as VT
from paperloom.streaming.embedding_stream import embed_article_stream, stored_vectors

import citations as c


# The model below travels with the job, as a caller's would.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LengthModel:
    """Embeds a text as its length, its number of words and the prompt."""

    def encode(self, texts, batch_size, prompt_name):
        assert batch_size == 32
        return np.array([[len(t), len(t.split()), len(prompt_name or "")] for t in texts], dtype=float)


def vectors(spark, ids, dim=3):
    return spark.createDataFrame(
        [(i, [float(i + j) / 7 for j in range(dim)]) for i in ids], "pmid bigint, embedding array<float>"
    )


def test_append_vectors(spark, tmp_path):
    folder = str(tmp_path / "v")
    assert VT.append_vectors(vectors(spark, [1, 2]), folder, 3) == 2
    assert VT.append_vectors(vectors(spark, [3]), folder, 3) == 3
    with pytest.raises(ValueError, match="half precision"):
        VT.append_vectors(vectors(spark, [9]), folder, 3, "half")
    for bad, message in [
        (vectors(spark, [3, 4]), "duplicate"), (vectors(spark, [5, 5]), "duplicate"), (vectors(spark, [6], 2), "dimensions"),
    ]:
        with pytest.raises(ValueError, match=message):
            VT.append_vectors(bad, folder, 3)
    with pytest.raises(ValueError, match="precision"):
        VT.append_vectors(vectors(spark, [9]), folder, 3, "quarter")
    with pytest.raises(Exception):
        VT.prepare_vectors(vectors(spark, [2**31]), 3).collect()
    assert spark.read.parquet(folder).count() == 3


def test_half_precision_tables(spark, tmp_path):
    """Two bytes a component on disk, the nearest binary16 number when read."""
    full, half = str(tmp_path / "full"), str(tmp_path / "half")
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=256) * 10.0 ** rng.integers(-9, 4)]) for i in range(400)]
    rows += [(400, [65504.0, -65504.0, 6e-8, 2e-8, -0.0, float("nan")] + [0.0] * 250)]
    frame = spark.createDataFrame(rows, "pmid long, embedding array<float>").coalesce(1)
    assert VT.append_vectors(frame, half, 256, "half") == VT.append_vectors(frame, full, 256) == 401
    sizes = [sum(f.stat().st_size for f in (tmp_path / x).glob("*.parquet")) for x in ("half", "full")]
    assert sizes[0] < 0.6 * sizes[1]
    back = {r.pmid: r.embedding for r in VT.read_vectors(spark, half).collect()}
    for i, x in rows:
        assert np.array_equal(np.float32(back[i]), np.float16(np.float32(x)).astype(np.float32), equal_nan=True)
    assert VT.read_vectors(spark, full).schema["embedding"].dataType.simpleString() == "array<float>"
    with pytest.raises(Exception, match="half-precision"):
        VT.append_vectors(vectors(spark, [10**6]), half, 3, "half")
    pair = spark.createDataFrame([(1, None), (2, []), (3, [1.5, 2.0])], "pmid long, embedding array<float>")
    packed = pair.withColumn("p", V.pack_half("embedding")).withColumn("u", V.unpack_half("p"))
    assert {r.pmid: (r.p, r.u) for r in packed.collect()} == {1: (None, None), 2: (b"", []), 3: (b"\x00>\x00@", [1.5, 2.0])}


def test_wide_files(spark, tmp_path):
    folder = str(tmp_path / "wide")
    df = vectors(spark, range(25), 11).withColumn("pub_date", F.lit(700000))
    VT.write_wide(df.coalesce(1), folder, 11, rows_per_file=10)
    assert len(list((tmp_path / "wide").glob("*.parquet"))) == 3
    back = VT.read_wide(spark, folder)
    assert sorted(map(tuple, back.select("pmid", F.col("embedding").cast("string")).collect())) == sorted(
        map(tuple, df.select("pmid", F.col("embedding").cast("string")).collect())
    )


def test_partitioned_copy(spark, tmp_path):
    df = vectors(spark, range(40))
    VT.write_partitioned(df, str(tmp_path / "p"))
    copy = spark.read.parquet(str(tmp_path / "p"))
    assert copy.drop("part").exceptAll(df).count() == 0 and copy.count() == 40
    assert {r.part: r.n_rows for r in VT.partition_counts(df).collect()} == {i: 5 for i in range(8)}


def test_copy_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS src")
    vectors(spark, [1, 2]).write.mode("overwrite").saveAsTable("src.v")
    spark.range(3).write.mode("overwrite").saveAsTable("src.ids")
    assert tables.copy_database(spark, "src", "dst") == ["ids", "v"]
    assert tables.copy_database(spark, "src", "dst") == ["ids", "v"]
    assert spark.table("dst.v").count() == 2
    tables.refresh_statistics(spark, "dst.ids")
    assert "3 rows" in spark.sql("DESCRIBE EXTENDED dst.ids").filter("col_name = 'Statistics'").first().data_type
    assert {r.column_name: r.source_type for r in tables.declared_types(spark, "dst.ids").collect()} == {"id": "bigint"}
    tables.register_temporary(spark.range(2), "two")
    assert spark.table("two").count() == 2
    assert tables.jdbc_read_options("u", "t", "pmid", 0, 9, 4)["numPartitions"] == "4"
    assert tables.jdbc_write_options("u", "t")["batchsize"] == "100000"


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "articles")
    rows = spark.range(100).select(
        F.col("id").alias("pmid"), F.lit("t").alias("title"), F.lit("a").alias("abstract"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("publication_date"),
        (F.col("id") % 5).cast("int").alias("file_number"),
    )
    tables.write_by_date(rows, path, files=4)
    articles = spark.read.parquet(path)
    found = tables.date_range(articles, "2000-01-05", "2000-01-09").select("pmid")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 5 and "GreaterThanOrEqual(publication_date" in plan and "title" not in plan
    top = tables.max_id_as_of(articles, 1)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert top.first().max_pmid == 96 and "LessThanOrEqual(file_number,1)" in plan
    assert tables.point_lookup(articles, 22).count() == 1


def test_quality_checks(spark):
    v = spark.createDataFrame(
        [(1, [1.0, 2.0]), (1, [1.0]), (2, None), (3, [0.0, 0.0])], "pmid bigint, embedding array<float>"
    )
    assert [tuple(r) for r in quality.duplicate_keys(v).collect()] == [(1, 2)]
    assert sorted((r.pmid, r.n_dims) for r in quality.dimension_violations(v, 2).collect()) == [(1, 1), (2, None)]
    articles = spark.createDataFrame([(1, "a", None), (3, "b", "x")], "pmid bigint, title string, issue string")
    assert [r.pmid for r in quality.orphan_vectors(v, articles).collect()] == [2]
    expected = spark.createDataFrame(
        [(1, "a", None), (3, "B", None), (4, "c", None)], "pmid bigint, title string, issue string"
    )
    got = {r.pmid: (r.found, r.differing) for r in quality.record_differences(articles, expected).collect()}
    assert got == {1: (True, ""), 3: (True, "title,issue"), 4: (False, None)}


def test_embedder_contract(spark):
    texts = spark.createDataFrame([(1, "two words"), (2, None)], "pmid bigint, text string")
    got = {r.pmid: r.embedding for r in E.embed_texts(texts, LengthModel).collect()}
    assert got == {1: [9.0, 2.0, 0.0], 2: [0.0, 0.0, 0.0]}
    queries = spark.createDataFrame([("q", "abc")], "query_id string, query string")
    assert E.embed_queries(queries, LengthModel).first().embedding == [3.0, 1.0, 5.0]


def test_hashed_embedding(spark):
    texts = spark.createDataFrame(
        [(1, "Alpha beta alpha"), (2, ""), (3, None), (4, "beta ALPHA, alpha!")], "pmid bigint, text string"
    )
    got = {r.pmid: r.embedding for r in E.hashed_embedding(texts, dim=16).collect()}
    expected = np.zeros(16)
    for word in "alpha beta alpha".split():
        expected[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 16] += 1
    assert np.allclose(got[1], expected / np.linalg.norm(expected), atol=1e-7)
    assert got[4] == got[1] and got[2] == got[3] == [0.0] * 16
    plan = E.hashed_embedding(spark.range(9).select(F.col("id").alias("pmid"), F.lit("a").alias("text")))
    assert "hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()


def test_corpus_and_pending(spark, tmp_path, write_gz):
    folder = tmp_path / "xml"
    folder.mkdir()
    write_gz(folder / "mn0001.xml.gz", c.citation_set(c.article(1, title="one"), c.article(2, title="two")))
    assert update_articles(spark, str(folder), str(tmp_path / "store")) == 2
    from paperloom.operators.changelog import ArticleStore

    store = ArticleStore(spark, str(tmp_path / "store"))
    none = spark.createDataFrame([], "pmid bigint, text_hash string")
    embed = lambda df: E.embed_texts(df, LengthModel, carry=("text_hash", "pub_date"))
    first = embed_pending(store.articles(), none, embed)
    done = spark.createDataFrame(first.select("pmid", "text_hash").collect(), none.schema)
    assert sorted(r.pmid for r in first.collect()) == [1, 2]
    write_gz(folder / "mn0002.xml.gz", c.citation_set(c.article(2, title="changed"), c.article(3, title="new")))
    assert update_articles(spark, str(folder), str(tmp_path / "store")) == 3
    assert sorted(r.pmid for r in embed_pending(store.articles(), done, embed).collect()) == [2, 3]


def test_embedding_stream(spark, tmp_path):
    source, out = str(tmp_path / "texts"), str(tmp_path / "vectors")

    def publish(rows):
        spark.createDataFrame(rows, "pmid bigint, text string").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema("pmid bigint, text string").parquet(source)
        embed_article_stream(
            stream, lambda df: E.embed_texts(df, LengthModel, carry=("text_hash",)), out, str(tmp_path / "ckpt")
        ).awaitTermination()

    publish([(1, "a"), (2, "bb")])
    run()
    publish([(1, "a"), (2, "changed"), (3, "ccc")])
    run()
    got = {r.pmid: (r.embedding[0], r.batch) for r in stored_vectors(spark, out).collect()}
    assert got == {1: (1.0, 0), 2: (7.0, 1), 3: (3.0, 1)}


def test_copy_in_chunks_goes_on_where_it_stopped(spark, tmp_path):
    rows = [(i, f"t{i}") for i in [-3, 0, 1, 9, 10, 25, 25, None]]
    source, folder = spark.createDataFrame(rows, "pmid bigint, title string"), str(tmp_path / "copy")
    want = [(-1, 1, 1), (0, 3, 4), (1, 1, 5), (2, 2, 7), (None, 1, 8)]
    assert [tuple(r) for r in tables.copy_in_chunks(source, folder, "pmid", 10).collect()] == want
    assert sorted(map(str, tables.read_chunks(spark, folder).collect())) == sorted(map(str, source.collect()))
    # One chunk's job was lost before its count was written, another chunk is done and stays as it is.
    (tmp_path / "copy" / "done" / "1").unlink()
    changed = source.selectExpr("pmid", "'new' AS title")
    assert [tuple(r) for r in tables.copy_in_chunks(changed, folder, "pmid", 10).collect()] == want
    assert [r.pmid for r in tables.read_chunks(spark, folder).filter("title = 'new'").collect()] == [10]
    assert tables.copy_in_chunks(source.limit(0), str(tmp_path / "none"), "pmid", 10).count() == 0


def test_hashed_embedding_takes_words_in_steps():
    texts = [["a", "b"] * 150_000, [], ["c"] * 600_000, ["a", "c"], ["b"] * 400_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array([["z"], *texts])], names=["pmid", "_words"]).slice(1)
    parts = list(keyword.word_slices(batch, "_words"))
    assert [p.column("pmid").to_pylist() for p in parts] == [[1, 2], [3], [4, 5]]
    whole = E._hashed_units(batch.column("_words"), 16, {})
    assert np.array_equal(whole, np.concatenate([E._hashed_units(p.column("_words"), 16, {}) for p in parts]))
    assert list(keyword.word_slices(batch.slice(0, 0), "_words")) == []
