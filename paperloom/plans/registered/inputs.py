"""The given tables in the shapes the library works on, for Spark and for SQL.

Each frame here has a common table expression of the same name and content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.knn import rank_within_query

DIM = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def title_of(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """One article per document; its date is that of the order with its number."""
    lang, source = F.col("lang"), F.col("source")
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").alias("pmid"),
        title_of(F.col("text")).alias("title"),
        F.col("text").alias("abstract"),
        F.when(lang == "en", source).alias("mesh_terms"),
        lang.alias("keywords"),
        F.when(lang == "de", F.concat(lang, F.lit("\n"), source)).alias("chemicals"),
        source.alias("authors"),
        source.alias("journal_name"),
        F.when(lang != "fr", F.col("n_chars").cast("string")).alias("volume"),
        F.when(lang != "es", lang).alias("issue"),
        F.when(lang == "en", F.concat(F.lit("1-"), F.col("n_chars").cast("string"))).alias("pagination"),
        F.substring(source, 4, 10).cast("int").alias("file_number"),
    )
    dates = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("pmid"),
        F.col("o_orderdate").cast("date").alias("publication_date"),
        F.year("o_orderdate").alias("year"),
    )
    return documents.join(dates, "pmid", "left")


ARTICLES = """articles AS (
  SELECT d.doc_id AS pmid, split_part(d.text, chr(10), 1) AS title, d.text AS abstract,
    CASE WHEN lang = 'en' THEN source END AS mesh_terms, lang AS keywords,
    CASE WHEN lang = 'de' THEN lang || chr(10) || source END AS chemicals,
    source AS authors, source AS journal_name,
    CASE WHEN lang <> 'fr' THEN CAST(n_chars AS VARCHAR) END AS volume,
    CASE WHEN lang <> 'es' THEN lang END AS issue,
    CASE WHEN lang = 'en' THEN '1-' || CAST(n_chars AS VARCHAR) END AS pagination,
    CAST(substr(source, 4) AS INTEGER) AS file_number,
    CAST(o.o_orderdate AS DATE) AS publication_date, CAST(year(o.o_orderdate) AS INTEGER) AS year
  FROM documents d LEFT JOIN orders o ON o.o_orderkey = d.doc_id)"""


def other_ids(articles: DataFrame, lang: str) -> DataFrame:
    """All articles; those of one language have ids that no vector and no record has."""
    return articles.withColumn("pmid", F.when(F.col("keywords") == lang, -1 - F.col("pmid")).otherwise(F.col("pmid")))


OTHER_IDS = "CASE WHEN keywords = '{}' THEN -1 - pmid ELSE pmid END"


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("pmid"), "embedding")


VECTORS = "vectors AS (SELECT vec_id AS pmid, embedding FROM embeddings)"


def mean_vector(spark: SparkSession, folder: str) -> list[float]:
    """Mean of all vectors, the query of the single-query searches."""
    component = lambda i: F.col("embedding")[i].cast("double")
    return list(table(spark, folder, "embeddings").agg(*[F.avg(component(i)) for i in range(DIM)]).first())


MEAN_VECTOR = """mean_vector AS (
  SELECT list(m ORDER BY i) AS q FROM (
    SELECT i, avg(CAST(x AS DOUBLE)) AS m
    FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY i))"""

# Distance as both engines rank by it: rounded, so that ties fall to the smaller id.
DISTANCE = "abs(round(list_cosine_distance(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])), 12))"


def text_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


TEXT_QUERIES = "text_queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("pmid"), "text")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number in their properties as ``k``."""
    k = F.regexp_extract("props", r'"k": ([0-9]+)', 1).cast("bigint")
    return table(spark, folder, "events").withColumn("k", k)


EVENTS_K = """events_k AS (
  SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k FROM events)"""


def scored_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Users as queries and ``k`` as documents, scored by what the events add up to."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    return events(spark, folder).groupBy(F.col("user_id").alias("query_id"), F.col("k").alias("pmid")).agg(
        F.sum(cents).alias("score")
    )


SCORED_PAIRS = """scored_pairs AS (
  SELECT user_id AS query_id, k AS pmid, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS score
  FROM events_k GROUP BY ALL)"""


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked run of every scored pair."""
    ranked = rank_within_query(scored_pairs(spark, folder), F.col("score"))
    return ranked.select("query_id", "pmid", F.col("rank").cast("int").alias("rank"))


RUN = """run AS (
  SELECT query_id, pmid, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pmid) - 1 AS INTEGER) AS rank
  FROM scored_pairs)"""


def qrels(spark: SparkSession, folder: str) -> DataFrame:
    """Graded judgments: the best event of a pair counts."""
    grade = F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "click", 1).otherwise(0)
    return events(spark, folder).groupBy(F.col("user_id").alias("query_id"), F.col("k").alias("pmid")).agg(
        F.max(grade).alias("rel")
    )


QRELS = """qrels AS (
  SELECT user_id AS query_id, k AS pmid,
    max(CASE event_type WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 ELSE 0 END) AS rel
  FROM events_k GROUP BY ALL)"""

RUN_AND_QRELS = [EVENTS_K, SCORED_PAIRS, RUN, QRELS]


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a change feed: one file per day, errors delete."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("pmid"),
        F.date_format("ts", "yyyyMMdd").alias("file_name"),
        (F.col("event_type") == "error").cast("int").alias("is_delete"),
        F.col("event_id").alias("pos"),
        "value",
    )


CHANGES = """changes AS (
  SELECT user_id AS pmid, strftime(ts, '%Y%m%d') AS file_name,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_delete, event_id AS pos, value
  FROM events)"""


def corpus_text(spark: SparkSession, folder: str) -> DataFrame:
    """Corpus lines as benchmarks publish them: some without an id, some without an article id."""
    lang, doc_id = F.col("lang"), F.col("doc_id").cast("string")
    line = F.concat(
        F.when(lang == "es", F.lit("{")).otherwise(F.concat(F.lit('{"_id": "d'), doc_id, F.lit('", '))),
        F.lit('"title": "'),
        title_of(F.col("text")),
        F.lit('", "metadata": {'),
        F.when(lang == "en", F.lit("}")).otherwise(
            F.concat(F.lit('"pubmed_id": "'), doc_id, F.lit('"}'))
        ),
        F.lit("}"),
    )
    return table(spark, folder, "documents").select(line.alias("value"), F.col("doc_id").alias("line_no"))


CORPUS = """corpus AS (
  SELECT 'd' || doc_id AS doc_id, regexp_extract('"' || split_part(text, chr(10), 1) || '",', '"(.*?)",', 1) AS title,
    CASE WHEN lang <> 'en' THEN doc_id END AS article_id, doc_id AS line_no
  FROM documents WHERE lang <> 'es')"""
