"""Registered queries over vectors and searches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paperloom import embedding
from paperloom.functions import vectors as V
from paperloom.functions.text import author_line, citation, distance_line
from paperloom.operators import ivf, knn, postings, quality
from paperloom.plans import search
from paperloom.plans.registered import inputs as I
from paperloom.session import shared_dir
from paperloom.sources import vector_tables

QUERIES = {}
SQL = {}
K = 10
CELLS = 8
PROBED = 3


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def hashed_cte(name: str, source: str, key: str) -> str:
    """Common table expressions of the hashed embedding of ``source(key, text)``."""
    return f"""{name}_words AS (
  SELECT {key}, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS token FROM {source}),
{name}_counts AS (
  SELECT {key}, CAST(CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % {I.DIM} AS INTEGER) AS bucket, count(*) AS n
  FROM {name}_words WHERE token <> '' GROUP BY ALL),
{name}_norms AS (SELECT {key}, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM {name}_counts GROUP BY ALL),
{name}_long AS (
  SELECT s.{key}, CAST(b.bucket AS INTEGER) AS bucket,
    CAST(CASE WHEN norm > 0 THEN coalesce(n, 0) / norm ELSE 0 END AS FLOAT) AS x
  FROM {source} s CROSS JOIN (SELECT unnest(range({I.DIM})) AS bucket) b
  LEFT JOIN {name}_counts c ON c.{key} = s.{key} AND c.bucket = b.bucket
  LEFT JOIN {name}_norms m ON m.{key} = s.{key}),
{name} AS (SELECT {key}, list(x ORDER BY bucket) AS embedding FROM {name}_long GROUP BY {key})"""


ARTICLE_TEXTS = "article_texts AS (SELECT doc_id AS pmid, text FROM documents)"
QUERY_TEXTS = "query_texts AS (SELECT item_id AS query_id, text FROM benchmark)"
HASHED_ARTICLES = hashed_cte("article_vectors", "article_texts", "pmid")
HASHED_QUERIES = hashed_cte("query_vectors", "query_texts", "query_id")


def embed_text_queries(queries):
    return embedding.hashed_embedding(queries, "query_id", "query", I.DIM)


# Cells around the mean vector of each label; a query looks into the ones nearest to it.
CELLS_AND_PROBES = f"""centres AS (
  SELECT label AS cell, list(m ORDER BY i) AS centre FROM (
    SELECT label, i, avg(CAST(x AS DOUBLE)) AS m
    FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL)
  GROUP BY label),
cells AS (
  SELECT vec_id, embedding, cell FROM embeddings CROSS JOIN centres QUALIFY row_number() OVER (
    PARTITION BY vec_id ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre) DESC, cell) = 1),
probes AS (
  SELECT query_id, embedding, cell FROM query_vectors CROSS JOIN centres QUALIFY row_number() OVER (
    PARTITION BY query_id ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre) DESC, cell) <= {PROBED})"""


def neighbours_sql(pairs: str, *ctes: str) -> str:
    return I.with_ctes(QUERY_TEXTS, HASHED_QUERIES, *ctes) + f"""SELECT
  query_id, pmid, CAST(rank AS INTEGER) AS rank, abs(round(distance, 6)) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, pmid) - 1 AS rank FROM (
    SELECT q.query_id, v.vec_id AS pmid, {I.DISTANCE.format(a='q.embedding', b='v.embedding')} AS distance
    FROM {pairs})) WHERE rank < {K}"""


NEIGHBOURS = neighbours_sql("query_vectors q CROSS JOIN embeddings v")


def _queries(spark, folder):
    """The benchmark texts ask for their neighbours."""
    return embed_text_queries(I.text_queries(spark, folder))


def _rounded(df):
    return df.withColumn("distance", F.round("distance", 6))


@register(
    I.with_ctes(I.VECTORS, I.ARTICLES, I.MEAN_VECTOR)
    + f"""SELECT round(distance, 6) AS distance, pmid, title, authors, journal_name, year, volume, issue, pagination,
  CAST(row_number() OVER (ORDER BY distance, pmid) - 1 AS INTEGER) AS rank
FROM (SELECT {I.DISTANCE.format(a='v.embedding', b='q')} AS distance, v.pmid, a.* EXCLUDE (pmid)
  FROM vectors v JOIN articles a ON v.pmid = {I.OTHER_IDS.format('en').replace('pmid', 'a.pmid')} CROSS JOIN mean_vector)
ORDER BY distance, pmid LIMIT 25"""
)
def search_with_metadata(spark, folder):
    articles = I.other_ids(I.articles(spark, folder), "en")
    return _rounded(search.search_with_metadata(I.vectors(spark, folder), articles, I.mean_vector(spark, folder)))


@register(NEIGHBOURS)
def knn_exact_batch(spark, folder):
    return _rounded(knn.nearest(I.vectors(spark, folder), _queries(spark, folder), K))


@register(NEIGHBOURS)
def knn_exact_pruned(spark, folder):
    return _rounded(
        knn.nearest(I.vectors(spark, folder), _queries(spark, folder), K, prune_fraction=0.2)
    )


@register(
    I.with_ctes(I.VECTORS, I.MEAN_VECTOR)
    + f"""SELECT pmid, CAST(row_number() OVER (ORDER BY distance, pmid) - 1 AS INTEGER) AS rank,
  round(distance, 6) AS distance
FROM (SELECT pmid, {I.DISTANCE.format(a='embedding', b='q')} AS distance FROM vectors CROSS JOIN mean_vector)
ORDER BY distance, pmid LIMIT 5"""
)
def knn_single(spark, folder):
    return _rounded(knn.nearest_to_vector(I.vectors(spark, folder), I.mean_vector(spark, folder), 5))


def _index(spark, folder):
    vectors = I.vectors(spark, folder)
    centroids = ivf.train_centroids(vectors, CELLS)
    return ivf.assign_cells(vectors, centroids), centroids


@register(NEIGHBOURS)
def knn_ivf_full_probe(spark, folder):
    cells, centroids = _index(spark, folder)
    return _rounded(ivf.search(cells, centroids, _queries(spark, folder), K, n_probe=CELLS))


@register(neighbours_sql("probes q JOIN cells v USING (cell)", CELLS_AND_PROBES))
def knn_ivf(spark, folder):
    labelled = I.table(spark, folder, "embeddings").select(F.col("vec_id").alias("pmid"), "embedding", "label")
    centroids = ivf.group_centroids(labelled, "label", I.DIM)
    cells = ivf.assign_cells(labelled, centroids)
    return _rounded(ivf.search(cells, centroids, _queries(spark, folder), K, n_probe=PROBED))


@register(
    I.with_ctes(I.MEAN_VECTOR)
    + f"""SELECT vec_id AS pmid, round({I.DISTANCE.format(a='embedding', b='q')}, 6) AS distance
FROM embeddings CROSS JOIN mean_vector"""
)
def cosine_distance(spark, folder):
    query = F.array(*[F.lit(x) for x in I.mean_vector(spark, folder)])
    distance = F.round(F.round(V.cosine_distance(F.col("embedding"), query), 12), 6)
    return I.vectors(spark, folder).select("pmid", distance.alias("distance"))


@register(
    """SELECT vec_id AS pmid, i - 1 AS i, CAST(CASE WHEN x = 0 THEN x
    ELSE round_even(x / pow(2, greatest(floor(log2(abs(x))), -14) - 10), 0)
      * pow(2, greatest(floor(log2(abs(x))), -14) - 10) END AS DOUBLE) AS half
FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)"""
)
def half_precision(spark, folder):
    """Through a table that stores two bytes a component."""
    path = f"{shared_dir(spark).rstrip('/')}/half-vectors-{uuid.uuid4().hex}"
    vector_tables.append_vectors(I.vectors(spark, folder), path, I.DIM, "half")
    stored = vector_tables.read_vectors(spark, path)
    halves = stored.select(F.col("pmid").cast("bigint").alias("pmid"), F.posexplode("embedding").alias("i", "x"))
    return halves.select("pmid", F.col("i").cast("bigint").alias("i"), F.col("x").cast("double").alias("half"))


@register(
    """SELECT vec_id AS pmid, i - 1 AS i, CAST(x AS DOUBLE) AS x
FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)"""
)
def vector_literal(spark, folder):
    text = V.vector_to_literal(F.col("embedding"))
    parsed = I.vectors(spark, folder).select("pmid", text.alias("text")).select(
        "pmid", F.posexplode(V.literal_to_vector(F.col("text"))).alias("i", "x")
    )
    return parsed.select("pmid", F.col("i").cast("bigint").alias("i"), F.col("x").cast("double").alias("x"))


@register(
    """SELECT vec_id AS pmid, CAST(len(embedding) AS INTEGER) AS n_dims,
  round(sqrt(list_sum([CAST(x AS DOUBLE) * CAST(x AS DOUBLE) FOR x IN embedding])), 6) AS norm FROM embeddings"""
)
def scan_vectors(spark, folder):
    return I.vectors(spark, folder).select(
        "pmid", F.size("embedding").alias("n_dims"), F.round(V.l2_norm(F.col("embedding")), 6).alias("norm")
    )


@register(
    "SELECT vec_id AS pmid, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS embedding_{i}" for i in range(I.DIM))
    + " FROM embeddings"
)
def vectors_to_wide(spark, folder):
    wide = V.to_wide(I.vectors(spark, folder), I.DIM)
    return wide.select("pmid", *[F.col(c).cast("double").alias(c) for c in V.wide_columns(wide.columns)])


@register(
    """SELECT vec_id AS pmid, i - 1 AS i, CAST(x AS DOUBLE) AS x
FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)"""
)
def wide_to_vectors(spark, folder):
    back = V.from_wide(V.to_wide(I.vectors(spark, folder), I.DIM))
    each = back.select("pmid", F.posexplode("embedding").alias("i", "x"))
    return each.select("pmid", F.col("i").cast("bigint").alias("i"), F.col("x").cast("double").alias("x"))


@register(
    "SELECT CAST(vec_id % 8 AS INTEGER) AS part, count(*) AS n_rows FROM embeddings GROUP BY 1"
)
def hash_partition_counts(spark, folder):
    return vector_tables.partition_counts(I.vectors(spark, folder))


def _uneven(spark, folder):
    """Vectors of which one label lost half its dimensions."""
    short = F.when(F.col("label") == 3, F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    return I.table(spark, folder, "embeddings").select(F.col("vec_id").alias("pmid"), short.alias("embedding"))


@register("SELECT vec_id AS pmid, 32 AS n_dims FROM embeddings WHERE label = 3")
def dimension_violations(spark, folder):
    return quality.dimension_violations(_uneven(spark, folder), I.DIM)


WITH_ARTICLE = f"""with_article AS (
  SELECT count(*) AS n FROM vectors WHERE pmid IN (SELECT {I.OTHER_IDS.format('en')} FROM articles))"""


@register(
    I.with_ctes(I.VECTORS, I.ARTICLES, WITH_ARTICLE)
    + """SELECT count(*) AS n_new, count(*) FILTER (WHERE label = 3) AS n_wrong_dim,
  (SELECT n FROM with_article) AS n_existing, CAST(0 AS BIGINT) AS n_repeated,
  count(*) + (SELECT n FROM with_article) AS n_after
FROM embeddings"""
)
def vector_append_check(spark, folder):
    stored = search.with_article(I.vectors(spark, folder), I.other_ids(I.articles(spark, folder), "en"))
    return quality.append_check(_uneven(spark, folder), stored, I.DIM)


@register(
    I.with_ctes(I.VECTORS, I.ARTICLES)
    + f"SELECT pmid FROM vectors WHERE pmid NOT IN (SELECT {I.OTHER_IDS.format('en')} FROM articles)"
)
def orphan_vectors(spark, folder):
    articles = I.other_ids(I.articles(spark, folder), "en")
    return quality.orphan_vectors(I.vectors(spark, folder), articles)


@register(
    I.with_ctes(ARTICLE_TEXTS, HASHED_ARTICLES)
    + "SELECT pmid, bucket AS i, round(CAST(x AS DOUBLE), 6) AS x FROM article_vectors_long"
)
def embed_hashed(spark, folder):
    vectors = embedding.hashed_embedding(I.texts(spark, folder), dim=I.DIM)
    each = vectors.select("pmid", F.posexplode("embedding").alias("i", "x"))
    return each.select("pmid", F.col("i").cast("int").alias("i"), F.round(F.col("x").cast("double"), 6).alias("x"))


def text_neighbours_sql(k: int) -> str:
    return f"""SELECT query_id, pmid, rank, distance FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, pmid) - 1 AS INTEGER) AS rank FROM (
    SELECT query_id, pmid, {I.DISTANCE.format(a='q.embedding', b='v.embedding')} AS distance
    FROM query_vectors q CROSS JOIN article_vectors v)) WHERE rank < {k}"""


@register(
    I.with_ctes(ARTICLE_TEXTS, QUERY_TEXTS, HASHED_ARTICLES, HASHED_QUERIES)
    + f"SELECT query_id, pmid, rank, round(distance, 6) AS distance FROM ({text_neighbours_sql(K)})"
)
def embed_then_search(spark, folder):
    vectors = embedding.hashed_embedding(I.texts(spark, folder), dim=I.DIM)
    return _rounded(knn.nearest(vectors, embed_text_queries(I.text_queries(spark, folder)), K))


@register(
    I.with_ctes(
        "titles AS (SELECT doc_id AS pmid, split_part(text, chr(10), 1) AS text FROM documents)",
        "full_texts AS (SELECT doc_id AS pmid, split_part(text, chr(10), 1) || chr(10) || chr(10) || text AS text FROM documents)",
        ARTICLE_TEXTS,
        hashed_cte("title_vectors", "titles", "pmid"),
        hashed_cte("full_vectors", "full_texts", "pmid"),
        HASHED_ARTICLES,
    )
    + f"""SELECT f.pmid,
  round(1 - {I.DISTANCE.format(a='f.embedding', b='a.embedding')}, 6) AS sim_abstract,
  round(1 - {I.DISTANCE.format(a='f.embedding', b='t.embedding')}, 6) AS sim_title
FROM full_vectors f JOIN article_vectors a USING (pmid) JOIN title_vectors t USING (pmid)"""
)
def pairwise_similarity(spark, folder):
    articles = I.articles(spark, folder)
    parts = {
        "whole": F.concat("title", F.lit("\n\n"), "abstract"),
        "abstract": F.col("abstract"),
        "title": F.col("title"),
    }
    frames = [
        embedding.hashed_embedding(articles.select("pmid", text.alias("text")), dim=I.DIM).withColumnRenamed(
            "embedding", name
        )
        for name, text in parts.items()
    ]
    joined = frames[0].join(frames[1], "pmid").join(frames[2], "pmid")
    similar = knn.similarity_to_variants(joined, "whole", ["abstract", "title"])
    return similar.select("pmid", *[F.round(F.round(c, 12), 6).alias(c) for c in similar.columns[1:]])


BM25 = r"""doc_words AS (
  SELECT doc_id AS pmid, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term FROM documents),
doc_terms AS (SELECT pmid, term FROM doc_words WHERE term <> ''),
postings AS (SELECT pmid, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
doc_lengths AS (SELECT d.doc_id AS pmid, count(t.term) AS length
  FROM documents d LEFT JOIN doc_terms t ON t.pmid = d.doc_id GROUP BY 1),
doc_stats AS (SELECT count(*) AS n_docs, avg(length) AS mean_length FROM doc_lengths),
query_words AS (
  SELECT DISTINCT item_id AS query_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term
  FROM benchmark),
frequencies AS (SELECT term, count(*) AS df FROM postings GROUP BY 1),
keyword_scores AS (
  SELECT query_id, pmid, round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5))
    * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean_length))), 12) AS score
  FROM query_words JOIN postings USING (term) JOIN frequencies USING (term) JOIN doc_lengths USING (pmid)
  CROSS JOIN doc_stats WHERE term <> '' GROUP BY query_id, pmid),
keyword_run AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pmid) - 1 AS INTEGER) AS rank
    FROM keyword_scores) WHERE rank < 1000)"""


_indexes: dict[tuple[str, str], str] = {}


def _keyword_index(spark, folder):
    key = (spark.sparkContext.applicationId, folder)
    if key not in _indexes:
        path = f"{shared_dir(spark).rstrip('/')}/keyword-index-{uuid.uuid4().hex}"
        postings.write_index(I.texts(spark, folder), path)
        _indexes[key] = path
    return _indexes[key]


@register(I.with_ctes(BM25) + "SELECT query_id, pmid, rank, round(score, 6) AS score FROM keyword_run WHERE rank < 100")
def keyword_bm25(spark, folder):
    """From an index on disk, which is written once per session and table."""
    found = postings.search_index(spark, _keyword_index(spark, folder), I.text_queries(spark, folder), 100)
    return found.withColumn("score", F.round("score", 6))


@register(
    I.with_ctes(I.ARTICLES)
    + """SELECT pmid, 'Authors: ' || authors AS author_line,
  coalesce(journal_name, 'None') || ', Vol. ' || coalesce(volume, 'None') || ' (Issue ' || coalesce(issue, 'None')
    || '), pp. ' || coalesce(pagination, 'None') || ', ' || year || ', PMID: ' || pmid AS citation,
  journal_name || CASE WHEN volume IS NULL AND issue IS NULL THEN '' ELSE ', ' || concat_ws(' ', 'Vol. ' || volume,
    '(Issue ' || issue || ')') END || coalesce(', pp. ' || pagination, '') || ', ' || year || ', PMID: ' || pmid
    AS short_citation,
  'Semantic distance: ' || printf('%.3f', file_number / 7.0) AS distance_line,
  'Semantic distance: ' || printf('%.3f', CAST(pmid AS DOUBLE) / 2000) AS tie_line
FROM articles"""
)
def citation_string(spark, folder):
    c = F.col
    parts = [c(n) for n in ("journal_name", "volume", "issue", "pagination", "year", "pmid")]
    return I.articles(spark, folder).select(
        "pmid",
        author_line(c("authors")).alias("author_line"),
        citation(*parts, none_text="None").alias("citation"),
        citation(*parts).alias("short_citation"),
        distance_line(c("file_number") / 7.0).alias("distance_line"),
        distance_line(c("pmid") / 2000).alias("tie_line"),
    )
