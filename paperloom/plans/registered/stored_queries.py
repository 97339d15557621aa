"""Registered queries that write what they read: change files, streams, clustered and bucketed tables, indexes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paperloom import embedding
from paperloom.operators import cell_bounds, changelog, hyperplanes, ivf
from paperloom.operators.changelog import ArticleStore
from paperloom.plans.registered import inputs as I
from paperloom.plans.registered.vector_queries import ARTICLE_TEXTS, HASHED_ARTICLES, NEIGHBOURS, embed_text_queries
from paperloom.session import shared_dir
from paperloom.sources import change_files, runs, tables, vector_tables
from paperloom.streaming.article_stream import apply_change_stream
from paperloom.streaming.embedding_stream import embed_article_stream, stored_vectors

QUERIES = {}
SQL = {}


def register(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _new_path(spark, name):
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- change files --------------------------------------------------------

# Documents of one file; each has an update file after it.
PER_FILE = 500


def _escaped(column):
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        column = F.replace(column, F.lit(char), F.lit(entity))
    return column


def _record(version, title, volume, journal="Journal"):
    """A document as a citation record."""
    parts = [
        F.lit(f"<PubmedArticle><MedlineCitation><PMID Version='{version}'>"), F.col("doc_id").cast("string"),
        F.lit(f"</PMID><Article><{journal}><JournalIssue><Volume>"), volume,
        F.lit("</Volume><PubDate><MedlineDate>1998 Dec-1999 Jan</MedlineDate></PubDate></JournalIssue></"),
        F.lit(f"{journal}><ArticleTitle>"), title,
        F.lit("</ArticleTitle><Abstract><AbstractText>"), _escaped(F.col("text")),
        F.lit("</AbstractText></Abstract></Article><MeshHeadingList><MeshHeading><DescriptorName UI='D1'>"), F.col("source"),
        F.lit("</DescriptorName><QualifierName>x</QualifierName></MeshHeading></MeshHeadingList><KeywordList><Keyword>"), F.col("lang"),
        F.lit("</Keyword><Keyword/><Keyword>"), F.col("source"),
        F.lit("</Keyword></KeywordList></MedlineCitation></PubmedArticle>\n"),
    ]
    return F.concat(*parts)


def _file_name(number):
    digits = number.cast("string")
    return F.concat(F.lit("med24n"), F.lpad(digits, F.greatest(F.length(digits), F.lit(4)), "0"), F.lit(".xml.gz"))


def _published(spark, folder, only=None):
    """``file_name, place, text``: all documents in their files, second versions of the Spanish ones
    with them; in the update files new German volumes, unreadable Spanish records and deletes of the French ones.

    ``only`` names one file; just its documents are made records."""
    documents = I.table(spark, folder, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    base = F.expr(f"2 * (doc_id div {PER_FILE}) + 1")
    if only is not None:
        documents = documents.filter(F.lit(only).isin(_file_name(base), _file_name(base + 1)))
    title, volume, lang = _escaped(I.title_of(F.col("text"))), F.col("n_chars").cast("string"), F.col("lang")
    rows = F.array(
        F.struct(base.alias("number"), _record(1, title, volume).alias("text")),
        F.when(lang == "es", F.struct(base.alias("number"), _record(2, F.lit("later"), volume).alias("text"))),
        F.when(lang == "de", F.struct((base + 1).alias("number"), _record(1, title, F.lit("new")).alias("text"))),
        F.when(lang == "es", F.struct((base + 1).alias("number"), _record(1, title, volume, journal="Book").alias("text"))),
    )
    records = documents.select("doc_id", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select(
        "r.number", F.col("doc_id").alias("place"), "r.text"
    )
    tag = F.concat(F.lit("<PMID Version='1'>"), F.col("doc_id").cast("string"), F.lit("</PMID>"))
    # A file has at most as many deletes as documents.
    blocks = documents.filter(lang == "fr").groupBy((base + 1).alias("number")).agg(F.collect_list(tag).alias("tags"))
    block = F.concat(F.lit("<DeleteCitation>"), F.array_join("tags", "\n"), F.lit("</DeleteCitation>\n"))
    deletes = blocks.select("number", F.lit(2**62).alias("place"), block.alias("text"))
    ends = [(-1, "<?xml version='1.0'?>\n<PubmedArticleSet>\n"), (2**62 + 1, "</PubmedArticleSet>\n")]
    end = F.explode(F.array(*[F.struct(F.lit(p).cast("bigint").alias("place"), F.lit(t).alias("text")) for p, t in ends]))
    # Every document is in its file; the update file has rows of these languages only. No text is made for this.
    files = F.when(lang.isin("de", "es", "fr"), F.array(base, base + 1)).otherwise(F.array(base))
    numbers = documents.select(F.explode(files).alias("number")).distinct()
    frame = numbers.select("number", end.alias("e")).select("number", "e.*")
    whole = records.unionByName(deletes).unionByName(frame)
    named = whole.select(_file_name(F.col("number")).alias("file_name"), "place", "text")
    return named if only is None else named.filter(F.col("file_name") == only)


BASE = f"(2 * (doc_id // {PER_FILE}) + 1)"
FILE_NAME = "'med24n' || lpad(CAST({0} AS VARCHAR), CAST(greatest(4, length(CAST({0} AS VARCHAR))) AS INTEGER), '0') || '.xml.gz'"
PUBLISHED_COLUMNS = ["pmid", "title", "abstract", "publication_date", "mesh_terms", "keywords", "journal_name", "volume", "file_number"]
LIVING = f"""SELECT doc_id AS pmid, nullif(split_part(text, chr(10), 1), '') AS title, nullif(text, '') AS abstract,
  DATE '1998-01-01' AS publication_date, source AS mesh_terms, lang || chr(10) || source AS keywords,
  CAST(NULL AS VARCHAR) AS journal_name, CASE WHEN lang = 'de' THEN 'new' ELSE CAST(n_chars AS VARCHAR) END AS volume,
  CAST({BASE} + CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS INTEGER) AS file_number
FROM documents WHERE lang <> 'fr'"""


@register(LIVING)
def ingest_change_files(spark, folder):
    """Gzip change files written from the documents, read in their order to the living articles."""
    path = _new_path(spark, "change-files")
    change_files.write_change_files(_published(spark, folder), path)
    readable, _ = change_files.split_errors(change_files.read_changes(spark, path, on_error="quarantine"))
    return changelog.live_rows(readable).select(PUBLISHED_COLUMNS)


@register(LIVING)
def ingest_change_stream(spark, folder):
    """The same files as a stream that stops twice: the first file comes late, after its own update."""
    path, work = _new_path(spark, "change-landing"), _new_path(spark, "change-stream")
    late = "med24n0001.xml.gz"
    for arrived in (_published(spark, folder).filter(F.col("file_name") != late), _published(spark, folder, late), None):
        if arrived is not None:
            change_files.write_change_files(arrived, path)
        apply_change_stream(spark, path, f"{work}/store", f"{work}/checkpoint", quarantine=f"{work}/unreadable").awaitTermination()
    return ArticleStore(spark, f"{work}/store").articles().select(PUBLISHED_COLUMNS)


@register(f"""SELECT doc_id AS pmid, {FILE_NAME.format(f'({BASE} + 1)')} AS file_name, 'no journal' AS error
FROM documents WHERE lang = 'es'""")
def quarantined_records(spark, folder):
    path = _new_path(spark, "change-files")
    change_files.write_change_files(_published(spark, folder), path)
    _, unreadable = change_files.split_errors(change_files.read_changes(spark, path, on_error="quarantine"))
    return unreadable.select("pmid", "file_name", "error")


# --- embedding stream ----------------------------------------------------


@register(
    I.with_ctes(ARTICLE_TEXTS, HASHED_ARTICLES)
    + """SELECT l.pmid, CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS batch, md5(coalesce(text, '')) AS text_hash,
  bucket AS i, round(CAST(x AS DOUBLE), 6) AS x
FROM article_vectors_long l JOIN documents d ON d.doc_id = l.pmid"""
)
def embedding_stream(spark, folder):
    """Texts embedded as they arrive; all come again when the French ones have changed, and only those are embedded again."""
    path = _new_path(spark, "embedding-stream")
    documents = I.table(spark, folder, "documents").select(F.col("doc_id").alias("pmid"), "text", "lang")
    before = F.when(F.col("lang") == "fr", F.concat(F.lit("old "), "text")).otherwise(F.col("text"))
    embed = lambda texts: embedding.hashed_embedding(texts, dim=I.DIM, carry=("text_hash",))
    for version in (before, F.col("text")):
        documents.select("pmid", version.alias("text")).write.mode("append").parquet(f"{path}/texts")
        texts = spark.readStream.schema("pmid bigint, text string").parquet(f"{path}/texts")
        embed_article_stream(texts, embed, f"{path}/vectors", f"{path}/checkpoint").awaitTermination()
    rows = stored_vectors(spark, f"{path}/vectors").select("pmid", "batch", "text_hash", F.posexplode("embedding").alias("i", "x"))
    return rows.select("pmid", F.col("batch").cast("int").alias("batch"), "text_hash", "i", F.round(F.col("x").cast("double"), 6).alias("x"))


# --- clustered and bucketed tables, stored runs --------------------------


@register(
    I.with_ctes(I.ARTICLES)
    + """SELECT pmid, publication_date, title FROM articles
WHERE publication_date BETWEEN DATE '1995-03-01' AND DATE '1996-12-31'"""
)
def date_range_clustered(spark, folder):
    """A date range of articles stored in the order of their dates."""
    path = _new_path(spark, "articles-by-date")
    tables.write_by_date(I.articles(spark, folder), path)
    return tables.date_range(spark.read.parquet(path), "1995-03-01", "1996-12-31").select("pmid", "publication_date", "title")


@register(
    """SELECT vec_id AS pmid, CAST(len(embedding) AS INTEGER) AS n_dims, lang, source AS authors
FROM embeddings JOIN documents ON doc_id = vec_id"""
)
def colocated_join(spark, folder):
    """Vectors and articles in tables bucketed alike, joined where they lie."""
    name = uuid.uuid4().hex
    vectors = vector_tables.save_bucketed(I.vectors(spark, folder), f"vectors_{name}", _new_path(spark, "bucketed-vectors"))
    articles = vector_tables.save_bucketed(I.articles(spark, folder), f"articles_{name}", _new_path(spark, "bucketed-articles"))
    joined = vectors.hint("merge").join(articles, "pmid")
    return joined.select("pmid", F.size("embedding").alias("n_dims"), F.col("keywords").alias("lang"), "authors")


@register(
    I.with_ctes(I.EVENTS_K, I.SCORED_PAIRS, I.RUN)
    + """SELECT query_id, pmid, rank, CAST(rank AS DOUBLE) AS score, 'second' AS system FROM run
UNION ALL SELECT query_id, pmid, rank, CAST(0 AS DOUBLE) AS score, 'other' AS system FROM run"""
)
def stored_runs(spark, folder):
    """Two systems' runs kept on disk, of which one is replaced."""
    path = _new_path(spark, "runs")
    run = I.run(spark, folder).select(F.col("query_id").cast("int").alias("query_id"), "pmid", "rank")
    scored = lambda score, system: run.select("*", score.cast("double").alias("score"), F.lit(system).alias("system"))
    runs.save_run(scored(F.lit(1), "second").union(scored(F.lit(0), "other")), path)
    runs.save_run(scored(F.col("rank"), "second"), path)
    return runs.read_run(spark, path, "second").union(runs.read_run(spark, path, "other"))


CHUNKS = 16


@register(
    f"""SELECT chunk, n_rows, CAST(sum(n_rows) OVER (ORDER BY chunk) AS BIGINT) AS running_total FROM (
  SELECT CAST(doc_id // width AS BIGINT) AS chunk, count(*) AS n_rows
  FROM documents, (SELECT (max(doc_id) - min(doc_id)) // {CHUNKS} + 1 AS width FROM documents) GROUP BY ALL)"""
)
def copy_in_chunks(spark, folder):
    """Documents copied chunk by chunk, twice: the second copy finds every chunk done."""
    documents, path = I.table(spark, folder, "documents"), _new_path(spark, "documents-copy")
    width = documents.agg(F.expr(f"coalesce((max(doc_id) - min(doc_id)) div {CHUNKS}, 0) + 1")).first()[0]
    tables.copy_in_chunks(documents, path, "doc_id", width)
    return tables.copy_in_chunks(documents, path, "doc_id", width)


# --- exact search that skips cells ---------------------------------------


@register(NEIGHBOURS)
def knn_exact_cells(spark, folder):
    """From cells on disk around the mean vector of each label; cells that cannot hold a neighbour are not read."""
    labelled = I.table(spark, folder, "embeddings").select(F.col("vec_id").alias("pmid"), "embedding", "label")
    path = _new_path(spark, "cells")
    cell_bounds.write_index(labelled, ivf.group_centroids(labelled, "label", I.DIM), path)
    found = cell_bounds.search(spark, path, embed_text_queries(I.text_queries(spark, folder)), 10)
    return found.withColumn("distance", F.round("distance", 6))


# --- hash tables ---------------------------------------------------------

HASH_TABLES = 12
HASH_BITS = 6
K = 10
# Every hundredth vector asks for its neighbours.
ASKING = "vec_id % 100 = 0"


def _asking(spark, folder):
    rows = I.table(spark, folder, "embeddings").filter(ASKING)
    return rows.select(F.col("vec_id").alias("query_id"), "embedding")


@register(
    I.with_ctes(
        f"""directions AS (
  SELECT t, b, list(CASE WHEN substr(md5(t || ':' || b || ':' || i), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY i) AS d
  FROM range({HASH_TABLES}) t(t), range({HASH_BITS}) b(b), range({I.DIM}) i(i) GROUP BY t, b)""",
        """buckets AS (
  SELECT vec_id, embedding, t, CAST(sum(CASE WHEN list_dot_product(CAST(embedding AS DOUBLE[]), d) > 0 THEN 1 << b ELSE 0 END) AS BIGINT) AS bucket
  FROM embeddings, directions GROUP BY ALL)""",
        f"""pairs AS (
  SELECT DISTINCT q.vec_id AS query_id, v.vec_id AS pmid FROM buckets q JOIN buckets v USING (t)
  WHERE q.{ASKING} AND bit_count(xor(q.bucket, v.bucket)) <= 1)""",
        f"""near AS (
  SELECT query_id, pmid, {I.DISTANCE.format(a='q.embedding', b='v.embedding')} AS distance
  FROM pairs JOIN embeddings q ON q.vec_id = query_id JOIN embeddings v ON v.vec_id = pmid)""",
    )
    + f"""SELECT query_id, pmid, CAST(n - 1 AS INTEGER) AS rank, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, pmid) AS n FROM near) WHERE n <= {K}"""
)
def knn_hyperplanes(spark, folder):
    """From hash tables on disk; a query probes its own bucket of a table and those one sign away."""
    path = _new_path(spark, "hyperplanes")
    hyperplanes.write_index(I.vectors(spark, folder), path, HASH_TABLES, HASH_BITS)
    found = hyperplanes.search(spark, path, _asking(spark, folder), K)
    return found.withColumn("distance", F.round("distance", 6))
