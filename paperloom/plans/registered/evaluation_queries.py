"""Registered queries over runs, judgments and their scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom import embedding
from paperloom.operators import judgments, keyword, knn, metrics
from paperloom.operators.metrics import CUTOFFS
from paperloom.plans import evaluation
from paperloom.plans.reference_sets import ReferenceSet, sample_queries as sample
from paperloom.plans.registered import inputs as I
from paperloom.plans.registered import vector_queries as VQ
from paperloom.sources.tables import max_id_as_of

QUERIES = {}
SQL = {}
FILE_LIMIT = 9


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def score_ctes(run: str = "run", qrels: str = "qrels") -> str:
    """Common table expressions down to ``per_query``."""
    cut = "\n".join(
        f"    sum(CASE WHEN hit AND r <= {k} THEN 1 ELSE 0 END) / {k}.0 AS p_{k},\n"
        f"    sum(CASE WHEN hit AND r <= {k} THEN gain / log2(r + 1) ELSE 0 END) AS gain_{k},"
        for k in CUTOFFS
    )
    ideal = ",\n".join(
        f"    sum(CASE WHEN r <= {k} THEN rel / log2(r + 1) END) AS ideal_{k}" for k in CUTOFFS
    )
    ndcg = ",\n".join(f"    p_{k}, gain_{k} / ideal_{k} AS ndcg_{k}" for k in CUTOFFS)
    return f"""judged AS (SELECT r.query_id, r.pmid, r.rank, q.rel FROM {run} r LEFT JOIN {qrels} q USING (query_id, pmid)),
positions AS (
  SELECT query_id, coalesce(rel, 0) AS gain, coalesce(rel > 0, false) AS hit,
    row_number() OVER w AS r,
    sum(CASE WHEN rel > 0 THEN 1 ELSE 0 END) OVER w AS hits,
    sum(CASE WHEN rel <= 0 THEN 1 ELSE 0 END) OVER w AS misses
  FROM judged WINDOW w AS (PARTITION BY query_id ORDER BY rank, pmid ROWS UNBOUNDED PRECEDING)),
topic AS (
  SELECT query_id, count(*) FILTER (WHERE rel > 0) AS n_rel, count(*) FILTER (WHERE rel <= 0) AS n_nonrel
  FROM {qrels} GROUP BY query_id),
ideal AS (
  SELECT query_id,
{ideal}
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rel DESC, pmid) AS r FROM {qrels} WHERE rel > 0)
  GROUP BY query_id),
sums AS (
  SELECT query_id, count(*) AS num_ret, sum(CASE WHEN hit THEN 1 ELSE 0 END) AS num_rel_ret,
    sum(CASE WHEN hit AND r <= 10000 THEN hits / r ELSE 0 END) AS ap_sum,
    sum(CASE WHEN hit AND r <= 1000 THEN
      CASE WHEN least(n_rel, n_nonrel) > 0
        THEN 1 - least(misses, least(n_rel, n_nonrel)) / least(n_rel, n_nonrel) ELSE 1 END ELSE 0 END) AS bpref_sum,
    sum(CASE WHEN hit AND r <= least(n_rel, 1000) THEN 1 ELSE 0 END) AS r_hits,
{cut}
    coalesce(1.0 / min(CASE WHEN hit AND r <= 1000 THEN r END), 0) AS recip_rank
  FROM positions LEFT JOIN topic USING (query_id) GROUP BY query_id),
per_query AS (
  SELECT query_id, CAST(num_ret AS BIGINT) AS num_ret, CAST(coalesce(n_rel, 0) AS BIGINT) AS num_rel,
    CAST(num_rel_ret AS BIGINT) AS num_rel_ret,
    ap_sum / nullif(n_rel, 0) AS ap, bpref_sum / nullif(n_rel, 0) AS bpref, r_hits / nullif(n_rel, 0) AS rprec,
    CAST(recip_rank AS DOUBLE) AS recip_rank,
{ndcg}
  FROM sums LEFT JOIN topic USING (query_id) LEFT JOIN ideal USING (query_id))"""


def _avg(column: str, name: str) -> str:
    return f'round(avg({column}), 6) AS "{name}"'


COUNTS_SQL = """CAST(sum(num_ret) AS BIGINT) AS num_ret,
  (SELECT count(*) FROM {qrels} WHERE rel > 0) AS num_rel,
  CAST(sum(num_rel_ret) AS BIGINT) AS num_rel_ret, count(*) AS num_q"""
GM_SQL = "round(exp(avg(ln(greatest(ap, 1e-5))) FILTER (WHERE ap IS NOT NULL)), 6) AS gm_map"


def panel_sql(qrels: str = "qrels") -> str:
    columns = [
        COUNTS_SQL.format(qrels=qrels),
        _avg("ap", "map"),
        GM_SQL,
        _avg("bpref", "bpref"),
        _avg("rprec", "Rprec"),
        _avg("recip_rank", "recip_rank"),
        *[_avg(f"p_{k}", f"P@{k}") for k in CUTOFFS],
        *[_avg(f"ndcg_{k}", f"NDCG@{k}") for k in CUTOFFS],
    ]
    return "SELECT " + ",\n  ".join(columns) + " FROM per_query"


SCORED = I.with_ctes(*I.RUN_AND_QRELS, score_ctes())


def rounded(panel):
    whole = {"num_ret", "num_rel", "num_rel_ret", "num_q", "query_id"}
    return panel.selectExpr(
        *[f"`{c}`" if c in whole else f"round(`{c}`, 6) AS `{c}`" for c in panel.columns]
    )


def _panel(spark, folder, *columns):
    panel = rounded(metrics.metric_panel(I.run(spark, folder), I.qrels(spark, folder)))
    return panel.select(*[f"`{c}`" for c in columns]) if columns else panel


@register(SCORED + panel_sql())
def eval_all(spark, folder):
    return _panel(spark, folder)


@register(SCORED + "SELECT " + COUNTS_SQL.format(qrels="qrels") + " FROM per_query")
def eval_counts(spark, folder):
    return _panel(spark, folder, "num_ret", "num_rel", "num_rel_ret", "num_q")


@register(SCORED + f"SELECT {_avg('ap', 'map')} FROM per_query")
def eval_map(spark, folder):
    return _panel(spark, folder, "map")


@register(SCORED + f"SELECT {GM_SQL} FROM per_query")
def eval_gm_map(spark, folder):
    return _panel(spark, folder, "gm_map")


@register(SCORED + f"SELECT {_avg('bpref', 'bpref')} FROM per_query")
def eval_bpref(spark, folder):
    return _panel(spark, folder, "bpref")


@register(SCORED + f"SELECT {_avg('rprec', 'Rprec')} FROM per_query")
def eval_rprec(spark, folder):
    return _panel(spark, folder, "Rprec")


@register(SCORED + f"SELECT {_avg('recip_rank', 'recip_rank')} FROM per_query")
def eval_mrr(spark, folder):
    return _panel(spark, folder, "recip_rank")


@register(SCORED + "SELECT " + ", ".join(_avg(f"p_{k}", f"P@{k}") for k in CUTOFFS) + " FROM per_query")
def eval_precision(spark, folder):
    return _panel(spark, folder, *[f"P@{k}" for k in CUTOFFS])


@register(SCORED + "SELECT " + ", ".join(_avg(f"ndcg_{k}", f"NDCG@{k}") for k in CUTOFFS) + " FROM per_query")
def eval_ndcg(spark, folder):
    return _panel(spark, folder, *[f"NDCG@{k}" for k in CUTOFFS])


@register(
    SCORED
    + "SELECT query_id, num_ret, num_rel, num_rel_ret, round(ap, 6) AS ap, round(bpref, 6) AS bpref, "
    + 'round(rprec, 6) AS "Rprec", round(recip_rank, 6) AS recip_rank, '
    + ", ".join(f'round(p_{k}, 6) AS "P@{k}", round(ndcg_{k}, 6) AS "NDCG@{k}"' for k in CUTOFFS)
    + " FROM per_query"
)
def eval_per_query(spark, folder):
    return rounded(metrics.per_query_metrics(I.run(spark, folder), I.qrels(spark, folder)))


@register(I.with_ctes(I.EVENTS_K, I.SCORED_PAIRS) + """
SELECT query_id, pmid, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pmid) - 1 AS INTEGER) AS rank
FROM scored_pairs""")
def run_rank(spark, folder):
    return knn.rank_within_query(I.scored_pairs(spark, folder), F.col("score"))


@register(
    I.with_ctes(*I.RUN_AND_QRELS)
    + "SELECT query_id, string_agg(pmid, chr(10) ORDER BY rank) AS lines FROM run GROUP BY query_id"
)
def run_as_lists(spark, folder):
    from paperloom.functions.text import ids_to_lines

    lists = judgments.run_as_lists(I.run(spark, folder))
    return lists.select("query_id", ids_to_lines(F.col("pmids")).alias("lines"))


ALLOWED = "allowed AS (SELECT doc_id AS pmid FROM documents WHERE lang <> 'en')"


def _allowed(spark, folder):
    documents = I.table(spark, folder, "documents").filter(F.col("lang") != "en")
    return documents.select(F.col("doc_id").alias("pmid"))


@register(
    I.with_ctes(*I.RUN_AND_QRELS, ALLOWED)
    + "SELECT query_id, pmid, rank FROM run WHERE pmid IN (SELECT pmid FROM allowed)"
)
def filter_allowed(spark, folder):
    return judgments.keep_allowed(I.run(spark, folder), _allowed(spark, folder))


MAX_PMID = (
    f"max_pmid AS (SELECT max(doc_id) AS m FROM documents WHERE CAST(substr(source, 4) AS INTEGER) <= {FILE_LIMIT})"
)


@register(
    I.with_ctes(I.EVENTS_K, MAX_PMID)
    + "SELECT event_id, user_id AS query_id, k * 15 AS pmid FROM events_k WHERE k * 15 <= (SELECT m FROM max_pmid)"
)
def filter_max_id(spark, folder):
    shown = I.events(spark, folder).select(
        "event_id", F.col("user_id").alias("query_id"), (F.col("k") * 15).alias("pmid")
    )
    return judgments.keep_up_to(shown, max_id_as_of(I.articles(spark, folder), FILE_LIMIT))


@register(
    I.with_ctes(*I.RUN_AND_QRELS)
    + "SELECT query_id, pmid FROM run WHERE (query_id, pmid) NOT IN (SELECT (query_id, pmid) FROM qrels WHERE rel > 0)"
)
def nonrelevant_anti(spark, folder):
    return judgments.retrieved_not_relevant(I.run(spark, folder), I.qrels(spark, folder))


BINARY_QRELS = """binary_qrels AS (
  SELECT query_id, pmid, 1 AS rel FROM qrels WHERE rel > 0
  UNION ALL
  SELECT query_id, pmid, 0 AS rel FROM run
  WHERE (query_id, pmid) NOT IN (SELECT (query_id, pmid) FROM qrels WHERE rel > 0))"""


def _binary(qrels):
    return qrels.filter(F.col("rel") > 0).select("query_id", "pmid", F.lit(1).alias("rel"))


@register(I.with_ctes(*I.RUN_AND_QRELS, BINARY_QRELS) + "SELECT * FROM binary_qrels")
def qrels_union(spark, folder):
    return judgments.with_retrieved_as_judged(I.run(spark, folder), _binary(I.qrels(spark, folder)))


@register(
    I.with_ctes(
        *I.RUN_AND_QRELS,
        ALLOWED,
        "allowed_run AS (SELECT * FROM run WHERE pmid IN (SELECT pmid FROM allowed))",
        score_ctes("allowed_run"),
    )
    + panel_sql()
)
def evaluate_graded(spark, folder):
    run, qrels = judgments.prepare_graded(I.run(spark, folder), I.qrels(spark, folder), _allowed(spark, folder))
    return rounded(metrics.metric_panel(run, qrels))


LIMITED_RUN = "limited_run AS (SELECT * FROM run WHERE pmid <= (SELECT floor(avg(k)) FROM events_k))"


@register(
    I.with_ctes(*I.RUN_AND_QRELS, BINARY_QRELS, LIMITED_RUN, score_ctes("limited_run", "binary_qrels"))
    + panel_sql("binary_qrels")
)
def evaluate_binary(spark, folder):
    limit = I.events(spark, folder).agg(F.floor(F.avg("k")).alias("max_pmid"))
    run, qrels = judgments.prepare_binary(I.run(spark, folder), _binary(I.qrels(spark, folder)), limit)
    return rounded(metrics.metric_panel(run, qrels))


@register(
    I.with_ctes(
        *I.RUN_AND_QRELS,
        VQ.ARTICLE_TEXTS,
        VQ.QUERY_TEXTS,
        VQ.HASHED_ARTICLES,
        VQ.HASHED_QUERIES,
        f"vector_run AS ({VQ.text_neighbours_sql(1000)})",
        score_ctes("vector_run"),
    )
    + panel_sql()
)
def evaluate_vector_run(spark, folder):
    reference = ReferenceSet(I.text_queries(spark, folder), I.qrels(spark, folder))
    vectors = embedding.hashed_embedding(I.texts(spark, folder), dim=I.DIM)
    return rounded(evaluation.evaluate_vector_search(reference, vectors, VQ.embed_text_queries))


CACHED = """cached AS (
  SELECT query_id, pmid, rank FROM run WHERE query_id IN (SELECT doc_id FROM labels))"""


def _cached(spark, folder):
    """Stored results of the users that have a label."""
    labelled = I.table(spark, folder, "labels").select(F.col("doc_id").alias("query_id"))
    lists = judgments.run_as_lists(I.run(spark, folder))
    return lists.join(labelled.distinct(), "query_id", "left_semi")


@register(
    I.with_ctes(*I.RUN_AND_QRELS, CACHED, I.TEXT_QUERIES)
    + "SELECT query_id, query FROM text_queries WHERE query_id NOT IN (SELECT query_id FROM cached)"
)
def cache_misses(spark, folder):
    return keyword.split_by_cache(I.text_queries(spark, folder), _cached(spark, folder))[1]


@register(
    I.with_ctes(
        *I.RUN_AND_QRELS,
        CACHED,
        I.TEXT_QUERIES,
        VQ.BM25,
        """merged_run AS (
  SELECT query_id, pmid, rank FROM cached WHERE query_id IN (SELECT query_id FROM text_queries)
  UNION ALL
  SELECT query_id, pmid, rank FROM keyword_run WHERE query_id NOT IN (SELECT query_id FROM cached))""",
        score_ctes("merged_run"),
    )
    + panel_sql()
)
def evaluate_keyword_run(spark, folder):
    reference = ReferenceSet(I.text_queries(spark, folder), I.qrels(spark, folder))
    return rounded(
        evaluation.evaluate_keyword_search(reference, I.texts(spark, folder), _cached(spark, folder))
    )


@register(
    I.with_ctes(*I.RUN_AND_QRELS)
    + """SELECT query_id FROM (SELECT DISTINCT query_id FROM qrels)
ORDER BY md5('1:' || query_id), query_id LIMIT 50"""
)
def sample_queries(spark, folder):
    return sample(I.qrels(spark, folder).select("query_id").distinct(), 50)


@register(
    I.with_ctes(*I.RUN_AND_QRELS)
    + """SELECT * FROM qrels WHERE query_id IN (
  SELECT query_id FROM (SELECT DISTINCT query_id FROM qrels) ORDER BY md5('1:' || query_id), query_id LIMIT 50)"""
)
def sample_subset(spark, folder):
    qrels = I.qrels(spark, folder)
    return judgments.keep_queries(qrels, sample(qrels.select("query_id").distinct(), 50))
