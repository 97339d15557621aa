"""URL filter: rules by host and path, then trust and distrust spread over the host graph.

Pages that a rule fits get its verdict. The rules' pages make their hosts seeds:
trust is a personalised PageRank from the allowed ones along the links, distrust one
from the blocked ones against the links. Both run as joins of the host edges with
the hosts' values; the graph holds one row per pair of hosts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import stored

DAMPING = 0.85
# Largest change of a host's value in the last round, as a share of the value or of 1.
TOLERANCE = 1e-6
# By then a double holds nothing of what the damping leaves of a seed; more rounds are an error.
MAX_ROUNDS = 5000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)href[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*([^"'\x20\x09-\x0D>]+)"""


@dataclass(frozen=True)
class UrlRule:
    """``host/path``; fits the host and its subdomains where the path starts with ``/path``."""

    rule: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        own, _, rest = self.rule.partition("/")
        return ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{rest}")


RULES = (
    UrlRule("org/", "allow"),
    UrlRule("example.org/es/", "block"),
    UrlRule("example.org/en/1", "block"),
    UrlRule("com/fr/", "allow"),
    UrlRule("com/de/", "block"),
)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(pages: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, host, path, rule, ruling, links``; the longest fitting rule counts, of equal lengths the first."""
    placed = pages.select(
        F.col(page_id).alias("page_id"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_HREF), F.lit(1)).alias("links"),
    )
    ordered = sorted(rules, key=lambda r: -len(r.rule))
    pick = lambda value: F.coalesce(F.lit(None).cast("string"), *[F.when(r.fits(F.col("host"), F.col("path")), F.lit(value(r))) for r in ordered])
    return placed.withColumns({"rule": pick(lambda r: r.rule), "ruling": pick(lambda r: r.verdict)})


def host_edges(placed: DataFrame) -> DataFrame:
    """``src, dst, n``: links between different hosts, counted before they are shuffled. Links without a host stay inside theirs."""
    link = F.explode(F.filter("links", lambda x: x.contains("://") | x.startswith("//")))
    pairs = placed.select(F.col("host").alias("src"), link.alias("link")).select(
        "src", host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))).alias("dst")
    )
    return pairs.filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def _spread(edges: DataFrame, source: str, target: str, seeds: DataFrame, name: str) -> DataFrame:
    """``host, value``: personalised PageRank of ``seeds`` (``host, seed``) along the edges from ``source`` to ``target``.

    What reaches a host without further edges is not handed on. Rounds go on until every
    host that the seeds reach has a value and no value moves, however small it is.
    """
    out = edges.groupBy(source).agg(F.sum("n").alias("out")).withColumnRenamed(source, "from")
    shares = edges.join(out, F.col(source) == F.col("from")).select(
        F.col(source).alias("from"), F.col(target).alias("to"), (F.col("n") / F.col("out")).alias("share")
    )
    shares = stored(shares, f"{name}-shares")
    seeds = stored(seeds.filter("seed > 0"), f"{name}-seeds")
    state = seeds.select("host", (F.col("seed") * (1 - DAMPING)).alias("value"))
    for _ in range(MAX_ROUNDS):
        flow = shares.join(state, F.col("from") == F.col("host")).groupBy("to").agg((F.sum(F.col("share") * F.col("value")) * DAMPING).alias("flow"))
        new = (
            seeds.join(flow, F.col("host") == F.col("to"), "full_outer")
            .select(
                F.coalesce("host", "to").alias("host"),
                (F.coalesce("seed", F.lit(0.0)) * (1 - DAMPING) + F.coalesce("flow", F.lit(0.0))).alias("value"),
            )
            .join(state.toDF("before_host", "before"), F.col("host") == F.col("before_host"), "left")
            .withColumn("moved", F.abs(F.col("value") - F.coalesce("before", F.lit(0.0))))
            .select("host", "value", (F.col("moved") > F.least("value", F.lit(1.0)) * TOLERANCE).alias("moves"))
        )
        new = stored(new, f"{name}-rank")
        state = new.select("host", "value")
        if not new.filter("moves").limit(1).count():
            return state
    raise RuntimeError(f"{name} still moves after {MAX_ROUNDS} rounds")


def judged(pages: DataFrame, rules=RULES, ratio: float = 1.0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every row of ``pages``.

    A page without a rule is blocked if its host's distrust is above ``ratio`` times its
    trust. A host that neither reaches is allowed, and so is a null url, whose host and
    path are empty.
    """
    placed = ruled(pages, rules, page_id, url, html)
    hosts = placed.filter("host <> ''").groupBy("host").agg(
        F.count(F.when(F.col("ruling") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("ruling") == "block", 1)).alias("blocked"),
    )
    hosts = stored(hosts.filter("allowed + blocked > 0"), "url-hosts")
    edges = stored(host_edges(placed), "url-edges")
    seed = lambda c: hosts.select("host", (F.col(c) / (F.col("allowed") + F.col("blocked"))).alias("seed"))
    trust = _spread(edges, "src", "dst", seed("allowed"), "trust").toDF("trusted_host", "trust")
    distrust = _spread(edges, "dst", "src", seed("blocked"), "distrust").toDF("distrusted_host", "distrust")
    values = trust.join(distrust, F.col("trusted_host") == F.col("distrusted_host"), "full_outer").select(
        F.coalesce("trusted_host", "distrusted_host").alias("valued_host"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
    scored = placed.drop("links").join(stored(values, "url-values"), F.col("host") == F.col("valued_host"), "left")
    method = F.when(F.col("distrust") > ratio * F.col("trust"), "block").otherwise("allow")
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruling", method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
