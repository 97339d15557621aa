"""Column functions over article text and metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats and input prefixes that results must carry as they are.
ARTICLE_URL = "https://pubmed.ncbi.nlm.nih.gov/"
DOCUMENT_URL_PREFIX = "http://www.ncbi.nlm.nih.gov/pubmed/"
FILE_NUMBER_PATTERN = r"n(\d+)\.xml\.gz"
ID_FIELD_PATTERN = r'"_id":\s"([a-z0-9]+)"'
TEXT_FIELD_PATTERN = r'"text":\s"(.*?)",'
TITLE_FIELD_PATTERN = r'"title":\s"(.*?)",'
ARTICLE_ID_FIELD_PATTERN = r'"pubmed_id":\s"([0-9]+)"'
SQL_TYPE_RULES = [
    (("INT",), "INTEGER"),
    (("CHAR", "TEXT"), "TEXT"),
    (("BLOB",), "BYTEA"),
    (("REAL", "FLOA", "DOUB"), "DOUBLE PRECISION"),
]
SQL_TYPE_DEFAULT = "TEXT"


def embedding_text(
    title: Column, abstract: Column, mesh_terms: Column, keywords: Column, chemicals: Column
) -> Column:
    """Text to embed: each present part under its heading, ended by an empty line."""
    parts = [
        ("", title),
        ("", abstract),
        ("MeSH terms:\n", mesh_terms),
        ("Keywords:\n", keywords),
        ("Chemicals:\n", chemicals),
    ]
    return F.concat(
        *[F.coalesce(F.concat(F.lit(head), part, F.lit("\n\n")), F.lit("")) for head, part in parts]
    )


def null_to_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def join_nonempty(items: Column, separator: str) -> Column:
    """Items in order, empty ones skipped; NULL when nothing is left."""
    kept = F.filter(items, lambda x: x != "")
    return F.nullif(F.array_join(kept, separator), F.lit(""))


def file_number(file_name: Column) -> Column:
    """Sequence number in a change file's name, NULL when there is none."""
    return F.nullif(F.regexp_extract(file_name, FILE_NUMBER_PATTERN, 1), F.lit("")).try_cast("int")


def strip_url_prefix(url: Column, prefix: str = DOCUMENT_URL_PREFIX) -> Column:
    return F.replace(url, F.lit(prefix), F.lit(""))


def urls_to_ids(urls: Column, prefix: str = DOCUMENT_URL_PREFIX) -> Column:
    return F.transform(urls, lambda u: strip_url_prefix(u, prefix).cast("bigint"))


def extract_field(line: Column, pattern: str) -> Column:
    """First capture group, NULL when the pattern does not occur."""
    return F.when(line.rlike(pattern), F.regexp_extract(line, pattern, 1))


def ids_to_lines(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), "\n")


def lines_to_ids(text: Column) -> Column:
    """Ids from text with one id per line; empty text is an empty list."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda s: F.trim(s) != "")
    return F.transform(lines, lambda s: F.trim(s).cast("bigint"))


def target_sql_type(source_type: Column) -> Column:
    """Target column type for a declared source type; the first matching rule wins."""
    upper = F.upper(source_type)
    result = None
    for needles, target in SQL_TYPE_RULES:
        condition = upper.contains(needles[0])
        for needle in needles[1:]:
            condition = condition | upper.contains(needle)
        result = F.when(condition, target) if result is None else result.when(condition, target)
    return result.otherwise(SQL_TYPE_DEFAULT)


def article_url(pmid: Column) -> Column:
    return F.concat(F.lit(ARTICLE_URL), pmid.cast("string"), F.lit("/"))


def author_line(authors: Column, none_text: str = "") -> Column:
    return F.concat(F.lit("Authors: "), F.coalesce(authors, F.lit(none_text)))


def citation(
    journal: Column,
    volume: Column,
    issue: Column,
    pagination: Column,
    year: Column,
    pmid: Column,
    none_text: str | None = None,
) -> Column:
    """One-line reference of an article.

    Parts that are NULL are left out, unless ``none_text`` is given to stand
    in for them.
    """
    pieces = [
        (F.lit(""), journal, F.lit("")),
        (F.lit("Vol. "), volume, F.lit("")),
        (F.lit("(Issue "), issue, F.lit(")")),
        (F.lit("pp. "), pagination, F.lit("")),
        (F.lit(""), year.cast("string"), F.lit("")),
        (F.lit("PMID: "), pmid.cast("string"), F.lit("")),
    ]
    shown = [
        F.concat(a, F.coalesce(v, F.lit(none_text)) if none_text is not None else v, b)
        for a, v, b in pieces
    ]
    volume_and_issue = F.nullif(F.concat_ws(" ", shown[1], shown[2]), F.lit(""))
    return F.concat_ws(", ", shown[0], volume_and_issue, *shown[3:])


def distance_line(distance: Column) -> Column:
    """Distance with three decimals, rounded from the number itself, true ties to even.

    The number is compared with the middle between two thousandths without rounding:
    its halves of 26 bits times 2000 are exact.
    """
    x = F.abs(distance.cast("double"))
    below = F.floor(x * 1000).cast("bigint")
    scaled = x * 134217729.0
    high = scaled - (scaled - x)
    side = (high * 2000.0 - (below * 2 + 1).cast("double")) + (x - high) * 2000.0
    up = (side > 0) | ((side == 0) & (below % 2 == 1))
    n = below + up.cast("bigint")
    whole = F.floor(n / 1000).cast("bigint")
    sign = F.when(distance < 0, "-").otherwise("")
    decimals = F.lpad((n - whole * 1000).cast("string"), 3, "0")
    return F.concat(F.lit("Semantic distance: "), sign, whole.cast("string"), F.lit("."), decimals)
