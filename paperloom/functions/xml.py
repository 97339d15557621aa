"""Column functions that read elements out of one citation record.

A record is a few kilobytes of well-formed XML. Character data cannot hold a
raw ``<``, so the text before an element's first child is all that precedes
the next ``<``; this needs one regular expression and no parser.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.dates import publication_date
from paperloom.functions.text import file_number, join_nonempty

# Element and attribute names of the citation format.
RECORD_START = "<PubmedArticle>"
RECORD_END = "</PubmedArticle>"
RECORD_START_PATTERN = r"<PubmedArticle[ >]"
KEPT_VERSION = "1"

_ATTRIBUTES = r"\s[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*"


def _tag(name: str) -> str:
    """Start of an element, self-closed or not."""
    return rf"<{name}(?:{_ATTRIBUTES}|/)?"


def _leading(name: str) -> str:
    """Start tag and, as group 1, the text up to the next tag."""
    return rf"{_tag(name)}(?:(?<=/)>|(?<!/)>([^<]*))"


def _block(name: str) -> str:
    """Whole element as group 1, or an empty group when self-closed."""
    return rf"(?s){_tag(name)}(?:(?<=/)>|(?<!/)>(.*?)</{name}\s*>)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def if_any(xml: Column, name: str) -> Column:
    """``xml``, or nothing when no such element can be in it: a plain search spares the pattern's walk."""
    return F.when(~xml.contains(f"<{name}"), F.lit("")).otherwise(xml)


def clean_record(raw: Column) -> Column:
    """Line ends, comments and CDATA sections as a parser would deliver them."""

    def escaped(part: Column) -> Column:
        data = F.substring_index(part, "]]>", 1)
        rest = F.substring(part, F.length(data) + F.lit(4), F.length(part))
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            data = F.replace(data, F.lit(char), F.lit(entity))
        return F.concat(data, rest)

    def without_sections(text: Column) -> Column:
        text = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
        parts = F.split(text, r"<!\[CDATA\[")
        return F.array_join(
            F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(let(p, escaped))), ""
        )

    def cleaned(text: Column) -> Column:
        return F.when(text.contains("<!"), without_sections(text)).otherwise(text)

    lines = F.when(raw.contains("\r"), F.regexp_replace(raw, r"\r\n?", "\n")).otherwise(raw)
    return let(lines, cleaned)


def decode(text: Column) -> Column:
    """Entity and character references resolved; only texts with ``&`` pay for it."""

    def resolved(t: Column) -> Column:
        wrapped = F.concat(F.lit("<t>"), t, F.lit("</t>"))
        return F.when(t.contains("&"), F.xpath_string(wrapped, F.lit("/t"))).otherwise(F.nullif(t, F.lit("")))

    return let(text, resolved)


def leading_text(xml: Column, name: str) -> Column:
    """Text before the first child of the first such element; NULL when none."""
    return decode(F.regexp_extract(if_any(xml, name), _leading(name), 1))


def full_text(xml: Column, name: str) -> Column:
    """All text of the first such element, markup removed."""
    inner = F.regexp_replace(F.regexp_extract(if_any(xml, name), _block(name), 1), r"<[^>]*>", "")
    return decode(inner)


def element_text(xml: Column, name: str, text_mode: str) -> Column:
    return full_text(xml, name) if text_mode == "full" else leading_text(xml, name)


def has_element(xml: Column, name: str) -> Column:
    return if_any(xml, name).rlike(_tag(name) + ">")


def elements(xml: Column, name: str) -> Column:
    """Every such element with its tags, in document order."""
    whole = rf"(?s){_tag(name)}(?:(?<=/)>|(?<!/)>.*?</{name}\s*>)"
    return F.regexp_extract_all(if_any(xml, name), F.lit(whole), F.lit(0))


def attribute(element: Column, name: str) -> Column:
    """Attribute of the start tag ``element`` begins with, NULL when absent or empty."""
    tag = F.regexp_extract(element, r"^<[^\s/>]+(" + _ATTRIBUTES + r")?", 1)
    quoted = F.regexp_extract(tag, rf"\s{name}\s*=\s*(\"[^\"]*\"|'[^']*')", 1)
    value = let(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2))
    return decode(F.translate(value, "\n\t", "  "))


def texts_of(xml: Column, name: str, text_mode: str = "leading") -> Column:
    return F.transform(elements(xml, name), lambda e: element_text(e, name, text_mode))


def abstract_text(xml: Column, text_mode: str = "leading") -> Column:
    """Sections with text, each under its label, an empty line between them."""

    def section(e: Column) -> Column:
        heading = F.coalesce(F.concat(attribute(e, "Label"), F.lit("\n")), F.lit(""))
        return F.concat(heading, element_text(e, "AbstractText", text_mode))

    return join_nonempty(F.transform(elements(xml, "AbstractText"), section), "\n\n")


def mesh_terms(xml: Column, text_mode: str = "leading") -> Column:
    headings = elements(xml, "MeshHeading")
    return join_nonempty(
        F.transform(headings, lambda h: element_text(h, "DescriptorName", text_mode)), "\n"
    )


def author_name(author: Column) -> Column:
    """Collective name, else ``Last, Initials``, else last name; NULL when unreadable."""
    initials = F.coalesce(F.concat(F.lit(", "), leading_text(author, "Initials")), F.lit(""))
    return F.when(
        has_element(author, "CollectiveName"), leading_text(author, "CollectiveName")
    ).otherwise(F.concat(leading_text(author, "LastName"), initials))


def with_article_columns(df: DataFrame, text_mode: str = "leading") -> DataFrame:
    """``df(record, file_name, ...)`` with the article columns in place of ``record``.

    Adds ``pmid``, ``version`` and ``error``, the first reason why the record
    cannot be taken over. Steps that later ones use several times are columns
    of their own, so that each pattern runs once per record.
    """
    xml = F.col("record")
    others = [c for c in df.columns if c != "record"]
    cut = df.select(
        *others,
        "record",
        F.regexp_extract(if_any(xml, "PMID"), _leading("PMID"), 0).alias("pmid_tag"),
        F.regexp_extract(if_any(xml, "Journal"), _block("Journal"), 1).alias("journal"),
        F.regexp_extract(if_any(xml, "PubDate"), _block("PubDate"), 1).alias("pub_date"),
        F.transform(elements(xml, "Author"), author_name).alias("author_names"),
    )
    pub_date, journal = F.col("pub_date"), F.col("journal")
    read = cut.select(
        *others,
        "record",
        "journal",
        "author_names",
        F.trim(leading_text(F.col("pmid_tag"), "PMID")).try_cast("bigint").alias("pmid"),
        attribute(F.col("pmid_tag"), "Version").alias("version"),
        *[
            leading_text(pub_date, part).alias(f"date_{part}")
            for part in ("Year", "Month", "Day", "MedlineDate")
        ],
        *[has_element(pub_date, part).alias(f"has_{part}") for part in ("Year", "Month", "Day")],
    )
    empty_part = reduce(
        lambda a, b: a | b,
        [F.col(f"has_{part}") & F.col(f"date_{part}").isNull() for part in ("Year", "Month", "Day")],
    )
    date = publication_date(
        F.col("date_Year"), F.col("date_Month"), F.col("date_Day"), F.col("date_MedlineDate")
    )
    dated = read.withColumn("publication_date", F.when(~empty_part, date))
    error = (
        F.when(F.col("pmid").isNull(), F.lit("no article id"))
        .when(~has_element(xml, "Journal"), F.lit("no journal"))
        .when(F.col("publication_date").isNull(), F.lit("unreadable publication date"))
        .when(F.exists("author_names", lambda a: a.isNull()), F.lit("unreadable author"))
    )
    return dated.select(
        *others,
        "pmid",
        "version",
        error.alias("error"),
        element_text(xml, "ArticleTitle", text_mode).alias("title"),
        abstract_text(xml, text_mode).alias("abstract"),
        "publication_date",
        mesh_terms(xml, text_mode).alias("mesh_terms"),
        join_nonempty(texts_of(xml, "Keyword", text_mode), "\n").alias("keywords"),
        join_nonempty(texts_of(xml, "NameOfSubstance", text_mode), "\n").alias("chemicals"),
        join_nonempty(F.col("author_names"), "\n").alias("authors"),
        leading_text(journal, "ISOAbbreviation").alias("journal_name"),
        F.year("publication_date").alias("year"),
        leading_text(journal, "Volume").alias("volume"),
        leading_text(journal, "Issue").alias("issue"),
        leading_text(xml, "MedlinePgn").alias("pagination"),
        join_nonempty(texts_of(xml, "PublicationType", text_mode), "\n").alias("publication_types"),
        file_number(F.col("file_name")).alias("file_number"),
    )


def deleted_ids(xml: Column, first_only: bool = False) -> Column:
    """Ids in the delete blocks; all of them, or the first of each block."""

    def ids(block: Column) -> Column:
        found = texts_of(block, "PMID")
        return F.slice(found, 1, 1) if first_only else found

    nested = F.flatten(F.transform(elements(xml, "DeleteCitation"), ids))
    return F.transform(F.filter(nested, lambda t: t.isNotNull()), lambda t: F.trim(t).cast("bigint"))
