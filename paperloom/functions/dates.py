"""Publication dates: structured parts, free text, ordinals.

Every parser returns NULL where the date is unreadable; callers decide
whether that fails the job or quarantines the record.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month abbreviations in calendar order.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# Fixed value: days from 0001-01-01 (day 1) to 1970-01-01.
ORDINAL_OF_EPOCH = 719163


def _whole_number(text: Column) -> Column:
    return F.when(text.rlike(r"^\s*\d{1,9}\s*$"), F.trim(text).try_cast("int"))


def _date_or_null(year: Column, month: Column, day: Column) -> Column:
    valid = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    text = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.when(valid, F.try_to_date(text, "yyyy-MM-dd"))


def date_components(year: Column, month: Column, day: Column) -> tuple[Column, Column, Column]:
    """Trimmed parts; an absent month or day counts as the first."""
    return (
        F.trim(year),
        F.coalesce(F.trim(month), F.lit("01")),
        F.coalesce(F.trim(day), F.lit("01")),
    )


def parse_date(year: Column, month: Column, day: Column) -> Column:
    """Date from text parts; the month is an abbreviation in any case, or a number.

    The abbreviation form needs a four-digit year, the numeric form does not.
    """
    position = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.trim(month)))
    named = F.when(position > 0, position.cast("int"))
    y, d = _whole_number(year), _whole_number(day)
    by_name = F.when(
        F.trim(year).rlike(r"^\d{4}$") & F.trim(day).rlike(r"^\d{1,2}$"), _date_or_null(y, named, d)
    )
    return F.coalesce(by_name, _date_or_null(y, _whole_number(month), d))


def parse_free_text_date(text: Column) -> Column:
    """First of January of the year a free-text date names.

    Tried in turn: the text is a four-digit year; its first word is a number;
    it starts with a number; it ends with one.
    """
    head, tail = F.substring(text, 1, 4), F.right(text, F.lit(4))
    first_word = F.split(F.ltrim(text), r"\s+")[0]
    year = (
        F.when(text.rlike(r"^\d{4}$"), text)
        .when(text.contains(" ") & first_word.rlike(r"^\d+$"), first_word)
        .when(head.rlike(r"^\d+$"), head)
        .when(tail.rlike(r"^\d+$"), tail)
    )
    return _date_or_null(_whole_number(year), F.lit(1), F.lit(1))


def publication_date(year: Column, month: Column, day: Column, free_text: Column) -> Column:
    """Structured date when a year is given, else the free-text form."""
    y, m, d = date_components(year, month, day)
    return F.when(F.coalesce(y, F.lit("")) != "", parse_date(y, m, d)).otherwise(
        parse_free_text_date(free_text)
    )


def date_ordinal(date: Column) -> Column:
    """Days since 0000-12-31 in the proleptic Gregorian calendar."""
    return (F.unix_date(date) + F.lit(ORDINAL_OF_EPOCH)).cast("int")


def ordinal_to_date(ordinal: Column) -> Column:
    return F.date_from_unix_date(ordinal - F.lit(ORDINAL_OF_EPOCH))
