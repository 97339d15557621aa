"""Quality rules: a table of thresholds as one projection of built-in functions.

Every text is measured once, in the task that reads it, without a shuffle and
without user functions. Repeated word windows are found by sorting the windows of
one text by their hash, so a text of n words costs n log n.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import words

WINDOW = 3
PLACE_BITS = 24
SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the four languages of the corpus, lower case.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the to was with "
    "au aux de des du en est et la le les par pour que qui sur un une "
    "auf das dem den der die ein eine ist mit nicht sich und von zu "
    "como con del el es los no para por se su"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if ``low <= metric <= high``; a null metric passes."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


BASE_RULES = (
    Rule("too_short", "n_words", low=50),
    Rule("repetitive", "repeat_word_ratio", high=0.5),
)
RULES = (
    Rule("word_length", "mean_word_chars", low=2.0, high=15.0),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("shouting", "capital_ratio", high=0.5),
    Rule("exclamations", "exclamation_ratio", high=0.5),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
    Rule("bullets", "bullet_line_ratio", high=0.9),
    Rule("cut_lines", "ellipsis_line_ratio", high=0.5),
)


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and one column per metric, for every row of ``docs``.

    A null or empty text has no words and ratios of null. Repeated rows and null
    ids stay as they are; other columns are not carried.
    """
    # The arrays are made in a projection of their own: functions of functions read columns, not expressions.
    split = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        words(F.col(text)).alias("words"),
        F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    split = _with_repeated_windows(split)
    n_words = F.nullif(F.size("words"), F.lit(0))
    n_lines = F.nullif(F.size("lines"), F.lit(0))
    word_chars = F.length(F.array_join("words", "")).cast("long")
    counted = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        word_chars.alias("word_chars"),
        _count("text", SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered("repeated").alias("n_repeat_words"),
        F.size(F.array_intersect("words", F.array(*map(F.lit, _spellings())))).alias("n_stop_words"),
        (_count("text", "[A-Z]") / F.nullif(word_chars, F.lit(0))).alias("capital_ratio"),
        (_count("text", r"!(?![^\x20\x09-\x0D])") / n_words).alias("exclamation_ratio"),
        (F.size(F.filter("lines", lambda x: x.rlike("^[-*•–]"))) / n_lines).alias(
            "bullet_line_ratio"
        ),
        (F.size(F.filter("lines", lambda x: x.endswith("...") | x.endswith("…"))) / n_lines).alias(
            "ellipsis_line_ratio"
        ),
        n_lines.alias("n_lines"),
    )
    return counted.withColumns(
        {
            "mean_word_chars": F.col("word_chars") / F.nullif("n_words", F.lit(0)),
            "symbol_ratio": F.col("n_symbols") / F.nullif("n_words", F.lit(0)),
            "repeat_word_ratio": F.col("n_repeat_words") / F.nullif("n_words", F.lit(0)),
            "dup_line_ratio": F.col("n_dup_lines") / F.col("n_lines"),
        }
    )


def judged(docs: DataFrame, rules=RULES, base_rules=BASE_RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The metrics of each document, ``base_failed``, ``kept`` and the names of the ``failed`` rules."""
    m = measured(docs, doc_id, text)
    failed = F.filter(F.array(*[F.when(~_passes(r), F.lit(r.name)) for r in (*base_rules, *rules)]), lambda x: x.isNotNull())
    base = reduce(lambda a, b: a & b, [_passes(r) for r in base_rules], F.lit(True))
    rest = reduce(lambda a, b: a & b, [_passes(r) for r in rules], F.lit(True))
    return m.withColumns({"base_failed": ~base, "kept": base & rest, "failed": failed})


def _passes(rule: Rule) -> Column:
    metric, parts = F.col(rule.metric), []
    if rule.low is not None:
        parts.append(metric >= rule.low)
    if rule.high is not None:
        parts.append(metric <= rule.high)
    return F.coalesce(reduce(lambda a, b: a & b, parts, F.lit(True)), F.lit(True))


def _count(text: str, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _from(array: str, start: int, n: Column) -> Column:
    return F.slice(array, F.lit(start), F.greatest(n, F.lit(0)))


def _pairs(array: str) -> Column:
    """The neighbours ``a`` and ``b`` of an array; the last element has none."""
    return F.arrays_zip(F.col(array).alias("a"), _from(array, 2, F.size(array) - 1).alias("b"))


def _with_repeated_windows(split: DataFrame) -> DataFrame:
    """Adds ``repeated``: sorted places of the word windows that the text holds more than once.

    A window's hash and its place share one number, so that sorting plain numbers
    brings equal windows together. Only windows whose upper hash bits meet are
    compared word by word, so the result does not depend on the hash. Texts with
    more words than places can be numbered compare all their windows.
    """
    n = F.size("words")
    place = (1 << PLACE_BITS) - 1
    paired = split.withColumn(
        "paired",
        F.zip_with(_from("words", 1, n - 1), _from("words", 2, n - 1), lambda a, b: F.xxhash64(a, b)),
    )
    keyed = paired.withColumn(
        "keys",
        F.sort_array(
            F.transform(
                _from("paired", 1, n - (WINDOW - 1)),
                lambda x, i: F.xxhash64(x, F.get("paired", i + 1)).bitwiseAND(F.lit(~place)).bitwiseOR(i.cast("long")),
            )
        ),
    ).drop("paired")
    meeting = F.filter(_pairs("keys"), lambda p: F.shiftright(p["a"], PLACE_BITS) == F.shiftright(p["b"], PLACE_BITS))
    some = keyed.withColumn("keys", meeting).withColumn(
        "places",
        F.when(
            n <= place,
            F.transform(F.array_distinct(F.concat("keys.a", "keys.b")), lambda k: k.bitwiseAND(F.lit(place)).cast("int")),
        ).otherwise(F.sequence(F.lit(0), n - WINDOW)),
    )
    window = lambda i: F.struct(*[F.get("words", i + k).alias(f"w{k}") for k in range(WINDOW)], i.alias("place"))
    sorted_ = some.drop("keys").withColumn("windows", F.sort_array(F.transform("places", window))).drop("places")
    same = lambda p: reduce(lambda x, y: x & y, [p["a"][f"w{k}"] == p["b"][f"w{k}"] for k in range(WINDOW)])
    found = sorted_.withColumn("windows", F.filter(_pairs("windows"), same))
    return found.withColumn(
        "repeated", F.sort_array(F.array_distinct(F.concat("windows.a.place", "windows.b.place")))
    ).drop("windows")


def _covered(starts: str) -> Column:
    """Words covered by windows that begin at the given sorted places."""
    steps = F.transform(_pairs(starts), lambda p: F.least(F.lit(WINDOW), F.coalesce(p["b"] - p["a"], F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def _spellings() -> list[str]:
    return sorted({s for w in STOP_WORDS for s in (w, w.capitalize())})
