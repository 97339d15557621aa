import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.functions import dates, text as X, vectors as V


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_half_precision_matches_ieee(spark):
    rng = np.random.default_rng(3)
    xs = np.concatenate([
        rng.normal(size=500), rng.normal(size=200) * 1e-6, rng.normal(size=200) * 1e4,
        [0.0, 1.0, -2.0, 65504.0, 6e-8, 2.9e-8, 1e-9, 0.1, 2049.0, 2051.0, 1 + 2**-11, 1 + 3 * 2**-11],
    ]).astype(np.float32)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, x float")
    got = {r.i: r.h for r in df.select("i", V.to_half(F.col("x")).alias("h")).collect()}
    expected = xs.astype(np.float16).astype(np.float32)
    assert all(got[i] == expected[i] for i in range(len(xs)))
    with pytest.raises(Exception, match="half-precision"):
        df.limit(1).select(V.to_half(F.lit(70000.0))).collect()


def test_cosine_distance_edges(spark):
    rows = [
        ([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]),
        ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<float>, b array<float>")
    d = [r.d for r in df.select("i", V.cosine_distance(F.col("a"), F.col("b")).alias("d")).orderBy("i").collect()]
    assert d[:3] == [0.0, 2.0, 1.0] and math.isnan(d[3]) and d[4] is None
    bad = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="differ in length"):
        bad.select(V.cosine_distance(F.col("a"), F.col("b"))).collect()
    order = df.filter("i in (0, 3)").orderBy(V.cosine_distance(F.col("a"), F.col("b"))).collect()
    assert [r.i for r in order] == [0, 3]


def test_literals_and_dimension(spark):
    v = F.array(F.lit(1.5), F.lit(-2.0)).cast("array<float>")
    assert one(spark, V.vector_to_literal(v)) == "[1.5,-2.0]"
    assert one(spark, V.literal_to_vector(F.lit(" [1.5, -2,3e-1] "), "double")) == [1.5, -2.0, 0.3]
    assert one(spark, V.literal_to_vector(F.lit("[]"))) == []
    assert one(spark, V.require_dimension(v, 2)) == [1.5, -2.0]
    with pytest.raises(Exception, match="expected 3 dimensions"):
        one(spark, V.require_dimension(v, 3))


def test_wide_columns_follow_their_number(spark):
    df = spark.createDataFrame([(1, list(map(float, range(12))))], "pmid int, embedding array<float>")
    wide = V.to_wide(df, 12)
    shuffled = wide.select("pmid", *sorted(wide.columns[1:]))
    assert V.from_wide(shuffled).first().embedding == list(map(float, range(12)))


DATE_CASES = [
    (("2001", None, None, None), dt.date(2001, 1, 1)),
    ((" 2001 ", "Mar", "5", None), dt.date(2001, 3, 5)),
    (("2001", "mar", None, None), dt.date(2001, 3, 1)),
    (("2001", "DEC", "31", None), dt.date(2001, 12, 31)),
    (("2001", "03", "07", None), dt.date(2001, 3, 7)),
    (("2001", "3", None, None), dt.date(2001, 3, 1)),
    (("99", "3", "2", None), dt.date(99, 3, 2)),
    (("99", "Mar", "2", None), None),
    (("2001", "Feb", "31", None), None),
    (("2001", "13", "1", None), None),
    (("2001", "March", "1", None), None),
    (("2001", "Spring", None, None), None),
    ((None, None, None, "1998"), dt.date(1998, 1, 1)),
    ((None, None, None, "1998 Dec-1999 Jan"), dt.date(1998, 1, 1)),
    ((None, None, None, "1998-1999 Winter"), dt.date(1998, 1, 1)),
    ((None, None, None, "Spring 2001"), dt.date(2001, 1, 1)),
    ((None, None, None, "12 Jan 2001"), dt.date(12, 1, 1)),
    ((None, None, None, "19"), dt.date(19, 1, 1)),
    ((None, None, None, "0000"), None),
    ((None, None, None, "20011 x"), None),
    ((None, None, None, "unknown"), None),
    ((None, None, None, None), None),
    (("", None, None, "1998"), dt.date(1998, 1, 1)),
]


def test_publication_dates(spark):
    rows = [(i, *c[0]) for i, c in enumerate(DATE_CASES)]
    df = spark.createDataFrame(rows, "i int, y string, m string, d string, t string")
    date = dates.publication_date(*[F.col(c) for c in "ymdt"])
    got = {r.i: r.x for r in df.select("i", date.alias("x")).collect()}
    for i, (parts, expected) in enumerate(DATE_CASES):
        assert got[i] == expected, parts


def test_ordinals(spark):
    for day in (dt.date(1, 1, 1), dt.date(1970, 1, 1), dt.date(2024, 3, 1), dt.date(9999, 12, 31)):
        assert one(spark, dates.date_ordinal(F.lit(day.isoformat()).cast("date"))) == day.toordinal()
        assert one(spark, dates.ordinal_to_date(F.lit(day.toordinal()))) == day


def test_text_functions(spark):
    n = F.lit(None).cast("string")
    assert one(spark, X.embedding_text(F.lit("T"), F.lit("A"), F.lit("m1\nm2"), F.lit("k"), F.lit("c"))) == (
        "T\n\nA\n\nMeSH terms:\nm1\nm2\n\nKeywords:\nk\n\nChemicals:\nc\n\n"
    )
    assert one(spark, X.embedding_text(n, F.lit(""), n, n, n)) == "\n\n"
    assert one(spark, X.embedding_text(n, n, n, n, n)) == ""
    assert one(spark, X.file_number(F.lit("med24n1402.xml.gz"))) == 1402
    assert one(spark, X.file_number(F.lit("med24.xml.gz"))) is None
    urls = F.array(F.lit(X.DOCUMENT_URL_PREFIX + "15"), F.lit(X.DOCUMENT_URL_PREFIX + "7"))
    assert one(spark, X.urls_to_ids(urls)) == [15, 7]
    assert one(spark, X.lines_to_ids(F.lit("3\n1\r\n2\n"))) == [3, 1, 2]
    assert one(spark, X.lines_to_ids(F.lit(""))) == []
    assert one(spark, X.ids_to_lines(F.array(F.lit(3), F.lit(1)))) == "3\n1"
    for value in (0.0625, 0.0005, 0.0025, 0.0015, 0.1875, 1.0005, 0.9995, 1.9999, 0.0, -0.0004, 12.3445, 2 / 3):
        assert one(spark, X.distance_line(F.lit(value))) == f"Semantic distance: {value:.3f}"
    assert one(spark, X.article_url(F.lit(5))).endswith("/5/")
    args = [F.lit("J"), n, F.lit("2"), n, F.lit(2020), F.lit(9)]
    assert one(spark, X.citation(*args)) == "J, (Issue 2), 2020, PMID: 9"
    assert one(spark, X.citation(*args, none_text="None")) == "J, Vol. None (Issue 2), pp. None, 2020, PMID: 9"


def test_sql_types(spark):
    cases = {
        "INTEGER": "INTEGER", "bigint": "INTEGER", "VARCHAR(9)": "TEXT", "text": "TEXT", "BLOB": "BYTEA",
        "REAL": "DOUBLE PRECISION", "float": "DOUBLE PRECISION", "DOUBLE": "DOUBLE PRECISION", "DATE": "TEXT",
        "POINT": "INTEGER",
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.x for r in df.select("t", X.target_sql_type(F.col("t")).alias("x")).collect()} == cases
