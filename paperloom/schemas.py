"""Fixed schemas; nothing in the library infers a schema from data."""

from pyspark.sql import types as T

ARTICLE_FIELDS = [
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("publication_date", T.DateType()),
    T.StructField("mesh_terms", T.StringType()),
    T.StructField("keywords", T.StringType()),
    T.StructField("chemicals", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("journal_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("volume", T.StringType()),
    T.StructField("issue", T.StringType()),
    T.StructField("pagination", T.StringType()),
    T.StructField("publication_types", T.StringType()),
    T.StructField("file_number", T.IntegerType()),
]
ARTICLE_COLUMNS = [f.name for f in ARTICLE_FIELDS]

ARTICLES = T.StructType([T.StructField("pmid", T.LongType(), False), *ARTICLE_FIELDS])

# One row per published change: the article columns are NULL for a delete.
CHANGES = T.StructType(
    [
        T.StructField("pmid", T.LongType(), False),
        T.StructField("file_name", T.StringType()),
        T.StructField("is_delete", T.IntegerType()),
        T.StructField("pos", T.LongType()),
        *ARTICLE_FIELDS,
    ]
)
CHANGE_ORDER = ["file_name", "is_delete", "pos"]

VECTORS = T.StructType(
    [
        T.StructField("pmid", T.IntegerType(), False),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

RUN = T.StructType(
    [
        T.StructField("query_id", T.IntegerType()),
        T.StructField("pmid", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("system", T.StringType()),
    ]
)

QRELS = T.StructType(
    [
        T.StructField("query_id", T.IntegerType()),
        T.StructField("pmid", T.LongType()),
        T.StructField("rel", T.IntegerType()),
    ]
)

QUERIES = T.StructType(
    [
        T.StructField("query_id", T.IntegerType()),
        T.StructField("query", T.StringType()),
    ]
)

QUESTION_FILE = T.StructType(
    [
        T.StructField(
            "questions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("body", T.StringType()),
                        T.StructField("documents", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        )
    ]
)
