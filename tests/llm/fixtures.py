"""Small tables with the awkward rows that every operator must take."""
from pyspark.sql import types as T

LONG = "Word " * 30_000 + "token = 'abcdef123456'"
AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog", 1),
    (2, "the quick brown fox jumps over the lazy dog", 1),
    (2, "the quick brown fox jumps over the lazy dog", 1),
    (3, None, None),
    (4, "", 0),
    (5, " \n\t ", 3),
    (None, "the quick brown fox jumps over the lazy dog", None),
    (None, None, None),
    (6, LONG, len(LONG)),
    (7, "É ñ ü 漢字 \U0001F600 x", 10),
]


def awkward(spark, **renamed):
    """doc_id, text, and columns whose names clash with the operators' own."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
                           *(T.StructField(c, T.StringType()) for c in ("utf8", "secret_spans", "toxicity", "row_key", "key", "node", "pseudonyms"))])
    df = spark.createDataFrame([(*r, "u", "s", "t", "r", "k", "n", "p") for r in AWKWARD], schema)
    return df.withColumnsRenamed(renamed)


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")
