"""Rows that operators must bear: nulls anywhere, empty and long texts, ties, repeats, clashing extra columns."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for results or inside.
        T.StructField("size", T.StringType()),
        T.StructField("component_id", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("node", T.StringType()),
    ]
)

LONG = " ".join(f"word{i % 997} of\nthe {i}" for i in range(60_000))
PLAIN = "The old house by the river was sold last year, and nobody in the village knows who lives there now."


def rows():
    base = [
        (1, PLAIN, "en", "a"),
        (2, PLAIN, "en", None),
        (2, PLAIN, "en", None),
        (2, PLAIN, "en", None),
        (3, None, "en", "b"),
        (4, "", None, "b"),
        (5, " \t\n ", "fr", "c"),
        (6, "?!... 123 --", "de", "c"),
        (None, PLAIN, None, None),
        (None, None, None, None),
        (None, None, None, None),
        (7, LONG, "en", "a"),
        (8, PLAIN.replace("sold", "bought"), "en", ""),
        (9, "one", "en", "a"),
        (10, "one", "en", "a"),
        (-5, "Das alte Haus am Fluss wurde verkauft.\nDas alte Haus am Fluss wurde verkauft.", "de", "ß"),
        (11, "a  double space, 　 a wide one \n and trailing ", "en", "z"),
        (12, "x" * 300_000, "en", "z"),
        (13, "\x00 odd ퟿ signs \U0001f600 ‍ here", "en", "z"),
    ]
    return [(i, t, l, s, None if t is None else len(t), "x", None, "1", "n", "k") for i, t, l, s in base]


def documents(spark, few=None):
    return spark.createDataFrame(rows()[:few] if few is not None else rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
