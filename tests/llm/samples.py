"""Small tables with everything that can be odd about documents."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        *[T.StructField(name, T.StringType()) for name in ("size", "fp", "key", "row", "label", "score", "bucket", "_keep", "_digest", "_key", "_single")],
    ]
)


def make(spark, rows):
    """Documents from (doc_id, text, source), with clashing extra columns."""
    extra = ("x",) * 11
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t), *extra) for i, t, s in rows], SCHEMA
    ).repartition(3)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    return " ".join(WORDS[(seed * 7 + i * i * 3 + i * seed) % len(WORDS)] + str((seed * 31 + i * 17) % 97) for i in range(n))


def odd_rows():
    """Nulls, empty, white space, long, tied and repeated rows."""
    long = prose(5, 20_000)
    return [
        (1, "Hello World again and again", "a"),
        (2, "hello world AGAIN and again", "a"),
        (2, "hello world AGAIN and again", "a"),
        (3, None, None),
        (4, "", "b"),
        (None, "", "b"),
        (None, None, None),
        (5, " \t\n\r", "b"),
        (6, long, "a"),
        (7, long + " end", "a"),
        (8, "one", "É"),
        (9, "Ünïcode ÄÖÜ ŝtays 東京 😀", "É"),
        (10, prose(1, 300), "a"),
        (11, prose(1, 300), "c"),
    ]
