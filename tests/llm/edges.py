"""Tables of awkward rows: nulls in any column, empty and very long texts, repeated rows, clashing column names."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet consectetur " * 6000

ROWS = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 62),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n\n ", "de", "", 5),
    (5, "short", "en", "b", 5),
    (6, LONG, "la", "b", len(LONG)),
    (7, "one two three four five six seven eight nine ten eleven twelve", "en", None, 62),
    (7, "one two three four five six seven eight nine ten eleven twelve", "en", None, 62),
    (None, "one two three four five six seven eight nine ten eleven twelve", None, "c", None),
    (8, "line a b\nline c d\nline e f\n\nline a b\nline c d\n", "en", "a", 47),
    (9, "ünï cödé \u4f60\u597d\u4e16\u754c \U0001f600 é\u0301 \u00a0x", None, "a", 20),
    (10, "x" * 70000, "xx", "a", 70000),
]
#: Names that operators use for their own columns.
CLASHING = ["key", "row", "size", "target", "shards", "n_lines", "n_removed", "n_chunks", "n_repeated", "removed", "spans", "kept",
            "node", "part", "ids", "component", "d", "h", "t", "rank", "block", "shard", "_copy"]


def edge_docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_by_key(df, key="key"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out
