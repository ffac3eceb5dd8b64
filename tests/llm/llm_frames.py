"""Small tables with everything that may go wrong in them."""

import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

LONG = "lorem ipsum dolor sit amet " * 40_000

#: (doc_id, text): nulls, empty and blank texts, one very long one, ties, repeated rows.
ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the angry bear."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b "),
    (None, "A text without an id, which is scored like any other one of its kind."),
    (6, LONG),
    (7, "42 1234 --- !!!"),
    (7, "42 1234 --- !!!"),
    (8, "naïve café — 日本語 텍스트 😀 \x00 \x1c end"),
]


def documents(spark, rows, clash=True):
    """Documents with columns whose names operators use inside or differ in case alone."""
    extra = ["score", "label", "key", "node", "kept", "place", "TEXT"] if clash else []
    fields = ["doc_id long", "text string", "lang string", "source string", "n_chars long"]
    schema = ", ".join([*fields, *[f"{name} string" for name in extra]])
    full = []
    for row in rows:
        doc_id, text, *lang = row
        full.append((doc_id, text, lang[0] if lang else None, "src", 0, *["x"] * len(extra)))
    return spark.createDataFrame(full, schema)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, extra string")


def rows_of(df, *columns):
    """Rows as tuples in an order of their own."""
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


def duck(sf_dir=SF_DIR):
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection
