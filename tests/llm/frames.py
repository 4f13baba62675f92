"""Small text tables with every awkward case."""

import random

import duckdb

# Columns whose names operators use inside.
CLASHING = "key string, score string, text_of int, matches int, _label string, _0 string, _row int"


def docs(spark, rows, clashing=True):
    """documents from (doc_id, text[, lang]) with clashing extra columns."""
    extra = ("k", "s", 1, 2, "l", "z", 3) if clashing else ()
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), *extra) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(full, schema + (", " + CLASHING if clashing else ""))


def sample(sf="sf0.001", table="documents", columns="doc_id, text, lang", limit=200):
    sql = f"SELECT {columns} FROM '/root/testdata/{sf}/{table}.parquet' ORDER BY 1 LIMIT {limit}"
    return duckdb.sql(sql).fetchall()


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "12345 ... !!!"),
    (5, "same text twice here, more or less so"),
    (6, "same text twice here, more or less so"),
    (6, "same text twice here, more or less so"),
    (None, "same text twice here, more or less so"),
    (None, None),
    (9, "word " * 30_000),
    (10, "x" * 100_000),
    (11, "ÄÖÜ ß 日本語 \U0001f600 é"),
    (12, "a\0b"),
]


def by_id(df, *columns):
    """Rows as tuples by id; ids without repeats only."""
    return {row.doc_id: tuple(row[c] for c in columns) for row in df.collect()}


def random_words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]
