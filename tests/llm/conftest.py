from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

SF = os.environ.get("TIERLINE_TEST_SF", "/root/testdata/sf0.001")

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        T.StructField("fingerprint", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("__kept", T.LongType()),
        T.StructField("ids", T.LongType()),
        T.StructField("spans", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def make_docs(spark):
    """A documents table with clashing extra columns from (doc_id, text[, lang]) rows."""

    def make(rows):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1]), "x", "y", 1, 2, "z")
            for r in rows
        ]
        return spark.createDataFrame(full, DOCS)

    return make


#: Nulls, empty, wordless, very long, repeated and equal texts.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "... --- !!!"), (5, "word"), (6, "one two three four five six seven"),
    (6, "one two three four five six seven"), (7, "one two three four five six seven"), (None, "no id here at all"),
    (8, "long " * 60000), (9, "a" * 50000), (10, "Ünïcödé ﬁ 漢字 \U0001F600 é x\x00y"), (11, "a  b\t\tc\r\n d "),
]


@pytest.fixture()
def odd_rows():
    return list(ODD)


@pytest.fixture()
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
