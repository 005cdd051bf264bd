"""Frames of documents with the cases that every operator has to take, and words the plain way."""

import re

import pytest

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = "/root/testdata/sf0.001"
EMPTY = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def shown(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest table and rows with null, empty, repeated, tied and odd values."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows += [
        (None, None), (2_000_000, ""), (2_000_000, "ab" * 1000), (2_000_001, "z" * 5000), (2_000_002, rows[7][1]),
        (2_000_002, rows[7][1]), (2_000_003, "one two"), (2_000_004, "One, two"), (None, "a b c d e f"),
        (None, "a b c d e f"), (2_000_005, " \n\t"), (2_000_006, "漢字 \u00e9\u00e8 <|im_end|> \\ 🎉"),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, documents):
    """As a frame, with further columns whose names the operators use inside."""
    frame = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(3)
    return frame.selectExpr("*", "1 AS n_words", "'x' AS _score", "2 AS key", "3 AS _text_key", "4 AS _spans").cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EMPTY)
