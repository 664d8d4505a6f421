from __future__ import annotations

import os

import pytest

os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")

#: Names that operators use inside; rows carry them as further columns.
CLASHING = ["key", "keep_id", "sha", "ids", "row", "place", "rep", "regs", "band", "label", "score", "text_hash", "_reported", "_repeated", "_sha", "n_tokens", "leaf"]

LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(30_000))
ODD_TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog and runs away from the hunters."),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "the  QUICK brown\tfox jumps over the lazy dog and runs away from the hunters."),
    (5, "The quick brown fox jumps over the lazy dog and runs away from the hunters."),
    (6, LONG),
    (7, LONG + " more"),
    (8, "one"),
    (9, "one"),
    (9, "one"),
    (9, "two words"),
    (None, "one"),
    (None, "nobody else has this"),
    (None, None),
    (10, "日本語の文章です。 <|endoftext|> Ünïcödé　 text's end\n\n\n  x"),
    (11, "12345 !!! 67"),
    (12, "Der schnelle Fuchs läuft über die Straße und die Häuser sind groß und schön."),
]


def _table(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F

    taken = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in taken})


@pytest.fixture(scope="session")
def odd_rows():
    return [(i, t, lang) for (i, t), lang in zip(ODD_TEXTS, ["en", None, "en", "de", "en", "en", None, "en", "en", "en", "en", "en", "en", "en", None, "ja", "en", "de"])]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return _table(spark, odd_rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return _table(spark, [], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows, schema: _table(spark, rows, schema)


@pytest.fixture(scope="session")
def given(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


@pytest.fixture(scope="session")
def library():
    from tokenizers import Tokenizer

    from dugout.llm.tokens import default_tokenizer

    return Tokenizer.from_file(default_tokenizer())


@pytest.fixture(scope="session")
def plain_ids(library):
    return lambda text: library.encode(text or "", add_special_tokens=False).ids
