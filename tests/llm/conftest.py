import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{k % 977}x{k % 31}" for k in range(60_000))

#: Null keys and texts, no letters, repeated rows, ties, a very long text, odd code points.
AWKWARD = [
    (None, "a text without a key, but with some words in it", "en", "s1"),
    (1, None, "en", "s1"),
    (2, "", None, None),
    (3, " \t\n ", "fr", "s2"),
    (4, "12 34 !!", "en", "s2"),
    (5, "same words here again and again", "en", "s1"),
    (5, "same words here again and again", "en", "s1"),
    (6, "same words here again and again", "en", "s3"),
    (7, LONG, "en", "s1"),
    (8, "naïve café\x00 \x85 日本語 🙂 ﻿<|endoftext|> x" + "y" * 300, "fr", "s4"),
    (9, "y" * 5000, "de", "s4"),
    (5, "other text under a repeated key", "de", "s1"),
]
#: Columns that operators use for themselves.
CLASHING = "0L n, 'x' hash, 'y' part, 'z' line, 1 row, 2.5D score, 'q' kept, 'w' lang_pred, 3 n_removed, 4 n_lines, 'i' id"


@pytest.fixture(scope="session")
def awkward(spark):
    rows = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string")
    return rows.selectExpr("*", "cast(length(text) as bigint) n_chars", *CLASHING.split(", "))


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [(row.doc_id, row.text) for row in documents.select("doc_id", "text").collect()]
