"""Small tables with the cases every operator has to stand."""

import pytest

LONG = "word " * 30_000 + "end"
TEXTS = [
    "The quick brown fox jumps over the lazy dog near the old river bank today.",
    "The quick brown fox jumps over the lazy dog near the old river bank today.",
    "The quick  brown fox jumps over the lazy dog near the old river bank today. ",
    "",
    None,
    " \n\t",
    LONG,
    LONG + " more",
    "A|b!! ÉÉ ß 12½ <|endoftext|> x",
    "All rights reserved. CC BY 4.0 and CC\nBY; general public license",
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and extra columns with clashing names."""
    rows = [(i, t, "en", f"src{i % 2}", 1, 5, "x") for i, t in enumerate(TEXTS)]
    rows += [(0, TEXTS[0], "en", "src0", 1, 5, "x"), (None, TEXTS[0], None, None, None, None, None), (None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, digest string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return spark.createDataFrame([], edge_docs.schema)
