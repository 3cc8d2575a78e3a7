import pytest

WEIRD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two three"),
    (4, "one two three"),
    (None, "no id here, seven words in this one"),
    (5, "a " * 40_000),
    (6, "x" * 200_000),
    (7, "İstanbul ſecret K ▁ é日本 \U0001f600 \x00 nul"),
]


@pytest.fixture(scope="session")
def weird(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with the operators' own."""
    rows = [(i, t, 1, "x", "y") for i, t in WEIRD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, id int, spans string, print string")
