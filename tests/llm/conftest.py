import pytest

CLASHING = ["id", "rep", "key", "seed", "row", "anchor", "token", "sha", "_salt", "_hashed", "_maybe", "_block", "_cells",
            "_flag", "_sha", "_keep", "group", "size", "part", "text_sha256", "keep_id", "Lang_Pred", "score"]
LONG = " ".join(f"word{i * 7919 % 5003} the{i % 13}" for i in range(12000))
#: Nulls, empty and blank texts, ties, repeated rows, odd characters, and a long text.
ROWS = [
    (1, "the thing is what it is", "en"), (2, "the thing is what it is", "en"), (2, "the thing is what it is", "en"),
    (3, None, "en"), (4, "", None), (5, "   \n\t ", "de"), (6, "12 345 !!!", "de"), (7, "die Tür ist über dem Öl", "de"),
    (8, LONG, "en"), (9, LONG + " end", "en"), (10, "日本語のテキスト   ﻿ x", None), (11, "a", "en"),
    (12, "\x00 \x1c odd\r\n  spaces  here <|endoftext|>", "en"), (None, "no id here but some words in it", "en"),
    (None, None, None), (13, "😀 é é ǅ İ", "fr"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Rows that every operator must take, with columns that clash with names used inside."""
    spec = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in ROWS], spec).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(edge, spark):
    return spark.createDataFrame([], edge.schema)
