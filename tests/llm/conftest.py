import pytest

ODD_TEXTS = [
    None,
    "",
    " ",
    "a",
    "  two  blanks ",
    "line\n\n lines \n",
    "don't I'll <|endoftext|> it's <|ENDOFTEXT|>",
    "İstanbul ẞ é e\u0301 ½ ² １２ 日本語 テスト",
    "tab\tone \x1c two\x1d three\u00a0nbsp \u2003em",
    "!!! ### $$$ 1,000.50",
    "x" * 3000,
    "word " * 2000,
    "word " * 2000,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, odd, long and repeated texts, a null id, and columns whose names clash with results."""
    rows = [(i if i != 4 else None, t, i, "k") for i, t in enumerate(ODD_TEXTS)]
    rows += [(1, "", 0, "k"), (3, "a", 0, "k")]
    schema = "doc_id long, text string, n_tokens int, score string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_tokens int, score string")
