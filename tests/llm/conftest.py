import pytest

#: Rows that every operator must take: nulls, empty and white texts, ties, repeats, odd characters, a long word.
ODD = [
    (1, "the cat and the dog"), (2, None), (3, ""), (4, "  \n\t "), (5, "the cat and the dog"), (5, "the cat and the dog"),
    (None, "no id at all"), (None, None), (7, "é ß 日本語 😀 x <|endoftext|> İ ▁ \x00"), (8, "x" * 5000), (9, "the end. " * 900),
    (-(2**63), "least"), (2**63 - 1, "greatest"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows in a table whose other columns have the names that operators use inside."""
    rows = [(d, t, "src", 7, 1, 2, "z", [1]) for d, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, score int, range int, `text_id` string, words array<int>")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
