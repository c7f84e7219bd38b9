import pytest

LONG = "word " * 30_000 + "\n" + "last line\n" * 50
ROWS = [
    (1, "The quick brown fox\njumps over the lazy dog", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "de", "a"),
    (5, LONG, "en", "b"),
    (6, "THE quick brown fox\njumps over the lazy dog", "en", "b"),
    (7, "the QUICK brown fox\njumps over the lazy dog", "en", None),
    (7, "the QUICK brown fox\njumps over the lazy dog", "en", None),
    (None, "no id here " * 30, "en", "c"),
    (8, "naïve café Ünïcode ✓ 漢字 <|endoftext|> it's x y İ ς", "fr", "b"),
    (9, "a b c a b c a b c\n\na b c\n$$ || ##", "en", "ä"),
    (10, "one", "en", "c"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and blank texts, a very long one, ties, a repeated row, clashing extra columns."""
    schema = "doc_id long, text string, lang string, source string, kept boolean, size string, n_words int, digest string, class_id int, pii string, row int"
    return spark.createDataFrame([(*r, None, "s", 1, "d", 2, "p", 3) for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
