import pytest

# Texts that trouble operators: NULL, empty, white space only, very long, ties,
# repeats, characters outside ASCII and outside the basic plane.
HARD_TEXTS = [
    None,
    "",
    " \t\n\x0b ",
    "one",
    "naïve 😀 Straße ſ K İ",
    "\n\n\n",
    "The same line of some length\nand another line that is long\nthe SAME line of some length  ",
    "long " * 60_000,
    "x" * 150_000,
    "a\x00b \x1c c",
]


@pytest.fixture
def hard_docs(spark):
    """Hard texts, twice, with NULL ids and columns whose names operators use."""
    rows = [
        (i if i % 7 else None, t, "en" if i % 2 else None, "s" if i % 3 else None, i, "x", 1.5)
        for i, t in enumerate(HARD_TEXTS * 2)
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_lines int, `a.key` string,"
        " Score double"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_lines int"
    )


@pytest.fixture
def make_docs(spark):
    def make(texts, start=0):
        return spark.createDataFrame(
            [(start + i, t) for i, t in enumerate(texts)], "doc_id long, text string"
        )

    return make
