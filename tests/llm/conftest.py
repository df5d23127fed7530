import pytest

CLASHING = ["row", "node", "held", "word", "n", "score", "id", "key", "length", "block", "place", "kinds"]
AWKWARD = [
    (1, "one two three four five six seven", "en"),
    (1, "one two three four five six seven", "en"),  # a repeated row
    (1, "another text under the same id", "en"),
    (None, "a text without an id", None),
    (None, None, None),
    (2, None, "fr"),
    (3, "", "fr"),
    (4, " \t\n ", None),
    (5, "12 -- 34", "de"),
    (6, "ONE  two\tthree four five six seven", "en"),
    (7, "long " * 30_000, "en"),
    (8, "x" * 100_000, "de"),
    (9, "é▁ ß 日本語 🎉 <|endoftext|> </s>", "es"),
    (-5, "one two three four five six seven", "en"),
]


@pytest.fixture
def make(spark):
    """Documents with extra columns whose names an operator might use itself."""

    def build(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"{c} string" for c in CLASHING
        )
        return spark.createDataFrame(
            [(i, t, lang, "src", None if t is None else len(t), *CLASHING) for i, t, lang in rows], schema
        )

    return build


@pytest.fixture
def awkward(make):
    return make(AWKWARD)


@pytest.fixture
def nothing(make):
    return make([])


@pytest.fixture
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
