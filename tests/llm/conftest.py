import pytest

from tidemark.llm.queries import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text, extra columns whose names clash with those of results)."""

    def make(rows):
        full = [(i, t, "en", "s", "x", 7, True, "y") for i, t in rows]
        return spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, ids string, n_words int, kept boolean, labels string",
        )

    return make


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and blank texts, odd characters, repeated rows and ids, a long text."""
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "Zwei  Wörter\u3000\u00a0 don't"),
        (None, "no id here"), (6, long), (6, "other text, same id"), (7, "tab\tand\r\nreturn \x1c end"),
        (8, "\U0001f600 emoji \u0130\u00df"), (None, None),
    ]
