import pytest

from tests.conftest import spark  # noqa: F401


@pytest.fixture
def docs(spark):  # noqa: F811
    """Rows with nulls, empty and blank texts, repeats, a long text and clashing extra columns."""
    long = " ".join(f"word{i % 700} item{i % 311}" for i in range(20_000))
    base = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree " * 6
    rows = [(1, base, "en"), (2, base, "en"), (2, base, "en"), (3, base + "at night", None), (4, None, "de"),
            (5, "", "de"), (6, " \t\n", None), (None, base, "en"), (7, "drei kurze Worte", "de"), (8, long, "en"),
            (9, "Der alte Mann geht mit dem Hund durch den Wald und singt " * 9, "de"),
            (10, "été à la plage avec les enfants et le chien noir " * 12, "fr"), (11, "12 34 !!", "fr")]
    return spark.createDataFrame([(i, t, g, "s", "x", 1.0) for i, t, g in rows],
                                 "doc_id long, text string, lang string, source string, score string, node double")


@pytest.fixture
def no_docs(docs):
    return docs.limit(0)
