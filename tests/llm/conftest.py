import pytest

from firmfold.llm.common import configure


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the operators' settings."""
    return configure(spark)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls in every column, empty and very long texts, repeated rows, an extra column with an operator's own name."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    near = [f"n{i}" for i in range(200)]
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 3), (4, long, "en", "b", len(long)),
        (5, " ".join(near), "en", "b", 0), (5, " ".join(near), "en", "b", 0), (6, " ".join(near[:-4]), "de", None, 0),
        (None, "the same words of a row without an id and the rest of it", "en", "c", 0), (None, None, None, None, None),
        (7, "short Text", "en", "c", 10), (8, "SHORT text", "fr", "c", 10), (9, "%%% ### 123", "en", "d", 11),
        (10, "\U0001F600 日本語 text", "en", "d", 9)]
    frame = llm.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F
    return frame.withColumns({"id": F.lit("clash"), "n": F.lit(1), "class": F.lit("x"), "s": F.lit("y"), "size": F.lit(0)})


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOCS)
