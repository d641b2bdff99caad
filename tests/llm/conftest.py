import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from catlens.llm.shared import ship

    ship(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows with columns in another order and columns that clash with names used inside."""

    def make(rows):
        full = [(f"x{i}", t, i, d, "en" if i % 3 else None, f"src{i % 2}", 0.5, "z") for i, (d, t) in enumerate(rows)]
        return spark.createDataFrame(full, "node string, text string, k long, doc_id long, lang string, source string, score double, extra string")

    return make
