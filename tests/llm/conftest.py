import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans int, n_lines int, score string, node int"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with extra columns whose names clash with those that operators add."""

    def make(rows):
        full = [(i, t, *(r + ("en", "s", None)[len(r):]), 7, 8, "x", 9) for i, t, *r in [(x[0], x[1], *x[2:]) for x in rows] for r in [tuple(r)]]
        return spark.createDataFrame(full, DOCS)

    return make
