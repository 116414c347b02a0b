import pytest

#: Columns named like those that operators use inside, and a null in every column somewhere.
EXTRA = ", _doc long, _key string, _text string, _size double, key long, copy string, score string, label string, a long"


@pytest.fixture
def awkward(spark):
    """Makes documents of ``(doc_id, text, lang, source)`` with further columns of clashing names."""

    def made(rows):
        full = [(*row, 1, "k", None, 0.5, None, "x", "y", "z", 7) for row in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string" + EXTRA)

    return made
