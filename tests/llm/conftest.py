import pytest

# Columns that no operator may trip over: they clash with names used inside.
CLASH = "key long, fp long, h string, size string, blob string, row int, values string, short long, bundle string, part string, n long, root string, found string, day string, rank int, drawn int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) with extra columns of clashing names."""

    def build(rows, partitions=3):
        full = [(i, t, *(rest or ["en"]), "src", None if t is None else len(t)) + (1, 2, "a", "b", "c", 3, "d", 4, "e", "f", 5, "g", "h", "i", 6, 7) for i, t, *rest in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return build


@pytest.fixture
def odd_rows():
    """Null and empty texts, white space, a very long text, repeated rows, a null id and language."""
    long = "word another thing " * 12_000
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "tiny"), (5, long), (6, "same text here twice"), (6, "same text here twice"), (None, "a row without an id"),
        (7, "no language", None), (8, "12345 67890 !!!"), (9, "ünïcödé ßtraße 中文 🙂 é"),
    ]
