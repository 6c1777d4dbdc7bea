import pytest

#: Rows that every operator on texts must stand: nulls, empties, ties, repeats, long texts.
LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again and again."),
    (2, None), (3, ""), (4, " \t\r\n\x0b\x0c "), (None, "a row without an id, kept all the same"),
    (5, "one"), (6, "one two"), (7, "Äpfel und Öl: naïve café № ﬁ 東京 タワー 😀 end"),
    (8, "same text twice"), (8, "same text twice"), (9, "same id, another text"), (9, "other"),
    (10, LONG), (11, LONG), (12, "a a a a a a a a"), (13, "x" * 5000),
    (14, "line\nline\n\nline \n other\nline"), (None, None),
]
SCHEMA = "doc_id long, text string, fp string, key long, n_words string, text_hash string, " \
         "lang string, source string, n_chars long"


def documents(spark, rows):
    """Rows as documents, with columns whose names clash with the operators' own."""
    return spark.createDataFrame(
        [(i, t, "x", 7, None, "y", "en", "s", None if t is None else len(t)) for i, t in rows],
        SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return documents(spark, ROWS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])
