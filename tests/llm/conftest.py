import pytest

ODD = [
    (1, None, "en", "a", 1),
    (2, "", None, "a", 0),
    (3, "one two", "en", None, 7),
    (4, "word " * 60000, "en", "b", 300000),
    (5, "Der Hund läuft. " * 3 + "\n\n \t\nZeile", "de", "a", None),
    (6, "same text as the next one, in full\nshared line", "en", "a", 46),
    (7, "same text as the next one, in full\nshared line", "en", "a", 46),
    (7, "same text as the next one, in full\nshared line", "en", "a", 46),
    (None, "no id at all", "xx", "c", 12),
    (9, "\n \r\x0b", "en", "a", 4),
    (10, "é ü ß 漢字 😀 " * 30, "zz", "b", 300),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use for their own results.
CLASHES = ["n_words", "kept", "n_lines", "n_dropped", "epoch", "block", "host", "key", "id", "place", "row", "tokens", "words", "all", "lines", "_id", "_spans", "spans", "mark", "text_key"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns with clashing names."""
    df = spark.createDataFrame(ODD, SCHEMA)
    for name in CLASHES:
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
