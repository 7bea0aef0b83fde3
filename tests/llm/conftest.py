import pytest

HARD = [
    None, "", " \n\t", "one", "One two three", "a b c d e", "A B C D E", "é è ñ 你好 😀 a", "x " * 3000,
    "word. word, word; l'été 12,345.67 can't it's", "z" * 5000,
]


@pytest.fixture(scope="session")
def hard(spark):
    """Null, empty and long texts, ties, a repeated row, a null id, and clashing names."""
    rows = [(k, t, "en", "s", 1, "x", 0, 7) for k, t in enumerate(HARD)]
    rows += [rows[5], (None, "a b c d e", None, None, None, None, None, None), (99, "one", "en", "s", 1, "y", 1, 8)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id string, bucket int, component long"
    )


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
