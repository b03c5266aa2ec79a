import pytest
from pyspark.sql import Row

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the quick brown fox jumps over a lazy dog while seven grey birds sing in old trees near our quiet river bank".split()


def prose(seed: int, n: int) -> str:
    """``n`` words, the same for the same seed."""
    out, state = [], seed * 7919 + 17
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[(state >> 16) % len(WORDS)] + str((state >> 8) % 97))
    return " ".join(out)


def hard_rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, repeated rows, odd characters."""
    long_text = prose(5, 30_000)
    return [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (None, prose(1, 80), "en", None, 1),
        (None, prose(1, 80), None, "b", 1),
        (4, prose(1, 80), "en", "a", 1),
        (5, prose(1, 80), "en", "b", 1),
        (5, prose(1, 80), "en", "b", 1),
        (6, prose(1, 79) + " changed", "de", "é", 1),
        (7, prose(2, 60), "", "", 1),
        (7, prose(3, 60), None, "a", 1),
        (8, long_text, "en", "a", 1),
        (9, long_text + " tail", "en", "c", 1),
        (10, "x" * 3000, "en", "c", 1),
        (11, "word " * 400, "fr", "c", 1),
        (12, "日本語 текст ελληνικά 😀     é " + prose(4, 70), None, "c", 1),
        (13, "two words", "fr", "c", 2),
        (14, "    a  ", "fr", "c", 2),
    ]


@pytest.fixture
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clash(spark, hard):
    """The same rows with columns called like those that the operators make or use, some in another case."""
    names = "key size place target taken times IDS decoded SCORE held_out lang_pred n_words script kept base_failed n shingle rep sign spans begin".split()
    names += "row _doc _sign _spans _slot SLOT shard _id _group group of low_byte_share other own_id own_sign again first component_id id doc marks toxic labelled n_bytes edge _key".split()
    return hard.selectExpr("*", *[f"'x' AS {name}" for name in names])


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


__all__ = ["Row"]
