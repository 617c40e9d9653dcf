import pytest

from aeris.llm.common import ready

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "si", "to") for b in ("ba", "den", "fel", "gor", "him", "jul", "kes", "lan")]
PROSE = " ".join(f"The {WORDS[i % 64]} of {WORDS[i * 7 % 64]} and {WORDS[i * 13 % 64]}." for i in range(40))
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, words string, score string, component string, key string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ready(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, clashing column names."""
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", PROSE, PROSE, PROSE.upper(), "x" * 300_000, (PROSE + "\n") * 300, "été ça ñ ß 漢字 \U0001f600 " * 40, "a\x00b c", "1 2 3 4 5 6 7 8 9 10 11"]
    rows = [(i, t, ("en", "de", None)[i % 3], ("a", "b", None)[i % 3], None, "r", "w", "s", "c", "k") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, PROSE, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None), (4, "other text of the same id", "en", "a", 1, None, None, None, None, None)]
    return spark.createDataFrame(rows, ODD_SCHEMA).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
