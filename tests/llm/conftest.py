import re

import pytest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


LONG = "the quick brown fox jumps over the lazy dog and runs away from every hunter in these old woods. " * 300
ODD = [
    (1, "A line that is long enough to count.\nShared line of twenty points\nx", "en", "a", 1, 9, "k"),
    (2, "a line that is long enough to count. \nshared LINE of twenty points\ny", "en", "a", 1, 9, None),
    (3, "\tA line that is long enough to count.\nShared line of twenty points\nShared line of twenty points", "en", None, 1, 9, "k"),
    (3, "\tA line that is long enough to count.\nShared line of twenty points\nShared line of twenty points", "en", None, 1, 9, "k"),
    (4, None, None, None, None, None, None),
    (5, "", "de", "b", 0, 0, ""),
    (6, " \t\n\x0b\x0c\r ", "de", "b", 7, 0, ""),
    (7, LONG, "en", "c", len(LONG), 1, "z"),
    (8, LONG + "once more with another end", "en", "c", len(LONG), 1, "z"),
    (9, "123 456 !!", "en", "\U00010000", 3, 1, "z"),
    (10, "ein kurzer Text ÄÖÜ 😀́", "de", "￿", 3, 1, "z"),
    (None, "no id at all here", "de", "b", 3, 1, "z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank and long texts, repeated rows, and columns with names of results."""
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
