import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LONG = "".join(f"wort{i % 977} " for i in range(40_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "b", 43), (2, "the quick brown fox jumps over the lazy dog", "en", "b", 43), (2, "the quick brown fox jumps over the lazy dog", "en", "b", 43),
        (3, "le chien paresseux dort sous la table et le chat aussi", "fr", None, None), (4, None, None, None, None), (None, "password = 'abcdefghijklmnop' and more", None, "a", 1),
        (5, "", "en", "", 0), (6, " \t\n\x0b\x0c\r", None, "a", 6), (7, LONG, "de", "c", len(LONG)), (8, "12345 !!! 678", "en", "c", 13), (9, "ü\U0001f600 AKIA" + "Z9" * 8 + " 0123456789abcdef00", "de", "ä", 5), (None, None, None, None, None), (10, "wort", "de", "c", 4),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
