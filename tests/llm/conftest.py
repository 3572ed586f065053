import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from cirrus.session import build_session
    s = build_session("local[4]", shuffle_partitions=4)
    yield s
    s.stop()



@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    prose = " ".join(f"word{i % 97} other{i % 13}" for i in range(60))
    long_text = " ".join(f"w{i}x{i * i % 1009}" for i in range(30000))
    data = [
        (1, prose, "en", "a", 1), (1, prose, "en", "a", 1), (2, prose + " end", "en", "b", 2), (3, None, None, None, None),
        (4, "", "de", "b", 0), (None, "no id but text here", "de", None, 3), (None, None, None, None, None),
        (5, " \t\n", "fr", "a", 3), (6, long_text, "fr", "a", 9), (7, "x" * 200000, "en", "c", 9), (8, "one", "en", "c", 3),
        (9, "Mail me: jo@x.example.com, +1 (980) 555-6268 or 10.1.2.3 idiot 4111 1111 1111 1111", "en", "b", 5),
        (9007199254740993, "large id", "es", "b", 7), (10, "ñandú \U0001F600 été", "es", "b", 6)]
    return spark.createDataFrame(data, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
