import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside or give out themselves.
CLASHES = "row STRING, k1 STRING, k2 STRING, kept STRING, digest STRING, n STRING, c STRING, size STRING, hash STRING, score STRING, spans STRING, _may STRING, doc STRING"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def long_text(words: int) -> str:
    return " ".join(f"w{i * 7919 % 10007}é" for i in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = long_text(30_000)
    near = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega " * 3
    return [
        (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n\r\x0b\x0c ", None, "a"), (4, long, "en", "b"), (5, long, "en", "b"),
        (6, "one two", "en", "b"), (7, "One\x1ctwo x", "fr", "b"), (8, near + "end", "de", "c"), (9, near + "stop", "de", "c"), (9, near + "stop", "de", "c"),
        (None, near + "end", None, None), (10, "x" * 50_000, None, "b"), (11, "a " * 5_000, "en", "a"), (12, "ONE TWO", "en", "a"),
        (13, "\U0001F600 password = 'abcdef12' \U0001F600 é", "en", "a"), (14, " " * 40_000 + "z", "en", "a"), (15, "1234 !?", "en", "a"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns of clashing names."""
    schema = f"doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, {CLASHES}"
    return spark.createDataFrame([(*r, 0, *["x"] * 13) for r in odd_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
