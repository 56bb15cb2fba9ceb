import pytest

#: Rows that every operator has to bear: nulls, empty and odd texts, ties, repeated rows.
ODD = [
    (1, "The cat sat on the mat, and the dog lay on the rug.", "en", "a", 51),
    (1, "The cat sat on the mat, and the dog lay on the rug.", "en", "a", 51),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "12 34 -- !!", "en", None, 11),
    (None, "Le chat est sur le tapis et le chien dort.", "fr", "b", 42),
    (5, "Le chat est sur le tapis et le chien dort.", "fr", "b", 42),
    (6, "word " * 30000, "en", "a", 150000),
    (7, "\n\t \x0b", "fr", "c", 4),
    (8, "É ß ü 日本語 \U0001f600", None, "b", 12),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def sf():
    from pathlib import Path

    if not Path("/root/testdata/sf0.001").exists():
        pytest.skip("the driver's tables are not here")
    return "/root/testdata/sf0.001"
