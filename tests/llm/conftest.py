import os

import pytest

ROOT = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def folder():
    path = f"{ROOT}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("needs the given tables")
    return path


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


ODD_ROWS = [(1, "one two three four five six seven", "en"), (2, "one two three four five six seven", "en"),
            (3, "ONE two three\tfour five six\nseven", None), (4, "", "en"), (5, None, "de"),
            (6, " \n\t ", "en"), (7, "short text", ""), (8, "short  text", None), (9, "wörd " * 3000, "fr"),
            (9, "wörd " * 3000, "fr"), (None, "one two three four five six seven", "en"),
            (10, "x" * 30000, "en"), (11, "call (229) 555-4838 or a.b9@mail.example.com", "en")]
ODD_SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties and repeated rows."""
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
