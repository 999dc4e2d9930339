import pytest

DOCS = "doc_id long, text string, TEXT string, row int, score double, fp string, lang string"


def long_text(n):
    return " ".join(f"w{i % 977}x{i % 13}" for i in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls, empty and very long texts, ties and repeated rows."""
    text = "the quick brown fox jumps over the lazy dog and runs away from the old house by the river"
    rows = [(0, text), (1, None), (2, ""), (3, " \n\t "), (4, text), (4, text), (None, text), (None, None),
            (5, "Ünïcode ß straße 漢字 " * 3), (6, long_text(60_000)), (7, "one"), (8, "one two"),
            (9, text.upper()), (50, text + " today"), (51, "a" * 5000)]
    return [(i, t) for i, t in rows]


@pytest.fixture()
def odd(spark, odd_rows):
    """The odd rows beside columns whose names clash with the operators' own or differ in case only."""
    return spark.createDataFrame([(i, t, "other", 1, 0.5, "f", "en") for i, t in odd_rows], DOCS)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
