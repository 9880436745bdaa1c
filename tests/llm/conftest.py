import pytest


@pytest.fixture(scope="session")
def sample_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sample_dir):
    return spark.read.parquet(f"{sample_dir}/documents.parquet")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empties, repeated rows, ties, a long text, clashing columns."""
    long = " ".join(f"word{i % 977} of{i}" for i in range(60_000))
    data = [
        (1, "Same text here", "a", 1),
        (1, "Same text here", "a", 1),
        (2, "same TEXT here", "b", 2),
        (3, None, None, None),
        (4, "", "c", 3),
        (5, "   \n\t ", "c", 3),
        (None, "a text without an id", "d", 4),
        (None, "SAME text here", "d", 4),
        (7, long, "e", 5),
        (8, "É is not é, yet A is a", "f", 6),
        (9, "é is not é, yet A is a", "f", 6),
    ]
    return spark.createDataFrame(data, "doc_id long, text string, kept string, score int")
