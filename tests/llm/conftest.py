import pytest


@pytest.fixture
def frame(spark):
    """Rows (doc_id, text) as documents over several partitions."""
    def make(rows, schema="doc_id long, text string", parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


ODD_TEXTS = [None, "", " ", "a", "é", "日本語 text", "x" * 30000, "word " * 5000, "\n\n", "a\x00b"]


@pytest.fixture
def odd(frame):
    """Null, empty, very long and repeated texts, a null id, and columns whose names operators use inside."""
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD_TEXTS)] + [(None, "a", None, None), (3, "a", "x", 1)]
    return frame(rows, "doc_id long, text string, spans string, score int")
