import pytest

SHAPE = "doc_id long, text string, `row` string, uid long, `node` int, length int, `index` string"


@pytest.fixture
def edge_docs(spark):
    """Nulls in each column, an empty and a very long text, repeated rows, and names the operators use inside."""
    long_text = "word " * 30_000 + "x" * 5_000
    return spark.createDataFrame([
        (1, "A b c d e", None, 1, 1, 1, "i"), (1, "A b c d e", None, 1, 1, 1, "i"), (2, "", "r", None, None, None, None),
        (3, None, "r", 3, 3, 3, None), (None, "a b c d e", "r", 4, 4, 4, "i"), (None, None, None, None, None, None, None),
        (4, long_text, "r", 5, 5, 5, "i"), (5, "naïve ½ İ 　 日本\n\n<|endoftext|> it's", "r", 6, 6, 6, "i"),
        (6, " \t\n", "r", 7, 7, 7, "i")], SHAPE)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SHAPE)
