import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "The river ran past the old mill, and nobody in the village could say when its wheel had last turned. "


def frame(spark, texts, start=0):
    """Documents numbered from ``start``."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts, start)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


def clashing(df):
    """Further columns whose names the operators use or write themselves, or that differ in case alone."""
    for name in ("TEXT", "score", "doc", "id", "start", "content", "n", "rep", "root", "_key", "_hash", "_marks", "text_hash", "c0", "k", "h", "words", "key", "x"):
        df = df.toDF(*df.columns).withColumn(f"tmp_{name}", F.lit("7"))
    return df.toDF(*[c.removeprefix("tmp_") for c in df.columns])


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long_text = "".join(f"word{i % 5003} goes on and " for i in range(30_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \n\t ", "en", "s", 4),
        (4, long_text, "en", "s", len(long_text)),
        (5, PROSE * 3, "en", None, 300),
        (5, PROSE * 3, "en", None, 300),
        (6, PROSE * 3, None, "s", 300),
        (7, "x" * 5000, "en", "s", 5000),
        (8, "日本語 über naïve e\u0301 \U0001f600 <|endoftext|> it's", "en", "s", 40),
        (None, "a text without any key at all", "en", "s", 29),
        (None, None, None, None, None),
    ]
    return clashing(spark.createDataFrame(rows, SCHEMA))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
