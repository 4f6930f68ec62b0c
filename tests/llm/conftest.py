import duckdb
import pytest

SMOKE = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = " ".join(f"word{i % 977} the of and {i}" for i in range(6000))
LINE = "This line is surely longer than forty characters and stands in many documents."
BASE = "the quick brown fox jumps over the lazy dog while seven wizards mix jugs of strong liquor near quiet boxes " * 3


def weird_rows():
    """NULLs in every column, empty and long texts, ties, repeated rows, odd characters."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", "a", 5), (None, "no id here", "en", "b", 3),
        (None, None, None, None, None), (4, "word", "en", "b", 4), (5, "word", "en", "b", 4), (5, "word", "en", "b", 4),
        (6, LONG, "en", None, len(LONG)), (7, LONG + " tail", "en", "c", len(LONG)), (8, "!!! ### 123 456", "de", "c", 9),
        (9, "naïve café — 東京 😀 <|endoftext|> x y　z", "fr", "é", 9), (10, "a" * 5000, "en", "c", 5000),
    ]
    for i in range(20, 28):
        rows.append((i, f"Start {i}.\n{LINE}\n  {LINE.upper()} \nEnd of {i} is here.", "en", "d", 1))
    for i in range(30, 36):
        rows.append((i, BASE + f"number {i}", "en", "d", 1))
    return rows


@pytest.fixture(scope="session")
def weird(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(weird_rows(), DOCS)
    for name in ("key", "n_words", "comp", "version", "vote", "size", "words", "kept", "batch"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def smoke(spark):
    return spark.read.parquet(f"{SMOKE}/documents.parquet")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    return con
