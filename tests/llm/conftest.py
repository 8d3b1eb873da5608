import pytest

LONG = "Wort " * 30_000
# Rows that every operator on documents must stand: NULLs, empty and long texts, repeated rows.
EDGES = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "src0"),
    (1, "The quick brown fox jumps over the lazy dog", "en", "src0"),
    (2, None, None, None),
    (3, "", "de", "src0"),
    (4, " \n\t ", "de", None),
    (5, LONG, "de", "src1"),
    (None, "a text without id", "en", "src1"),
    (6, "a text without id", None, "src1"),
    (7, "日本語 \u0000 ‰ ß <|endoftext|> 'll x́", "fr", "src2"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def edges(spark):
    """Documents at the edges, with columns named as the operators' own."""
    from pyspark.sql import functions as F

    clashing = ("id", "key", "fp", "n", "n_words", "failed", "kept", "words", "label", "good", "host", "path", "block", "item", "hashes")
    frame = spark.createDataFrame(EDGES, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    return frame.withColumns({c: F.lit("clash") for c in clashing})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA + ", n_chars long")
