import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None, "", " ", "\n \t", "one", "One  two", "a b c d", "é𝒳 日本", "the " * 3000, "x" * 5000, "same words here and there again", "same words here and there again",
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, long and repeated texts, a repeated row, a null id, and columns with names the operators use."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[-1], (None, "text without an id", None, None, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("score", "places", "base", "spans", "n", "bucket", "root", "class_id", "digest", "label", "start", "unit", "table", "copies"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("1 = 0")
