import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
        StructField("source", StringType()), StructField("n_chars", LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Documents from texts, or from tuples with an id before the text."""

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, *rest = r if isinstance(r, tuple) else (i, r)
            lang, source = [*rest, "en", "src0"][:2] if rest else ("en", "src0")
            full.append((doc_id, text, lang, source, len(text or "")))
        return spark.createDataFrame(full, DOCUMENTS)

    return make
