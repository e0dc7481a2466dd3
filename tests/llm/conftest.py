import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (id, text) pairs, with further columns from a list like ", name type"."""

    def make(pairs, extra=""):
        df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in pairs], DOCS)
        for column in extra.split(", ")[1:]:
            name, kind = column.split()
            df = df.withColumn(name, F.lit("1").cast(kind))
        return df

    return make
