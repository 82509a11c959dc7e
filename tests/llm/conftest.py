import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with an extra column whose names clash
    with ones that operators use inside."""
    def make(pairs, partitions=3):
        rows = [(i, t, "en", "src0", len(t or "")) for i, t in pairs]
        df = spark.createDataFrame(rows, DOC).repartition(partitions)
        for name in ("id", "sub", "fp", "node", "component", "h", "c", "pos", "w", "n", "k", "size", "ids",
                     "data", "start", "_id", "_key", "_n", "text_key", "length", "rank", "found", "ranges"):
            df = df.withColumn(name, F.lit("x"))
        return df
    return make
