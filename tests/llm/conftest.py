import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("score", StringType()),
                   StructField("c", StringType()), StructField("spans", StringType())])


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names the
    operators use inside."""
    def make(rows, partitions=3):
        return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS).repartition(partitions, "doc_id")
    return make
