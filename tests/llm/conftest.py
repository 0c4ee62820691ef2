import pytest


@pytest.fixture
def few(spark):
    """Few shuffle partitions, for small frames."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)
