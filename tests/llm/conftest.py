import pytest
from awkward import SCHEMA, odd_rows


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture()
def clashing(odd):
    """The same with extra columns named like results and helpers of the operators."""
    extra = "size shard slot n_words score k h key uid tokens n words body row file start bits positions copies".split()
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("x").alias(c) for c in extra])


@pytest.fixture()
def empty(odd):
    return odd.limit(0)
