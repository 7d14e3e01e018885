import brute
import pytest


@pytest.fixture(scope="session")
def hard(spark):
    return brute.with_clashes(spark.createDataFrame(brute.hard_rows(), brute.DOCUMENT).repartition(3))


@pytest.fixture(scope="session")
def empty(spark):
    return brute.with_clashes(spark.createDataFrame([], brute.DOCUMENT))


@pytest.fixture
def stage(spark):
    from skyjoin.llm.common import Stage

    return Stage(spark, "test")
