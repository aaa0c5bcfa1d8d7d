import pytest

from llm_tables import tables


@pytest.fixture(autouse=True)
def _utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture(scope="session")
def nasty(spark):
    return tables(spark, False)


@pytest.fixture(scope="session")
def nothing(spark):
    return tables(spark, True)
