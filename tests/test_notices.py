"""Pending runs and the notices of their results, by Spark's own state operators."""

from helpers import run
from test_pending import World


def test_notices_are_joined_by_state_operators_of_spark(spark):
    """no Python call for every run's notice; each run leaves once."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        w = World(spark)
        w.runs(run(1, revision="1abcdef012", raw_results_url=""), run(2, revision="2abcdef012", raw_results_url=""))
        w.commits("1abcdef012" + "0" * 30)
        w.notices(1, 1, 2, 3)
        w.c.run_available()
        w.commits("2abcdef012" + "0" * 30)
        w.notices(1, 2)
        w.c.run_available()
        assert w.done() == w.reports() == [1, 2]
        assert "TransformWithState" not in w.c.assembling(10)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
