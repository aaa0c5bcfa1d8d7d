"""runledger: Spark-native curation and querying of test-run collections.

Every operator is a function ``f(DataFrame, ...) -> DataFrame`` (or a pair of
them) built from Spark SQL expressions, so Catalyst sees and optimises the
whole plan.  Layout:

* ``functions``  column-level predicates and scalar helpers (no UDFs)
* ``operators``  DataFrame operators: rules, dedup, revisions, cells, reports,
                 queries over runs and results, dense numbering
* ``sources``    readers and writers: proxy tables, reports, snapshots,
                 versioned tables, object listings
* ``streaming``  Structured Streaming consolidation of newly arriving runs
* ``plans``      the registered queries and their DuckDB oracle SQL
"""

from runledger.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
