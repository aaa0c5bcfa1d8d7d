"""Substring search over the test dictionary by trigram postings.

``write_index`` stores two tables:

* ``entries``: the dictionary, in folders by ``block`` (id div ``ENTRIES``);
* ``postings``: (depth, gram, id) for every three characters in a row of every
  path segment (depth 1, 2, ...) and of the whole name (depth 0), in folders by
  ``bucket``, a hash of (depth, gram), sorted by (depth, gram, id).

A search names the trigrams of each piece at the piece's depth.  Their buckets
are constants of the plan, so only those folders are read; ids that have all
of the trigrams are the candidates, whose blocks prune the entries, and the
search's own predicate has the last word on them.  Pieces of one or two
characters have no trigrams and are left to that predicate; a search without
any trigram scans the entries.  Every table grows with the names' length and
no group with a trigram's frequency: ids are counted, not collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators import search as S

GRAM, BUCKETS, ENTRIES = 3, 64, 16_384
WHOLE_NAME = 0
_ENTRIES = "id BIGINT, test STRING, subtest STRING, block BIGINT"
_POSTINGS = "depth INT, gram STRING, id BIGINT, bucket BIGINT"


@dataclass
class SearchIndex:
    entries: DataFrame    # id, test, subtest, block
    postings: DataFrame   # depth, gram, id, bucket
    buckets: int
    block_size: int


def _bucket(depth: Column, gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(depth, gram), F.lit(buckets))


def grams(s: Column) -> Column:
    """The distinct trigrams of a string; none if it is shorter."""
    cuts = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - (GRAM - 1), F.lit(1))), lambda i: F.substring(s, i, F.lit(GRAM)))
    return F.when(F.length(s) >= GRAM, F.array_distinct(cuts)).otherwise(F.array().cast("array<string>"))


def write_index(tests: DataFrame, path: str, buckets: int = BUCKETS, block_size: int = ENTRIES) -> str:
    """Store entries and postings of a dictionary (id, test, subtest) under ``path`` (never overwritten)."""
    block = F.expr(f"id div {int(block_size)}").cast("bigint")
    entries = tests.select("id", "test", "subtest", block.alias("block"))
    entries.repartitionByRange("block", "id").sortWithinPartitions("block", "id").write.partitionBy("block").parquet(f"{path}/entries")
    named = S.with_segments(tests).select("id", F.concat(F.array(S.full_name()), "segments").alias("pieces"))
    pieces = named.select("id", F.posexplode("pieces").alias("depth", "piece"))
    found = pieces.select("id", "depth", F.explode(grams(F.col("piece"))).alias("gram"))
    rows = found.select("depth", "gram", "id", _bucket(F.col("depth"), F.col("gram"), buckets).alias("bucket"))
    # by ranges that end in the id, so a trigram that most names have is many tasks' work
    (rows.repartitionByRange("bucket", "depth", "gram", "id").sortWithinPartitions("bucket", "depth", "gram", "id")
     .write.partitionBy("bucket").parquet(f"{path}/postings"))
    return path


def load_index(spark: SparkSession, path: str, buckets: int = BUCKETS, block_size: int = ENTRIES) -> SearchIndex:
    """The index under ``path``, with the numbers it was written with."""
    return SearchIndex(spark.read.schema(_ENTRIES).parquet(f"{path}/entries"), spark.read.schema(_POSTINGS).parquet(f"{path}/postings"), buckets, block_size)


def _grams_of(text: str) -> list[str]:
    return sorted({text[i:i + GRAM] for i in range(len(text) - GRAM + 1)})


def candidates(index: SearchIndex, wanted: list[tuple[int, str]]) -> DataFrame:
    """(id, block) of the entries that have all of the wanted (depth, gram)."""
    buckets = [_bucket(F.lit(d), F.lit(g), index.buckets) for d, g in wanted]
    by_depth: dict[int, list[str]] = {}
    for d, g in wanted:
        by_depth.setdefault(d, []).append(g)
    has = F.lit(False)
    for d, gs in by_depth.items():
        has |= (F.col("depth") == d) & F.col("gram").isin(gs)
    hits = index.postings.where(F.col("bucket").isin(buckets) & has)
    per_id = hits.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(wanted))
    return per_id.select("id", F.expr(f"id div {int(index.block_size)}").cast("bigint").alias("block"))


def _pruned(index: SearchIndex, wanted: list[tuple[int, str]]) -> DataFrame:
    if not wanted:
        return index.entries.drop("block")
    return index.entries.join(candidates(index, wanted), ["block", "id"], "left_semi").drop("block")


def path_search(index: SearchIndex, query: str, max_results: int | None = None) -> DataFrame:
    """T2/T3 as ``search.path_search`` has it, over the entries that the postings leave."""
    wanted = [(depth, g) for depth, piece in enumerate(query.split("/")[1:], 1) for g in _grams_of(piece)]
    return S.path_search(_pruned(index, wanted), query, max_results)


def name_search(index: SearchIndex, s: str, max_results: int | None = None) -> DataFrame:
    """T4 as ``search.name_search`` has it, over the entries that the postings leave."""
    return S.name_search(_pruned(index, [(WHOLE_NAME, g) for g in _grams_of(s)]), s, max_results)
