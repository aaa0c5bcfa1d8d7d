"""Parameterised run filters and ordered scans.

Filters are built as one ``Column`` from request-style parameters, so the
substring tests on stored string columns reach the Parquet scan as
``StringContains`` pushed filters.  The limit is a real ``limit`` after an
order (``TakeOrderedAndProject``: a per-task top-n, then a merge of n rows per
task), never a stateful counter.
"""

from __future__ import annotations

import logging
import re
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions import predicates as P
from runledger.operators.numbering import dense_ids

log = logging.getLogger(__name__)

# The filterable properties - four string properties and one
# list property.
STRING_PROPS = ("browser_name", "browser_version", "os_name", "os_version")
LIST_PROPS = ("labels",)

# Named scan orders of the run table: (column, descending); run_id breaks ties.
SCAN_ORDERS: dict[str, tuple[str, bool]] = {
    "newest": ("created_at", True),
    "oldest": ("created_at", False),
    "start_desc": ("time_start", True),
    "url_desc": ("raw_results_url", True),
}


def scan_order(name: str) -> list[Column]:
    """Sort columns of a named order; a missing value is the smallest (a missing time the oldest)."""
    c, desc = SCAN_ORDERS[name]
    first = F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first()
    return [first, F.col("run_id").asc()]


def run_predicate(params: Mapping[str, str]) -> Column:
    """AND of one substring test per non-empty parameter.

    Unknown names raise; ``limit`` is handled by ``filter_runs``."""
    preds = []
    for name, value in params.items():
        if name == "limit" or value in (None, ""):
            continue
        if name in STRING_PROPS:
            # Bare ``contains`` (not coalesced): inside an AND-only filter a
            # NULL already rejects the row, and this form is pushed to the
            # scan as StringContains.
            preds.append(F.col(name).contains(value))
        elif name in LIST_PROPS:
            preds.append(P.any_contains(name, value))
        else:
            raise KeyError(f"unknown run property: {name!r}")
    return P.all_of(*preds)


def parse_limit(value: str | None) -> int | None:
    """Text limit -> int (optional sign and digits only); invalid text is
    warned about and ignored (None)."""
    if value in (None, ""):
        return None
    if not re.fullmatch(r"[+-]?[0-9]+", str(value)):
        log.warning("invalid limit: %r (ignored)", value)
        return None
    return int(value)


def filter_runs(runs: DataFrame, params: Mapping[str, str], order: str = "oldest") -> DataFrame:
    """L2: matching runs; with ``limit`` the first n matches in ``order``
    (n <= 0 gives none)."""
    out = runs.where(run_predicate(params))
    n = parse_limit(params.get("limit"))
    if n is not None:
        out = out.orderBy(*scan_order(order)).limit(max(n, 0))
    return out


def scan_runs(spark, path: str, order: str | None = None, rank_col: str = "rank") -> DataFrame:
    """Read a stored run table; with ``order`` each row also gets its
    0-based position in that order (no row is dropped)."""
    runs = spark.read.parquet(path)
    return runs if order is None else scan_ordered(runs, order, rank_col)


def scan_ordered(runs: DataFrame, order: str = "newest", rank_col: str = "rank") -> DataFrame:
    """The whole table with its 0-based position in ``order``; rows
    whose sort column is missing are kept, as the smallest."""
    return dense_ids(runs, scan_order(order), rank_col)
