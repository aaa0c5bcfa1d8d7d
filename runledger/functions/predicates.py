"""Column-level predicates and scalar helpers.

Every helper returns a ``Column`` built from Spark SQL built-ins, so all of
them stay inside whole-stage code generation and are visible to Catalyst
(string predicates on stored columns are pushed to the Parquet scan).

Missing values: the source data model has zero values, never NULL, so NULL
and the zero value both mean "missing" here.  Predicates that negate or test
list membership coalesce first; otherwise three-valued logic silently drops
rows (``NOT NULL`` is NULL, and a NULL filter rejects the row).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default list of known browser names (a parameter everywhere
# it is used), the experimental suffix, the channel labels, the labels that mark
# mainline runs or CI sources, and the zero time used for a missing timestamp.
DEFAULT_BROWSERS = ("chrome", "edge", "firefox", "safari")
EXPERIMENTAL_SUFFIX = "-experimental"
CHANNEL_LABELS = ("stable", "release", "beta", "dev", "canary", "nightly", "preview")
MAINLINE_LABELS = ("master", "pr_base", "pr_head")
CI_LABELS = ("azure", "taskcluster", "buildbot")
ZERO_TIME_TEXT = "0001-01-01 00:00:00"
# Whitespace trimmed from resolved hashes: space, tab, CR, LF, VT.
HASH_WHITESPACE = " \t\r\n\u000b"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_time() -> Column:
    """The zero timestamp, typed like the run table (timestamp without zone)."""
    return F.lit(ZERO_TIME_TEXT).cast("timestamp_ntz")


def str_array(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def labels_or_empty(labels: str | Column = "labels") -> Column:
    """NULL list -> empty list (a nil list in the source model)."""
    return F.coalesce(_c(labels), F.array().cast("array<string>"))


# ---- F1-F8: string functions -------------------------------------------------

def trim_suffix(s: str | Column, suffix: str) -> Column:
    """Remove one trailing ``suffix`` (literal, not a regex)."""
    s = _c(s)
    n = len(suffix)
    return F.when(s.endswith(suffix), s.substr(F.lit(1), F.length(s) - F.lit(n))).otherwise(s)


def trim_prefix(s: str | Column, prefix: str) -> Column:
    """Remove one leading ``prefix``."""
    s = _c(s)
    return F.when(s.startswith(prefix), s.substr(F.lit(len(prefix) + 1), F.length(s))).otherwise(s)


def trim_chars(s: str | Column, chars: str = HASH_WHITESPACE) -> Column:
    """Trim any of ``chars`` from both ends."""
    return F.btrim(_c(s), F.lit(chars))


def split_drop_first(s: str | Column, sep: str = "/") -> Column:
    """Split on a literal separator and drop the first piece (trailing empties kept)."""
    parts = F.split(_c(s), _regex_literal(sep), -1)
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def _regex_literal(s: str) -> str:
    import re
    return re.escape(s)


def regex_split(s: str | Column, pattern: str) -> Column:
    """Split on a regular expression (F7).  Empty patterns are rejected:
    zero-length matches split differently across regex engines."""
    if pattern == "":
        raise ValueError("regex_split: empty pattern is not supported")
    return F.split(_c(s), pattern, -1)


def first_chars(s: str | Column, n: int = 10) -> Column:
    return F.substring(_c(s), 1, n)


def rfc3339_utc(ts: str | Column) -> Column:
    """UTC RFC 3339 text with second precision (session zone must be UTC)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


INT_TEXT = r"^[+-]?[0-9]+\z"


def parse_int(s: str | Column) -> Column:
    """Strict integer text (optional sign, digits, nothing else) -> BIGINT,
    else NULL.  The pattern test runs first, so the cast's error path is only
    reached on overflow."""
    c = _c(s)
    return F.when(c.rlike(INT_TEXT), c.try_cast("bigint"))


# ---- P1-P8: run predicates ---------------------------------------------------

def is_known_browser(name: str | Column = "browser_name",
                     known: Sequence[str] = DEFAULT_BROWSERS) -> Column:
    """The name, less one ``-experimental`` suffix, is a known browser."""
    return F.coalesce(trim_suffix(name, EXPERIMENTAL_SUFFIX).isin(list(known)), F.lit(False))


def has_any(labels: str | Column, names: Sequence[str]) -> Column:
    """The label list shares an element with ``names`` (never NULL)."""
    return F.arrays_overlap(labels_or_empty(labels), str_array(names))


def is_missing_str(s: str | Column) -> Column:
    """P5: NULL or empty string (never NULL itself; written as IS NULL OR = ''
    so its negation reaches the scan as IsNotNull + Not(EqualTo))."""
    c = _c(s)
    return c.isNull() | (c == F.lit(""))


def is_missing_time(ts: str | Column) -> Column:
    """NULL or the zero time."""
    ts = _c(ts)
    return ts.isNull() | (ts == zero_time())


def lasted_longer_than(start: str | Column, end: str | Column, minutes: int = 10) -> Column:
    """End - start > minutes, with missing times as the zero time."""
    z = zero_time()
    s = F.coalesce(_c(start), z)
    e = F.coalesce(_c(end), z)
    return e > s + F.expr(f"INTERVAL {int(minutes)} MINUTES")


def value_changed(old: str | Column, new: str | Column) -> Column:
    """NOT (old <=> new)."""
    return ~_c(old).eqNullSafe(_c(new))


def all_of(*preds: Column) -> Column:
    """AND over an always-true base."""
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def any_contains(name: str, value: str) -> Column:
    """P10: some element of a list property contains ``value``."""
    return F.exists(labels_or_empty(name), lambda x: x.contains(value))
