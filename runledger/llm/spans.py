"""Spans of regular expressions in whole texts, by built-in functions only.

Everything here takes time in proportion to the text and its hits: positions
come from a running scan that works block by block, so that no step copies more
than a block of what was found before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,kind:string,value:string,before:string>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"
#: Characters kept of what stands before a span; the first of a text has START before it.
BEFORE = 128
#: Marks the place before a text's first character.
START = "\x03"
#: Elements of a block of a scan, and spans up to which a text is cut by substrings.
BLOCK, FEW = 256, 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def scan(items: Column, state: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], empty: str) -> Column:
    """``emit(state before, item)`` of every item, the state running through ``step``.

    A first pass carries the state from block to block, a second runs through
    each block; ``empty`` is SQL for an empty array of what is emitted.
    """
    first = F.struct(state.alias("now"), F.slice(F.array(state), 1, 0).alias("all"))
    last = lambda xs: F.greatest(F.ceil(F.size(xs) / BLOCK).cast("int") - 1, F.lit(0))
    cut = lambda xs: F.transform(F.sequence(F.lit(0), last(xs)), lambda b: F.slice(xs, b * BLOCK + 1, F.lit(BLOCK)))
    starts = lambda blocks: F.aggregate(blocks, first, lambda a, b: F.struct(F.aggregate(b, a["now"], step).alias("now"), F.concat(a["all"], F.array(a["now"])).alias("all")), lambda a: a["all"])

    def within(block: Column, s: Column) -> Column:
        begin = F.struct(s.alias("now"), F.expr(empty).alias("out"))
        return F.aggregate(block, begin, lambda a, x: F.struct(step(a["now"], x).alias("now"), F.concat(a["out"], F.array(emit(a["now"], x))).alias("out")), lambda a: a["out"])

    return let(items, lambda xs: let(cut(xs), lambda blocks: F.flatten(F.zip_with(blocks, starts(blocks), within))))


def _last(text: Column, n: int = BEFORE) -> Column:
    return F.substring(text, -n, n)


def spans(text: Column, regex: str, kind: str, keep: Callable[[Column], Column] | None = None, source: Column | None = None) -> Column:
    """Array of SPAN, leftmost and non-overlapping, in code points, end exclusive.

    The matches come from one function and what lies between them from another
    (Java's ``split`` cuts at the same matches), so a running sum of their
    lengths gives the places.  ``source``: the text to match if it isn't the
    text itself; it must have the same characters in the same places but for
    those the regex names.  ``before``: the last BEFORE characters of the text
    up to the span (of ``source``, whose marks count as they are).
    """
    source = text if source is None else source
    between = F.split(source, regex, -1)
    paired = lambda hits: F.zip_with(hits, F.slice(between, 1, F.greatest(F.size(hits), F.lit(1))), lambda h, b: F.struct(h.alias("h"), b.alias("b")))
    pairs = F.filter(let(F.regexp_extract_all(source, F.lit(regex), F.lit(0)), paired), lambda x: x["h"].isNotNull())
    # only the last BEFORE characters are carried on, and of what lies between no more are copied
    to = lambda s, x: F.when(F.length(x["b"]) >= BEFORE, _last(x["b"])).otherwise(_last(F.concat(s["tail"], x["b"])))
    step = lambda s, x: F.struct((s["at"] + F.length(x["b"]) + F.length(x["h"])).alias("at"), _last(F.concat(to(s, x), _last(x["h"]))).alias("tail"))

    def emit(s: Column, x: Column) -> Column:
        begin = s["at"] + F.length(x["b"])
        return F.struct(begin.alias("start"), (begin + F.length(x["h"])).alias("end"), F.lit(kind).alias("kind"), x["h"].alias("value"), to(s, x).alias("before"))

    found = scan(pairs, F.struct(F.lit(0).alias("at"), F.lit(START).alias("tail")), step, emit, NO_SPANS)
    return found if keep is None else F.filter(found, lambda s: keep(s["value"]))


def only_if(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.expr(NO_SPANS))


def joined(found: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def rank_of(kinds: list[str]) -> Callable[[Column], Column]:
    places = F.array(*map(F.lit, kinds))
    return lambda s: F.array_position(places, s["kind"])


def by_start(found: Column, kinds: list[str]) -> Column:
    """Sorted by start, then by kind as listed."""
    rank = rank_of(kinds)
    keyed = F.transform(found, lambda s: F.struct(s["start"].alias("a"), rank(s).alias("b"), s["end"].alias("c"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def by_kind(found: Column, kinds: list[str]) -> Column:
    """Sorted by kind as listed, then by start."""
    rank = rank_of(kinds)
    keyed = F.transform(found, lambda s: F.struct(rank(s).alias("a"), s["start"].alias("b"), s["end"].alias("c"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def apart(found: Column, others: Column) -> Column:
    """The spans of ``found`` that overlap none of ``others`` (neither holds empty spans)."""
    # by start, others first where starts are equal; one scan for others that began earlier, one backwards for those that begin later
    row = lambda own: lambda s: F.struct(s["start"].alias("a"), F.lit(1 if own else 0).alias("own"), s["end"].alias("e"), s.alias("s"))
    every = F.array_sort(F.concat(F.transform(others, row(False)), F.transform(found, row(True))))
    mark = f"cast(array() as array<struct<own:int,bad:boolean,a:int,e:int,s:{SPAN}>>)"
    ends = scan(every, F.lit(0), lambda s, x: F.when(x["own"] == 0, F.greatest(s, x["e"])).otherwise(s),
                lambda s, x: F.struct(x["own"].alias("own"), (x["a"] < s).alias("bad"), x["a"].alias("a"), x["e"].alias("e"), x["s"].alias("s")), mark)
    far = (1 << 31) - 1
    free = scan(F.reverse(ends), F.lit(far), lambda s, x: F.when(x["own"] == 0, x["a"]).otherwise(s),
                lambda s, x: F.struct(x["own"].alias("own"), (x["bad"] | (s < x["e"])).alias("bad"), x["a"].alias("a"), x["e"].alias("e"), x["s"].alias("s")), mark)
    kept = F.transform(F.filter(F.reverse(free), lambda x: (x["own"] == 1) & ~x["bad"]), lambda x: x["s"])
    return F.when((F.size(others) == 0) | (F.size(found) == 0), found).otherwise(kept)


def masked(text: Column, found: Column, mask: str) -> Column:
    """The text with every span (sorted by start) replaced; overlapping spans make one."""
    gaps = scan(found, F.lit(0), lambda s, x: F.greatest(s, x["end"]), lambda s, x: F.struct(s.alias("a"), x["start"].alias("z")), "cast(array() as array<struct<a:int,z:int>>)")
    gaps = F.filter(gaps, lambda g: g["z"] >= g["a"])
    end = F.coalesce(F.array_max(F.transform(found, lambda s: s["end"])), F.lit(0))
    pieces = lambda cut: F.array_join(F.transform(gaps, lambda g: F.concat(cut(g["a"], g["z"] - g["a"]), F.lit(mask))), "")
    few = F.concat(pieces(lambda a, n: F.substring(text, a + 1, n)), F.substring(text, end + 1, F.length(text)))
    # a substring is counted from the text's first character, so a text with many spans is taken apart once instead
    joined_up = lambda letters, a, n: F.array_join(F.slice(letters, a + 1, n), "")
    many = let(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda letters: F.concat(
        pieces(lambda a, n: joined_up(letters, a, n)), joined_up(letters, end, F.greatest(F.size(letters) - end, F.lit(0)))))
    return F.when(F.size(found) > FEW, many).otherwise(few)
