"""Benchmark decontamination by template canonicalisation.

Words become canonical tokens: numbers, names and units turn into typed
placeholders (their values are the slots), all else is lower-cased and
stripped of punctuation.  A name is a capitalised word; at the start of a
sentence it may be an ordinary word, and a copy may have lost its capitals, so
texts are read with either and with no names.  A last reading has the words
themselves, numbers and units too, with the signs that stand alone between
them: it finds exact copies whatever they are made of.  In scripts without
spaces each character is a word.  Windows of WINDOW canonical tokens (DENSE of
an item that is mostly such characters; an item with fewer: all its tokens) are joined by
hash with those of the benchmark; a pair of windows must have the same tokens
and the same pattern of equal slots.  Windows with the item's own slot values
count as they are.  For the others, over each run of windows in one reading of
a document and an item at one offset, each slot value of the item must stand
for one value of the document and the other way round; windows with a value
that doesn't are dropped.  Re-parameterised questions (other numbers, other
names) are caught that way, and windows that only share their shape aren't.

A bitmap of the benchmark's window hashes (2**FILTER_BITS bits at any size of
the benchmark) spares the join nearly all windows of clean texts; it has no
false negatives, and what passes is joined by shuffle.

Defined results: null and empty texts, and those of signs only, have no window
and match nothing; items of fewer than LEAST tokens, and windows with fewer
than LITERALS of 10 literal tokens, match exact copies only (an item of one
word every text with that word); repeated documents match alike, repeated items count
once per item id; null ids are reported as null; empty tables give no rows;
columns besides id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import small_batches, stored, text_of

WINDOW, DENSE, LEAST, LITERALS, FILTER_BITS = 10, 20, 5, 6, 24
CACHE_WORDS = 600_000
PLAIN, NUMBER, TITLE, UNIT, NOTHING = range(5)

#: Words that name units of measure and money, and words for numbers.
UNITS = frozenset("""mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds
oz ounce ounces t ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days
week weeks month months year years mph kmh km/h m/s hz khz mhz ghz w kw kwh v a n j kj cal kcal pa kpa c f k degree degrees percent % $ € £
usd eur gbp dollar dollars cent cents euro euros""".split())
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split())
NUMERIC = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?")
EDGE = re.compile(r"^[^\w$€£+-]+|[^\w%$€£]+$")
#: Scripts written without spaces (Thai to Myanmar, Khmer, Tai, Balinese, kana, bopomofo, Chinese characters, Javanese).
SPACELESS = re.compile("[\u0e00-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u1b00-\u1b7f\u3005-\u3007\u3021-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf"
                       "\u4e00-\u9fff\ua980-\ua9df\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]")
PARTS = re.compile(f"{SPACELESS.pattern}|[^{SPACELESS.pattern[1:-1]}]+")


def _spaceless(text: str) -> bool:
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
        return False
    except UnicodeEncodeError:
        return SPACELESS.search(text) is not None


class Words:
    """Canonical hash, class and sentence end of each distinct word, kept while there is room."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.core: list[str] = []
        self.code = np.zeros(1024, np.uint64)
        self.kind = np.zeros(1024, np.int8)
        self.ends = np.zeros(1024, bool)

    def _add(self, w: str) -> None:
        letters = w.isalpha()
        core = w if letters or SPACELESS.match(w) else EDGE.sub("", w)
        low = core.lower() if core else w  # signs count in the last reading
        data = low.encode("utf-8", "replace")
        i = self.place[w] = len(self.core)
        self.core.append(low)
        if i == len(self.code):
            self.code, self.kind, self.ends = (np.concatenate([a, np.zeros_like(a)]) for a in (self.code, self.kind, self.ends))
        self.code[i] = xxhash.xxh64_intdigest(data)
        self.kind[i] = (NOTHING if not core else NUMBER if low in NUMBER_WORDS or (not letters and NUMERIC.fullmatch(core)) else UNIT if low in UNITS
                        else TITLE if core[0].isupper() and core[1:].islower() else PLAIN)
        self.ends[i] = not letters and w.rstrip("\"')]»”").endswith((".", "!", "?", ":"))

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        if len(self.core) > CACHE_WORDS:
            self.__init__()
        words, place = text.split(), self.place
        dense = None
        if _spaceless(text):
            words = [x for w in words for x in PARTS.findall(w)]
            dense = np.fromiter((SPACELESS.match(w) is not None for w in words), bool, len(words))
        at = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
        for i in np.flatnonzero(at < 0).tolist():
            if words[i] not in place:
                self._add(words[i])
            at[i] = place[words[i]]
        return at, self.code[at], self.kind[at], self.ends[at], dense


def _mixed(x: int) -> int:
    """A 64-bit value spread over all bits (the finaliser of a common generator)."""
    x &= (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    x = (x ^ x >> 27) * 0x94D049BB133111EB & (1 << 64) - 1
    return x ^ x >> 31


HOLDERS = np.array([0, *[_mixed(k) for k in (11, 12, 13)], 0], np.uint64)  # by class
MARKS = {NUMBER: "<num>", TITLE: "<name>", UNIT: "<unit>"}
POWERS = np.array([_mixed(101 + k) | 1 for k in range(DENSE)], np.uint64)
EXACT = 3  # the last reading


def _signs(code: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Per real token a hash of the signs that stand between it and the one before, 0 without any."""
    out = np.zeros(int(real.sum()) + 1, np.uint64)
    if not real.all():
        here = np.arange(len(real))
        rank = here - np.maximum.accumulate(np.where(real, here, -1))
        np.add.at(out, np.cumsum(real)[~real], code[~real] * (2 * rank[~real] + 1).astype(np.uint64))
    return out[:-1]


def windows(text: str, words: Words, lengths: tuple[int, ...] | None, bits: np.ndarray | None) -> Iterator[tuple]:
    """(hash, length, position, readings, tokens, pattern, values) of the windows that pass ``bits``; without ``lengths``, those of an item."""
    every, code, kind, ends, dense = words.of(text)
    real = kind != NOTHING
    if not real.any():
        return
    begins = np.concatenate([[True], ends[:-1]])
    signs, origin = _signs(code, real), np.flatnonzero(real)
    at, code, kind, begins = every[real], code[real], kind[real].copy(), begins[real]
    item = lengths is None
    if item:
        lengths = (min(len(at), DENSE if dense is not None and 2 * dense[real].sum() >= len(at) else WINDOW),)
    after = np.concatenate([[False], kind[:-1] == NUMBER])
    kind[(kind == UNIT) & ~after] = PLAIN
    first = (kind == TITLE) & begins
    inner = (kind == TITLE) & ~first
    valued = (kind == NUMBER) | (kind == UNIT)  # elsewhere the readings without names have the words themselves
    readings = [(np.where(first, PLAIN, kind), None), (kind, first), (np.where(kind == TITLE, PLAIN, kind), inner), (np.full(len(kind), PLAIN, kind.dtype), None if item else valued)]
    # a window without names that a reading sees otherwise is the same window in that reading
    also = [(r, np.concatenate([[0], np.cumsum(need)])) for r, (_, need) in enumerate(readings[:EXACT]) if need is not None and need.any()]
    for reading, (now, need) in enumerate(readings):
        if need is not None and not need.any() and (reading != EXACT or min(lengths) >= LEAST):
            continue  # nothing that the other readings don't have
        token = np.where(now == PLAIN, code, HOLDERS[now])
        tail = token + signs * POWERS[0] if reading == EXACT else token
        literal = np.concatenate([[0], np.cumsum(now == PLAIN)])
        differs = None if need is None else np.concatenate([[0], np.cumsum(need)])
        for n in lengths:
            if len(token) < n or (n > WINDOW and dense is None) or (n < LEAST and reading != EXACT):
                continue
            size = len(token) - n + 1
            h = np.full(size, n, np.uint64)
            for j in range(n):
                h += (tail if j else token)[j:j + size] * POWERS[j]
            h ^= h >> np.uint64(32)
            good = (literal[n:] - literal[:-n]) * 10 >= LITERALS * n
            if differs is not None and n >= LEAST:
                good &= differs[n:] > differs[:-n]
            if bits is not None:
                slot = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                good &= (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
            for i in np.flatnonzero(good):
                if reading == EXACT:
                    yield int(h[i].view(np.int64)), n, int(i), [EXACT], " ".join(words.core[k] for k in every[origin[i]:origin[i + n - 1] + 1]), "=", []
                    continue
                tokens, pattern, values, seen = [], [], [], {}
                for k in range(i, i + n):
                    core = words.core[at[k]]
                    if now[k] == PLAIN:
                        tokens.append(core)
                    else:
                        tokens.append(MARKS[int(now[k])])
                        pattern.append(str(seen.setdefault((int(now[k]), core), len(seen))))
                        values.append(f"{MARKS[int(now[k])]}{core}")
                within = [reading] if reading else [0, *[r for r, c in also if c[i + n] == c[i]]]
                yield int(h[i].view(np.int64)), n, int(i), within, " ".join(tokens), " ".join(pattern), values


COLUMNS = "win long, length int, place int, readings array<int>, tokens string, pattern string, values array<string>"


def _windows(df: DataFrame, key_schema: str, lengths: tuple[int, ...] | None, bits=None) -> DataFrame:
    """Windows of every text (the last column), beside the columns before it."""
    keys = len(df.columns) - 1
    schema = f"{key_schema}, {COLUMNS}"
    types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.string(), pa.string(), pa.list_(pa.string())]
    names = df.columns[:keys] + [c.split()[0] for c in COLUMNS.split(", ")]
    words = Words()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_bits = None if bits is None else bits.value
        for b in batches:
            rows, out = [], []
            for i, text in enumerate(b.column(keys).cast(pa.binary()).to_pylist()):
                for w in windows(text.decode("utf-8", "replace"), words, lengths, filter_bits):
                    rows.append(i)
                    out.append(w)
                if len(out) > 20_000 or (out and i + 1 == b.num_rows):
                    head = pa.RecordBatch.from_arrays(b.columns[:keys], b.schema.names[:keys]).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([*head.columns, *[pa.array(c, t) for c, t in zip(zip(*out), types)]], names)
                    rows, out = [], []

    return df.mapInArrow(run, schema)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text: str = "text") -> DataFrame:
    """Per document text and item found in it: id, hash, item_id, n_windows, first_token, last_token, reparameterised."""
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.xxhash64(text_of(item_text)).alias("item_hash"), text_of(item_text).alias("text"))
    own = _windows(items, "item_id long, item_hash long", None)
    own = stored(own.drop("readings").distinct(), "item_windows")
    lengths = tuple(sorted(r[0] for r in own.select("length").distinct().collect()))  # at most DENSE values
    slot = F.shiftrightunsigned("win", 64 - FILTER_BITS)
    marks = own.groupBy(F.shiftright(slot, 3).alias("byte")).agg(F.bit_or(F.expr(f"shiftleft(1, cast(shiftrightunsigned(win, {64 - FILTER_BITS}) & 7 as int))")).alias("bits"))
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for byte, value in marks.toLocalIterator():  # at most 2**(FILTER_BITS - 3) rows, at any size of the benchmark
        bits[byte] = value
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_of(text_col)).alias("hash"), text_of(text_col).alias("text"))
    found = stored(_windows(rows, "id long, hash long", lengths, spark.sparkContext.broadcast(bits)) if lengths else spark.createDataFrame([], f"id long, hash long, {COLUMNS}"), "windows")
    keys = ["win", "length", "tokens", "pattern"]
    pairs = found.join(own.select("item_id", "item_hash", *keys, F.col("place").alias("item_place"), F.col("values").alias("item_values")), keys)
    group = ["id", "hash", "item_id", "item_hash", "offset", "reading"]
    each = pairs.select("id", "hash", "item_id", "item_hash", (F.col("place") - F.col("item_place")).alias("offset"), F.explode("readings").alias("reading"),
                        "place", "values", "item_values").distinct()
    # a group has at most as many windows, and DENSE times as many slots, as the item has
    line = Window.partitionBy(*group).orderBy("place")
    gap = F.coalesce((F.col("place") - F.lag("place").over(line) > 1).cast("int"), F.lit(0))
    runs = each.withColumn("gap", gap).withColumn("run", F.sum("gap").over(line))
    slots = runs.select(*group, "run", "place", (F.col("values") == F.col("item_values")).alias("same"), F.explode_outer(F.arrays_zip("item_values", "values")).alias("slot"))
    slots = slots.select("*", "slot.item_values", "slot.values").drop("slot")

    def several(of: str, by: str):
        of_one = Window.partitionBy(*group, "run", by)
        return F.coalesce(F.min(of).over(of_one) != F.max(of).over(of_one), F.lit(False))

    torn = slots.withColumn("torn", several("values", "item_values")).withColumn("torn", F.col("torn") | several("item_values", "values"))
    whole = torn.groupBy(*group, "place").agg(F.max("same").alias("same"), F.max("torn").alias("torn")).where("same or not torn")
    return whole.groupBy("id", "hash", "item_id").agg(
        F.size(F.collect_set("place")).alias("n_windows"), F.min("place").alias("first_token"), F.max("place").alias("last_token"),
        F.max(~F.col("same")).alias("reparameterised"))


def without_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item of ``benchmark`` is found."""
    found = matches(docs, benchmark, id_col, text_col).select(F.col("id").alias("leak_id"), F.col("hash").alias("leak_hash")).distinct()
    found = stored(found, "leaks")
    same = docs[id_col].cast("long").eqNullSafe(found.leak_id) & (F.xxhash64(text_of(text_col)) == found.leak_hash)
    return docs.join(found, same, "left_anti")
