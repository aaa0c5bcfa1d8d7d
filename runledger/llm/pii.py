"""Personal data: base patterns, and identifiers learnt from their contexts.

Base spans come from four forms (e-mail, IP address, card, phone).  They seed
a bootstrapped extraction:

* an instance is a value with several digits or an @ sign before a letter or
  digit, of any length (as written, lower case); instances that base forms found are seeds;
* a lexical pattern is the two words before an instance (digits as 0) within
  the BEFORE characters up to it, the text's start counting as words too;
* patterns and instances make a graph, pre-aggregated over the corpus; a
  pattern's reliability is the mean reliability of its instances, with one
  unreliable instance added; an instance's is the mean of its patterns'; seeds
  stay at 1.  What a pattern passes to itself is solved for, so instances that
  stand behind no other pattern count neither for nor against it; of what
  others pass on, SPREAD is kept in each round.  Reliabilities only rise, and
  after ROUNDS rounds nothing is more than SPREAD ** ROUNDS (0.04) below where
  it would end, at any size of the graph: ending early can leave a pattern out
  and let none in;
* a pattern is good at reliability CONFIDENCE or more, with SUPPORT different
  seeds that are a share of LEAST_SHARE or more of all its different instances
  (the lower end of the share's confidence interval counts, Z standard
  deviations wide): a context that stands before everything meets a few seeds
  by chance, but they are no share of what it meets;
* good patterns discover the other instances they stand before, as spans of
  kind ``id``.  Discovered instances whose patterns are reliable on the mean
  (PROMOTE) are seeds of the next generation, which finds the patterns that
  only they support, and their other places; after GENERATIONS, or when no new
  pattern is good, the discovery ends.

A hot pattern or value is only ever a key of an aggregate or a join that the
engine may split.  Documents are known by (id, hash of the text).

Defined results: a null text is empty and has no span; null ids and repeated
rows keep their rows; equal spans of a repeated row are its own; a table without
seeds discovers nothing; an empty table gives no rows; columns besides id and
text don't matter.  Texts are matched whole, in time that follows their length
and their hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import stored, text_of
from runledger.llm.spans import NO_SPANS, START, apart, by_kind, only_if, spans

#: The base kinds, in their order; the method adds kind ``id``.
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "id"]
SUPPORT, CONFIDENCE, LEAST_SHARE, Z, PROMOTE, GENERATIONS = 5, 0.8, 0.02, 1.645, 0.5, 4
SPREAD, ROUNDS, TOLERANCE = 0.9, 30, 1e-3
LEAST_DIGITS, LEAST_LENGTH = 4, 6

# A lookbehind makes a match start where its run of characters does (or where the match before ended), and possessive
# repeats never give back: the matches are those of the plain forms, in linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Mark a space and a hyphen between two digits, for cards; and what stands for such marks of the text itself.
SPACE, HYPHEN, OTHER = "\x01", "\x04", "\x02"
CARD = f"[0-9{SPACE}{HYPHEN}]{{16,}}+"
TOKEN = r"(?<![A-Za-z0-9@._+#/-])[A-Za-z._+#/-]*+[0-9@][A-Za-z0-9@._+#/-]*+"
HANDLE = "@[A-Za-z0-9_]"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    digits = F.transform(F.split(F.reverse(_digits(hit)), ""), lambda d, i: F.struct(d.try_cast("int").alias("d"), (i % 2).alias("odd")))
    twice = lambda x: F.when(x["odd"] == 1, F.when(x["d"] > 4, x["d"] * 2 - 9).otherwise(x["d"] * 2)).otherwise(x["d"])
    return F.aggregate(digits, F.lit(0), lambda a, x: a + F.coalesce(twice(x), F.lit(0))) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of the four base kinds."""
    small = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.substring(p, -3, 3).cast("int") <= 255)
    marked = F.translate(text, SPACE + HYPHEN, OTHER * 2)
    for sign, mark in ((" ", SPACE), ("-", HYPHEN)):
        marked = F.regexp_replace(marked, f"(?<=[0-9]){sign}(?=[0-9])", mark)
    digit = text.rlike("[0-9]")
    n = lambda hit: F.length(_digits(hit))
    return F.concat(
        only_if(F.contains(text, F.lit("@")), spans(text, EMAIL, "email")),
        only_if(digit & F.contains(text, F.lit(".")), spans(text, IP, "ip", lambda h: F.forall(F.split(h, r"\."), small))),
        only_if(digit, spans(text, CARD, "card", lambda h: n(h).between(16, 19) & _luhn(h), marked)),
        only_if(F.contains(text, F.lit("+")), spans(text, PHONE, "phone", lambda h: n(h).between(8, 15))))


def instances(text: Column) -> Column:
    """Spans of values that may be identifiers, of kind ``id``."""
    numbered = lambda h: (F.length(_digits(h)) >= LEAST_DIGITS) & (F.length(h) >= LEAST_LENGTH)
    return only_if(text.rlike("[0-9@]"), spans(text, TOKEN, "id", lambda h: numbered(h) | h.rlike(HANDLE)))


def pattern(before: Column) -> Column:
    """The two words at the end of what stands before a place, in lower case, digits as 0."""
    plain = F.regexp_replace(F.lower(F.translate(before, SPACE + HYPHEN, " -")), "[0-9]+", "0")
    words = F.split(F.trim(F.regexp_replace(plain, rf"[\s{START}]+", " ")), " ")
    # the text's start stands for the words that aren't there
    padded = F.when(F.contains(before, F.lit(START)), F.concat(F.array(F.lit(START), F.lit(START)), F.filter(words, lambda w: w != ""))).otherwise(words)
    return F.concat_ws(" ", F.slice(padded, -F.least(F.size(padded), F.lit(2)), F.lit(2)))


def _scored(edges: DataFrame) -> DataFrame:
    """(pattern, seeds, n, p) of a graph (pattern, value, seed)."""
    degree = edges.groupBy("value").agg(F.count(F.lit(1)).alias("degree"), F.min("seed").alias("least"))
    known = stored(edges.join(degree, "value"), "degrees")
    # p * (n + 1) = seeds + the means of the others; a mean holds p itself by 1 / degree, which goes to the left side
    own = F.sum(F.when(F.col("seed") == 0, 1 / F.col("degree")).otherwise(0.0))
    patterns = known.groupBy("pattern").agg(F.sum("seed").alias("seeds"), F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) + 1 - own).alias("weight"))
    patterns = stored(patterns.withColumn("p", F.col("seeds") / F.col("weight")), "patterns")
    shared = stored(known.where("degree > 1 and least = 0").drop("least"), "shared")
    linked = shared.select("pattern").distinct()
    live = stored(patterns.join(linked, "pattern"), "live")
    for _ in range(ROUNDS):
        scored = shared.join(live.select("pattern", "p"), "pattern")
        total = scored.groupBy("value").agg(F.sum("p").alias("total"))
        passed = scored.where("seed = 0").join(total, "value").groupBy("pattern").agg(F.sum((F.col("total") - F.col("p")) / F.col("degree")).alias("passed"))
        fresh = live.withColumnRenamed("p", "old").join(passed, "pattern", "left")
        fresh = stored(fresh.select("pattern", "seeds", "n", "weight", "old", ((F.col("seeds") + SPREAD * F.coalesce("passed", F.lit(0.0))) / F.col("weight")).alias("p")), "live")
        change = fresh.agg(F.max(F.abs(F.col("p") - F.col("old")))).first()[0] or 0.0
        live = fresh.drop("old")
        if change < TOLERANCE:
            break
    every = patterns.join(linked, "pattern", "left_anti").unionByName(live)
    return every.select("pattern", "seeds", "n", "p")


def share_at_least(seeds: Column, n: Column) -> Column:
    """The lower end of the confidence interval (Wilson's) of the share of seeds among n instances."""
    share, z2 = seeds / n, Z * Z
    return (share + z2 / (2 * n) - Z * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def _good() -> Column:
    return (F.col("p") >= CONFIDENCE) & (F.col("seeds") >= SUPPORT) & (share_at_least(F.col("seeds"), F.col("n")) >= LEAST_SHARE)


def reliable_patterns(edges: DataFrame) -> DataFrame:
    """(pattern, p) of the graph ``edges`` (pattern, value, seed) that are good with these seeds, as they stand."""
    return _scored(edges).where(_good()).select("pattern", "p")


def bootstrap(edges: DataFrame) -> DataFrame:
    """(pattern) that are good in some generation, each generation's seeds with what the ones before found."""
    now, good, n_good = edges, None, -1
    for _ in range(GENERATIONS):
        scored = stored(_scored(now).withColumn("good", _good()), "scored")
        good = scored.where("good")
        n = good.count()
        if n == n_good or n == 0:
            break
        n_good = n
        # an instance is promoted if a good pattern stands before it and its patterns are reliable on the mean
        reached = now.join(scored.select("pattern", "p", "good"), "pattern").groupBy("value").agg(F.max("seed").alias("seed"), F.max("good").alias("found"), F.avg("p").alias("mean"))
        new = reached.where((F.col("seed") == 0) & F.col("found") & (F.col("mean") >= PROMOTE)).select("value", F.lit(1).alias("promoted"))
        now = stored(now.join(new, "value", "left").select("pattern", "value", F.greatest("seed", F.coalesce("promoted", F.lit(0))).alias("seed")), "generation")
    return good.select("pattern")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, hash, base (spans) and all (spans), by kind as listed and then start."""
    text = text_of(text_col)
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    rows = keyed.select("id", "hash", base_spans(F.col("text")).alias("base"), instances(F.col("text")).alias("values"))
    placed = lambda c: F.transform(c, lambda s: s.withField("before", pattern(s["before"])))
    rows = rows.select("id", "hash", placed(F.col("base")).alias("base"), placed(apart(F.col("values"), F.col("base"))).alias("values"))
    rows = stored(rows, "spans")
    every = rows.select(F.explode(F.concat(F.transform("base", lambda s: F.struct(s.alias("s"), F.lit(1).alias("seed"))),
                                           F.transform("values", lambda s: F.struct(s.alias("s"), F.lit(0).alias("seed"))))).alias("x"))
    edges = every.select(F.col("x.s.before").alias("pattern"), F.xxhash64(F.lower("x.s.value")).alias("value"), "x.seed")
    edges = stored(edges.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "graph")
    good = bootstrap(edges)
    found = rows.where(F.size("values") > 0).select("id", "hash", F.explode("values").alias("v")).withColumn("pattern", F.col("v.before"))
    new = found.join(good, "pattern").groupBy(F.col("id").alias("id2"), F.col("hash").alias("hash2")).agg(F.collect_set("v").alias("new"))
    both = rows.join(new, F.col("id").eqNullSafe(F.col("id2")) & (F.col("hash") == F.col("hash2")), "left")
    added = F.coalesce("new", F.expr(NO_SPANS))
    return both.select("id", "hash", by_kind(F.col("base"), KINDS).alias("base"), by_kind(F.concat("base", added), KINDS).alias("all"))
