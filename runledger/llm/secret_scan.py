"""Secret scans through a trigram inverted index.

1. ``trigram_query`` reads a rule's regex and derives a Boolean query: an OR
   of sets of trigrams that any match must hold (in lower case).  A rule with
   an alternative that demands no trigram scans every text.
2. ``build_index`` writes the postings (trigram, document) of the trigrams
   that the rules' queries name; the rule set bounds their number.
3. ``candidates`` intersects the postings: per document the trigrams present,
   held against every alternative.
4. Candidates are verified with the regex on the whole text.

A document is known by (id, hash of the text), so ids that are null or repeat
do no harm.  Defined results: a null text is empty and has no span; repeated
rows keep their number; empty tables give no rows; the input's columns all
come back, beside ``secrets`` (under a free name).  Long texts are matched
whole; the patterns run in linear time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as K
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import free_name, stored, text_of
from runledger.llm.spans import by_start, masked, only_if, spans

GAP = "\0"
#: Alternatives a derivation may hold; beyond, the part becomes a gap, which only widens the query.
MOST_ALTERNATIVES = 256
MOST_CLASS = 8


@dataclass(frozen=True)
class Rule:
    """kind, regex, and the least length of a group of the match (0: the match)."""
    kind: str
    regex: str
    group: int = 0
    least: int = 1

    def keep(self, hit: Column) -> Column:
        part = hit if self.group == 0 else F.regexp_extract(hit, f"^(?:{self.regex})$", self.group)
        return F.length(part) >= self.least


#: The base kinds, in their order.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Further kinds whose form alone tells a credential.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _strings(tree) -> set[str]:
    """Strings with gaps, one of which any match follows (lower case)."""
    found = {""}
    for op, arg in tree:
        if op is K.LITERAL:
            part = {chr(arg).lower()}
        elif op is K.IN and not any(o in (K.NEGATE, K.CATEGORY) for o, _ in arg):
            chars = {chr(c).lower() for o, a in arg for c in ([a] if o is K.LITERAL else range(a[0], a[1] + 1))}
            part = chars if len(chars) <= MOST_CLASS else {GAP}
        elif op is K.SUBPATTERN:
            part = _strings(arg[-1])
        elif op is K.BRANCH:
            part = set().union(*map(_strings, arg[1]))
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
            least, most, inner = arg
            once = _strings(inner)
            part = {""} | once if (least, most) == (0, 1) else once if least == most == 1 else {a + GAP + b for a in once for b in once} if least >= 2 else {a + GAP for a in once} if least else {GAP}
        elif op is K.AT:
            part = {""}
        else:
            part = {GAP}
        if len(found) * len(part) > MOST_ALTERNATIVES:
            part = {GAP}
        found = {a + b for a, b in product(found, part)}
    return found


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Alternatives of mandatory trigrams, none holding another; empty: the rule scans fully."""
    sets = {frozenset(run[i:i + 3] for run in s.split(GAP) for i in range(len(run) - 2)) for s in _strings(_parser.parse(regex))}
    if frozenset() in sets:
        return []
    return sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)


def build_index(keyed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Postings (trigram, id, hash) of the trigrams that the rules' queries name."""
    wanted = sorted({t for r in rules for alt in trigram_query(r.regex) for t in alt})
    low = keyed.select("id", "hash", F.lower("text").alias("low"))
    present = F.filter(F.array(*map(F.lit, wanted)), lambda t: F.contains(F.col("low"), t))
    return stored(low.select(F.explode(present).alias("trigram"), "id", "hash"), "trigrams")


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(id, hash, kinds): the rules whose trigram query a document meets."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.regex))}
    wanted = sorted({t for q in queries.values() for alt in q for t in alt})
    present = index.where(F.col("trigram").isin(wanted)).groupBy("id", "hash").agg(F.collect_set("trigram").alias("has"))
    meets = lambda q: F.array_contains(F.array(*[F.size(F.array_except(F.array(*map(F.lit, sorted(alt))), "has")) == 0 for alt in q]), True)
    kinds = F.array_compact(F.array(*[F.when(meets(q), F.lit(k)) for k, q in queries.items()]))
    return present.select("id", "hash", kinds.alias("kinds")).where(F.size("kinds") > 0)


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text",
                 out: str = "secrets") -> DataFrame:
    """``docs`` with an array of spans of all rules, by start and then kind as listed."""
    row, text = F.struct(*[F.col(f"`{c}`") for c in docs.columns]), text_of(f"`{text_col}`")
    keyed = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    hits = stored(candidates(build_index(keyed, rules), rules), "candidates").select(F.col("id").alias("id2"), F.col("hash").alias("hash2"), "kinds")
    looked = keyed.join(hits, F.col("id").eqNullSafe(F.col("id2")) & (F.col("hash") == F.col("hash2")), "left")
    found = []
    for r in rules:
        one = spans(F.col("text"), r.regex, r.kind, r.keep)
        found.append(only_if(F.array_contains("kinds", r.kind), one) if trigram_query(r.regex) else only_if(F.col("text").rlike(r.regex), one))
    every = by_start(F.concat(*found), [r.kind for r in rules])
    return looked.select("row.*", every.alias(free_name(docs.columns, out)))


def without_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text",
                    length_col: str | None = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; ``length_col``, if there, is the length of the new text."""
    name = free_name(docs.columns, "secrets")
    found = find_secrets(docs, rules, id_col, text_col)
    any_of = F.size(F.col(name)) > 0
    clean = found.withColumn(text_col, F.when(any_of, masked(F.col(f"`{text_col}`"), F.col(name), mask)).otherwise(F.col(f"`{text_col}`")))
    if length_col in docs.columns:
        length = F.length(f"`{text_col}`").cast(docs.schema[length_col].dataType)
        clean = clean.withColumn(length_col, F.when(any_of, length).otherwise(F.col(f"`{length_col}`")))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])
