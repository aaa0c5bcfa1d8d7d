"""Conditional row rewrites with a dry run.

A ``Rule`` is a predicate plus column assignments, both Spark ``Column``
expressions, so a rewrite is one ``select`` of ``CASE WHEN`` projections per
rule: narrow, no shuffle, one stage inside whole-stage codegen.  Several rules chain in a
stated order, each seeing the previous rule's output (order matters: the
stable tagger adds ``stable``, itself a channel label, which hides the run
from the channel tagger).

``rewrite`` returns the new table and the rows a rule selected, with a
``changed`` flag (a rule may select a row and leave it unchanged).  A dry run
uses only the selected frame and writes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions import predicates as P


@dataclass(frozen=True)
class Rule:
    """``should`` selects rows; ``set`` maps column name -> new value."""
    name: str
    should: Column
    set: Mapping[str, Column] = field(default_factory=dict)


def _apply_one(df: DataFrame, rule: Rule, flag: str) -> DataFrame:
    sel = F.coalesce(rule.should, F.lit(False))
    # Evaluate the predicate once, on the input row, then rewrite in one select.
    staged = df.withColumn(flag, sel)
    cols = []
    for c in df.columns:
        if c in rule.set:
            cols.append(F.when(F.col(flag), rule.set[c]).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    missing = [c for c in rule.set if c not in df.columns]
    if missing:
        raise ValueError(f"rule {rule.name}: unknown columns {missing}")
    return staged.select(*cols, F.col(flag))


def rewrite(df: DataFrame, rules: Rule | Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Apply rules in order.  Returns ``(new_df, selected_df)``.

    ``new_df`` has the input columns plus ``selected`` (any rule selected the
    row) and ``changed`` (some assigned column differs from the input, by
    ``NOT (old <=> new)``).  ``selected_df`` is the selected rows of
    ``new_df``: the dry-run report.
    """
    if isinstance(rules, Rule):
        rules = [rules]
    # Flags of an earlier rewrite are replaced, not duplicated.
    df = df.drop(*[c for c in ("selected", "changed") if c in df.columns])
    base_cols = list(df.columns)
    touched = sorted({c for r in rules for c in r.set})
    cur = df.select(*base_cols, *[F.col(c).alias(f"__old_{c}") for c in touched])
    flags = []
    for i, r in enumerate(rules):
        flag = f"__sel_{i}"
        cur = _apply_one(cur, r, flag)
        flags.append(flag)
    selected = F.lit(False)
    for f_ in flags:
        selected = selected | F.col(f_)
    changed = F.lit(False)
    for c in touched:
        changed = changed | P.value_changed(F.col(f"__old_{c}"), F.col(c))
    out = cur.select(*base_cols, selected.alias("selected"), changed.alias("changed"))
    return out, out.where(F.col("selected"))


def not_selected(new_df: DataFrame) -> DataFrame:
    """Rows no rule selected."""
    return new_df.where(~F.coalesce(F.col("selected"), F.lit(False)))


# ---- the taggers -------------------------------------------------------------

def browser_name_rule(known: Sequence[str] = P.DEFAULT_BROWSERS) -> Rule:
    """R2: known browser and no label is a plain browser name -> append the
    name without ``-experimental``."""
    should = P.is_known_browser("browser_name", known) & ~P.has_any("labels", known)
    return Rule("browser_name", should, {
        "labels": F.array_append(P.labels_or_empty("labels"),
                                 P.trim_suffix("browser_name", P.EXPERIMENTAL_SUFFIX)),
    })


def channel_label() -> Column:
    """The channel a version string implies, by exact browser name (NULL: none)."""
    b, v = F.col("browser_name"), F.col("browser_version")
    return (F.when((b == "chrome") & v.endswith(" dev"), F.lit("dev"))
            .when((b == "chrome") & v.endswith(" beta"), F.lit("beta"))
            .when((b == "firefox") & v.endswith("a1"), F.lit("nightly"))
            .when((b == "firefox") & v.endswith("b1"), F.lit("beta"))
            .when((b == "safari") & (v.contains("preview") | v.contains("Preview")), F.lit("preview")))


def channel_rule(known: Sequence[str] = P.DEFAULT_BROWSERS) -> Rule:
    """Known browser without any channel label -> append the implied
    channel, if any (others are selected but unchanged)."""
    should = P.is_known_browser("browser_name", known) & ~P.has_any("labels", P.CHANNEL_LABELS)
    label = channel_label()
    return Rule("channel", should, {
        "labels": F.when(label.isNotNull(), F.array_append(P.labels_or_empty("labels"), label))
        .otherwise(F.col("labels")),
    })


def is_experimental_run() -> Column:
    return (F.col("browser_name").endswith(P.EXPERIMENTAL_SUFFIX)
            | F.col("browser_version").endswith(" dev")
            | F.col("browser_version").endswith("a1"))


def _label_set(add: str, remove: str) -> Column:
    # Set semantics: de-duplicated, and sorted so the output is deterministic.
    return F.array_sort(F.array_remove(
        F.array_union(P.labels_or_empty("labels"), F.array(F.lit(add))), remove))


def experimental_rule(known: Sequence[str] = P.DEFAULT_BROWSERS) -> Rule:
    """Known experimental run -> labels as a set, + experimental, - stable."""
    should = P.is_known_browser("browser_name", known) & F.coalesce(is_experimental_run(), F.lit(False))
    return Rule("experimental", should, {"labels": _label_set("experimental", "stable")})


def stable_rule(known: Sequence[str] = P.DEFAULT_BROWSERS) -> Rule:
    """Known non-experimental run -> labels as a set, + stable, - experimental."""
    should = P.is_known_browser("browser_name", known) & ~F.coalesce(is_experimental_run(), F.lit(False))
    return Rule("stable", should, {"labels": _label_set("stable", "experimental")})


def mainline_rule(in_mainline: Column, minutes: int = 10) -> Rule:
    """Not already mainline/PR, from a CI source, lasted > ``minutes``,
    revision in the mainline set -> append ``master``.

    ``in_mainline`` is a boolean column produced by the revision join (J1).
    """
    should = (~P.has_any("labels", P.MAINLINE_LABELS)
              & P.has_any("labels", P.CI_LABELS)
              & P.lasted_longer_than("time_start", "time_end", minutes)
              & F.coalesce(in_mainline, F.lit(False)))
    return Rule("master", should, {
        "labels": F.array_append(P.labels_or_empty("labels"), F.lit("master")),
    })


def time_start_rule() -> Rule:
    """Missing start time -> copy the creation time."""
    return Rule("time_start", P.is_missing_time("time_start"), {"time_start": F.col("created_at")})
