"""Quality rules as a bitmask ledger (operator 10): every rule is evaluated once per document.

The ledger stores what was measured and one failure bit per rule.  Policies are versioned sets of
rules, so a new policy, its verdicts and the effect of leaving a rule out need bit operations on
the ledger only, never the texts again.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space; everything else is part of a word.
SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A failure condition over the measurements, in SQL; integers only, so no rounding."""

    name: str
    fails: str


#: A rule's bit is its position: append new rules, never reorder.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 25 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
)

MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Rules of each policy version.
POLICIES = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length"),
}


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    bits = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(bits[n] for n in names)


def _replaced(c: Column, chars: str, by: str) -> Column:
    for ch in chars:
        c = F.replace(c, F.lit(ch), F.lit(by))
    return c


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements ``n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words`` (long) instead of its text.

    A repeated window costs a sort of the text's window hashes, and only in texts that have one.
    Columns of ``docs`` that are called like a measurement give way to it.
    """
    taken = (*MEASUREMENTS, "fail_bits")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c == text_col or c.lower() not in taken])
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    step = docs.select(*kept, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t"))
    lines = F.filter(F.split("__t", "\n"), lambda x: F.trim(x, F.lit(" " + SPACES)) != "")
    step = step.select("*", F.array_remove(F.split(_replaced(F.col("__t"), SPACES, " "), " "), "").alias("__w"),
                       lines.alias("__l"))
    step = step.select(
        *kept, "__w", F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        (F.octet_length("__t") - F.octet_length(_replaced(F.col("__t"), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"))
    measured = [c for c in MEASUREMENTS if c in step.columns]
    first = F.slice("__w", F.lit(1), F.greatest(F.size("__w") - 2, F.lit(0)))
    step = step.select(*kept, *measured, F.transform(first, lambda w, i: F.xxhash64(
        w, F.get("__w", i + 1), F.get("__w", i + 2))).alias("__h"))
    twice = F.size("__h") > F.size(F.array_distinct("__h"))
    step = step.select(*kept, *measured, F.when(twice, F.sort_array(F.transform(
        "__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("__s"))
    same = F.filter("__s", lambda x, i: (x["h"] == F.get("__s", i - 1)["h"]) | (x["h"] == F.get("__s", i + 1)["h"]))
    step = step.select(*kept, *measured, F.sort_array(F.transform(same, lambda x: x["i"])).alias("__p"))
    covered = F.aggregate("__p", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
                          lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
                          lambda a: a["n"])
    return step.select(*kept, *measured, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def ledger(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``measure`` plus ``fail_bits``: bit i is set if rule i fails.

    Defined results: null or empty text has no words and no lines (all measurements 0, so it fails
    ``too_few_words`` only); rows that repeat are measured each; an empty table gives an empty
    ledger; columns of ``docs`` called like a measurement or ``fail_bits`` give way to these.
    """
    measured = measure(docs, text_col)
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rules):
        bits = bits + F.when(F.expr(r.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return measured.withColumn("fail_bits", bits)


def passes(names: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    """Verdict of a set of rules on a ledger row."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(names, rules)).cast("long")) == 0


def ablations(ledger_rows: DataFrame, policies: dict[str, Sequence[str]] = POLICIES,
              rules: Sequence[Rule] = RULES) -> DataFrame:
    """``policy, rule, n_failed, n_kept, n_kept_without``: what each rule of a policy does.

    The ledger is reduced to its distinct failure bits (at most 2 ** rules rows) before the
    policies are applied, so a policy costs nothing per document.
    """
    patterns = ledger_rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    wanted = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r.name).alias("rule"),
                                F.lit(mask(names, rules)).cast("long").alias("all"),
                                F.lit(1 << i).cast("long").alias("bit"))
                       for p, names in policies.items() for i, r in enumerate(rules) if r.name in names])
    rows = patterns.select("fail_bits", "n", F.explode(wanted).alias("p")).select("fail_bits", "n", "p.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("all"))
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return rows.groupBy("policy", "rule").agg(
        count(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"), count(hit == 0).alias("n_kept"),
        count(hit.bitwiseAND(F.bitwise_not("bit")) == 0).alias("n_kept_without"))
