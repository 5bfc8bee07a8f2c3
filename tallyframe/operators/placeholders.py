"""Placeholder closure (W4, T1): values that refer to other keys, closed whatever their order.

The ordered rule of substitution goes through the pairs once, so a value that refers to an earlier
key keeps its placeholder.  The closure goes by the graph of keys instead: a value's ``{other}`` is an
edge from its key to the other.  Reachability and values are found by pointer jumping, so a chain of n
keys takes about log2(n) joins.  Keys that reach a cycle and placeholders that no key explains
are reported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: A placeholder in a value; the key is what stands inside.
PLACEHOLDER = r"\{([^{}]+)\}"


def references(value: Column) -> Column:
    """Keys that a value refers to, once each."""
    return F.array_distinct(F.regexp_extract_all(value, F.lit(PLACEHOLDER), F.lit(1)))


def fill(value: Column, known: Column) -> Column:
    """The value with the placeholders of the map ``known`` filled in, all at once: what is filled in
    is not looked at again, and other placeholders stay."""
    names = F.regexp_extract_all(value, F.lit(PLACEHOLDER), F.lit(1))
    between = F.split(value, PLACEHOLDER, -1)
    parts = F.transform(between, lambda piece, i: F.concat(piece, F.when(i < F.size(names), F.coalesce(
        F.element_at(known, F.get(names, i)), F.concat(F.lit("{"), F.get(names, i), F.lit("}")))).otherwise("")))
    return F.array_join(parts, "")


def _closure(edges: DataFrame, target: list[str]) -> DataFrame:
    """All (target, a, b) such that b is reached from a; the length of the paths known doubles with
    each join, until no pair is new."""
    reach = materialise(edges.select(*target, "a", "b").distinct(), "reach")
    size = reach.count()
    while size:
        step = reach.select(*target, F.col("a").alias("b"), F.col("b").alias("c"))
        further = reach.join(step, [*target, "b"]).select(*target, "a", F.col("c").alias("b"))
        reach = materialise(reach.unionByName(further).distinct(), "reach")
        more = reach.count()
        if more == size:
            break
        size = more
    return reach


def close_placeholders(pairs: DataFrame, target: Sequence[str] | str = "target") -> DataFrame:
    """``(target, key, value, status, depth, unresolved)`` of ``(target, key, value)``, a key once a target.

    ``value`` has every placeholder that leads to a value filled in, through any number of keys.
    ``status``: ``ok``; ``unresolved`` if a placeholder is left that no key of the target explains
    (``unresolved`` lists all that are reached, sorted); ``cycle`` if the key is on a cycle or reaches one: its
    value then stays as it was given.  ``depth``: other keys that the value depends on.

    Defined results: null values are empty and null targets or keys are left out; a target's
    keys do not see other targets; ``{}`` is no placeholder; an empty table gives no row.
    """
    target = [target] if isinstance(target, str) else list(target)
    rows = pairs.select(*target, "key", F.coalesce("value", F.lit("")).alias("value")).na.drop(subset=[*target, "key"])
    rows = materialise(rows, "pairs")
    edges = rows.select(*target, F.col("key").alias("a"), F.explode(references(F.col("value"))).alias("b"))
    reach = _closure(edges, target)
    keys = rows.select(*target, F.col("key").alias("b"), F.lit(True).alias("known"))
    marked = reach.join(keys, [*target, "b"], "left")
    looped = reach.filter("a = b").select(*target, F.col("b"), F.lit(True).alias("looped"))
    facts = marked.join(looped, [*target, "b"], "left").groupBy(*target, F.col("a").alias("key")).agg(
        F.max(F.coalesce("looped", F.lit(False))).alias("cycle"), F.count("known").alias("depth"),
        F.sort_array(F.collect_set(F.when(F.col("known").isNull(), F.col("b")))).alias("unresolved"))
    state = materialise(rows.join(facts, [*target, "key"], "left").select(
        *target, "key", "value", F.coalesce("cycle", F.lit(False)).alias("cycle"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
        F.coalesce("unresolved", F.array().cast("array<string>")).alias("unresolved")), "state")
    # values jump: after a round each holds what twice as many keys away it depends on
    deepest = state.filter("not cycle").agg(F.max("depth")).first()[0] or 0
    rounds = 0 if not deepest else int(deepest).bit_length()
    values = state.filter("not cycle").select(*target, "key", "value")
    for _ in range(rounds):
        asked = values.select(*target, "key", "value", F.explode_outer(references(F.col("value"))).alias("b"))
        given = values.select(*target, F.col("key").alias("b"), F.col("value").alias("given"))
        known = F.map_from_entries(F.collect_list(F.when(F.col("given").isNotNull(), F.struct("b", "given"))))
        values = materialise(asked.join(given, [*target, "b"], "left").groupBy(*target, "key").agg(
            F.first("value").alias("value"), known.alias("known")).select(
            *target, "key", fill(F.col("value"), F.col("known")).alias("value")), "values")
    closed = values.withColumnRenamed("value", "closed")
    status = F.when(F.col("cycle"), "cycle").when(F.size("unresolved") > 0, "unresolved").otherwise("ok")
    return state.join(closed, [*target, "key"], "left").select(
        *target, "key", F.coalesce("closed", "value").alias("value"), status.alias("status"), "depth", "unresolved")
