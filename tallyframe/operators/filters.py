"""Row filters (F1-F6).  Plain predicates, so Catalyst pushes them into the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1 ------------------------------------------------------------------------------------
def is_active(flag) -> Column:
    """``lower(flag) = 'true'``; a missing flag counts as active."""
    return F.lower(F.trim(F.coalesce(_c(flag).cast("string"), F.lit("True")))) == "true"


def active_only(df: DataFrame, flag: str = "active", must_have: str | None = None) -> DataFrame:
    cond = is_active(flag)
    if must_have is not None:
        cond = cond & F.col(must_have).isNotNull()
    return df.filter(cond)


# F2 ------------------------------------------------------------------------------------
def version_ok(allowed, value) -> Column:
    """True when the list is absent or contains ``value``."""
    return F.coalesce(F.array_contains(_c(allowed), _c(value)), F.lit(True))


def version_match(df: DataFrame, versions: str, version: str,
                  collections: str | None = None, collection: str | None = None) -> DataFrame:
    cond = version_ok(versions, version)
    if collections is not None and collection is not None:
        cond = cond & version_ok(collections, collection)
    return df.filter(cond)


# F3 ------------------------------------------------------------------------------------
def group_value_filter(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) == F.lit(str(value).upper()))


# F4 ------------------------------------------------------------------------------------
def both_over_threshold(df: DataFrame, first: str, second: str,
                        threshold: float = 1_000_000) -> DataFrame:
    return df.filter((F.col(first) >= threshold) & (F.col(second) >= threshold))


# F5 ------------------------------------------------------------------------------------
def name_regex_filter(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Keep rows whose ``column`` contains a match of ``pattern`` (search, not full match)."""
    return df.filter(F.col(column).rlike(pattern))


# F6 ------------------------------------------------------------------------------------
def runnable_sets(pairs: DataFrame, systems: DataFrame, filesets: DataFrame,
                  run_unknown: bool = False) -> DataFrame:
    """Keep (system, fileset) pairs that may run.

    ``pairs``: (system, fileset, pair_active); ``systems``: (system, active);
    ``filesets``: (fileset, active).  A pair runs when its system is active and the fileset
    is active both in the master list and on the pair, or the fileset is unknown to the
    master list while ``run_unknown`` is set.
    """
    s = systems.select("system", F.col("active").alias("__sys_active"))
    f = filesets.select("fileset", F.col("active").alias("__fs_active"),
                        F.lit(True).alias("__known"))
    j = pairs.join(s, "system", "inner").join(f, "fileset", "left")
    known = F.coalesce(F.col("__known"), F.lit(False))
    cond = is_active("__sys_active") & (
        (known & is_active("__fs_active") & is_active("pair_active"))
        | (~known & F.lit(bool(run_unknown))))
    return j.filter(cond).drop("__sys_active", "__fs_active", "__known")
