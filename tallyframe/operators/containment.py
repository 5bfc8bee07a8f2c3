"""Version and collection lists as an inverted index (J2, F2): a containment join on equality keys.

A file admits a system if its list of versions is absent or holds the system's version, and likewise
its collections.  The files of a fileset that have the same lists are one class.  Each class is indexed
under the tokens that admit it, with a wildcard for an absent list; each system asks under its own
tokens and the wildcard, and the classes that it gets bring their files.  A pair that matches meets
exactly once and one that doesn't never meets, so the join's output is the result; the index
repeats lists, never files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import is_active


def _held(allowed: str) -> Column:
    """Index keys of a list: its tokens once each, or a null for an absent list.  (A list that holds a
    null admits the versions that it holds, and, as nothing is known of the others, those too.)"""
    open_ = F.col(allowed).isNull() | F.exists(F.col(allowed), lambda x: x.isNull())
    token = F.struct(F.lit(True).alias("any"), F.lit("").alias("token"))
    each = F.transform(F.array_distinct(F.col(allowed)), lambda x: F.struct(F.lit(False).alias("any"), x.alias("token")))
    return F.when(open_, F.array(token)).otherwise(each)


def _asked(value: str) -> Column:
    """Keys that a value looks under: itself and the wildcard.  A null value knows no list, so it is
    admitted by every one: it looks under all, by a key of its own (see ``_indexed``)."""
    wild = F.struct(F.lit(True).alias("any"), F.lit("").alias("token"))
    own = F.struct(F.lit(False).alias("any"), F.coalesce(F.col(value), F.lit("")).alias("token"))
    return F.when(F.col(value).isNull(), F.array(F.struct(F.lit(True).alias("any"), F.lit("null").alias("token")))).otherwise(
        F.array(own, wild))


def _indexed(allowed: str) -> Column:
    return F.concat(_held(allowed), F.array(F.struct(F.lit(True).alias("any"), F.lit("null").alias("token"))))


def admitted_files(pairs: DataFrame, systems: DataFrame, filesets: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of ``eligible_files`` (flat ``files``): active systems, their active filesets, and the
    files of these whose lists admit the system.

    Lists hold few tokens, and a class is indexed once per pair of them; a file is moved once, to its class.
    Null versions or collections of a system are admitted by every list, as by ``version_ok``; an empty list
    admits nobody else.
    """
    s = systems.filter(is_active("active")).select("system", "dbsversion", "collection")
    p = pairs.filter(is_active("pair_active")).select("system", "fileset")
    active = filesets.filter(is_active("active")).select("fileset").distinct()
    lists = ["file_versions", "file_collections"]
    f = files.select("fileset", "file_key", "gitfile", F.col("dbsversion").alias("file_versions"),
                     F.col("collection").alias("file_collections"), "params")
    classes = f.select("fileset", *lists).distinct()
    index = classes.withColumn("v", F.explode(_indexed("file_versions"))).withColumn("c", F.explode(_indexed("file_collections")))
    asking = p.join(active, "fileset", "left_semi").join(s, "system").withColumn(
        "v", F.explode(_asked("dbsversion"))).withColumn("c", F.explode(_asked("collection")))
    granted = asking.join(index, ["fileset", "v", "c"]).select(
        "system", F.col("fileset").alias("__set"), "dbsversion", "collection", *[F.col(c).alias(f"__{c}") for c in lists])
    same = [F.col(f"__{c}").eqNullSafe(F.col(c)) for c in lists]
    return granted.join(f, [F.col("__set") == F.col("fileset"), *same]).select(
        "system", "fileset", "dbsversion", "collection", "file_key", "gitfile", *lists, "params")
