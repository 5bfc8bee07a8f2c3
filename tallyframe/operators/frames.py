"""Whole-frame utilities: profiles, grouping, ordering, unions, numbering (A13-A15, O*, U1, U3,
W3, W7)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import grouped_row_number

_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# A13 -----------------------------------------------------------------------------------
def type_class(dt: T.DataType) -> str:
    if isinstance(dt, _INT_TYPES):
        return "int"
    if isinstance(dt, _FLOAT_TYPES):
        return "float"
    return "text"


def text_profile(df: DataFrame, headroom: int = 100) -> DataFrame:
    """One row per column: type class, max text length, declared SQL type, row count.

    One aggregation pass computes every column's maximum length at once; the single
    result row is then turned into a long frame.  Integers map to BIGINT, floats to
    DECIMAL(32,10) and everything else to VARCHAR(max length + headroom).
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, f in enumerate(fields):
        if type_class(f.dataType) == "text":
            aggs.append(F.max(F.length(F.col(_q(f.name)).cast("string"))).alias(f"__l{i}"))
    one = df.agg(*aggs)
    entries = []
    for i, f in enumerate(fields):
        tc = type_class(f.dataType)
        mlen = F.col(f"__l{i}") if tc == "text" else F.lit(None).cast("int")
        sql_type = {"int": F.lit("BIGINT"), "float": F.lit("DECIMAL(32,10)")}.get(
            tc, F.concat(F.lit("VARCHAR("), (F.coalesce(mlen, F.lit(0)) + headroom).cast("string"),
                         F.lit(")")))
        entries.append(F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                                F.lit(tc).alias("type_class"), mlen.alias("max_len"),
                                sql_type.alias("sql_type"), F.col("__n").alias("n_rows")))
    return one.select(F.inline(F.array(*entries)))


# A14 -----------------------------------------------------------------------------------
def partition_by_key(df: DataFrame, key: str, default: str = "default",
                     guaranteed: Sequence[str] = (), out: str = "group_key") -> DataFrame:
    """Every record under ``coalesce(key, default)``; listed groups exist even when empty.

    The result is long (one row per record plus one all-null row per empty guaranteed
    group) rather than one collected list per group, so a hot group never becomes one
    row or one task.  ``nest_groups`` gives the nested form for small inputs.
    """
    keyed = df.select(F.coalesce(F.col(_q(key)).cast("string"), F.lit(default)).alias(out), "*")
    if not guaranteed:
        return keyed
    spark = df.sparkSession
    want = spark.createDataFrame([(g,) for g in guaranteed], f"{out} string")
    missing = want.join(keyed.select(out).distinct(), out, "left_anti")
    return keyed.unionByName(missing, allowMissingColumns=True)


def nest_groups(long: DataFrame, key: str = "group_key") -> DataFrame:
    """Nested view (one row per group, records as a list).  Only for bounded groups."""
    rest = [c for c in long.columns if c != key]
    rec = F.struct(*[_q(c) for c in rest])
    allnull = reduce(lambda a, b: a & b, [F.col(_q(c)).isNull() for c in rest])
    return long.groupBy(key).agg(F.collect_list(F.when(~allnull, rec)).alias("records"))


def split_children(parents: DataFrame, parent: str, children: str, key: str,
                   order: str) -> DataFrame:
    """Nested variant: children (a ``map<name, map<string,string>>``) grouped by their
    ``key`` value; children without the key are skipped; a repeated child name keeps
    the last one (by ``order``)."""
    ex = parents.select(F.col(parent), F.col(order),
                        F.explode(F.col(children)).alias("child", "attrs"))
    ex = ex.filter(F.col("attrs")[key].isNotNull())
    ordcol = F.col(order)
    return (ex.groupBy(F.col("attrs")[key].alias("group_key"), "child")
            .agg(F.max_by(F.struct(F.col(parent), F.col("attrs")), ordcol).alias("last"))
            .select("group_key", "child", "last.*"))


# A15 -----------------------------------------------------------------------------------
def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


# O4 ------------------------------------------------------------------------------------
def preview(df: DataFrame, order: Sequence[str | Column], n: int = 10) -> DataFrame:
    """First ``n`` rows in a defined order (top-k: a sort with a limit, no full sort)."""
    return df.orderBy(*order).limit(n)


# O5 ------------------------------------------------------------------------------------
def find_site_column(df: DataFrame) -> str | None:
    for c in df.columns:
        if c.lower().replace("_", "") == "siteid":
            return c
    return None


def site_id(df: DataFrame, order: Sequence[str | Column], default: str = "unknown",
            out: str = "site_id") -> DataFrame:
    """Value of the first ``siteid`` column (case/underscore-insensitive) in the first row."""
    col = find_site_column(df)
    if col is None:
        return df.sparkSession.range(1).select(F.lit(default).alias(out))
    first = df.orderBy(*order).limit(1).select(F.col(_q(col)).cast("string").alias("__v"))
    return (first.groupBy().agg(F.first("__v").alias("__v"))
            .select(F.coalesce(F.col("__v"), F.lit(default)).alias(out)))


# O6 ------------------------------------------------------------------------------------
def latest_run(df: DataFrame, name: str, group: Sequence[str] = (), out: str = "latest_run") -> DataFrame:
    """Newest run by its time-stamped name (names sort chronologically)."""
    return df.groupBy(*group).agg(F.max(name).alias(out))


# U1 ------------------------------------------------------------------------------------
def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns missing on one side are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# U3 ------------------------------------------------------------------------------------
def combine_texts(df: DataFrame, keys: Sequence[str], order: str, text: str | Column,
                  sep: str = "", prefix: str | None = None, out: str = "text") -> DataFrame:
    """One text per group: the members' texts in ``order`` order, joined by ``sep``.

    When ``prefix`` is given it is removed from every member and written once at the
    top if any member carried it.  A group becomes one row by definition, so this is
    for naturally bounded groups (the scripts of one fileset, the turns of one
    conversation).
    """
    t = F.col(text) if isinstance(text, str) else text
    base = df.select(*keys, F.col(order).alias("__o"), t.alias("__t"))
    if prefix:
        base = base.withColumns({"__p": F.contains(F.col("__t"), F.lit(prefix)),
                                 "__t": F.replace(F.col("__t"), F.lit(prefix), F.lit(""))})
    else:
        base = base.withColumn("__p", F.lit(False))
    agg = base.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("__o", "__t"))).alias("__a"),
        F.max("__p").alias("__has"))
    body = F.array_join(F.transform("__a", lambda e: e["__t"]), sep)
    if prefix:
        body = F.when(F.col("__has"), F.concat(F.lit(prefix), body)).otherwise(body)
    return agg.select(*keys, body.alias(out))


def combine_scripts(scripts: DataFrame, prefix: str | None = None) -> DataFrame:
    """Scripts of one (system, fileset, extension) in name order → ``!_<sys>_<set>.combined.<ext>``."""
    ext = F.lower(F.trim(F.element_at(F.split("file", r"\."), -1)))
    s = scripts.withColumn("ext", ext)
    out = combine_texts(s, ["system", "fileset", "ext"], "file", "text", prefix=prefix)
    return out.withColumn("file", F.format_string("!_%s_%s.combined.%s", "system", "fileset", "ext"))


# W3 ------------------------------------------------------------------------------------
# Fixed values below: a repeat's counter (``.%03d`` before the extension) and the combined name.
def dedupe_names(df: DataFrame, name: str, seq: Sequence[str] | str, out: str = "file_name") -> DataFrame:
    """The n-th repeat (n ≥ 1, in ``seq`` order) of a name gets ``.%03d`` before its extension."""
    seq = [seq] if isinstance(seq, str) else list(seq)
    ranked = grouped_row_number(df, [name], seq, out="__rn")
    n = F.col("__rn") - 1
    nm = F.col(name)
    dup = F.concat(F.expr(f"substring({_q(name)}, 1, length({_q(name)}) - 4)"),
                   F.format_string(".%03d", n), F.right(nm, F.lit(4)))
    return ranked.withColumn(out, F.when(n == 0, nm).otherwise(dup)).drop("__rn")


# Fixed value: the name of a result that no directive names.
OUTPUT_NAME = "%s.%s--%s%04d.csv"


def default_output_name_py(system: str, fileset: str, script: str, number: int) -> str:
    return OUTPUT_NAME % (system, fileset, script, number)


# W7 ------------------------------------------------------------------------------------
def row_chunks(df: DataFrame, order: Sequence[str], size: int = 100,
               group: Sequence[str] = (), out: str = "chunk") -> DataFrame:
    """Chunk number ``floor((row_number-1)/size)+1`` in ``order`` (per ``group``).

    Numbering is by slices (``grouped_row_number``): no window over an unpartitioned or
    hot group.
    """
    ranked = grouped_row_number(df, list(group), list(order), out="row_no")
    return ranked.withColumn(out, F.floor((F.col("row_no") - 1) / size).cast("long") + 1)
