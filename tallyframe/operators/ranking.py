"""Skew-safe ordered numbering and cumulative weights within groups.

A window ``row_number() over (partition by g order by o)`` sends a whole group to one
task.  When one group may hold a third of the table that task is the job.  Here the
ordered table is cut into slices at split points taken from a bounded random sample.  The
split points are fixed before the numbering, so a row's slice is a plain column of that row: every
scan, every retry and every plan sees the same slice, whichever exchange Spark reuses.

A group that lies inside one slice needs no correction.  Only the groups that a split point
cuts do, and there are at most as many as split points, so their per-slice sums are a small
table of proven size (two rows a slice at most).  Few split points and sums are literals of the
plan; more of them are one value that a scalar subquery brings, so the plan does not grow with the
number of slices.  No join either way.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

#: Sampled rows per slice, and in all, but for MANY_SLICES a slice; the sample's keys are gathered.
SAMPLE_PER_SLICE, SAMPLE, MANY_SLICES = 40, 10_000, 4
#: Split points up to which they are literals, searched by compiled comparisons.
TREE_SLICES = 64

_B = "__tf_slice"
_TIE = "__tf_tie"
_G = "__tf_g"
_O = "__tf_o"


def _cols(cs: Sequence[str | Column] | str | Column | None) -> list:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        return [cs]
    return list(cs)


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class _Sliced:
    """A frame with its key columns and slice number, and the literals that go with them."""

    def __init__(self, df: DataFrame, group: list, order: list, n: int):
        self.columns = df.columns
        cols = [F.col(f"`{c}`") for c in df.columns]
        self.g = [f"{_G}{i}" for i in range(len(group))]
        self.o = [f"{_O}{i}" for i in range(len(order))]
        # the row's hash breaks ties, so a run of equal order keys can be cut too; only fully
        # identical rows stay together, and those are interchangeable
        keyed = df.select(*cols, *[F.expr(f"`{c}`").alias(a) if isinstance(c, str) else c.alias(a)
                                   for c, a in zip(group + order, self.g + self.o)],
                          F.xxhash64(*cols).alias(_TIE))
        self.keys = [*self.g, *self.o, _TIE]
        picked = self._sample(keyed, n) if n > 1 else []
        step = max(1, len(picked) // n)
        self.splits = list(dict.fromkeys(tuple(r) for r in picked[step::step]))[:n - 1]
        self.spark, self.many = df.sparkSession, len(self.splits) > TREE_SLICES
        self.types = {f.name: f.dataType for f in keyed.schema.fields}
        ng = len(self.g)
        self.edges = [s[:ng] for s in self.splits]
        self.df = self._sliced(keyed)
        self._edge_array = self._array(self.edges, self.g) if ng and self.splits else None

    def _sample(self, keyed: DataFrame, n: int) -> list:
        """Keys of random rows, sorted.  The rows are counted first (Spark counts a table without
        reading a column), so a share of them is drawn where they are: no task gathers more
        than the sample."""
        wanted = min(SAMPLE_PER_SLICE * n, max(SAMPLE, MANY_SLICES * n))
        total = keyed.count()
        drawn = keyed.filter(F.rand(17) < wanted / total) if total > wanted else keyed
        return drawn.select(*self.keys).repartition(1).sortWithinPartitions(*self.keys).collect()

    def _struct(self, row, names: list[str]) -> Column:
        return F.struct(*[F.lit(v).cast(self.types[c]).alias(c) for v, c in zip(row, names)])

    def _array(self, rows: Sequence[tuple], names: list[str]) -> Column:
        """An array of keys, as literals or as the value of a scalar subquery."""
        if not self.many:
            return F.array(*[self._struct(r, names) for r in rows])
        kind = T.ArrayType(T.StructType([T.StructField(c, self.types[c]) for c in names]))
        return self._value([tuple(r) for r in rows], kind)

    def _value(self, value: list, kind: T.DataType) -> Column:
        schema = T.StructType([T.StructField("__table", kind)])
        # written, so that the plan holds a file and not the rows
        return materialise(self.spark.createDataFrame([(value,)], schema), "bounds").scalar()

    def _numbers(self, values: list) -> Column:
        if not self.many:
            return F.array(*[F.lit(v) for v in values])
        # exact types: whole sums stay whole, decimals stay decimals
        kind = (T.DoubleType() if any(isinstance(v, float) for v in values) else T.DecimalType(38, 18)
                if any(isinstance(v, Decimal) for v in values) else T.LongType())
        same = [float(v) if isinstance(kind, T.DoubleType) else Decimal(v) if isinstance(kind, T.DecimalType) else v for v in values]
        return self._value(same, T.ArrayType(kind))

    def _sliced(self, keyed: DataFrame) -> DataFrame:
        """``keyed`` with the number of split points <= the row's key, by binary search: over few of them
        as nested comparisons, which compile to plain code, over more a step a projection."""
        key = F.struct(*self.keys)
        if self.many:
            table, at = self._array(self.splits, self.keys), F.col(_B)
            rows = keyed.withColumn(_B, F.lit(0))
            for i in reversed(range(len(self.splits).bit_length())):
                rows = rows.withColumn(_B, F.when(F.get(table, at + ((1 << i) - 1)) <= key, at + (1 << i)).otherwise(at))
            return rows
        bounds = [self._struct(x, self.keys) for x in self.splits]

        def search(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(bounds[mid] <= key, search(mid + 1, hi)).otherwise(search(lo, mid))

        return keyed.withColumn(_B, search(0, len(bounds)))

    def at_edge(self, below: bool) -> Column:
        """Whether the row's group is the one cut by the split point below (above) its slice."""
        if not self.splits:
            return F.lit(False)
        if self._edge_array is None:
            return (F.col(_B) > 0) if below else (F.col(_B) < len(self.splits))
        here = F.get(self._edge_array, F.col(_B) - (1 if below else 0))
        return F.coalesce(F.struct(*self.g).eqNullSafe(here) & here.isNotNull(), F.lit(False))

    def carried(self, weight: Column, zero) -> tuple[Column, Column, Column]:
        """(sum of the row's group in earlier slices, group total from below, from above).

        One scan with partial aggregation; it keeps at most two groups a slice.
        """
        if not self.splits:
            return F.lit(zero), F.lit(zero), F.lit(zero)
        rows = self.df
        if self._edge_array is not None:  # tested on the group alone, before any slice is computed
            groups = list(dict.fromkeys(self.edges))
            rows = rows.filter(F.array_contains(self._array(groups, self.g), F.struct(*self.g)) if self.many else F.struct(
                *self.g).isin(*[self._struct(e, self.g) for e in groups]))
        rows = rows.groupBy(_B, *self.g).agg(F.sum(weight).alias("__w")).collect()
        part, total = defaultdict(dict), defaultdict(lambda: zero)
        for r in rows:
            g = repr(tuple(r[c] for c in self.g))
            w = r["__w"] if r["__w"] is not None else zero
            part[g][r[_B]] = w
            total[g] += w
        before, tot = [zero], []
        for b, edge in enumerate(self.edges, start=1):
            g = repr(tuple(edge))
            before.append(sum((w for s, w in part[g].items() if s < b), zero))
            tot.append(total[g])
        at = lambda vals, i: F.get(self._numbers(vals), i)
        return (F.when(self.at_edge(True), at(before, F.col(_B))).otherwise(F.lit(zero)),
                at(tot, F.col(_B) - 1), at(tot, F.col(_B)))

    def restore(self, df: DataFrame, *more: Column) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in self.columns], *more)


def grouped_row_number(df: DataFrame, group_cols, order_cols, out: str = "rn",
                       num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its group in ``order_cols`` order.

    Equal to ``row_number() over (partition by group order by order)`` (order ascending,
    nulls first, ties broken by a hash of the row), without ever putting one group into one
    task.  With no group columns this is a global, gap-free row number.  The input is counted,
    read three times (sample, counts at the cuts, numbering) and shuffled once.
    """
    s = _Sliced(df, _cols(group_cols), _cols(order_cols), _num_partitions(df, num_partitions))
    before, _, _ = s.carried(F.lit(1), 0)
    w = Window.partitionBy(_B, *s.g).orderBy(*s.o, _TIE)
    numbered = s.df.withColumn("__tf_rn", F.row_number().over(w))
    return s.restore(numbered, (F.col("__tf_rn") + before).cast("long").alias(out))


def grouped_cumulative(df: DataFrame, group_cols, order_cols, weight: str,
                       before: str = "cum_before", total: str | None = None,
                       num_partitions: int | None = None) -> DataFrame:
    """Add ``before`` = sum of ``weight`` over the earlier rows of the same group (and,
    with ``total``, the group's whole weight).  Same slices as ``grouped_row_number``."""
    s = _Sliced(df, _cols(group_cols), _cols(order_cols), _num_partitions(df, num_partitions))
    zero = 0.0 if dict(df.dtypes)[weight] in ("double", "float") else 0
    w_col = F.col(f"`{weight}`")
    earlier, tot_below, tot_above = s.carried(w_col, zero)
    part = Window.partitionBy(_B, *s.g)
    running = part.orderBy(*s.o, _TIE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = s.df.withColumn("__tf_run", F.sum(w_col).over(running) - w_col)
    if total:
        numbered = numbered.withColumn("__tf_all", F.sum(w_col).over(part))
    more = [(earlier + F.col("__tf_run")).alias(before)]
    if total:
        more.append(F.when(s.at_edge(True), tot_below).when(s.at_edge(False), tot_above)
                    .otherwise(F.col("__tf_all")).alias(total))
    return s.restore(numbered, *more)
