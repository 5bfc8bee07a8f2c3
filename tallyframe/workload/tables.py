"""Loading the driver's parquet tables and small shared helpers for the query catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Doubles are compared at 12 significant digits, not at a fixed number of decimals: a
# fixed scale is finer than double precision for large sums (and coarser than needed for
# small densities), so summation order alone could flip the last kept digit.
SIG_DIGITS = 12


def sig_round(c: Column, digits: int = SIG_DIGITS) -> Column:
    """Round a double to ``digits`` significant digits (0, null and NaN pass through)."""
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(c)))
    scale = F.pow(F.lit(10.0), k)
    return F.when(c.isNull() | (c == 0) | F.isnan(c), c).otherwise(F.round(c * scale, 0) / scale)


def sig_sql(expr: str, digits: int = SIG_DIGITS) -> str:
    """The same rounding as a DuckDB expression."""
    k = f"({digits - 1} - floor(log10(abs({expr}))))"
    return (f"(CASE WHEN ({expr}) IS NULL OR ({expr}) = 0 THEN ({expr}) "
            f"ELSE round(({expr}) * pow(10, {k}), 0) / pow(10, {k}) END)")


def with_sig_rounding(sql: str) -> str:
    """Rewrite every ``round(<expr>, 6)`` of an oracle into ``sig_sql(<expr>)``.

    A small balanced-parenthesis scan over the oracle text (written in this package),
    so the oracles keep their readable ``round(x, 6)`` spelling.
    """
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, last_comma = 1, j + 6, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                last_comma = k
            k += 1
        args_end = k - 1
        if last_comma is not None and sql[last_comma + 1:args_end].strip() == "6":
            inner = with_sig_rounding(sql[j + 6:last_comma])
            out.append(sql[i:j])
            out.append(sig_sql(inner))
        else:
            out.append(sql[i:k])
        i = k


def r6(df: DataFrame) -> DataFrame:
    """Round every double column for the oracle compare (see ``sig_round``)."""
    cols = []
    for f in df.schema.fields:
        c = F.col("`%s`" % f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = sig_round(c).alias(f.name)
        cols.append(c)
    return df.select(*cols)
