"""Projections that tidy result frames before reporting.

All of them only rewrite the projection list, so they fuse into the scan's codegen stage
and never move data.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import humanise_name_py, strip_ws

# Headers that mark an exported row index (pandas writes "Unnamed: n", Spark reads "_cN").
_UNNAMED = re.compile(r"^(Unnamed: ?\d*|_c\d+)$")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# P1 ------------------------------------------------------------------------------------
def drop_unnamed(df: DataFrame) -> DataFrame:
    drop = [c for c in df.columns if _UNNAMED.match(c) or c.strip() == ""]
    return df.drop(*drop) if drop else df


# P2 ------------------------------------------------------------------------------------
def resolve_names(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Case-insensitive lookup of ``names`` among ``df.columns`` (frame order kept)."""
    want = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() in want]


def keep_columns(df: DataFrame, index: Sequence[str] = (), data: Sequence[str] = ()) -> DataFrame:
    """Keep index ∪ data columns (case-insensitive); a no-op when ``data`` is empty."""
    if not data:
        return df
    return df.select(*[_q(c) for c in resolve_names(df, list(index) + list(data))])


# P3 ------------------------------------------------------------------------------------
def humanise_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = df.columns if columns is None else columns
    return df.withColumnsRenamed({c: humanise_name_py(c) for c in cols if humanise_name_py(c) != c})


# P4 ------------------------------------------------------------------------------------
def trim_all(df: DataFrame) -> DataFrame:
    """Strip every string cell and every header (whitespace as Python's ``strip``)."""
    out = []
    for f in df.schema.fields:
        name = f.name.strip()
        if isinstance(f.dataType, T.StringType):
            out.append(strip_ws(F.col(_q(f.name))).alias(name))
        else:
            out.append(F.col(_q(f.name)).alias(name))
    return df.select(*out)


# P5 ------------------------------------------------------------------------------------
def stringify(df: DataFrame, columns: Sequence[str] | None = None,
              null_text: str | None = None) -> DataFrame:
    """Cast text-like columns (or ``columns``) to string; nulls stay null unless ``null_text``."""
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, (T.StringType, T.DateType, T.TimestampType,
                                              T.TimestampNTZType, T.BooleanType, T.BinaryType))]
    cols = set(columns)
    out = []
    for c in df.columns:
        if c in cols:
            e = F.col(_q(c)).cast("string")
            if null_text is not None:
                e = F.coalesce(e, F.lit(null_text))
            out.append(e.alias(c))
        else:
            out.append(F.col(_q(c)))
    return df.select(*out)


# P6 ------------------------------------------------------------------------------------
def pad_hour_expr(c) -> F.Column:
    s = F.col(c).cast("double").cast("int").cast("string") if isinstance(c, str) else c
    # zfill(2): never truncates (lpad would cut "123" to "12")
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), 2 - F.length(s))), s)


def pad_hour(df: DataFrame) -> DataFrame:
    hits = resolve_names(df, ["loghour"])
    if not hits:
        return df
    return df.withColumns({h: pad_hour_expr(h) for h in hits})


# P7 ------------------------------------------------------------------------------------
def log_time(df: DataFrame) -> DataFrame:
    d, h = resolve_names(df, ["logdate"]), resolve_names(df, ["loghour"])
    if not d or not h:
        return df
    lt = F.concat(F.col(_q(d[0])).cast("string"), F.lit(" h"), F.col(_q(h[0])).cast("string"))
    return df.select(lt.alias("LogTime"), *[_q(c) for c in df.columns if c != "LogTime"])


# P8 ------------------------------------------------------------------------------------
def clean_log_frame(df: DataFrame, index: Sequence[str] = (), data: Sequence[str] = (),
                    sort: bool = True, null_text: str | None = None) -> DataFrame:
    """Drop index-like columns, keep index+data, text to string, pad hours, add LogTime.

    With ``sort`` the frame is ordered by the index columns (the documented intent).
    """
    out = drop_unnamed(df)
    out = keep_columns(out, index, data)
    out = stringify(out, null_text=null_text)
    out = pad_hour(out)
    out = log_time(out)
    idx = resolve_names(out, index)
    if sort and idx:
        out = out.orderBy(*[_q(c) for c in idx])
    return out


# P9 ------------------------------------------------------------------------------------
def normalise_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper-case, then underscores to spaces (the humanise map can no longer match)."""
    return df.withColumns({c: F.replace(F.upper(F.col(_q(c))), F.lit("_"), F.lit(" "))
                           for c in columns})


# P10 -----------------------------------------------------------------------------------
def decimal_to_double(df: DataFrame) -> DataFrame:
    dec = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(_q(c)).cast("double") for c in dec}) if dec else df


# P11 -----------------------------------------------------------------------------------
def nan_to_null(df: DataFrame) -> DataFrame:
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(_q(c)), F.lit(None).cast(
        df.schema[c].dataType)) for c in fl}) if fl else df


# P12 -----------------------------------------------------------------------------------
def scatter_points(df: DataFrame, x: str, y: str, hue: str, style: str) -> DataFrame:
    """Readable-named projection of the four scatter roles (no aggregation)."""
    cols = []
    for c in dict.fromkeys([x, y, hue, style]):
        cols.append(F.col(_q(c)).alias(humanise_name_py(c)))
    return df.select(*cols)
