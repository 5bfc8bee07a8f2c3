"""File sources (S1-S4, S6-S9): CSV in its several guises, script folders, drop folders and
load manifests.  Every reader is a Spark reader; file names and positions come from the
``_metadata`` column, never from listing files on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean
from ..operators.ranking import grouped_row_number

# The default separator and the candidates tried, in this order.
DEFAULT_DELIMITER = "|~|"
DELIMITER_CANDIDATES = [",,", ",", "::", ":", ";;", ";", "||", "|"]


# S1 ------------------------------------------------------------------------------------
def csv_scan(spark: SparkSession, path: str, infer: bool = True, dates_as_text: bool = True,
             sep: str = ",", sampling_ratio: float = 1.0) -> DataFrame:
    """Header CSV with inferred types.  Dates and timestamps stay text (as a pandas reader
    leaves them), so ``1974-12-17`` is not reformatted.  Inference is one extra pass over
    the data; on very large inputs lower ``sampling_ratio`` (inference then looks at a
    sample) or pass ``infer=False`` (all strings)."""
    rd = spark.read.option("header", True).option("escape", '"').option("sep", sep)
    if not infer:
        return rd.csv(path)
    df = rd.option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path)
    if not dates_as_text:
        return df
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if not any(isinstance(f.dataType, temporal) for f in df.schema.fields):
        return df
    schema = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, temporal)
                                         else f.dataType, True) for f in df.schema.fields])
    return spark.read.option("header", True).option("escape", '"').option("sep", sep).schema(schema).csv(path)


# S2 ------------------------------------------------------------------------------------
def _cells(line, sep: str) -> F.Column:
    """The cells of one CSV record: quoted cells lose their quotes, unquoted empty ones are null.
    Every record is cut on its own, so records of any width lose and gain no cell."""
    other = f"[^\\x{{{ord(sep):x}}}]*" if len(sep) == 1 else rf"(?:(?!\Q{sep}\E).)*"
    # every cell follows a separator, so that no match is empty
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(rf'(?s)\Q{sep}\E("[^"]*+(?:""[^"]*+)*+"|{other})'), 1)
    return F.transform(found, lambda c: F.when(F.startswith(c, F.lit('"')) & F.endswith(c, F.lit('"')) & (
        F.length(c) > 1), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).when(c != "", c))


def csv_cells(spark: SparkSession, path: str, sep: str = ",", multiline: bool = False,
              with_path: bool = False) -> DataFrame:
    """Every cell of every CSV file as text: (file, row_no, col_no, cell).

    Files are told apart by their full path (same-named files in different folders stay
    separate); ``with_path`` adds that path as a ``path`` column.  Files and lines may differ in
    width.  Blank lines do not count.

    Row 0 is the header line, columns count from 1.  Row numbers are exact and
    distributed: each row remembers its split (``_metadata.file_block_start``) and its
    position inside the split, and ``grouped_row_number`` numbers them per file without
    gathering a file into one task.  Quoted cells with line breaks need ``multiline=True``:
    each file is then one row, which is meant for report-sized files; the numbering is the same.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if multiline:
        whole = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("__path"), "value")
        records = F.filter(F.regexp_extract_all("value", F.lit(r'((?:[^"\r\n]++|"[^"]*+")++)'), 1), lambda r: F.trim(r) != "")
        ranked = whole.select("__path", F.posexplode(records).alias("row_no", "value")).withColumn(
            "row_no", F.col("row_no").cast("long"))
    else:
        raw = reader.text(path).filter(F.trim("value") != "").select(
            "value", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__blk"),
            F.monotonically_increasing_id().alias("__mid"))
        ranked = grouped_row_number(raw, ["__path"], ["__blk", "__mid"], out="__rn").withColumn(
            "row_no", F.col("__rn") - 1)
    out = ranked.select(F.element_at(F.split("__path", "/"), -1).alias("file"), F.col("__path").alias("path"),
                        "row_no", F.posexplode(_cells(F.col("value"), sep)).alias("__p", "cell"))
    cols = ["file"] + (["path"] if with_path else [])
    return out.select(*cols, "row_no", (F.col("__p") + 1).alias("col_no"), "cell")


# S3 ------------------------------------------------------------------------------------
def delimiter_sniff(spark: SparkSession, path: str, start: str = DEFAULT_DELIMITER,
                    candidates: Sequence[str] = DELIMITER_CANDIDATES) -> DataFrame:
    """Pick each file's separator from non-overlapping counts over the whole file:
    (path, file, delimiter), files told apart by their full path.

    A candidate replaces the current choice when ``count·len·1.1`` beats the current
    ``count·len``.  All counts are one aggregation per file; the fold over the few
    candidates is a column expression.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("path"), "value")
    cands = [start] + list(candidates)

    def occurrences(c: str):
        return (F.length("value") - F.length(F.replace(F.col("value"), F.lit(c), F.lit("")))) / len(c)

    counts = lines.groupBy("path").agg(*[F.sum(occurrences(c)).alias(f"__n{i}") for i, c in enumerate(cands)])
    choice, score = F.lit(start), F.col("__n0") * len(start)
    for i, c in enumerate(cands[1:], start=1):
        s = F.col(f"__n{i}") * len(c)
        better = (s * 1.1) > score
        choice = F.when(better, F.lit(c)).otherwise(choice)
        score = F.when(better, s).otherwise(score)
    return counts.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), choice.alias("delimiter"))


# S4 ------------------------------------------------------------------------------------
def delimited_rows(spark: SparkSession, path: str | list[str], sep: str = DEFAULT_DELIMITER) -> DataFrame:
    """Files read with ``sep``, strings and headers stripped, NaN → null."""
    df = spark.read.option("header", True).option("sep", sep).option("escape", '"').option(
        "inferSchema", True).csv(path)
    return clean.nan_to_null(clean.trim_all(df))


def delimited_normalise(spark: SparkSession, path: str | list[str], out: str, sep: str = DEFAULT_DELIMITER) -> DataFrame:
    """Re-read with ``sep``, strip strings and headers, NaN → null, write quoted comma CSV."""
    df = delimited_rows(spark, path, sep)
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(out)
    return csv_scan(spark, out)


# S6 ------------------------------------------------------------------------------------
def temp_view_types(df: DataFrame, empty_string_for_null: bool = False) -> DataFrame:
    """int → bigint, float → decimal(32,10), everything else → string."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.nanvl(c.cast("double"), F.lit(None).cast("double")).cast("decimal(32,10)")
        else:
            c = c.cast("string")
            if empty_string_for_null:
                c = F.coalesce(c, F.lit(""))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def csv_temp_view(spark: SparkSession, path: str, name: str | None = None,
                  empty_string_for_null: bool = False) -> str:
    """Expose a CSV as a session view named after the file (without extension)."""
    view = name or path.rstrip("/").split("/")[-1].rsplit(".", 1)[0]
    temp_view_types(csv_scan(spark, path), empty_string_for_null).createOrReplaceTempView(view)
    return view


# S7 ------------------------------------------------------------------------------------
def script_scan(spark: SparkSession, root: str, pattern: str = "*.sql") -> DataFrame:
    """Folder of scripts ``root/<system>/<fileset>/<file>`` → (system, fileset, file, text).

    Hidden files are skipped by Spark's file index; ``key=value`` folder names (as written by
    ``partitionBy``) are read as their value.
    """
    # wholetext goes through text()'s own keyword: text() sets it explicitly, so an earlier
    # .option("wholetext", True) would be overridden
    df = (spark.read.option("recursiveFileLookup", True)
          .option("pathGlobFilter", pattern).text(root, wholetext=True))
    parts = F.split(F.col("_metadata.file_path"), "/")
    n = F.size(parts)

    def seg(k):
        return F.regexp_replace(F.element_at(parts, n - k), "^[^=]*=", "")

    return df.select(seg(2).alias("system"), seg(1).alias("fileset"),
                     F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


# S8 ------------------------------------------------------------------------------------
ROUTE = ("system", "fileset", "name")


def route_drop_files(df: DataFrame) -> DataFrame:
    """Add (system, fileset, name) from ``system.fileset.name.csv`` file names; a column of the
    file that is called like one of them gets ``_csv`` after its name."""
    own = [F.col(f"`{c}`").alias(f"{c}_csv" if c.lower() in ROUTE else c) for c in df.columns]
    parts = F.split(F.col("_metadata.file_name"), r"\.")
    return df.select(*own, parts[0].alias("system"), parts[1].alias("fileset"),
                     F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), ".").alias("name"))


def drop_folder_scan(spark: SparkSession, folder: str, out: str | None = None,
                     schema: T.StructType | str | None = None) -> DataFrame:
    """Hand-delivered CSVs routed by their name; optionally written partitioned by
    (system, fileset).  For an incrementally filled folder see ``streaming.dropfolder``.

    Files may have different headers: each group of files with one header is read by it, and
    the groups are united by column name (a column that a file lacks is null).  The driver
    walks the headers and holds the file names, as Spark's own file index does.
    """
    rd = lambda: spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        routed = route_drop_files(rd().schema(schema).csv(folder))
    else:
        first = (spark.read.option("recursiveFileLookup", True).text(folder)
                 .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                         F.monotonically_increasing_id().alias("id")).filter("at = 0 and trim(value) <> ''")
                 .groupBy("path").agg(F.min_by("value", "id").alias("header")))
        layouts = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect()
        parts = [route_drop_files(rd().option("inferSchema", True).csv(r["paths"])) for r in layouts]
        if not parts:
            raise ValueError(f"no delivered file in {folder}")
        routed = reduce(lambda x, y: _united(x, y), parts)
    if out is not None:
        routed.write.mode("append").partitionBy("system", "fileset").parquet(out)
    return routed


def _united(x: DataFrame, y: DataFrame) -> DataFrame:
    """Union by name; a column read with two types becomes text."""
    kinds = dict(y.dtypes)
    mixed = [c for c, kind in x.dtypes if kinds.get(c, kind) != kind]
    text = {c: F.col(f"`{c}`").cast("string") for c in mixed}
    return x.withColumns(text).unionByName(y.withColumns(text), allowMissingColumns=True)


# S9 ------------------------------------------------------------------------------------
MANIFEST_SCHEMA = T.StructType([T.StructField("entries", T.ArrayType(T.StructType([
    T.StructField("file", T.StringType()), T.StructField("table", T.StringType()),
    T.StructField("call", T.StringType())])))])


def manifest_read(spark: SparkSession, path: str, default_schema: str = "default") -> DataFrame:
    """Manifest JSON → (file, schema, table, call); ``a.b`` splits, no dot → default schema."""
    m = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
    e = m.select(F.inline("entries"))
    parts = F.split(F.col("table"), r"\.")
    return e.select("file",
                    F.when(F.size(parts) >= 2, parts[0]).otherwise(F.lit(default_schema)).alias("schema"),
                    F.when(F.size(parts) >= 2, parts[1]).otherwise(F.col("table")).alias("table"),
                    F.coalesce("call", F.lit("")).alias("call"))
