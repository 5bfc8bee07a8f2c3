"""The split that the two classifiers learn by, and their bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(id_col: str) -> Column:
    """Documents whose crc32 of the id as text is 2 mod 4 (a null id: never)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


#: Rows of a label that are ranked, as a multiple of those wanted.
SPARE = 4


def sample(labelled: DataFrame, id_col: str, label_col: str, per_label: int, most_labels: int) -> DataFrame:
    """At most ``per_label`` rows of each of the ``most_labels`` most frequent labels.

    The rows with the smallest hashes of their id.  As the counts are known, a threshold on the hash
    first cuts each label to about SPARE times the rows wanted, so what is ranked (narrow rows, a
    task per label) does not follow the input.
    """
    frequent = labelled.groupBy(label_col).count().orderBy(F.desc("count"), label_col).limit(most_labels)
    share = F.lit(float(SPARE * per_label)) / F.col("count")
    place = F.pmod(F.xxhash64(id_col), F.lit(1 << 53)) / F.lit(float(1 << 53))
    order = Window.partitionBy(label_col).orderBy("__place", id_col)
    # at most most_labels rows are broadcast
    near = labelled.select(id_col, label_col, place.alias("__place")).join(F.broadcast(frequent), label_col).filter(
        F.col("__place") < share)
    chosen = near.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= per_label)
    return chosen.select(id_col, label_col).dropDuplicates([id_col])


def excerpt(text: Column, chars: int, pieces: int) -> Column:
    """The text, or of one with more than ``chars`` characters as many in ``pieces`` runs of whole words
    spread over all of it, one line each."""
    size, run = F.char_length(text), chars // pieces
    parts = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.regexp_replace(F.substring(
        text, (i * (size - run) / F.lit(pieces - 1)).cast("int") + 1, F.lit(run)), r"^[^ \t\n]*[ \t\n]|[ \t\n][^ \t\n]*$", ""))
    return F.when(size > chars, F.array_join(parts, "\n")).otherwise(text)


def sampled_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, chars: int, pieces: int) -> DataFrame:
    """``chosen`` (a bounded sample of ids) with the ``excerpt`` of its text as ``text``: one row an id; of an id that
    stands for several texts, that with the smallest hash."""
    known = docs.select(F.col(id_col), F.col(text_col).alias("text")).filter("text is not null")
    text = F.struct(F.xxhash64("text").alias("order"), excerpt(F.col("text"), chars, pieces).alias("text"))
    # the sample is broadcast, its rows are bounded by the caller's constants
    return known.join(F.broadcast(chosen), id_col).groupBy(*chosen.columns).agg(F.min(text).alias("one")).select(
        *chosen.columns, F.col("one.text").alias("text"))
