"""Mixing sources to target weights by weighted fair queueing (operator 5).

Each source queues its documents in a shuffled order, again from the start when they run out.
A copy of a document finishes at the virtual time (words its source has sent with it) divided by
its source's target.  All copies are then range-sorted by finish time over the whole table, and
the queue is cut where the words sent reach the total budget.  Every source is served in
proportion to its target, so at the cut each is within about one document of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import grouped_cumulative, grouped_row_number
from .tables import written

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int], share: Fraction, repeats: int) -> DataFrame:
    """``(source, source_size)`` to ``(source, source_size, target)``.

    ``share`` of all words is dealt by weight; a target stops at ``repeats`` times its source's
    size and the excess is dealt again, until none is above.  What is dealt per unit of weight
    only grows, so a round is one aggregation over the sources and a source capped once stays so.
    """
    ranked = grouped_row_number(sources.withColumn("__null", F.col("source").isNull()),
                                [], ["__null", "source"], out="__rank").drop("__null")
    turn = ((F.col("__rank") - 1) % len(weights)).cast("int")
    ranked = ranked.select("source", "source_size", F.get(F.array(*[F.lit(w) for w in weights]), turn).alias("weight"))
    ranked = written(ranked, "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, per, capped = share * total, Fraction(0), None
    while True:
        # cap < weight * per, in whole numbers
        above = (F.col("source_size") * repeats).cast("decimal(38,0)") * F.lit(per.denominator).cast("decimal(38,0)") < (
            F.col("weight").cast("decimal(38,0)") * F.lit(per.numerator).cast("decimal(38,0)"))
        caps, n, left = ranked.agg(
            F.coalesce(F.sum(F.when(above, F.col("source_size") * repeats)), F.lit(0)),
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == capped or not left:
            break
        capped, per = n, (budget - caps) / left
        per = per.limit_denominator(1 << 20) if per.denominator > 1 << 20 else per
    dealt = F.col("weight") * F.lit(float(per))
    return ranked.select("source", "source_size", F.least(
        dealt, (F.col("source_size") * repeats).cast("double")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (5, 2, 1), share: Fraction = Fraction(3, 2), repeats: int = 2,
        seed: int = 0) -> DataFrame:
    """One row per document: ``id_col, source, size, source_size, target, copies, taken``.

    Sources are ranked by code point, null last, and take ``weights`` in turn.  ``copies`` is how
    often the mix takes the document (0 to ``repeats``), ``taken`` its words times that.

    Defined results: null text has size 0; documents without words are never taken; a null source
    is a source; rows of one id are separate documents, told apart by their other values, and the
    order of fully equal rows does not matter; an empty table gives no row; other columns are
    ignored.  The shuffle is a hash of (seed, id), so reruns agree.
    """
    sizes = written(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("shuffled")), "sizes")
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(per_source, weights, share, repeats)
    queued = written(grouped_cumulative(sizes, ["source"], ["shuffled"], "size", before="sent"), "queued")
    queued = queued.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def finish(epoch) -> Column:
        return F.when((F.col("size") > 0) & (F.col("target") > 0),
                      (epoch * F.col("source_size") + F.col("sent") + F.col("size")) / F.col("target"))

    epochs = F.array(*[F.lit(e) for e in range(repeats)])
    copies = queued.select("size", "shuffled", F.explode(F.transform(epochs, lambda e: F.struct(
        finish(e).alias("finish"), e.alias("epoch")))).alias("c")).select("size", "shuffled", "c.*").filter("finish is not null")
    budget = sizes.agg(F.sum("size")).first()[0] or 0
    budget = int(budget * share)
    cut = (grouped_cumulative(written(copies, "copies"), [], ["finish", "epoch", "shuffled"], "size", before="served")
           .filter(F.col("served") + F.col("size") <= budget)
           .agg(F.max(F.struct("finish", "epoch", "shuffled")).alias("last")).first()["last"])
    if cut is None:
        copies_taken = F.lit(0)
    else:
        last = F.struct(F.lit(cut["finish"]), F.lit(cut["epoch"]), F.lit(cut["shuffled"]))
        copies_taken = sum((F.when(F.struct(finish(e), F.lit(e), F.col("shuffled")) <= last, 1).otherwise(0)
                            for e in range(repeats)), F.lit(0))
        copies_taken = F.when(F.col("size") > 0, copies_taken).otherwise(0)
    return queued.withColumn("copies", copies_taken.cast("int")).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  **options) -> DataFrame:
    """The rows that the mix takes, each as often as it takes them, with the columns of ``docs``.

    Rows are told apart by id, source and size; rows equal in all three are taken equally often,
    as often as the one taken least.
    """
    plan = mix(docs, id_col, text_col, source_col, **options).filter("copies > 0").groupBy(
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), F.col("size").alias("__size")).agg(
        F.min("copies").alias("__copies"))
    here = (F.col(id_col).eqNullSafe(F.col("__id")) & F.col(source_col).eqNullSafe(F.col("__source"))
            & (word_count(F.col(text_col)) == F.col("__size")))
    taken = docs.join(plan, here).withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies")))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
