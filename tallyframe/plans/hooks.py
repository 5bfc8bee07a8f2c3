"""User-extension surface (X1-X3): user functions run on statements, after loads and on
non-empty results.  User code receives DataFrames, never collected rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, scratch_dir
from .observed import write_if_any


# X1 ------------------------------------------------------------------------------------
def apply_per_statement(stmts: DataFrame, handlers: Mapping[str, Callable[[DataFrame], DataFrame]],
                        keys: Sequence[str] = ("system", "stmt_no")) -> DataFrame:
    """Run each handler on the statements that carry its directive.

    ``stmts`` has ``directives`` (array of key/value/kind) and ``runtime`` (map of the
    run-time directives).  A handler named ``all…`` runs on every statement.  Each
    handler is a ``DataFrame → DataFrame`` applied through ``transform`` and must return
    ``keys`` plus a string ``value``; results are unioned with the handler name.
    """
    outs = []
    for name, fn in handlers.items():
        if name.startswith("all"):
            sel = stmts
        else:
            sel = stmts.filter(F.exists("directives", lambda d: d["key"] == name)
                               | F.map_contains_key(F.col("runtime"), F.lit(name)))
        res = sel.transform(fn).select(*keys, F.lit(name).alias("handler"), F.col("value").cast("string"))
        outs.append(res)
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def post_work(results: DataFrame, handlers: Mapping[str, Callable[[DataFrame], DataFrame]],
              script: str = "script") -> DataFrame:
    """Per-script post-work: each handler gets its script's results as a DataFrame, the others
    pass unchanged; everything comes back in one frame.  Handlers keep the columns."""
    out = results.filter(~F.coalesce(F.col(script).isin(list(handlers)), F.lit(False)))
    for name, fn in handlers.items():
        out = out.unionByName(results.filter(F.col(script) == name).transform(fn))
    return out


@dataclass(frozen=True)
class GroupHandler:
    """A user function on a script's results: ``apply`` gets a part of them as an Arrow table and
    returns a table with the same columns; ``merge``, if there is one, gets what parts have become, one
    after another in a table, and returns what they are together (of one part: that part)."""

    apply: Callable[[pa.Table], pa.Table]
    merge: Callable[[pa.Table], pa.Table] | None = None


def grouped_post_work(results: DataFrame, handlers: Mapping[str, GroupHandler], script: str = "script",
                      parts: int = 64) -> DataFrame:
    """Per-script post-work as grouped user functions: one scan and one pass, whatever the number of
    scripts.

    A script's rows are dealt by their hash into ``parts`` groups, so a script with a third of all rows is
    that many tasks' work, and each group passes through its handler batch by batch
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows): what a call holds is bounded, whatever the
    script's size.  Handlers with a ``merge`` come back as one part per group and are then merged by
    script, pairs at a time.  Rows of other scripts, null scripts included, pass unchanged.
    """
    schema, columns = results.schema, results.columns
    own = F.coalesce(F.col(script).isin(list(handlers)), F.lit(False))
    part = F.when(own, F.pmod(F.xxhash64(*columns), F.lit(parts))).otherwise(F.pmod(F.xxhash64(*columns), F.lit(8 * parts)))
    dealt = results.withColumns({"__script": F.when(own, F.col(script)), "__part": part})
    merged = {k for k, h in handlers.items() if h.merge is not None}

    def applied(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handler, so_far = handlers.get(key[0].as_py()), None
        for batch in batches:
            table = pa.Table.from_batches([batch]).select(columns)
            if handler is not None:
                table = handler.apply(table).select(columns)
                if handler.merge is not None:
                    so_far = table if so_far is None else handler.merge(pa.concat_tables([so_far, table])).select(columns)
                    continue
            yield from table.to_batches()
        if so_far is not None:
            yield from so_far.to_batches()

    def together(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handler, so_far = handlers[key[0].as_py()], None
        for batch in batches:
            table = pa.Table.from_batches([batch]).select(columns)
            so_far = handler.merge(pa.concat_tables([*([] if so_far is None else [so_far]), table])).select(columns)
        if so_far is not None:
            yield from so_far.to_batches()

    if not merged:
        return dealt.groupBy("__script", "__part").applyInArrow(applied, schema)
    # the parts of merging handlers are few and small; all others are done after the first pass
    tagged = T.StructType([*schema.fields, T.StructField("__of", T.StringType())])

    def with_tag(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = key[0].as_py() if key[0].as_py() in merged else None
        for batch in applied(key, batches):
            yield batch.append_column("__of", pa.array([name] * batch.num_rows, pa.string()))

    first = materialise(dealt.groupBy("__script", "__part").applyInArrow(with_tag, tagged), "parts")
    done = first.filter("__of is null").select(*columns)
    return done.unionByName(first.filter("__of is not null").groupBy("__of").applyInArrow(together, schema))


# X3 ------------------------------------------------------------------------------------
def report_frame(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """Hand ``df`` to chart/report code only if it has rows.

    The frame is run once: its rows are counted while they are written to the shared folder, and the
    code gets the written table.
    """
    path = scratch_dir(df.sparkSession, "report")
    if not write_if_any(df, path, lambda rows, to: rows.write.parquet(to)):
        return None
    return fn(df.sparkSession.read.schema(df.schema).parquet(path))
