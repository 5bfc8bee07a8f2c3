"""Exactly-once loads, observed writes, grouped user functions, sketches and nested shapes."""
import uuid

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import report as RP
from tallyframe.operators import sketches as SK
from tallyframe.plans import hooks as H
from tallyframe.plans import jobs
from tallyframe.plans.observed import counted, write_if_any
from tallyframe.sources import ledger as L
from tallyframe.sources import sinks as K

MANIFEST = "file string, schema string, `table` string, call string"


@pytest.fixture
def target(spark, tmp_path):
    tail = uuid.uuid4().hex[:8]
    t, ledger = f"tf_t_{tail}", L.create_ledger(spark, f"tf_l_{tail}", str(tmp_path / "ledger"))
    spark.sql(f"CREATE TABLE {t} (a BIGINT, note STRING DEFAULT 'new', b STRING, load_id STRING) USING parquet "
              f"PARTITIONED BY (load_id) LOCATION '{tmp_path}/t'")
    yield t, ledger
    for name in (t, ledger):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows_of(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("a", "note", "b").collect())


def test_loads_are_made_once(spark, tmp_path, target):
    t, ledger = target
    deliver = lambda name, data: K.result_export(spark.createDataFrame(data, "b string, a long"), str(tmp_path / "in"), name)
    deliver("x.csv", [("one", 1), ("two", 2)])
    deliver("y.csv", [("three", 3)])
    entries = spark.createDataFrame([("x.csv", "", t, "hook"), ("y.csv", "", t, ""), ("gone.csv", "", t, "")], MANIFEST)
    calls = []

    def hook(session, name):
        calls.append(session.table(name).count())
        if len(calls) == 1:
            raise RuntimeError("no")

    run = lambda: [r["status"] for r in L.exactly_once_load(spark, entries, str(tmp_path / "in"), ledger, "m", {"hook": hook}).collect()]
    want = [(1, "new", "one"), (2, "new", "two"), (3, "new", "three")]
    assert run() == ["failed", "ok", "failed"] and rows_of(spark, t) == want
    assert run() == ["ok", "done before", "failed"] and rows_of(spark, t) == want
    assert run() == ["done before", "done before", "failed"] and rows_of(spark, t) == want
    assert len(calls) == 2
    # another manifest's load is its own; a file delivered anew replaces its rows and calls its hook
    L.exactly_once_load(spark, entries.filter("file = 'y.csv'"), str(tmp_path / "in"), ledger, "m2")
    assert len(rows_of(spark, t)) == 4
    deliver("x.csv", [("four", 4)])
    assert run() == ["ok", "done before", "failed"]
    assert rows_of(spark, t) == [(3, "new", "three"), (3, "new", "three"), (4, "new", "four")] and len(calls) == 3
    deliver("x.csv", [("four", 4)])  # the same rows delivered again
    run()
    assert len(rows_of(spark, t)) == 3
    steps = {tuple(r) for r in spark.table(ledger).select("file", "step").collect()}
    assert steps == {("x.csv", "loaded"), ("x.csv", "hooked"), ("y.csv", "loaded")}
    n = {r["file"]: r["n"] for r in spark.table(ledger).filter("step = 'loaded' and file = 'x.csv'").collect()}
    assert n == {"x.csv": 1}


def test_a_load_cut_short_is_overwritten(spark, tmp_path, target):
    t, ledger = target
    frame = spark.createDataFrame([(1, "x")], "a long, b string")
    assert L.overwrite_load(spark, frame, t, "k") == 1
    assert L.overwrite_load(spark, frame.unionByName(frame), t, "k") == 2  # as if the first had not been recorded
    assert L.overwrite_load(spark, frame, t, "other") == 1
    assert spark.table(t).count() == 3
    assert L.overwrite_load(spark, frame.limit(0), t, "k") == 0
    assert spark.table(t).count() == 1


def scans(spark, path, act):
    """How often an action reads a folder: counted by an accumulator inside the plan."""
    seen = spark.sparkContext.accumulator(0)

    def tick(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.read.parquet(path)
    act(df.mapInArrow(tick, df.schema))
    return seen.value / max(1, df.count())


def test_every_query_runs_once(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.range(100).write.parquet(path)
    out = str(tmp_path / "out")
    assert scans(spark, path, lambda df: K.result_export(df, out, "x.csv")) == 1
    assert scans(spark, path, lambda df: K.result_export(df, out, "one.csv", single_file=True)) == 1
    assert scans(spark, path, lambda df: H.report_frame(df, lambda d: d.agg(F.sum("id")).collect())) == 1
    assert scans(spark, path, lambda df: jobs.export_results(
        spark, jobs.prepare_scripts(spark.createDataFrame([("s", "f", "a.sql", "SELECT 1;")],
                                    "system string, fileset string, file string, text string"), ["system", "fileset", "file"]),
        out, run=lambda s, q: df, on_result=lambda name, d: d.count())) == 1


def test_empty_outputs_are_withdrawn(spark, tmp_path):
    write = lambda rows, to: rows.write.mode("overwrite").csv(to)
    for i, df in enumerate([spark.range(5).filter("id > 7"), spark.range(5).filter("1 = 0"), spark.createDataFrame([], "id long")]):
        assert write_if_any(df, str(tmp_path / f"e{i}"), write) == 0
        assert not (tmp_path / f"e{i}").exists()
        assert H.report_frame(df, lambda d: d) is None
        assert not K.result_export(df, str(tmp_path), "e.csv", single_file=True)
    assert write_if_any(spark.range(5), str(tmp_path / "f"), write) == 5 and (tmp_path / "f").exists()
    rows, count = counted(spark.range(8))
    rows.write.format("noop").mode("overwrite").save()
    assert count() == 8


RESULTS = "script string, v long, note string"


def test_grouped_functions_equal_post_work(spark):
    data = [(["hot", "hot", "a", "b", None, "none"][i % 6], i if i % 7 else None, f"n{i}") for i in range(600)]
    df = spark.createDataFrame(data, RESULTS).repartition(6)
    column = {"hot": lambda d: d.withColumn("v", F.col("v") * 2), "a": lambda d: d.filter("v > 100"), "gone": lambda d: d}
    arrow = {"hot": H.GroupHandler(lambda t: t.set_column(1, "v", pc.multiply(t.column("v"), 2))),
             "a": H.GroupHandler(lambda t: t.filter(pc.greater(t.column("v"), 100))), "gone": H.GroupHandler(lambda t: t)}
    canon = lambda d: sorted(map(tuple, d.collect()), key=repr)
    got = H.grouped_post_work(df, arrow)
    assert canon(got) == canon(H.post_work(df, column))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1  # one scan
    assert canon(H.grouped_post_work(df.limit(0), arrow)) == []


def test_grouped_functions_with_a_merge_see_bounded_parts(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("script"),
                                    F.col("id").alias("v"), F.lit("x").alias("note"))
    sizes = spark.sparkContext.accumulator(0)

    def total(t: pa.Table) -> pa.Table:
        if t.num_rows > 10_000:
            sizes.add(1)
        return pa.table({"script": t.column("script")[:1], "v": [pc.sum(t.column("v")).as_py()], "note": ["sum"]}, t.schema)

    out = H.grouped_post_work(df, {"hot": H.GroupHandler(total, merge=total)}, parts=8).collect()
    (hot,) = [r for r in out if r["script"] == "hot"]
    assert hot["v"] == sum(i for i in range(20_000) if i % 3) and sizes.value == 0
    assert len(out) == 1 + sum(i % 3 == 0 for i in range(20_000))


def test_sketches_of_days_merge_within_their_bound(spark, tmp_path):
    df = spark.range(60_000).select(
        F.format_string("2024-01-%02d", F.col("id") % 20 + 1).alias("d"), F.when(F.col("id") % 3 > 0, "hot").otherwise("b").alias("g"),
        F.when(F.col("id") % 101 > 0, F.pow(F.rand(5), 3.0)).alias("v"))
    df = df.unionByName(spark.createDataFrame([("2024-01-03", None, 1.0), (None, "b", 1.0), ("2024-01-03", "b", float("nan"))], "d string, g string, v double"))
    base = str(tmp_path / "base")
    df.write.parquet(base)
    df, path = spark.read.parquet(base), str(tmp_path / "sketches")
    SK.store_sketches(SK.sketch_days(df, "d", "g", "v"), path)
    SK.store_sketches(SK.sketch_days(df.filter("d = '2024-01-04'"), "d", "g", "v"), path)  # a day anew
    stored = spark.read.parquet(path)
    for first, last in (("2024-01-02", "2024-01-02"), ("2024-01-03", "2024-01-17"), ("2024-01-01", "2024-01-31")):
        for r in SK.range_quantiles(stored, first, last, (0.01, 0.25, 0.5, 0.75, 0.99)).collect():
            own = sorted(x["v"] for x in df.filter(F.col("d").between(first, last) & (F.col("g") == r["group"])).collect()
                         if x["v"] is not None and x["v"] == x["v"])
            assert (r["n"], r["smallest"], r["largest"]) == (len(own), own[0], own[-1])
            for p, q in zip((0.01, 0.25, 0.5, 0.75, 0.99), r["quantiles"]):
                low, high = (sum(x < q for x in own) / len(own), sum(x <= q for x in own) / len(own))
                assert low - SK.rank_error() <= p <= high + SK.rank_error()
    assert SK.range_box(stored, "2025-01-01", "2025-01-31").count() == 0
    plan = SK.range_box(stored, "2024-01-03", "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and base not in plan


SHAPES = "template string, shape_no long, parent_no long, position int, kind string, row_no long, col_no long, text string"


def test_nested_shapes_come_in_reading_order(spark):
    rows = [("t", 1, None, 10, "group", 0, 0, None), ("t", 2, 1, 2, "group", 0, 0, None), ("t", 3, 2, 1, "group", 0, 0, None),
            ("t", 4, 3, 2, "text", 0, 0, "{{val:a[1:1]}}"), ("t", 5, 3, 10, "text", 0, 0, "{{val:b[1:1]}}"), ("t", 6, 1, 1, "group", 0, 0, None),
            ("t", 7, 1, 3, "cell", 1, 0, "{{val:d[1:1]}}"), ("t", 7, 1, 3, "cell", 0, 1, "{{val:c[1:1]}} "), ("t", 8, None, 9, "text", 0, 0, "{{val:0[1:1]}}"),
            ("t", 9, 77, 0, "text", 0, 0, "lost"), ("u", 4, 1, 0, "text", 0, 0, "lost"), ("u", 1, 2, 0, "group", 0, 0, None),
            ("u", 2, 1, 0, "group", 0, 0, None), ("u", 3, None, 1, "text", 0, 0, "{{pic:x}}")]
    items = RP.flatten_shapes(spark.createDataFrame(rows, SHAPES))
    assert {r["text"] for r in items.filter("status = 'orphan'").collect()} == {"lost"}
    found = RP.extract_placeholders(items.filter("template = 't' and status = 'ok'")).orderBy("item_no", "row_no", "col_no", "ph_no")
    assert [r["file"] for r in found.collect()] == ["0", "a", "b", "c", "d"]
    assert RP.flatten_shapes(spark.createDataFrame([], SHAPES)).count() == 0
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"
