"""Jobs and sources on the cases that used to lose rows, order or files."""
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import charts as C
from tallyframe.plans import jobs
from tallyframe.sources import files as S
from tallyframe.sources import sinks as K

KEYS = ["system", "fileset", "file"]


def scripts(spark, text):
    return spark.createDataFrame([("s", "f", "a.sql", text)], "system string, fileset string, file string, text string")


def test_loops_under_any_key_with_a_file_key(spark):
    params = spark.createDataFrame([("p.csv", 1, "x"), ("p.csv", 2, "y")], "file string, n int, v string")
    sc = scripts(spark, "SELECT '{v}' AS v, {n} AS n /*{{loop2:p.csv}}*/; SELECT 1 AS k /*{{loop:gone.csv}}*/;")
    out = jobs.prepare_scripts(sc, KEYS, loop_params=params, loop_order=["n"]).orderBy("stmt_no", "row_no").collect()
    assert [(r["file"], r["row_no"], r["status"]) for r in out] == [
        ("a.sql", 1, "ok"), ("a.sql", 2, "ok"), ("a.sql", 0, "warning: loop file missing")]
    assert "csv row 2 out of 2" in out[1]["sql"] and "replaceMe" not in out[0]["sql"]
    kept = jobs.prepare_scripts(sc, KEYS).collect()
    assert [r["status"] for r in kept] == ["warning: loop file missing"] * 2


def test_several_includes_keep_their_order(spark):
    lib = spark.createDataFrame([("one.sql", "SELECT 1 AS a; SELECT 2 AS a"), ("two.sql", "SELECT 3 AS a")], "name string, body string")
    sc = scripts(spark, "/*{{file_b:two.sql}}*/ /*{{file:one.sql}}*/ SELECT 4 AS a /*{{file_c:none.sql}}*/;")
    prepared = jobs.prepare_scripts(sc, KEYS, library=lib)
    out = prepared.orderBy("sub_no").collect()
    assert [r["sub_no"] for r in out] == [0, 1, 3] and "two.sql" in out[0]["sql"] and "one.sql" in out[1]["sql"]
    parts = jobs.execution_parts(prepared, KEYS).orderBy("sub_no", "part").collect()
    assert [r["sql"].split("SELECT ")[1][0] for r in parts] == ["3", "1", "2", "4"]


def test_export_loses_no_statement(spark, tmp_path):
    sc = scripts(spark, "/*{{save:x.csv}}*/ SELECT CAST(1.5 AS DECIMAL(5,2)) AS a /*{{load:stage.t}}*/; /* only a note */;"
                        "SELECT broken FROM nothing; SELECT 1 AS a WHERE false; SELECT 2 AS a /*{{save:x.csv}}*/;")
    seen = []
    log = jobs.export_results(spark, jobs.prepare_scripts(sc, KEYS), str(tmp_path), manifest=str(tmp_path / "m"),
                              on_result=lambda name, df: seen.append((name, dict(df.dtypes)["a"]))).orderBy("stmt_no").collect()
    assert [(r["output"], r["written"], r["status"][:6]) for r in log] == [
        ("x.csv", True, "ok"), ("s.f--a.sql0002.csv", False, "failed"), ("s.f--a.sql0003.csv", False, "ok"), ("x.001.csv", True, "ok")]
    assert seen[0] == ("x.csv", "double")  # decimals become doubles
    m = S.manifest_read(spark, str(tmp_path / "m")).collect()
    assert [(r["file"], r["schema"], r["table"]) for r in m] == [("x.csv", "stage", "t")]


def test_cells_of_files_of_any_width(spark, tmp_path):
    # the folder of small report files: an unnamed index column, thousands separators in quotes
    files = {"a.csv": "cal_date,item\n2020/01/01,Decade\n2000/01/01,Millennium\n", "b.csv": ",cal_date\n0,1974-12-17\n",
             "c.csv": ',Site_ID,Set,Total,Pct\n0,TD03,"55,236","69,958",79\n', "d.csv": 'x,"q ""in"" q",\n\n"",y,z\n'}
    for k, v in files.items():
        (tmp_path / k).write_text(v)
    import csv
    want = set()
    for k, v in files.items():
        for i, row in enumerate(r for r in csv.reader(v.splitlines()) if r):
            want |= {(k, i, j + 1, c or None) for j, c in enumerate(row)}
    for multiline in (False, True):
        got = {(r["file"], r["row_no"], r["col_no"], r["cell"] or None) for r in S.csv_cells(
            spark, str(tmp_path), multiline=multiline).collect()}
        assert got == want
    (tmp_path / "e.csv").write_text('h,i\n"two\nlines",1\n')
    got = {(r["row_no"], r["col_no"], r["cell"]) for r in S.csv_cells(spark, str(tmp_path / "e.csv"), multiline=True).collect()}
    assert got == {(0, 1, "h"), (0, 2, "i"), (1, 1, "two\nlines"), (1, 2, "1")}


def test_csv_cells_are_complete_on_many_rows(spark, tmp_path):
    path = str(tmp_path / "big")
    spark.range(100_000).select("id", F.concat(F.lit("name "), "id").alias("v")).repartition(5).write.option(
        "header", True).csv(path)
    cells = S.csv_cells(spark, path, with_path=True)
    rows = cells.groupBy("path").agg(F.count("*").alias("n"), F.countDistinct("row_no").alias("d"), F.max("row_no").alias("m")).collect()
    assert sum(r["n"] for r in rows) == 2 * 100_005 and all(r["d"] == r["m"] + 1 == r["n"] // 2 for r in rows)


def test_drop_folder_by_header(spark, tmp_path):
    (tmp_path / "s.a.x.csv").write_text("id,qty\n1,2\n")
    (tmp_path / "s.b.x.csv").write_text("name,id,qty\nbob,7,8\n")
    got = {tuple(r) for r in S.drop_folder_scan(spark, str(tmp_path)).select(
        "id", "qty", "name_csv", "fileset", "name").collect()}
    assert got == {(1, 2, None, "a", "x.csv"), (7, 8, "bob", "b", "x.csv")}


def test_sniffing_tells_same_names_apart(spark, tmp_path):
    for d, text in (("p", "a,b\n1,2\n"), ("q", "a;b\n1;2\n")):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x.csv").write_text(text)
    assert sorted(r["delimiter"] for r in S.delimiter_sniff(spark, str(tmp_path)).collect()) == [",", ";"]


def test_ratios_of_constant_zero_and_empty_input(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "g string, v double")
    assert {r["share"] for r in C.share_by_group(df, "g", "v").collect()} == {None}
    assert {(r["norm"], r["dark"]) for r in C.heat_contrast(df, "v").collect()} == {(None, False)}
    months = spark.createDataFrame([("a", "JANUARY", 0.0), ("a", "MAY", 1.0)], "c string, `Month name` string, v double")
    assert [r["ratio"] for r in C.month_pivot(months, "c", "v", "January", "May", threshold=0).collect()] == [None]
    for fn in (lambda d: C.share_by_group(d, "g", "v"), lambda d: C.heat_contrast(d, "v"), lambda d: C.box_stats(d, "g", "v"),
               lambda d: C.violin_density(d, "g", "v")):
        assert fn(df.limit(0)).count() == 0


def test_whiskers_do_not_end_inside_the_box(spark):
    df = spark.createDataFrame([("a", x) for x in (0.0, 0.0, 0.0, 100.0)], "g string, v double")
    r = C.box_stats(df, "g", "v").first()
    assert (r["q3"], r["whisker_hi"], r["whisker_lo"], r["n_outliers"]) == (25.0, 25.0, 0.0, 1)


def test_violin_keeps_groups_without_spread(spark):
    df = spark.createDataFrame([("const", 5.0)] * 3 + [("one", 2.0)] + [("many", float(x)) for x in range(9)], "g string, v double")
    rows = C.violin_density(df, "g", "v", gridsize=20).groupBy("g").agg(
        F.count("*").alias("n"), F.max("width").alias("w"), F.max("median").alias("m")).collect()
    assert {(r["g"], r["n"], round(r["w"], 6), r["m"]) for r in rows} == {("const", 1, 1.0, 5.0), ("one", 1, 1.0, 2.0), ("many", 20, 1.0, 4.0)}


def test_failed_append_leaves_no_view_and_reports_rows(spark, tmp_path):
    K.result_export(spark.createDataFrame([(1, "x")], "a int, b string"), str(tmp_path), "f.csv")
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(Exception):
        K.table_append(spark, spark.range(1), "no_such_table_here")
    assert {t.name for t in spark.catalog.listTables()} == before
    entries = spark.createDataFrame([("f.csv", "", "no_such_table_here", "")], "file string, schema string, `table` string, call string")
    r = K.staged_load(spark, entries, str(tmp_path)).first()
    assert r["status"] == "failed" and 'first rows: [{"a": 1, "b": "x"}]' in r["detail"]


def test_manifest_of_returned_results_follows_the_directives(spark, tmp_path):
    sc = scripts(spark, "SELECT 1 AS a /*{{save:{x}.csv}}*/ /*{{load:{db}.t}}*/; SELECT 2 AS a /*{{save:b.csv}}*/ /*{{call:p({x})}}*/;"
                        "SELECT 3 AS a /*{{save:c.csv}}*/;")
    pairs = spark.createDataFrame([("s", "f", "a.sql", [(1, 0, "x", "{db}"), (2, 0, "db", "stage")])],
                                  "system string, fileset string, file string, pairs array<struct<priority:int,pos:int,k:string,v:string>>")
    entries = jobs.statement_entries(jobs.prepare_scripts(sc, KEYS), KEYS, pairs)
    assert sorted(map(tuple, entries.select("file", "table", "call").collect())) == [
        ("b.csv", "", "p(stage)"), ("stage.csv", "stage.t", "")]


def test_entry_survives_a_missing_library(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as entry

    real = importlib.import_module

    def missing(name, *a):
        if name == "tallyframe.llm.queries":
            raise ModuleNotFoundError("no", name="public_tokenizers")
        return real(name, *a)

    monkeypatch.setattr(importlib, "import_module", missing)
    with pytest.warns(UserWarning, match="public_tokenizers"):
        assert entry._optional("tallyframe.llm.queries") is None

    def broken(name, *a):
        raise ModuleNotFoundError("no", name="tallyframe.operators.gone")

    monkeypatch.setattr(importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        entry._optional("tallyframe.llm.queries")
    assert "tallyframe" in sys.modules


def test_prepare_runs_moves_lists_not_entries(spark):
    import re
    d = spark.createDataFrame
    layers = [("system", "s", None, 1, "who", "{x}"), ("system", "s", None, 0, "filesets", "hidden"), ("application", None, None, 0, "x", "app {y}"),
              ("fileset", None, "f", 0, "y", "set"), ("fileset", None, "f", 1, "own", "weak"), ("system_fileset", "s", "f", 0, "both", "{own}"),
              ("system", "other", None, 0, "who", "nobody")]
    out = jobs.prepare_runs(
        d([("s", "f", "True"), ("s", "f", "True"), ("s", "stray", "False")], "system string, fileset string, pair_active string"),
        d([("s", "True", "16.20", "daily")], "system string, active string, dbsversion string, collection string"),
        d([("f", "True")], "fileset string, active string"),
        d([("f", "k1", "sql/a.sql", None, None, None), ("f", "k2", "sql/b.sql", None, None, None), ("f", "k3", "sql/c.sql", None, None, None)],
          "fileset string, file_key string, gitfile string, dbsversion array<string>, collection array<string>, params map<string,string>"),
        d([("f", "a.sql", "{who} {both} {gitfile};{y}"), ("f", "c.sql", "{again}"), ("f", "c.sql", "{again}"), ("stray", "x.sql", "{who}"),
           ("unused", "z.sql", "z")], "folder string, name string, body string"),
        d([("", "x.sql", "root {who}")], "folder string, name string, body string"),
        d([("p/a.sql", 1, {"own": "late"}), ("p/a.sql", 0, {"gitfile": "no", "own": "mine"}), ("p/c.sql", 0, {"again": "+{again}"})],
          "path string, pos int, params map<string,string>"),
        d(layers, "layer string, system string, fileset string, pos int, key string, value string"), run_unknown=True)
    got = sorted(((r["fileset"], r["file"], r["stmt_no"], r["sql"], r["status"]) for r in out.collect()), key=str)
    end = "\n;\n\n"
    # a text that stands there twice has its entries twice, as one list
    assert got == sorted([
        ("f", "a.sql", 1, "app set mine {gitfile}" + end, "ok"), ("f", "a.sql", 2, "set" + end, "ok"), ("f", "c.sql", 1, "++{again}" + end, "ok"),
        ("f", "c.sql", 1, "++{again}" + end, "ok"), ("stray", "x.sql", 1, "root app {y}" + end, "ok"), ("f", "b.sql", 0, None, "error: no text")],
        key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(file_params" not in plan
    assert not re.search(r"Aggregate \[system#\d+, fileset#\d+, file#\d+\].*collect_list", plan)
