"""Readers and sinks on small files shaped like the original fixtures."""
import json

from pyspark.sql import functions as F

from tallyframe.operators.clean import drop_unnamed
from tallyframe.sources import files as S
from tallyframe.sources import sinks as K

MULTISET = ',Site_ID,SetTableCount,TotalObjectCount,SetTablePct\r\n0,SITE01,"55,236","69,958",79\r\n'
BIRTHDAY = ",cal_date\n0,1974-12-17\n"


def test_csv_scan_types(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MULTISET)
    (tmp_path / "b.csv").write_text(BIRTHDAY)
    m = S.csv_scan(spark, str(tmp_path / "m.csv"))
    types = dict(m.dtypes)
    assert types["_c0"] == "int" and types["SetTableCount"] == "string" and types["SetTablePct"] == "int"
    assert drop_unnamed(m).columns == ["Site_ID", "SetTableCount", "TotalObjectCount", "SetTablePct"]
    b = S.csv_scan(spark, str(tmp_path / "b.csv"))
    assert dict(b.dtypes)["cal_date"] == "string" and b.first()["cal_date"] == "1974-12-17"


def test_temp_view_typing(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n1,2.5,x\n2,,\n")
    view = S.csv_temp_view(spark, str(tmp_path / "t.csv"), empty_string_for_null=True)
    df = spark.table(view)
    assert dict(df.dtypes) == {"a": "bigint", "b": "decimal(32,10)", "c": "string"}
    assert [r["c"] for r in df.orderBy("a").collect()] == ["x", ""]


def test_manifest_roundtrip_and_export_gate(spark, tmp_path):
    ent = spark.createDataFrame([("a.csv", "stage.t1", None, True), ("b.csv", "t2", "p", False),
                                 ("c.csv", "t3", "q", True)], "file string, table string, call string, written boolean")
    K.manifest_write(ent, str(tmp_path / "m"))
    doc = json.loads(spark.read.text(str(tmp_path / "m")).first()[0])
    assert doc == {"entries": [{"file": "a.csv", "table": "stage.t1", "call": ""},
                               {"file": "c.csv", "table": "t3", "call": "q"}]}
    got = {(r["file"], r["schema"], r["table"], r["call"]) for r in S.manifest_read(spark, str(tmp_path / "m"), "dflt").collect()}
    assert got == {("a.csv", "stage", "t1", ""), ("c.csv", "dflt", "t3", "q")}
    df = spark.range(3)
    assert K.result_export(df, str(tmp_path / "out"), "x.csv", single_file=True)
    assert not K.result_export(df.filter(F.col("id") < 0), str(tmp_path / "out"), "y.csv")
    assert (tmp_path / "out" / "x.csv").is_file() and not (tmp_path / "out" / "y.csv").exists()


def test_staged_load_failure_reports(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("k,v\n1,a\n")
    loc = str(tmp_path / "tbl")
    spark.sql(f"CREATE TABLE tf_test_load (k BIGINT, v STRING, note STRING DEFAULT 'd') USING parquet LOCATION '{loc}'")
    man = spark.createDataFrame([("ok.csv", "", "tf_test_load", "hook"), ("missing.csv", "", "tf_test_load", "")],
                                "file string, schema string, table string, call string")
    calls = []
    status = {r["file"]: r["status"] for r in K.staged_load(
        spark, man, str(tmp_path), hooks={"hook": lambda s, t: calls.append(t)}).collect()}
    assert status == {"ok.csv": "ok", "missing.csv": "failed"}
    assert calls == ["tf_test_load"]
    assert [tuple(r) for r in spark.table("tf_test_load").collect()] == [(1, "a", "d")]


def test_csv_cells_multiline(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a,b\n"line1\nline2",x\n3,y\n')
    got = {(r["row_no"], r["col_no"]): r["cell"] for r in S.csv_cells(spark, str(tmp_path), multiline=True).collect()}
    assert got[(1, 1)] == "line1\nline2" and got[(2, 2)] == "y" and got[(0, 1)] == "a"


def test_prepare_keeps_orphan_loops(spark):
    from tallyframe.plans.jobs import prepare_scripts
    scripts = spark.createDataFrame([("s", "SELECT '{v}' /*{{loop:p.csv}}*/; SELECT 2 /*{{loop:gone.csv}}*/;")],
                                    "system string, text string")
    params = spark.createDataFrame([("p.csv", "a", 1), ("p.csv", "b", 2)], "file string, v string, o int")
    out = {(r["stmt_no"], r["row_no"]): (r["sql"], r["status"]) for r in prepare_scripts(
        scripts, ["system"], loop_params=params, loop_order=["o"]).collect()}
    assert out[(1, 1)][0].startswith("SELECT 'a' /*  csv row 1 out of 2  */")
    assert out[(1, 2)][0].startswith("SELECT 'b' /*  csv row 2 out of 2  */")
    assert out[(2, 0)] == ("SELECT 2 /* {{replaceMe:loop}} */\n;\n\n", "warning: loop file missing")


def test_prepare_temp_directives(spark):
    from tallyframe.plans.jobs import prepare_scripts
    scripts = spark.createDataFrame([("s", "SELECT * FROM t1 /*{{temp:t1.csv}}*/; SELECT 1 /*{{temp:nope.csv}}*/;")],
                                    "system string, text string")
    temps = spark.createDataFrame([("t1.csv",)], "name string")
    out = {r["stmt_no"]: (r["sql"], r["status"]) for r in prepare_scripts(scripts, ["system"], temp_files=temps).collect()}
    assert out[1] == ("SELECT * FROM t1 /* above volatile table create script for t1.csv */\n;\n\n", "ok")
    assert out[2][1] == "error: temp file missing"


def test_script_scan_reads_whole_multiline_scripts(spark, tmp_path):
    d = tmp_path / "sysA" / "setB"
    d.mkdir(parents=True)
    body = "SELECT 1\n;\n\nSELECT 2 /*{{save:x.csv}}*/\n;\n"
    (d / "a.q.sql").write_text(body)
    (d / ".hidden.q.sql").write_text("SELECT 3;")
    (d / "notes.txt").write_text("ignored")
    rows = S.script_scan(spark, str(tmp_path), pattern="*.q.sql").collect()
    assert [(r["system"], r["fileset"], r["file"], r["text"]) for r in rows] == [("sysA", "setB", "a.q.sql", body)]


def test_csv_cells_keeps_same_named_files_apart(spark, tmp_path):
    for k, rows in (("1", "a,b\n1,x\n2,y\n"), ("2", "a,b\n3,z\n")):
        d = tmp_path / f"part={k}"
        d.mkdir()
        (d / "data.csv").write_text(rows)
    got = S.csv_cells(spark, str(tmp_path), with_path=True).collect()
    by_path = {}
    for r in got:
        assert r["file"] == "data.csv"
        by_path.setdefault(r["path"].split("/")[-2], {})[(r["row_no"], r["col_no"])] = r["cell"]
    # folder names are not read as a partition column, and each file is numbered on its own
    assert by_path["part=1"] == {(0, 1): "a", (0, 2): "b", (1, 1): "1", (1, 2): "x", (2, 1): "2", (2, 2): "y"}
    assert by_path["part=2"] == {(0, 1): "a", (0, 2): "b", (1, 1): "3", (1, 2): "z"}
