"""Report binding with the golden values of the original test suite (templates as rows)."""
import pytest

from tallyframe.operators import report as RP
from tallyframe.plans.jobs import fill_report
from tallyframe.sources.files import csv_cells

DATES = "cal_date,item\r\n2020/01/01,Decade\r\n2000/01/01,Millennium\r\n2007/05/29,iPhone\r\n" \
        "1941/12/07,Pearl Harbor\r\n1886/01/28,Automobile\r\n1776/07/04,USA\r\n"
BIRTHDAY = ",cal_date\n0,1974-12-17\n"


@pytest.fixture(scope="module")
def cells(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    (d / "dates.csv").write_text(DATES)
    (d / "birthday.csv").write_text(BIRTHDAY)
    return csv_cells(spark, str(d)).cache()


def items(spark, rows):
    return spark.createDataFrame(rows, "template string, item_no long, kind string, row_no long, col_no long, text string")


def test_cells_exact_rows(cells):
    got = {(r["file"], r["row_no"], r["col_no"]): r["cell"] for r in cells.collect()}
    assert got[("dates.csv", 0, 1)] == "cal_date"
    assert got[("dates.csv", 6, 2)] == "USA"
    assert got[("birthday.csv", 1, 2)] == "1974-12-17"


def test_placeholder_discovery(spark):
    it = items(spark, [("t", 1, "text", 0, 0, "{{pic:alldates.png}}"),
                       ("t", 2, "cell", 0, 0, "{{col:dates.csv[1]}}"),
                       ("t", 2, "cell", 0, 1, "{{col:dates.csv[2]}}"),
                       ("t", 3, "text", 0, 0, "x {{val:birthday.csv[1:2]}} y")])
    got = sorted((r["tag"], r["file"], r["ref_row"], r["ref_col"], r["pat"])
                 for r in RP.extract_placeholders(it).collect())
    assert got == [("col", "dates.csv", None, 1, "{{col:dates.csv[1]}}"),
                   ("col", "dates.csv", None, 2, "{{col:dates.csv[2]}}"),
                   ("pic", "alldates.png", None, None, "{{pic:alldates.png}}"),
                   ("val", "birthday.csv", 1, 2, "{{val:birthday.csv[1:2]}}")]


def test_bind_all(spark, cells):
    rows = [("t", 4, "text", 0, 0, "Text with one placeholder {{val:birthday.csv[1:2]}}"),
            ("t", 7, "text", 0, 0, "TextBox with multiple placehoders: {{val:dates.csv[6:2]}} received "
                                   "independence on {{val:dates.csv[6:1]}}"),
            ("t", 8, "text", 0, 0, "keep {{val:nofile.csv[1:1]}}")]
    for r in range(3):
        for c in range(2):
            rows.append(("t", 6, "cell", r, c, "{{col:dates.csv[%d]}}" % (c + 1) if r == 0 else ""))
    out = {(r["item_no"], r["row_no"], r["col_no"]): (r["text"], r["status"])
           for r in fill_report(items(spark, rows), cells).collect()}
    assert out[(4, 0, 0)][0] == "Text with one placeholder 1974-12-17"
    assert out[(7, 0, 0)][0] == "TextBox with multiple placehoders: USA received independence on 1776/07/04"
    assert out[(8, 0, 0)] == ("keep {{val:nofile.csv[1:1]}}", "missing_file")
    table = [[out[(6, r, c)][0] for c in range(2)] for r in range(3)]
    assert table == [["cal_date", "item"], ["2020/01/01", "Decade"], ["2000/01/01", "Millennium"]]
