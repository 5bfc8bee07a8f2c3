"""Skew-safe numbering and exact quantiles against brute force on skewed data."""
import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators.charts import exact_quantiles, stacked_histogram
from tallyframe.operators.ranking import grouped_row_number
from tallyframe.sources.files import delimiter_sniff


def skewed(spark, n=20000):
    # one key holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("g"),
        ((F.abs(F.xxhash64("id")) % 1000003) / 1000.0).alias("v"), F.col("id"))


def test_grouped_row_number_matches_window(spark):
    df = skewed(spark)
    got = grouped_row_number(df, ["g"], ["v", "id"], num_partitions=16).select("id", "rn")
    exp = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).alias("rn"))
    assert got.exceptAll(exp).isEmpty() and exp.exceptAll(got).isEmpty()


def test_global_row_number_is_dense(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("x"))
    rn = [r["rn"] for r in grouped_row_number(df, [], ["x"], num_partitions=8).orderBy("x").collect()]
    assert rn == list(range(1, 5001))


def test_exact_quantiles_match_numpy(spark):
    df = skewed(spark)
    pdf = df.toPandas()
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", (0.25, 0.5, 0.9)).collect()}
    for g, grp in pdf.groupby("g"):
        exp = np.quantile(grp["v"].to_numpy(), [0.25, 0.5, 0.9])
        assert abs(got[g]["q25"] - exp[0]) < 1e-9 and abs(got[g]["q50"] - exp[1]) < 1e-9
        assert abs(got[g]["q90"] - exp[2]) < 1e-9 and got[g]["n"] == len(grp)


def test_histogram_counts_sum(spark):
    df = skewed(spark)
    h = stacked_histogram(df, "g", "v")
    assert h.agg(F.sum("n")).first()[0] == df.count()
    assert h.agg(F.max("bin")).first()[0] == 49


def test_delimiter_sniff_brute_force(spark, tmp_path):
    texts = {"a.txt": "x|~|y|~|z\n1|~|2|~|3\n", "b.txt": "a,b,c\n1,2,3\n", "c.txt": "a;b;c\n1;2;3\n",
             "d.txt": "a||b||c\n", "e.txt": "a:b\n"}
    for k, v in texts.items():
        (tmp_path / k).write_text(v)

    def brute(t):
        cur = "|~|"
        for c in [",,", ",", "::", ":", ";;", ";", "||", "|"]:
            if t.count(c) * len(c) * 1.1 > t.count(cur) * len(cur):
                cur = c
        return cur

    got = {r["file"]: r["delimiter"] for r in delimiter_sniff(spark, str(tmp_path)).collect()}
    assert got == {k: brute(v) for k, v in texts.items()}
