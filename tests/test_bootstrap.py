"""Poisson bootstrap (A2-A5): draws, intervals, plans."""
import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import bootstrap as B
from tallyframe.operators import charts as C


def weight(key, replica):
    digest = hashlib.md5(f"{key}#{replica // B.PER_DIGEST}".encode()).hexdigest()
    place = replica % B.PER_DIGEST * B.DIGITS
    return sum(digest[place:place + B.DIGITS] >= t for t in B.poisson_thresholds())


def test_thresholds_give_poisson_counts():
    t = [int(x, 16) / 16 ** B.DIGITS for x in B.poisson_thresholds()]
    below = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(len(t))]
    assert np.allclose(t, below, atol=2e-5)
    counts = Counter(weight(i, r) for i in range(400) for r in range(100))
    for k in range(4):
        assert counts[k] / 40_000 == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.01)


def rows(spark):
    data = [(i, ["a", "b", "hot", "hot"][i % 4], float(i % 17) if i % 11 else None) for i in range(300)]
    data += [(1000, "one", 5.0), (1001, "null", None), (1002, None, 3.0), (1003, "nan", float("nan")), (1004, "nan", 2.0)]
    return data, spark.createDataFrame(data, "id long, g string, v double")


def test_sums_and_interval_equal_a_plain_bootstrap(spark):
    data, df = rows(spark)
    got = {r["g"]: r for r in B.bootstrap_mean(df, ["g"], "v", ["id"], replicas=50).collect()}
    assert set(got) == {"a", "b", "hot", "one", "null", "nan"}
    for g in got:
        own = [(i, v) for i, k, v in data if k == g and v is not None and not math.isnan(v)]
        r = got[g]
        assert r["n"] == len(own)
        if not own:
            assert r["mean"] is None and r["ci_lo"] is None
            continue
        assert r["mean"] == pytest.approx(np.mean([v for _, v in own]))
        means = []
        for b in range(50):
            w = [weight(i, b) for i, _ in own]
            if sum(w):
                means.append(np.dot(w, [v for _, v in own]) / sum(w))
        assert [r["ci_lo"], r["ci_hi"]] == pytest.approx(list(np.percentile(means, [2.5, 97.5])))


def test_same_under_any_partitioning_and_empty(spark):
    _, df = rows(spark)
    canon = lambda d: sorted(((r[0], r[2], *(None if x is None else round(x, 9) for x in (r[1], r[3], r[4])))
                              for r in B.bootstrap_mean(d, ["g"], "v", ["id"], replicas=40).collect()), key=repr)
    assert canon(df.repartition(1)) == canon(df.repartition(7, "v")) == canon(df.orderBy(F.desc("id")))
    assert canon(df.limit(0)) == []


def test_coverage_is_about_the_level(spark):
    """Of many groups drawn from one population, about 95 % of the intervals hold its mean."""
    rng = np.random.default_rng(3)
    data = [(i, i % 100, float(x)) for i, x in enumerate(rng.exponential(2.0, 8000))]
    df = spark.createDataFrame(data, "id long, g int, v double")
    hit = B.bootstrap_mean(df, ["g"], "v", ["id"]).filter("ci_lo <= 2 and ci_hi >= 2").count()
    assert 85 <= hit <= 100


def test_rows_shuffle_as_sums(spark):
    """One aggregation of the rows, combined before its exchange; the second exchange has replicas."""
    _, df = rows(spark)
    plan = C.group_mean_ci(df, "g", "v", row_key=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    assert plan.count("partial_sum(") >= 2 * B.PER_DIGEST and "Python" not in plan
