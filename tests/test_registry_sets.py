"""Bitmaps (J1), containment join (J2) and placeholder closure (W4, T1) against plain Python."""
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import bitmaps as BM
from tallyframe.operators import containment as CJ
from tallyframe.operators import placeholders as PH
from tallyframe.operators import registry as R

PAIRS = "system string, fileset string, pair_active string"


def test_bitmaps_equal_the_pairs(spark, monkeypatch):
    rng = random.Random(1)
    names = [f"f{i:05d}" for i in range(400)]
    pairs = [(f"s{rng.randint(0, 9)}", rng.choice(names + ["unknown"]), "True") for _ in range(900)] + [("s0", n, "True") for n in names]
    pairs += [pairs[0], ("s1", None, "True")]
    p = spark.createDataFrame(pairs, PAIRS).repartition(5)
    systems = spark.createDataFrame([(f"s{i}",) for i in range(12)] + [("s1",)], "system string")
    numbered = BM.number_filesets(spark.createDataFrame([(n,) for n in names + names[:9] + [None]], "fileset string"))
    maps = BM.registry_bitmaps(p, numbered)
    have = {s: {f for t, f, _ in pairs if t == s and f in names} for s in (f"s{i}" for i in range(12))}
    got = {r["system"]: (r["n_known"], r["n_missing"]) for r in BM.fileset_counts(systems, maps, numbered).collect()}
    assert got == {s: (len(x), len(names) - len(x)) for s, x in have.items()}
    asked = systems.filter("system in ('s0', 's3', 's11')")
    missing = {tuple(r) for r in BM.missing_pairs(asked, maps, numbered).collect()}
    assert missing == {(s, n) for s in ("s0", "s3", "s11") for n in names if n not in have[s]}
    halves = [BM.registry_bitmaps(p.filter(F.xxhash64("fileset") % 2 == i), numbered) for i in (0, 1, -1)]
    merged = BM.fileset_counts(systems, BM.merge_bitmaps(*halves), numbered)
    assert {r["system"]: (r["n_known"], r["n_missing"]) for r in merged.collect()} == got


def test_more_filesets_than_a_bitmap_has_bits(spark):
    n = BM.BUCKET_BITS + 700
    names = spark.range(n).select(F.format_string("f%07d", "id").alias("fileset"))
    numbered = BM.number_filesets(names)
    pairs = names.filter("fileset < 'f0032700' or fileset >= 'f0032800'").select(F.lit("s").alias("system"), "fileset")
    maps = BM.registry_bitmaps(pairs, numbered)
    assert maps.count() == 2
    systems = pairs.select("system").limit(1)
    assert BM.fileset_counts(systems, maps, numbered).first()["n_missing"] == 100
    missing = sorted(r["fileset"] for r in BM.missing_pairs(systems, maps, numbered).collect())
    assert missing == [f"f{i:07d}" for i in range(32700, 32800)]


def test_registry_fill_without_filesets_or_pairs(spark):
    pairs = spark.createDataFrame([("a", "x", "True")], PAIRS)
    none = spark.createDataFrame([], "fileset string")
    assert [tuple(r) for r in R.fill_registry(pairs, none).collect()] == [("a", "x", "True", False, 1)]
    sets = spark.createDataFrame([("x",), ("y",)], "fileset string")
    got = {tuple(r) for r in R.fill_registry(pairs, sets, spark.createDataFrame([("b",)], "system string")).collect()}
    assert got == {("a", "x", "True", False, 2), ("a", "y", "False", True, 2), ("b", "x", "False", True, 2), ("b", "y", "False", True, 2)}
    assert R.fill_registry(pairs.limit(0), sets).count() == 0


def test_containment_join_equals_the_filter(spark):
    rng = random.Random(4)
    tokens = ["16.20", "17.10", "15.00", ""]
    lists = lambda: rng.choice([None, [], [rng.choice(tokens)], tokens[:2], [None, "x"], [rng.choice(tokens)] * 3])
    systems = [(f"s{i}", rng.choice(["True", "False", None]), rng.choice(tokens + [None]), rng.choice(["daily", None, ""])) for i in range(40)]
    pairs = [(s[0], f, rng.choice(["True", "false"])) for s in systems for f in ("shared", f"f{s[0]}")]
    sets = [("shared", "True"), *[(f"fs{i}", rng.choice(["True", None])) for i in range(40)]]
    files = [(rng.choice(["shared", f"fs{i % 40}", "gone"]), f"k{i}", f"sql/k{i}.sql", lists(), rng.choice([None, [], ["daily"], ["daily", "x", "daily"]]), None)
             for i in range(300)]
    d = spark.createDataFrame
    args = (d(pairs, PAIRS), d(systems, "system string, active string, dbsversion string, collection string"),
            d(sets, "fileset string, active string"),
            d(files, "fileset string, file_key string, gitfile string, dbsversion array<string>, collection array<string>, params map<string,string>"))
    canon = lambda df: sorted(map(tuple, df.select("system", "fileset", "file_key", "gitfile").collect()))
    want = canon(R.eligible_files(args[0], args[1], args[2], files=args[3]))
    got = CJ.admitted_files(*args)
    assert canon(got) == want and len(set(want)) == len(want) > 200
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan


CLOSE = "target string, key string, value string"


def closed(spark, pairs):
    return {(r["target"], r["key"]): (r["value"], r["status"], r["depth"], r["unresolved"])
            for r in PH.close_placeholders(spark.createDataFrame(pairs, CLOSE)).collect()}


def test_closure_of_chains_cycles_and_unknown_keys(spark):
    long = [("t", f"k{i:02d}", f"{{k{i + 1:02d}}}.") for i in range(20)] + [("t", "k20", "end")]
    got = closed(spark, long + [
        ("t", "twice", "{k19}{k19} {} {{k20}}"), ("t", "self", "x{self}"), ("t", "to_self", "{self} {k20}"), ("t", "open", "{nobody} {k20} {more}"),
        ("t", "to_open", "{open}"), ("u", "k20", "other {k19}"), ("u", "null", None), (None, "k", "v"), ("u", None, "v")])
    assert got["t", "k00"] == ("end" + "." * 20, "ok", 20, [])
    assert got["t", "twice"] == ("end.end. {} {end}", "ok", 2, [])
    assert got["t", "self"] == ("x{self}", "cycle", 1, [])
    assert got["t", "to_self"] == ("{self} {k20}", "cycle", 2, [])
    assert got["t", "open"] == ("{nobody} end {more}", "unresolved", 1, ["more", "nobody"])
    assert got["t", "to_open"] == ("{nobody} end {more}", "unresolved", 2, ["more", "nobody"])
    assert got["u", "k20"] == ("other {k19}", "unresolved", 0, ["k19"])
    assert got["u", "null"] == ("", "ok", 0, [])
    assert len(got) == 28
    assert PH.close_placeholders(spark.createDataFrame([], CLOSE)).count() == 0


def test_closure_equals_repeated_substitution(spark):
    rng = random.Random(6)
    pairs = []
    for t in range(6):
        for i in range(12):  # only to later keys: no cycle
            refs = [rng.randint(i + 1, 14) for _ in range(rng.randint(0, 2))]
            pairs.append((f"t{t}", f"k{i}", "".join(f"{{k{j}}}/" for j in refs) + str(i)))
    got = closed(spark, pairs)
    for t, k, v in pairs:
        own = {a: b for s, a, b in pairs if s == t}
        for _ in range(20):
            for name, value in own.items():
                v = v.replace(f"{{{name}}}", value)
        assert got[t, k][0] == v
        assert got[t, k][1] == ("unresolved" if "{" in v else "ok")


def test_layers_are_ranked_skipped_and_ordered(spark):
    entries = spark.createDataFrame([
        ("x", "fileset", 0, "a", "weak"), ("x", "application", 1, "a", "late"), ("x", "application", 0, "z", "{a}"),
        ("x", "file", 0, "a", "file"), ("x", "file", 1, "gitfile", "no"), ("x", "target_database", 0, "password", "no"),
        ("x", "target_database", 1, "db", "d"), ("x", "system", 0, "filesets", "no"), ("x", "system_fileset", 0, "password", "own")],
        "target string, layer string, pos int, key string, value string")
    (row,) = R.ordered_layers(R.rank_layers(entries)).collect()
    assert [(p["priority"], p["k"], p["v"]) for p in row["pairs"]] == [
        (1, "password", "own"), (3, "z", "{a}"), (3, "a", "late"), (4, "db", "d"), (5, "a", "file"), (6, "a", "weak")]
    with pytest.raises(Exception, match="no such layer"):
        R.rank_layers(entries.withColumn("layer", F.lit("other"))).collect()


def test_bitmaps_of_few_filesets_are_small(spark):
    sets = spark.range(5000).select(F.format_string("f%05d", "id").alias("fileset"))
    pairs = spark.range(40).select(F.format_string("s%d", F.col("id") % 20).alias("system"),
                                   F.format_string("f%05d", F.col("id") * 100 + 63).alias("fileset"))
    numbered = BM.number_filesets(sets)
    maps = BM.registry_bitmaps(pairs, numbered)
    assert all(len(repr(r["bits"])) < 500 for r in maps.collect())
    got = BM.fileset_counts(pairs.select("system"), maps, numbered).collect()
    assert {tuple(r) for r in got} == {(f"s{i}", 2, 4998) for i in range(20)}


def test_containment_join_repeats_no_files(spark):
    d = spark.createDataFrame
    out = CJ.admitted_files(
        d([("s", "a", "True")], PAIRS), d([("s", "True", "16.20", "daily")], "system string, active string, dbsversion string, collection string"),
        d([("a", "True")], "fileset string, active string"),
        d([("a", f"k{i}", "g", ["16.20", "17.10"], None, None) for i in range(3)] * 2,
          "fileset string, file_key string, gitfile string, dbsversion array<string>, collection array<string>, params map<string,string>"))
    assert sorted(r["file_key"] for r in out.collect()) == ["k0", "k0", "k1", "k1", "k2", "k2"]
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "Generate explode" in line:
            below = []
            for other in lines[i + 1:]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            assert not any("Project" in x and "file_key" in x for x in below)
