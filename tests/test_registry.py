"""Registries, layers and grouping: documented examples and properties."""
import random

from pyspark.sql import functions as F

from tallyframe.functions import text as X
from tallyframe.operators import charts as C
from tallyframe.operators import filters as FL
from tallyframe.operators import frames as FR
from tallyframe.operators import registry as R


def test_layer_precedence_example(spark):
    # system-fileset > system > application: "Aardvark" for demo of the first system,
    # "Bear" for the second system (no fileset-level value there).
    subs = spark.createDataFrame([
        ("sys1", "demo", 1, 1, "some_value", "Aardvark"),
        ("sys1", "demo", 2, 1, "some_value", "Bear"),
        ("sys1", "demo", 3, 1, "some_value", "Camel"),
        ("sys2", "demo", 2, 1, "some_value", "Bear"),
        ("sys2", "demo", 3, 1, "some_value", "Camel"),
        ("sys2", "demo", 3, 2, "account", "Demo Customer"),
    ], "system string, fileset string, priority int, pos int, key string, value string")
    res = R.resolve_layers(subs, ["system", "fileset"])
    got = {r["system"]: r["t"] for r in res.select(
        "system", X.substitute(F.lit("{some_value}/{account}"), F.col("pairs")).alias("t")).collect()}
    assert got == {"sys1": "Aardvark/{account}", "sys2": "Bear/Demo Customer"}
    # one value per key
    n = res.select(F.size("pairs").alias("n"), F.size(F.array_distinct(F.transform("pairs", lambda p: p["k"]))).alias("d"))
    assert all(r["n"] == r["d"] for r in n.collect())


PETS = [("spot", "True", "dog", None), ("jane", "True", "cat", None), ("lucky", "False", "cat", "3")]


def test_partition_by_key_examples(spark):
    pets = spark.createDataFrame(PETS, "name string, active string, type string, legs string")
    by_type = FR.partition_by_key(pets, "type", guaranteed=["cat", "dog", "bird", "gerbil"])
    groups = {}
    for r in by_type.collect():
        groups.setdefault(r["group_key"], set())
        if r["name"] is not None:
            groups[r["group_key"]].add(r["name"])
    assert groups == {"dog": {"spot"}, "cat": {"jane", "lucky"}, "bird": set(), "gerbil": set()}
    legs = {r["name"]: r["group_key"] for r in FR.partition_by_key(pets, "legs", default="4").collect()}
    assert legs == {"spot": "4", "jane": "4", "lucky": "3"}
    nested = {r["group_key"]: len(r["records"]) for r in FR.nest_groups(by_type).collect()}
    assert nested == {"dog": 1, "cat": 2, "bird": 0, "gerbil": 0}


def test_split_children_fleas(spark):
    df = spark.createDataFrame(
        [("lucky", 1, {"bobby": {"active": "False"}, "susie": {"active": "False"}, "bitey": {"active": "True"}}),
         ("spot", 2, {"rex": {"color": "brown"}})],
        "pet string, ord int, fleas map<string, map<string,string>>")
    got = {(r["group_key"], r["child"]) for r in FR.split_children(df, "pet", "fleas", "active", "ord").collect()}
    assert got == {("False", "bobby"), ("False", "susie"), ("True", "bitey")}


def test_fill_registry_size_and_overlay(spark):
    pairs = spark.createDataFrame([("s1", "a", "True"), ("s2", "b", "False")], "system string, fileset string, pair_active string")
    fs = spark.createDataFrame([("a",), ("b",), ("c",)], "fileset string")
    out = R.fill_registry(pairs, fs).collect()
    assert len(out) == 2 * 3
    assert {(r["system"], r["fileset"]): r["pair_active"] for r in out if not r["added"]} == {("s1", "a"): "True", ("s2", "b"): "False"}
    assert all(r["pair_active"] == "False" for r in out if r["added"])
    base = spark.createDataFrame([("f1", "x.sql", "base"), ("f2", "x.sql", "base"), ("f2", "y.sql", "base")], "folder string, name string, body string")
    ov = spark.createDataFrame([("", "x.sql", "root"), ("f2", "x.sql", "folder"), ("f1", "new.sql", "added"),
                                ("f9", "z.sql", "nofolder"), ("f1", ".hidden", "h")], "folder string, name string, body string")
    got = {(r["folder"], r["name"]): r["body"] for r in R.layered_overlay(base, ov).collect()}
    assert got == {("f1", "x.sql"): "root", ("f2", "x.sql"): "folder", ("f2", "y.sql"): "base", ("f1", "new.sql"): "added"}


def test_runnable_sets(spark):
    pairs = spark.createDataFrame([("s1", "a", "True"), ("s1", "b", "True"), ("s1", "zz", "True"), ("s2", "a", "True")],
                                  "system string, fileset string, pair_active string")
    systems = spark.createDataFrame([("s1", "True"), ("s2", "false")], "system string, active string")
    fs = spark.createDataFrame([("a", "True"), ("b", "False")], "fileset string, active string")
    run = lambda u: {(r["system"], r["fileset"]) for r in FL.runnable_sets(pairs, systems, fs, u).collect()}
    assert run(False) == {("s1", "a")}
    assert run(True) == {("s1", "a"), ("s1", "zz")}


def test_properties_on_tables(spark):
    sf = "/root/testdata/sf0.001"
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    share = C.share_by_group(li, "l_returnflag", "l_extendedprice").agg(F.sum("share")).first()[0]
    assert abs(share - 1.0) < 1e-9
    parts = [li.filter(F.col("l_returnflag") == f) for f in ("A", "N", "R")]
    assert FR.union_all(parts).count() == sum(p.count() for p in parts)


def test_mask_secrets_property(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(300):
        text = "".join(rnd.choice("abcxyz .") for _ in range(rnd.randint(0, 40)))
        secrets = ["".join(rnd.choice("abcxyz") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(0, 3))]
        rows.append((text, secrets))
    df = spark.createDataFrame(rows, "text string, secrets array<string>")
    got = [r["m"] for r in df.select(X.mask_secrets("text", F.col("secrets")).alias("m")).collect()]
    for (text, secrets), m in zip(rows, got):
        exp = text
        for s in secrets:
            exp = exp.replace(s, X.mask_secret_literal(s))
        assert m == exp
        if len(secrets) == 1:
            s = secrets[0]
            # a lone secret of 3+ characters that cannot overlap itself never survives
            if len(s) >= 3 and all(s[:k] != s[-k:] for k in range(1, len(s))):
                assert s not in m


def test_resolve_layers_one_value_per_key(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(1, 4), rnd.randint(1, 3), pos, rnd.choice("abcd"), f"v{i}")
            for i, pos in enumerate(rnd.randint(1, 5) for _ in range(400))]
    subs = spark.createDataFrame(rows, "target int, priority int, pos int, key string, value string")
    got = {r["target"]: r["pairs"] for r in R.resolve_layers(subs, "target").collect()}
    for t in {r[0] for r in rows}:
        keys = [p["k"] for p in got[t]]
        assert len(keys) == len(set(keys))  # one value per key
        for p in got[t]:
            cands = [r for r in rows if r[0] == t and r[3] == p["k"]]
            best = min((r[1], r[2]) for r in cands)
            assert (p["priority"], p["pos"]) == best  # the strongest layer wins
            assert p["v"] in {r[4] for r in cands if (r[1], r[2]) == best}
        # pairs come ordered by (priority, pos)
        assert [(p["priority"], p["pos"]) for p in got[t]] == sorted((p["priority"], p["pos"]) for p in got[t])
