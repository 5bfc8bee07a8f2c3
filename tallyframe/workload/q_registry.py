"""Registry joins (J1-J3, J5, F6, W4, T18) on registries derived from the driver tables:
supplier = systems, nation = filesets, part = files, region = settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import substitute
from ..operators import bitmaps as BM
from ..operators import containment as CJ
from ..operators import filters as FL
from ..operators import placeholders as PH
from ..operators import registry as R
from ..session import materialise
from .tables import table

Q: dict = {}
SQL: dict = {}


def reg(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# --- derived registries (Spark) ------------------------------------------------------
def systems(spark, sf):
    s = table(spark, sf, "supplier")
    return s.select(
        F.col("s_name").alias("system"),
        F.when(F.col("s_acctbal") >= 0, "True").otherwise("False").alias("active"),
        F.when(F.col("s_nationkey") < 12, "16.20").otherwise("17.10").alias("dbsversion"),
        F.when(F.col("s_acctbal") > 5000, "daily").otherwise("hourly").alias("collection"))


def pairs(spark, sf):
    s, n, r = table(spark, sf, "supplier"), table(spark, sf, "nation"), table(spark, sf, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    # each supplier owns its nation's fileset plus an (unknown) region fileset: both rows
    # come from one pass over the join
    own = F.struct(F.lower("n_name").alias("fileset"),
                   F.when(F.col("s_suppkey") % 7 == 0, "False").otherwise("True").alias("pair_active"))
    unknown = F.struct(F.concat(F.lit("region_"), F.lower("r_name")).alias("fileset"),
                       F.lit("True").alias("pair_active"))
    return j.select(F.col("s_name").alias("system"), F.explode(F.array(own, unknown)).alias("__p")) \
        .select("system", "__p.fileset", "__p.pair_active")


def filesets(spark, sf):
    n = table(spark, sf, "nation")
    return n.select(F.lower("n_name").alias("fileset"),
                    F.when(F.col("n_regionkey") == 4, "False").otherwise("True").alias("active"))


# J2 registries: one fileset per supplier ("fs<suppkey>") whose files are the parts that
# supplier sells in lineitem.  Every fileset has its own systems, so eligible files grow
# linearly with lineitem instead of as (systems × files) per shared fileset.
def _fs_name(key: str):
    return F.concat(F.lit("fs"), F.col(key).cast("string"))


def j2_registry(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    pairs2 = s.select(F.col("s_name").alias("system"), _fs_name("s_suppkey").alias("fileset"),
                      F.when(F.col("s_suppkey") % 7 == 0, "False").otherwise("True").alias("pair_active"))
    filesets2 = s.join(n, s.s_nationkey == n.n_nationkey).select(
        _fs_name("s_suppkey").alias("fileset"),
        F.when(F.col("n_regionkey") == 4, "False").otherwise("True").alias("active"))
    sold = li.select("l_suppkey", "l_partkey").distinct()
    files2 = sold.join(p, sold.l_partkey == p.p_partkey).select(
        _fs_name("l_suppkey").alias("fileset"),
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("file_key"),
        F.concat(F.lit("sql/p"), F.col("p_partkey").cast("string"), F.lit(".q.sql")).alias("gitfile"),
        F.when(F.col("p_size") < 10, None).otherwise(F.array(F.lit("16.20"), F.lit("15.10"))).alias("dbsversion"),
        F.when(F.col("p_size") > 40, F.array(F.lit("daily"))).otherwise(None).alias("collection"),
        F.create_map(F.lit("brand"), F.col("p_brand")).alias("params"))
    return pairs2, filesets2, files2


# --- derived registries (DuckDB) -------------------------------------------------------
_REG_SQL = """
WITH systems AS (
  SELECT s_name AS system, CASE WHEN s_acctbal >= 0 THEN 'True' ELSE 'False' END AS active,
         CASE WHEN s_nationkey < 12 THEN '16.20' ELSE '17.10' END AS dbsversion,
         CASE WHEN s_acctbal > 5000 THEN 'daily' ELSE 'hourly' END AS collection FROM supplier),
pairs AS (
  SELECT s_name AS system, lower(n_name) AS fileset,
         CASE WHEN s_suppkey % 7 = 0 THEN 'False' ELSE 'True' END AS pair_active
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT s_name, 'region_' || lower(r_name), 'True'
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
filesets AS (
  SELECT lower(n_name) AS fileset, CASE WHEN n_regionkey = 4 THEN 'False' ELSE 'True' END AS active
  FROM nation)
"""

_J2_SQL = """
WITH systems AS (
  SELECT s_name AS system, CASE WHEN s_acctbal >= 0 THEN 'True' ELSE 'False' END AS active,
         CASE WHEN s_nationkey < 12 THEN '16.20' ELSE '17.10' END AS dbsversion,
         CASE WHEN s_acctbal > 5000 THEN 'daily' ELSE 'hourly' END AS collection FROM supplier),
pairs AS (
  SELECT s_name AS system, 'fs' || CAST(s_suppkey AS VARCHAR) AS fileset,
         CASE WHEN s_suppkey % 7 = 0 THEN 'False' ELSE 'True' END AS pair_active FROM supplier),
filesets AS (
  SELECT 'fs' || CAST(s_suppkey AS VARCHAR) AS fileset,
         CASE WHEN n_regionkey = 4 THEN 'False' ELSE 'True' END AS active
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
files AS (
  SELECT 'fs' || CAST(sp.l_suppkey AS VARCHAR) AS fileset, 'p' || CAST(p_partkey AS VARCHAR) AS file_key,
         'sql/p' || CAST(p_partkey AS VARCHAR) || '.q.sql' AS gitfile,
         CASE WHEN p_size < 10 THEN NULL ELSE ['16.20', '15.10'] END AS versions,
         CASE WHEN p_size > 40 THEN ['daily'] ELSE NULL END AS collections
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) sp JOIN part ON sp.l_partkey = p_partkey)
"""


@reg("fill_registry", _REG_SQL + """
, allp AS (SELECT DISTINCT system FROM pairs),
names AS (SELECT DISTINCT fileset FROM filesets),
filled AS (
  SELECT system, fileset, pair_active, false AS added FROM pairs
  UNION ALL
  SELECT a.system, n.fileset, 'False', true FROM allp a, names n
  WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.system = a.system AND p.fileset = n.fileset))
SELECT *, count(*) OVER (PARTITION BY system) AS n_filesets FROM filled""")
def q_fill_registry(spark, sf):
    return R.fill_registry(pairs(spark, sf), filesets(spark, sf))


@reg("eligible_files", _J2_SQL + """
SELECT p.system, p.fileset, f.file_key, f.gitfile
FROM pairs p JOIN systems s ON p.system = s.system
JOIN filesets fs ON p.fileset = fs.fileset JOIN files f ON f.fileset = fs.fileset
WHERE lower(s.active) = 'true' AND lower(p.pair_active) = 'true' AND lower(fs.active) = 'true'
  AND coalesce(list_contains(f.versions, s.dbsversion), true)
  AND coalesce(list_contains(f.collections, s.collection), true)""")
def q_eligible_files(spark, sf):
    pairs2, filesets2, files2 = j2_registry(spark, sf)
    out = R.eligible_files(pairs2, systems(spark, sf), filesets2, files=files2)
    return out.select("system", "fileset", "file_key", "gitfile")


@reg("runnable_sets", _REG_SQL + """
SELECT p.system, p.fileset FROM pairs p JOIN systems s ON p.system = s.system
LEFT JOIN filesets fs ON p.fileset = fs.fileset
WHERE lower(s.active) = 'true'
  AND ((fs.fileset IS NOT NULL AND lower(fs.active) = 'true' AND lower(p.pair_active) = 'true')
       OR (fs.fileset IS NULL AND false))""")
def q_runnable_sets(spark, sf):
    fs = filesets(spark, sf).select("fileset", "active")
    return FL.runnable_sets(pairs(spark, sf), systems(spark, sf), fs).select("system", "fileset")


@reg("runnable_sets_unknown", _REG_SQL + """
SELECT p.system, p.fileset FROM pairs p JOIN systems s ON p.system = s.system
LEFT JOIN filesets fs ON p.fileset = fs.fileset
WHERE lower(s.active) = 'true'
  AND ((fs.fileset IS NOT NULL AND lower(fs.active) = 'true' AND lower(p.pair_active) = 'true')
       OR fs.fileset IS NULL)""")
def q_runnable_sets_unknown(spark, sf):
    fs = filesets(spark, sf).select("fileset", "active")
    return FL.runnable_sets(pairs(spark, sf), systems(spark, sf), fs, run_unknown=True).select("system", "fileset")


@reg("file_params", """
WITH params AS (
  SELECT 'params/' || lower(p_type) || '/p' || CAST(p_partkey AS VARCHAR) || '.q.sql' AS path, p_size AS pos,
         p_brand AS brand FROM part
  UNION ALL
  SELECT 'other/p' || CAST(p_partkey AS VARCHAR) || '.q.sql', p_size + 100, 'dup' FROM part),
firsts AS (SELECT string_split(path, '/')[-1] AS base, arg_min(brand, pos) AS brand FROM params GROUP BY 1)
SELECT 'p' || CAST(p_partkey AS VARCHAR) AS file_key, f.brand
FROM part LEFT JOIN firsts f ON f.base = 'p' || CAST(p_partkey AS VARCHAR) || '.q.sql'""")
def q_file_params(spark, sf):
    p = table(spark, sf, "part")
    params = p.select(F.concat(F.lit("params/"), F.lower("p_type"), F.lit("/p"), F.col("p_partkey").cast("string"),
                               F.lit(".q.sql")).alias("path"), F.col("p_size").alias("pos"),
                      F.create_map(F.lit("brand"), F.col("p_brand")).alias("params")).unionByName(
        p.select(F.concat(F.lit("other/p"), F.col("p_partkey").cast("string"), F.lit(".q.sql")).alias("path"),
                 (F.col("p_size") + 100).alias("pos"), F.create_map(F.lit("brand"), F.lit("dup")).alias("params")))
    files = p.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("file_key"),
                     F.concat(F.lit("sql/p"), F.col("p_partkey").cast("string"), F.lit(".q.sql")).alias("gitfile"))
    return R.file_params(files, params).select("file_key", F.col("file_params")["brand"].alias("brand"))


@reg("layered_overlay", """
WITH base AS (SELECT lower(p_type) AS folder, 'p' || CAST(p_partkey AS VARCHAR) || '.sql' AS name,
                     'base ' || p_name AS body, p_size FROM part),
ov AS (
  SELECT '' AS folder, name, 'root ' || body AS body FROM base WHERE p_size < 5
  UNION ALL SELECT folder, name, 'folder ' || body FROM base WHERE p_size BETWEEN 3 AND 6
  UNION ALL SELECT folder, 'new_' || name, 'added' FROM base WHERE p_size = 50
  UNION ALL SELECT folder, '.hidden_' || name, 'hidden' FROM base WHERE p_size = 49),
fold AS (SELECT * FROM ov WHERE folder <> '' AND NOT starts_with(name, '.')),
root AS (SELECT * FROM ov WHERE folder = '' AND NOT starts_with(name, '.'))
SELECT b.folder, b.name, coalesce(f.body, r.body, b.body) AS body,
       CASE WHEN f.body IS NOT NULL THEN 'folder' WHEN r.body IS NOT NULL THEN 'root' ELSE 'base' END AS source
FROM base b LEFT JOIN fold f ON f.folder = b.folder AND f.name = b.name LEFT JOIN root r ON r.name = b.name
UNION ALL
SELECT f.folder, f.name, f.body, 'folder' FROM fold f
WHERE f.folder IN (SELECT folder FROM base)
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.folder = f.folder AND b.name = f.name)""")
def q_layered_overlay(spark, sf):
    p = table(spark, sf, "part")
    base = p.select(F.lower("p_type").alias("folder"),
                    F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(".sql")).alias("name"),
                    F.concat(F.lit("base "), F.col("p_name")).alias("body"), "p_size")
    ov = (base.filter(F.col("p_size") < 5).select(F.lit("").alias("folder"), "name",
                                                   F.concat(F.lit("root "), "body").alias("body"))
          .unionByName(base.filter(F.col("p_size").between(3, 6)).select(
              "folder", "name", F.concat(F.lit("folder "), "body").alias("body")))
          .unionByName(base.filter(F.col("p_size") == 50).select(
              "folder", F.concat(F.lit("new_"), "name").alias("name"), F.lit("added").alias("body")))
          .unionByName(base.filter(F.col("p_size") == 49).select(
              "folder", F.concat(F.lit(".hidden_"), "name").alias("name"), F.lit("hidden").alias("body"))))
    return R.layered_overlay(base.drop("p_size"), ov)


@reg("resolve_layers", """
WITH sn AS (SELECT s_suppkey, n_name, r_name
            FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
subs AS (
  SELECT s_suppkey AS target, 1 AS priority, 1 AS pos, 'name' AS key, s_name AS value FROM supplier
  UNION ALL SELECT s_suppkey, 1, 2, 'id', CAST(s_suppkey AS VARCHAR) FROM supplier
  UNION ALL SELECT s_suppkey, 2, 1, 'name', n_name FROM sn
  UNION ALL SELECT s_suppkey, 2, 2, 'region', r_name FROM sn
  UNION ALL SELECT s_suppkey, 3, 1, 'greeting', 'Hi {name} from {region}' FROM supplier
  UNION ALL SELECT s_suppkey, 3, 2, 'name', 'app' FROM supplier)
SELECT target,
  replace(replace(replace(replace('{greeting} #{id} ({name}, {region})',
    '{name}', max(value) FILTER (WHERE priority = 1 AND key = 'name')),
    '{id}', max(value) FILTER (WHERE key = 'id')),
    '{region}', max(value) FILTER (WHERE key = 'region')),
    '{greeting}', max(value) FILTER (WHERE key = 'greeting')) AS text,
  CAST(4 AS INTEGER) AS n_pairs
FROM subs GROUP BY target""")
def q_resolve_layers(spark, sf):
    sp, n, r = table(spark, sf, "supplier"), table(spark, sf, "nation"), table(spark, sf, "region")
    sn = sp.join(n, sp.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    t = F.col("s_suppkey").alias("target")

    def layer(src, priority, pos, key, value):
        return src.select(t, F.lit(priority).alias("priority"), F.lit(pos).alias("pos"),
                          F.lit(key).alias("key"), value.alias("value"))

    subs = (layer(sp, 1, 1, "name", F.col("s_name"))
            .unionByName(layer(sp, 1, 2, "id", F.col("s_suppkey").cast("string")))
            .unionByName(layer(sn, 2, 1, "name", F.col("n_name")))
            .unionByName(layer(sn, 2, 2, "region", F.col("r_name")))
            .unionByName(layer(sp, 3, 1, "greeting", F.lit("Hi {name} from {region}")))
            .unionByName(layer(sp, 3, 2, "name", F.lit("app"))))
    res = R.resolve_layers(subs, "target")
    return res.select("target", substitute(F.lit("{greeting} #{id} ({name}, {region})"), F.col("pairs")).alias("text"),
                      F.size("pairs").alias("n_pairs"))


@reg("fill_defaults", """
WITH settings AS (SELECT lower(s_name) AS key, CAST(s_nationkey AS VARCHAR) AS value FROM supplier
                  WHERE s_acctbal >= 0),
required AS (SELECT lower(s_name) AS key, CASE WHEN s_nationkey = 4 THEN NULL ELSE 'dflt' END AS "default"
             FROM supplier)
SELECT r.key, coalesce(s.value, r."default", '') AS value, s.value IS NULL AS was_missing
FROM required r LEFT JOIN settings s ON r.key = s.key""")
def q_fill_defaults(spark, sf):
    sp = table(spark, sf, "supplier")
    settings = sp.filter(F.col("s_acctbal") >= 0).select(F.lower("s_name").alias("key"),
                                                        F.col("s_nationkey").cast("string").alias("value"))
    required = sp.select(F.lower("s_name").alias("key"),
                         F.when(F.col("s_nationkey") == 4, None).otherwise("dflt").alias("default"))
    return R.fill_defaults(settings, required)


@reg("unknown_filesets", _REG_SQL + """
SELECT system, fileset, pair_active FROM pairs WHERE fileset NOT IN (SELECT fileset FROM filesets)""")
def q_unknown_filesets(spark, sf):
    return R.unknown_filesets(pairs(spark, sf), filesets(spark, sf))


# Filesets of each system as bitmaps: every part is a fileset, a supplier's are the parts it sells,
# built by line status and merged.  Only the counts are asked for, no missing pair is spelled out.
@reg("registry_counts", """
WITH have AS (SELECT l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part) GROUP BY 1)
SELECT s_name AS system, coalesce(n, 0) AS n_known, (SELECT count(*) FROM part) - coalesce(n, 0) AS n_missing
FROM supplier LEFT JOIN have ON l_suppkey = s_suppkey""")
def q_registry_counts(spark, sf):
    li, sp = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    numbered = materialise(BM.number_filesets(table(spark, sf, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("fileset"))), "filesets")
    sold = li.join(sp, li.l_suppkey == sp.s_suppkey).select(
        F.col("s_name").alias("system"), F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("fileset"), "l_linestatus")
    parts = [BM.registry_bitmaps(sold.filter(F.col("l_linestatus") == x), numbered) for x in ("O", "F")]
    return BM.fileset_counts(sp.select(F.col("s_name").alias("system")), BM.merge_bitmaps(*parts), numbered)


# J2 as a containment join: the registry of eligible_files, and one fileset that all systems share.
_SHARED_SQL = """
, shared AS (
  SELECT 'shared' AS fileset, 'n' || n_nationkey AS file_key, 'sql/n' || n_nationkey || '.sql' AS gitfile,
         CASE n_regionkey WHEN 0 THEN NULL WHEN 1 THEN ['16.20'] WHEN 2 THEN ['16.20', '17.10'] WHEN 3 THEN [] ELSE ['15.00', NULL] END AS versions,
         CASE WHEN n_nationkey % 2 = 0 THEN ['daily', 'daily'] END AS collections FROM nation),
all_pairs AS (SELECT * FROM pairs UNION ALL SELECT system, 'shared', 'True' FROM systems),
all_sets AS (SELECT * FROM filesets UNION ALL SELECT 'shared', 'true'),
all_files AS (SELECT * FROM files UNION ALL SELECT * FROM shared)
"""


@reg("admitted_files", _J2_SQL + _SHARED_SQL + """
SELECT p.system, p.fileset, f.file_key, f.gitfile
FROM all_pairs p JOIN systems s ON p.system = s.system
JOIN all_sets fs ON p.fileset = fs.fileset JOIN all_files f ON f.fileset = fs.fileset
WHERE lower(s.active) = 'true' AND lower(p.pair_active) = 'true' AND lower(fs.active) = 'true'
  AND (versions IS NULL OR list_contains(versions, dbsversion) OR len(versions) > list_count(versions))
  AND (collections IS NULL OR list_contains(collections, collection))""")
def q_admitted_files(spark, sf):
    pairs2, filesets2, files2 = j2_registry(spark, sf)
    every = systems(spark, sf)
    n = table(spark, sf, "nation")
    text = lambda *xs: F.array(*[F.lit(x).cast("string") for x in xs])
    key = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    versions = F.when(F.col("n_regionkey") == 1, text("16.20")).when(F.col("n_regionkey") == 2, text("16.20", "17.10")).when(
        F.col("n_regionkey") == 3, F.array().cast("array<string>")).when(F.col("n_regionkey") == 4, text("15.00", None))
    # not a constant, which would turn the join on it into a nested loop
    shared = n.select(F.when(F.col("n_nationkey") >= 0, "shared").alias("fileset"), key.alias("file_key"), F.concat(F.lit("sql/"), key, F.lit(".sql")).alias("gitfile"),
                      versions.alias("dbsversion"), F.when(F.col("n_nationkey") % 2 == 0, text("daily", "daily")).alias("collection"),
                      F.lit(None).cast("map<string,string>").alias("params"))
    one = F.lit("shared").alias("fileset")
    own = F.when(F.col("system").isNotNull(), "shared").alias("fileset")
    out = CJ.admitted_files(pairs2.unionByName(every.select("system", own, F.lit("True").alias("pair_active"))), every,
                            filesets2.unionByName(spark.range(1).select(one, F.lit("true").alias("active"))),
                            files2.unionByName(shared))
    return out.select("system", "fileset", "file_key", "gitfile")


# A chain of nine keys whose order is the wrong way round, an unknown key, and a cycle for some systems.
@reg("close_placeholders", """
WITH s AS (SELECT s_suppkey AS target, s_name, s_nationkey < 12 AS loops FROM supplier),
chain AS (
  SELECT target, 'k' || i AS key, s_name || array_to_string(list_transform(range(7, i - 1, -1), lambda x: '-' || x), '') AS value,
    'ok' AS status, 8 - i AS depth, [] :: VARCHAR[] AS unresolved FROM s, range(9) r(i)),
rest AS (
  SELECT s.target, 'greeting' AS key, 'Hi ' || c.value || ' from {nope} {k8x}' AS value,
    'unresolved' AS status, 9 AS depth, ['k8x', 'nope'] AS unresolved FROM s JOIN chain c ON c.target = s.target AND c.key = 'k0'
  UNION ALL SELECT target, 'p', CASE WHEN loops THEN '{q}' ELSE s_name END, CASE WHEN loops THEN 'cycle' ELSE 'ok' END,
    CASE WHEN loops THEN 2 ELSE 1 END, [] FROM s
  UNION ALL SELECT target, 'q', CASE WHEN loops THEN '{p}' ELSE s_name || s_name END, CASE WHEN loops THEN 'cycle' ELSE 'ok' END, 2, [] FROM s
  UNION ALL SELECT target, 'r', CASE WHEN loops THEN 'see {p} {gone}' ELSE 'see ' || s_name || ' {gone}' END,
    CASE WHEN loops THEN 'cycle' ELSE 'unresolved' END, 2, ['gone'] FROM s)
SELECT target, key, value, status, CAST(depth AS BIGINT) AS depth, array_to_string(unresolved, ',') AS unresolved FROM chain
UNION ALL SELECT target, key, value, status, CAST(depth AS BIGINT), array_to_string(unresolved, ',') FROM rest""")
def q_close_placeholders(spark, sf):
    name, loops = F.col("s_name"), F.col("s_nationkey") < 12
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    chain = [pair(f"k{i}", F.lit(f"{{k{i + 1}}}-{i}")) for i in range(8)]
    entries = F.array(*chain, pair("k8", name), pair("greeting", F.lit("Hi {k0} from {nope} {k8x}")),
                      pair("p", F.when(loops, "{q}").otherwise("{k8}")),
                      pair("q", F.when(loops, "{p}").otherwise("{p}{k8}")),
                      pair("r", F.lit("see {p} {gone}")))
    pairs_ = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("target"), F.inline(entries))
    return PH.close_placeholders(pairs_).withColumn("unresolved", F.array_join("unresolved", ","))


# The whole prepare chain on the J2 registry: one script per file, overridden for every 50th part and missing
# for parts of size 50, a fileset outside of the list, and every layer of substitutions.
@reg("prepare_runs", _J2_SQL + """
, runs AS (
  SELECT p.system, p.fileset, f.file_key || '.q.sql' AS file, p_size, p_brand, p_partkey % 50 = 0 AS over
  FROM pairs p JOIN systems s ON p.system = s.system JOIN filesets fs ON p.fileset = fs.fileset
  JOIN files f ON f.fileset = p.fileset JOIN part ON f.file_key = 'p' || p_partkey
  WHERE lower(s.active) = 'true' AND lower(p.pair_active) = 'true' AND lower(fs.active) = 'true'
    AND (versions IS NULL OR list_contains(versions, dbsversion)) AND (collections IS NULL OR list_contains(collections, collection)))
SELECT system, fileset, file, CAST(1 AS INTEGER) AS stmt_no,
  'SELECT ''' || CASE WHEN p_size >= 5 THEN p_brand ELSE 'shared' END || ''' AS b, ''' || system || ''' AS w, ''app'' AS o, ''done'' AS c, ''{password}{gitfile}'' AS p, '''
  || CASE WHEN p_size >= 5 THEN 'set of ' || fileset ELSE '{first}' END || ''' AS f'
  || CASE WHEN over THEN ' /* override */' ELSE '' END || chr(10) || ';' || chr(10) || chr(10) AS sql, 'ok' AS status FROM runs WHERE p_size <> 50
UNION ALL SELECT system, fileset, file, 0, NULL, 'error: no text' FROM runs WHERE p_size = 50
UNION ALL SELECT system, 'stray', 'x.q.sql', 1, 'SELECT ''' || system || ''' AS w' || chr(10) || ';' || chr(10) || chr(10), 'ok'
FROM systems WHERE lower(active) = 'true'""")
def q_prepare_runs(spark, sf):
    from ..plans import jobs

    p2, fs2, files2 = j2_registry(spark, sf)
    part, every = table(spark, sf, "part"), systems(spark, sf)
    name = F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(".q.sql"))
    text = "SELECT '{brand}' AS b, '{who}' AS w, '{owner}' AS o, '{z}' AS c, '{password}{gitfile}' AS p, '{first}' AS f"
    written = part.filter("p_size <> 50").select(name.alias("name"))
    scripts = files2.select(F.col("fileset").alias("folder"), R.basename("gitfile").alias("name")).join(
        written, "name").select("folder", "name", F.lit(text + ";").alias("body")).unionByName(spark.range(1).select(
            F.lit("stray").alias("folder"), F.lit("x.q.sql").alias("name"), F.lit("SELECT '{who}' AS w;").alias("body")))
    overrides = part.filter(F.col("p_partkey") % 50 == 0).select(
        F.lit("").alias("folder"), name.alias("name"), F.lit(text + " /* override */;").alias("body"))
    # the file's owner loses to the application's, its gitfile is no substitution, its values keep their order
    params = part.filter("p_size >= 5").select(F.concat(F.lit("params/"), name).alias("path"), F.lit(0).alias("pos"), F.create_map(
        F.lit("first"), F.lit("{second}"), F.lit("brand"), "p_brand", F.lit("owner"), F.lit("file"), F.lit("gitfile"), F.lit("hidden"),
        F.lit("second"), F.lit("set of {set}")).alias("params"))
    fixed = [("application", 0, "owner", "app"), ("application", 1, "z", "{a}"), ("application", 2, "a", "done"),
             ("target_database", 0, "password", "secret")]
    layer = lambda rows: F.array(*[F.struct(
        F.lit(a).alias("layer"), F.lit(i).alias("pos"), F.lit(k).alias("key"), (F.lit(v) if isinstance(v, str) else v).alias("value"))
        for a, i, k, v in rows])
    none = F.lit(None).cast("string")
    layers = spark.range(1).select(none.alias("system"), none.alias("fileset"), F.inline(layer(fixed))).unionByName(
        every.select("system", none.alias("fileset"), F.inline(layer([
            ("system", 0, "who", F.col("system")), ("system", 1, "filesets", "hidden")])))).unionByName(
        fs2.select(none.alias("system"), "fileset", F.inline(layer([
            ("fileset", 0, "brand", "shared"), ("fileset", 1, "owner", "set"), ("fileset", 2, "set", F.col("fileset"))]))))
    strays = every.select("system", F.lit("stray").alias("fileset"), F.lit("False").alias("pair_active"))
    out = jobs.prepare_runs(p2.unionByName(strays), every, fs2, files2, scripts, overrides, params, layers, run_unknown=True)
    return out.select("system", "fileset", "file", "stmt_no", "sql", "status")
