"""Registries as DataFrames: systems, filesets, files, parameter layers.

Registries are configuration-sized, but nothing here assumes it: joins are equi-joins on
names and "first wins" is ``min_by`` (an aggregate with map-side combine, not a window).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .bitmaps import missing_pairs, number_filesets, registry_bitmaps
from .filters import is_active, version_ok


def system_pairs(systems: DataFrame) -> DataFrame:
    """``systems.filesets`` (map name → struct(active, params)) → (system, fileset, pair_active)."""
    return systems.select("system", F.explode("filesets").alias("fileset", "__fs")).select(
        "system", "fileset", F.col("__fs.active").alias("pair_active"))


# J1 ------------------------------------------------------------------------------------
def fill_registry(pairs: DataFrame, filesets: DataFrame, systems: DataFrame | None = None) -> DataFrame:
    """Every system gets every known fileset; pairs it lacked are added as inactive.

    Existing pairs are kept as they are.  ``n_filesets`` counts the pairs per system.
    The result is systems x filesets by definition; what is added are the clear bits of the systems'
    bitmaps (``bitmaps``), spelled out system by system, so the work is spread over the systems.
    """
    numbered = materialise(number_filesets(filesets), "filesets")
    sys_names = pairs.select("system")
    if systems is not None:
        sys_names = sys_names.unionByName(systems.select("system"))
    missing = missing_pairs(sys_names, registry_bitmaps(pairs, numbered), numbered) \
        .withColumn("pair_active", F.lit("False")).withColumn("added", F.lit(True))
    filled = pairs.withColumn("added", F.lit(False)).unionByName(missing, allowMissingColumns=True)
    # per-system row count as a partial-aggregated count joined back, so no system's rows
    # are gathered for a window; the counts (one row per system) are a materialized stage
    # that AQE broadcasts when small, and a hot system is split by its skew-join handling
    counts = filled.groupBy("system").agg(F.count(F.lit(1)).alias("n_filesets"))
    return filled.join(counts, "system", "left")


# J2 ------------------------------------------------------------------------------------
def eligible_files(pairs: DataFrame, systems: DataFrame, filesets: DataFrame,
                   files: DataFrame | None = None) -> DataFrame:
    """Active systems → their active filesets → active master fileset → its files,
    kept when the file's version and collection lists admit the system's values.

    The files come either nested in ``filesets.files`` (a configuration-sized registry) or
    as a flat table ``files`` (fileset, file_key, gitfile, dbsversion, collection, params),
    which is the form for file lists that grow with the data: no per-fileset array is
    ever built and the join stays an ordinary shuffle join on ``fileset``.
    """
    s = systems.filter(is_active("active")).select("system", "dbsversion", "collection")
    p = pairs.filter(is_active("pair_active")).select("system", "fileset")
    active = filesets.filter(is_active("active"))
    if files is None:
        f = active.select("fileset", F.explode("files").alias("f")).select(
            "fileset", "f.file_key", "f.gitfile", F.col("f.dbsversion").alias("file_versions"),
            F.col("f.collection").alias("file_collections"), "f.params")
    else:
        f = files.join(active.select("fileset"), "fileset", "left_semi").select(
            "fileset", "file_key", "gitfile", F.col("dbsversion").alias("file_versions"),
            F.col("collection").alias("file_collections"), "params")
    j = p.join(s, "system").join(f, "fileset")
    return j.filter(version_ok("file_versions", "dbsversion")
                    & version_ok("file_collections", "collection"))


def unknown_filesets(pairs: DataFrame, filesets: DataFrame) -> DataFrame:
    """Pairs whose fileset is not in the master list (reported, not run)."""
    return pairs.join(filesets.select("fileset"), "fileset", "left_anti")


# J3 ------------------------------------------------------------------------------------
def basename(path) -> F.Column:
    return F.element_at(F.split(F.col(path) if isinstance(path, str) else path, "/"), -1)


def file_params(files: DataFrame, params: DataFrame, order: str = "pos", path: str = "gitfile") -> DataFrame:
    """Attach each script's own parameter map by file basename; first entry wins.

    ``params``: (path, ``order``, params map); the scripts' paths are in the column ``path``.  ``min_by`` keeps the first entry per
    basename with partial aggregation, so duplicates never meet in one task.
    """
    first = params.groupBy(basename("path").alias("__base")).agg(
        F.min_by("params", F.col(order)).alias("file_params"))
    return files.join(first, basename(path) == F.col("__base"), "left").drop("__base")


# J5 ------------------------------------------------------------------------------------
def layered_overlay(base: DataFrame, overrides: DataFrame) -> DataFrame:
    """Overlay override files on base files.

    ``base``: (folder, name, body); ``overrides``: (folder, name, body) where folder ''
    is the root.  A root override replaces a same-named file in every folder; a folder
    override replaces (folder, name) and beats a root one, and may add new names to
    folders that exist.  Hidden names (leading ``.``) are ignored.
    """
    ov = overrides.filter(~F.col("name").startswith("."))
    root = ov.filter(F.col("folder") == "").select("name", F.col("body").alias("__root"))
    fold = ov.filter(F.col("folder") != "").select("folder", "name", F.col("body").alias("__fold"))
    kept = (base.join(fold, ["folder", "name"], "left").join(root, "name", "left")
            .select("folder", "name",
                    F.coalesce("__fold", "__root", "body").alias("body"),
                    F.when(F.col("__fold").isNotNull(), "folder")
                     .when(F.col("__root").isNotNull(), "root").otherwise("base").alias("source")))
    folders = base.select("folder").distinct()
    added = (fold.join(folders, "folder", "left_semi")
             .join(base.select("folder", "name"), ["folder", "name"], "left_anti")
             .select("folder", "name", F.col("__fold").alias("body"), F.lit("folder").alias("source")))
    return kept.unionByName(added)


# W4 ------------------------------------------------------------------------------------
def resolve_layers(subs: DataFrame, target: Sequence[str] | str = "target") -> DataFrame:
    """Layered substitutions → one ordered pair list per target; the first layer wins.

    ``subs``: (target..., priority, pos, key, value) with priority 1 = strongest.  The
    winning value per (target, key) is a ``min_by`` aggregate; the surviving pairs are
    ordered by (priority, pos) — order matters because values may hold placeholders.
    """
    target = [target] if isinstance(target, str) else list(target)
    win = subs.groupBy(*target, "key").agg(
        F.min_by(F.struct("priority", "pos", "value"), F.struct("priority", "pos")).alias("w"))
    return win.groupBy(*target).agg(F.array_sort(F.collect_list(F.struct(
        F.col("w.priority").alias("priority"), F.col("w.pos").alias("pos"),
        F.col("key").alias("k"), F.col("w.value").alias("v")))).alias("pairs"))


#: Layers of substitutions, the strongest first, and the keys of each that are registry entries or
#: connection settings and never substituted (fixed values).
LAYERS = ("system_fileset", "system", "application", "target_database", "file", "fileset")
SKIPPED_KEYS = {
    "system": ("filesets",),
    "target_database": ("host", "username", "password", "logmech"),
    "file": ("collection", "dbsversion", "gitfile"),
    "fileset": ("files",),
}


def rank_layers(entries: DataFrame, layers: Sequence[str] = LAYERS,
                skipped: Mapping[str, Sequence[str]] = SKIPPED_KEYS) -> DataFrame:
    """``(..., layer, pos, key, value)`` with the layer's ``priority`` (1 = strongest), without the keys
    that its layer skips.  A layer of another name is an error."""
    rank = F.coalesce(*[F.when(F.col("layer") == name, i) for i, name in enumerate(layers, start=1)],
                      F.raise_error(F.concat(F.lit("no such layer: "), F.coalesce("layer", F.lit("null")))).cast("int"))
    skip = F.lit(False)
    for name, keys in skipped.items():
        skip = skip | ((F.col("layer") == name) & F.col("key").isin(*keys))
    return entries.filter(~skip).withColumn("priority", rank)


def ordered_layers(subs: DataFrame, target: Sequence[str] | str = "target") -> DataFrame:
    """All substitutions of a target in the order in which they are made: layer by layer, and inside a
    layer as its dictionary has them.

    A placeholder goes to the strongest layer that knows it.  Unlike in ``resolve_layers``, weaker entries
    of a key stay in the list: they fill in what values of their own layer, or of weaker ones, bring in.
    """
    target = [target] if isinstance(target, str) else list(target)
    return subs.groupBy(*target).agg(F.array_sort(F.collect_list(F.struct(
        "priority", "pos", F.col("key").alias("k"), F.col("value").alias("v")))).alias("pairs"))


def entries_of_map(entries, layer: str) -> Column:
    """A layer's map as ``ordered_layers`` lists it: ``(priority, pos, k, v)`` in the order of the map, without the
    keys that the layer skips."""
    priority, skip = LAYERS.index(layer) + 1, list(SKIPPED_KEYS.get(layer, ()))
    listed = F.transform(F.map_entries(entries), lambda e, i: F.struct(
        F.lit(priority).alias("priority"), i.cast("long").alias("pos"), e["key"].alias("k"), e["value"].alias("v")))
    return F.filter(listed, lambda e: ~e["k"].isin(skip)) if skip else listed


def merged_layers(lists: Sequence[str], times: str) -> Column:
    """The lists of ``ordered_layers`` (null: empty) in columns of a row as one such list, in which each entry
    stands ``times`` times."""
    none = F.array().cast("array<struct<priority:int,pos:bigint,k:string,v:string>>")
    every = F.concat(*[F.coalesce(F.col(c), none) for c in lists])
    # no entry is null, and so this is the order of array_sort without a comparator called per pair
    return F.sort_array(F.when(F.col(times) > 1, F.flatten(F.array_repeat(every, F.col(times).cast("int")))).otherwise(every))


# T18 -----------------------------------------------------------------------------------
def fill_defaults(settings: DataFrame, required: DataFrame) -> DataFrame:
    """Required keys with their value, else the key's default, else ''; flag the misses.

    ``settings``: (key, value); ``required``: (key, default).
    """
    j = required.join(settings, "key", "left")
    return j.select("key", F.coalesce("value", "default", F.lit("")).alias("value"),
                    F.col("value").isNull().alias("was_missing"))
