"""The data behind the reference's charts.

Every aggregate is algebraic (partial aggregation before the shuffle), so a group holding
a third of the table costs no more than any other.  Global constants (min/max, overall
means, totals) are scalar subqueries, never a window over base rows.  The only
order-statistics (quantiles) go through ``exact_quantiles``, which brackets them instead
of collecting a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import classify_change, millions_label
from .filters import both_over_threshold, group_value_filter
from ..session import materialise
from .bootstrap import bootstrap_mean
from .ranking import grouped_cumulative

Z95 = 1.959963984540054  # two-sided 95% normal quantile


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _num(c) -> Column:
    """Value with NaN treated as missing (pandas skips NaN; Spark would propagate it)."""
    v = _c(c).cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def _keys(g) -> list:
    if g is None:
        return []
    return [g] if isinstance(g, (str, Column)) else list(g)


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pandas ``groupby`` drops null keys; Spark would keep them as a group."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def _with_interval(df: DataFrame, mean: str, sd: str, n: str, z: float) -> DataFrame:
    half = F.lit(z) * F.col(sd) / F.sqrt(F.col(n).cast("double"))
    return df.withColumns({"ci_lo": F.col(mean) - half, "ci_hi": F.col(mean) + half})


def _bind_stats(df: DataFrame, source: DataFrame, name: str, **aggs: Column) -> DataFrame:
    """Attach one-row statistics of ``source`` to ``df`` as the struct column ``name``.

    The statistics form one struct-valued scalar subquery bound to a column once.  A
    subquery Column referenced in several expressions is copied into the plan once per
    reference; AQE deduplicates the copies at run time, but the plan (and its planning
    work) grows with every reference.  Binding it first keeps the plan to one subquery.
    """
    stats = source.select(F.struct(*[c.alias(k) for k, c in aggs.items()])).scalar()
    return df.withColumn(name, stats)


# A1 + W1 -------------------------------------------------------------------------------
def group_mean_rounded(df: DataFrame, group: str, value: str, out: str = "mean_value") -> DataFrame:
    """Mean per group rounded half-to-even to an integer, flagged against the mean of means.

    ``flag`` is ``red`` when the rounded mean is below the mean of all rounded means,
    else ``green``.  Rows come back in ascending value order (O1).
    """
    agg = (_drop_null_keys(df, [group]).groupBy(group)
           .agg(F.bround(F.avg(_num(value)), 0).cast("long").alias(out)))
    return vs_overall_mean(agg, out, flag="flag").orderBy(out, group)


def vs_overall_mean(agg: DataFrame, value: str, flag: str = "flag",
                    diff: str | None = None) -> DataFrame:
    """Compare each (already aggregated) row with the mean over all rows."""
    out = _bind_stats(agg, agg, "__s", overall=F.avg(F.col(value).cast("double")))
    overall = F.col("__s.overall")
    out = out.withColumn(flag, F.when(F.col(value) < overall, F.lit("red")).otherwise(F.lit("green")))
    if diff:
        out = out.withColumn(diff, F.col(value) - overall)
    return out.drop("__s")


# A2 ------------------------------------------------------------------------------------
def group_mean_ci(df: DataFrame, x: str, y: str, hue: str | None = None,
                  z: float = Z95, row_key: Sequence[str] | None = None) -> DataFrame:
    """Mean of ``y`` per ``x`` (or per ``x, hue``) with a 95% interval.

    With ``row_key``, the columns that tell rows apart, the interval is a bootstrap's, as a
    plotting library draws it; without, its normal approximation (and ``sd``).
    """
    keys = [x] + ([hue] if hue else [])
    if row_key is not None:
        return bootstrap_mean(df, keys, y, row_key)
    agg = _drop_null_keys(df, keys).groupBy(*keys).agg(
        F.avg(_num(y)).alias("mean"), F.stddev_samp(_num(y)).alias("sd"),
        F.count(_num(y)).alias("n"))
    return _with_interval(agg, "mean", "sd", "n", z)


# A3-A5 ---------------------------------------------------------------------------------
def _trend(df: DataFrame, key: Column, key_name: str, series: str, value: str,
           extra: dict | None = None, z: float = Z95, row_key: Sequence[str] | None = None) -> DataFrame:
    if row_key is not None:
        named = [F.col(c).alias(f"__r{i}") for i, c in enumerate(row_key)]
        base = df.select(key.alias(key_name), F.col(series), F.col(value).alias("__v"), *named)
        out = bootstrap_mean(base, [key_name, series], "__v", [f"__r{i}" for i in range(len(named))])
        return out.withColumns(extra) if extra else out
    base = df.select(key.alias(key_name), F.col(series), _num(value).alias("__v"))
    agg = _drop_null_keys(base, [key_name, series]).groupBy(key_name, series).agg(
        F.avg("__v").alias("mean"), F.stddev_samp("__v").alias("sd"), F.count("__v").alias("n"))
    out = _with_interval(agg, "mean", "sd", "n", z)
    if extra:
        out = out.withColumns(extra)
    return out


def trend_daily(df: DataFrame, ts: str, series: str, value: str,
                row_key: Sequence[str] | None = None) -> DataFrame:
    """Mean per (day, series) with interval (a bootstrap's with ``row_key``); sort by ``day`` when drawing."""
    day = F.date_format(F.to_date(F.col(ts)), "yyyy-MM-dd")
    return _trend(df, day, "day", series, value, row_key=row_key)


def trend_weekly(df: DataFrame, ts: str, series: str, value: str,
                 row_key: Sequence[str] | None = None) -> DataFrame:
    """Mean per (ISO week start, series)."""
    wk = F.date_format(F.date_trunc("week", F.col(ts)), "yyyy-MM-dd")
    return _trend(df, wk, "week_start", series, value, row_key=row_key)


def trend_weekday(df: DataFrame, ts: str, series: str, value: str,
                  row_key: Sequence[str] | None = None) -> DataFrame:
    """Mean per (weekday 0=Monday, series) plus the weekday name."""
    out = _trend(df, F.weekday(F.col(ts)), "weekday", series, value, row_key=row_key)
    names = F.element_at(F.array(*[F.lit(d) for d in (
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")]),
        F.col("weekday") + 1)
    return out.withColumn("weekday_name", names)


def daily_max(df: DataFrame, ts: str, series: str, value: str, grain: str = "hour") -> DataFrame:
    """Maximum per (time bucket, series) — the usual feed of the trend charts."""
    return (df.groupBy(F.date_trunc(grain, F.col(ts)).alias("bucket"), F.col(series))
            .agg(F.max(_num(value)).alias(value)))


# A6 ------------------------------------------------------------------------------------
def share_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Sum per group and its share of the grand total (pie / donut); null if that is 0."""
    agg = _drop_null_keys(df, [group]).groupBy(group).agg(
        F.coalesce(F.sum(_num(value)), F.lit(0.0)).alias("total"))
    grand = agg.select(F.sum("total")).scalar()
    return agg.withColumn("share", F.try_divide("total", grand))


# A7 ------------------------------------------------------------------------------------
def stacked_histogram(df: DataFrame, group: str, value: str, bins: int = 50) -> DataFrame:
    """Counts per (bin, group) over ``bins`` equal-width bins on the common range.

    The last bin is closed on the right; a single-valued range widens by ±0.5.
    """
    v = _num(value)
    base = _drop_null_keys(df.select(F.col(group), v.alias("__v")), [group]).filter(
        F.col("__v").isNotNull())
    base = _bind_stats(base, base, "__s", mn=F.min("__v"), mx=F.max("__v"))
    mn, mx = F.col("__s.mn"), F.col("__s.mx")
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    base = base.withColumns({"__lo": lo, "__w": (hi - lo) / F.lit(float(bins))})
    b = F.least(F.lit(bins - 1), F.floor((F.col("__v") - F.col("__lo")) / F.col("__w")).cast("int"))
    # the range travels through the aggregation as a constant (max of a constant), so the
    # plan keeps a single statistics subquery instead of one copy per reference
    counts = base.withColumn("bin", b).groupBy(F.col(group), "bin").agg(
        F.count(F.lit(1)).alias("n"), F.max("__lo").alias("__lo"), F.max("__w").alias("__w"))
    return counts.withColumns({"bin_lo": F.col("__lo") + F.col("bin") * F.col("__w"),
                               "bin_hi": F.col("__lo") + (F.col("bin") + 1) * F.col("__w")}) \
        .drop("__lo", "__w")


# A8 ------------------------------------------------------------------------------------
HOURS = [f"{h:02d}" for h in range(24)]


def concurrency_cells(events: DataFrame, ts: str = "ts", user: str = "user_id",
                      measure: str = "Concurrency_Peak") -> DataFrame:
    """Distinct users per (LogDate, LogHour) — the concurrency measure of the heat map."""
    return (events.groupBy(F.date_format(F.col(ts), "yyyy-MM-dd").alias("LogDate"),
                           F.hour(F.col(ts)).alias("LogHour"))
            .agg(F.countDistinct(user).alias(measure)))


def hour_heatmap(df: DataFrame, measure: str, date: str = "LogDate", hour: str = "LogHour",
                 hours: Sequence[str] = HOURS, strict: bool = False) -> DataFrame:
    """Pivot (date × hour) of ``measure``; missing cells are null.

    ``hour`` must hold zero-padded text (``pad_hour``).  The pivot values are passed
    explicitly, which saves the job that would discover them.  ``strict`` raises when a
    (date, hour) cell occurs twice (one extra aggregation job).
    """
    if strict:
        dup = df.groupBy(date, hour).count().filter(F.col("count") > 1)
        if not dup.isEmpty():
            raise ValueError("duplicate (date, hour) cells in heat-map input")
    # explicit pivot as conditional aggregation: one aggregation (one exchange) instead of
    # pivot's aggregate-then-pivot pair
    return df.groupBy(date).agg(*[F.max(F.when(F.col(hour) == h, F.col(measure))).alias(h)
                                  for h in hours])


# W2 ------------------------------------------------------------------------------------
def heat_contrast(df: DataFrame, measure: str, threshold: float | None = None,
                  out: str = "dark") -> DataFrame:
    """``dark`` when the min-max normalised cell exceeds the (normalised) threshold.  A constant
    measure has no normalised value and no dark cell."""
    v = F.col(measure).cast("double")
    bound = _bind_stats(df, df, "__s", mn=F.min(v), mx=F.max(v))
    mn, mx = F.col("__s.mn"), F.col("__s.mx")
    norm = F.try_divide(v - mn, mx - mn)
    thr = F.lit(0.5) if threshold is None else F.try_divide(F.lit(float(threshold)) - mn, mx - mn)
    dark = F.when(mn == mx, F.lit(False)).otherwise(F.col("norm") > thr)
    return bound.withColumn("norm", norm).withColumn(out, dark).drop("__s")


# A9 ------------------------------------------------------------------------------------
#: Relative rank error of the approximate quantiles that bracket the exact ones, and the group
#: size up to which a group is taken whole.
RANK_ERROR = 1 / 1000
SMALL_GROUP = 2000


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    qs: Sequence[float] = (0.25, 0.5, 0.75),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per key (= ``percentile`` / ``quantile_cont``).

    One scan brackets each quantile between two approximate ones, whose rank error is bounded.
    A second counts the values below each bracket and keeps only those inside, about half a
    percent; both combine before the shuffle, so a hot key costs no more than others.  The exact
    ranks are then found among the values kept.  A rank that a bracket should miss is looked up
    among all values instead.
    """
    keys, qs = list(keys), list(qs)
    names = list(names) if names else [f"q{int(round(q * 100))}" for q in qs]
    base = _drop_null_keys(df.select(*keys, _num(value).alias("__v")).filter(F.col("__v").isNotNull()), keys)
    ends = [min(max(q + d, 0.0), 1.0) for q in qs for d in (-3 * RANK_ERROR, 3 * RANK_ERROR)]
    stats = materialise(base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx(
        "__v", F.array(*[F.lit(e) for e in ends]), int(1 / RANK_ERROR)).alias("__e")), "brackets")
    whole = F.col("__n") <= SMALL_GROUP
    cells = F.array(*[F.struct(F.lit(i).alias("__q"),
                               F.when(~whole & (F.col("__v") < F.get("__e", 2 * i)), F.lit(-1))
                               .when(~whole & (F.col("__v") > F.get("__e", 2 * i + 1)), F.lit(1)).otherwise(F.lit(0)).alias("__side"))
                      for i in range(len(qs))])
    kept = base.join(stats, keys).select(*keys, "__v", F.explode(cells).alias("__c")).select(
        *keys, "__c.__q", "__c.__side", F.when(F.col("__c.__side") == 0, F.col("__v")).alias("__v")).filter("__side < 1")
    kept = materialise(kept.groupBy(*keys, "__q", "__side", "__v").agg(F.count(F.lit(1)).alias("__c")), "bracketed")
    below = kept.filter("__side = -1").select(*keys, "__q", F.col("__c").alias("__below"))
    cum = grouped_cumulative(kept.filter("__side = 0").drop("__side"), [*keys, "__q"], ["__v"], "__c", before="__b")
    cum = cum.join(below, [*keys, "__q"], "left").join(stats.select(*keys, "__n"), keys).withColumn(
        "__b", F.col("__b") + F.coalesce("__below", F.lit(0)))
    pos = (F.col("__n") - 1) * F.get(F.array(*[F.lit(float(q)) for q in qs]), F.col("__q"))
    covers = lambda r: (r >= F.col("__b")) & (r < F.col("__b") + F.col("__c"))
    lo, hi = F.floor(pos), F.ceil(pos)
    found = cum.filter(covers(lo) | covers(hi)).groupBy(*keys, "__n", "__q").agg(
        F.max(F.when(covers(lo), F.col("__v"))).alias("__lo"), F.max(F.when(covers(hi), F.col("__v"))).alias("__hi"),
        F.first(pos - lo).alias("__part"))
    exact = F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("__part")
    out = materialise(stats.select(*keys, F.col("__n").alias("n")).join(found.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__q") == i, exact)).alias(nm) for i, nm in enumerate(names)]), keys, "left"), "quantiles")
    missed = out.filter(" or ".join(f"`{nm}` is null" for nm in names))
    if missed.isEmpty():
        return out
    again = base.join(missed.select(*keys), keys, "left_semi").groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    return out.join(missed.select(*keys), keys, "left_anti").unionByName(
        quantiles_from_counts(again, keys, "__v", "__c", qs, names))


def quantiles_from_counts(cv: DataFrame, keys: Sequence[str], value: str, count: str,
                          qs: Sequence[float] = (0.25, 0.5, 0.75),
                          names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles from a (keys, value, count) table of distinct values."""
    keys = list(keys)
    names = list(names) if names else [f"q{int(round(q * 100))}" for q in qs]
    # written once: the numbering reads its input three times
    cum = grouped_cumulative(materialise(cv, "counts"), keys, [value], count, before="__b", total="__n")
    # A distinct value covers the 0-based ranks [b, b + c); keep only rows covering a rank
    # the interpolation needs (plain codegen'd predicates, no per-row lambdas).
    def covers(r):
        return (r >= F.col("__b")) & (r < F.col("__b") + F.col(count))

    bounds = []
    for q in qs:
        pos = (F.col("__n") - 1) * F.lit(float(q))
        bounds.append((pos, F.floor(pos), F.ceil(pos)))
    wanted = None
    for _, lo_r, hi_r in bounds:
        c = covers(lo_r) | covers(hi_r)
        wanted = c if wanted is None else wanted | c
    hit = cum.filter(wanted)
    aggs = []
    for (pos, lo_r, hi_r), nm in zip(bounds, names):
        lo_v = F.max(F.when(covers(lo_r), F.col(value)))
        hi_v = F.max(F.when(covers(hi_r), F.col(value)))
        frac = F.first(pos - lo_r)
        aggs.append((lo_v + (hi_v - lo_v) * frac).alias(nm))
    return hit.groupBy(*keys).agg(F.first("__n").alias("n"), *aggs)


def box_stats(df: DataFrame, group: str, measures: Sequence[str] | str, whis: float = 1.5) -> DataFrame:
    """Per group and measure: q1, median, q3, whisker ends and the number of outliers.

    Whiskers reach the farthest data point within ``whis``·IQR of the box, but never end
    inside it; points beyond them are outliers.  Several measures are unpivoted into one long
    frame first.

    The quartiles (one row per box) are a written table.  The whisker pass joins the scan with
    them, so its minima, maxima and counts combine before the shuffle and the table of values
    is not shuffled again.
    """
    measures = [measures] if isinstance(measures, str) else list(measures)
    long = df.select(F.col(group), F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), _num(m).alias("v")) for m in measures])).alias("__m")
    ).select(group, "__m.measure", "__m.v")
    keys = [group, "measure"]
    long = _drop_null_keys(long.filter(F.col("v").isNotNull()), keys)
    q = exact_quantiles(long, keys, "v", (0.25, 0.5, 0.75), ["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    fences = q.withColumns({"__lo": F.col("q1") - whis * iqr, "__hi": F.col("q3") + whis * iqr})
    return long.join(fences, keys, "inner").groupBy(*keys, "n", "q1", "median", "q3").agg(
        F.min(F.when(F.col("v") >= F.col("__lo"), F.col("v"))).alias("__least"),
        F.max(F.when(F.col("v") <= F.col("__hi"), F.col("v"))).alias("__most"),
        F.count(F.when((F.col("v") < F.col("__lo")) | (F.col("v") > F.col("__hi")), 1)).alias("n_outliers")
    ).select(*keys, "n", "q1", "median", "q3", F.least("q1", "__least").alias("whisker_lo"),
             F.greatest("q3", "__most").alias("whisker_hi"), "n_outliers")


#: Sums of one generated aggregate (with keys, below spark.sql.codegen.maxFields).
GRID_SUMS = 50


# A10 -----------------------------------------------------------------------------------
def violin_density(df: DataFrame, group: str, value: str, gridsize: int = 100,
                   cut: float = 2.0, prebin: int | None = None) -> DataFrame:
    """Gaussian kernel density per group on ``gridsize`` points, plus quartiles.

    Bandwidth follows Scott's rule (sample sd · n^(-1/5)); the grid spans
    min - cut·h … max + cut·h; ``width`` is the density scaled to the group's peak.  A group
    without spread (one row, or all values equal) is one point of full width at its value,
    with no density.

    The grid is a set of sums per group, so all of it combines before the shuffle; a row comes once for
    every GRID_SUMS points, as wider aggregates fall out of generated code.  The per-group statistics are written once; the join with them
    broadcasts if their bytes allow it.  ``prebin`` (optional) snaps values onto that many bins
    per group first, an approximation for very wide value sets, off by default.
    """
    base = _drop_null_keys(df.select(F.col(group), _num(value).alias("__v")), [group]).filter(
        F.col("__v").isNotNull())
    stats = base.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("__v").alias("__sd"),
        F.min("__v").alias("__min"), F.max("__v").alias("__max"))
    stats = stats.withColumn("bandwidth", F.col("__sd") * F.pow(F.col("n").cast("double"), -0.2))
    lo, hi = F.col("__min") - cut * F.col("bandwidth"), F.col("__max") + cut * F.col("bandwidth")
    stats = materialise(stats.withColumns({"__glo": lo, "__step": (hi - lo) / F.lit(float(gridsize - 1))}), "violin")
    pts = base
    if prebin:
        pw = (F.col("__max") - F.col("__min")) / F.lit(float(prebin))
        pts = (base.join(stats.select(group, "__min", "__max"), group)
               .withColumn("__v", F.when(pw > 0, F.col("__min") + (F.floor((F.col("__v") - F.col("__min")) / pw) + 0.5) * pw)
                           .otherwise(F.col("__v"))).select(group, "__v"))
    spread = stats.filter("bandwidth > 0").select(group, F.col("n").alias("__n"), "bandwidth", "__glo", "__step")
    parts = -(-gridsize // GRID_SUMS)
    size = -(-gridsize // parts)
    at = [F.col("__glo") + (F.col("__part") * size + i) * F.col("__step") for i in range(size)]
    rows = pts.join(spread, group).withColumn("__part", F.explode(F.array(*[F.lit(i) for i in range(parts)])))
    sums = rows.groupBy(group, "__part").agg(*[
        F.sum(F.exp(-0.5 * F.pow((x - F.col("__v")) / F.col("bandwidth"), 2))).alias(f"__k{i}") for i, x in enumerate(at)])
    # the parts of a group, a handful of rows, side by side
    sums = sums.groupBy(group).agg(F.slice(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(
        "__part", F.array(*[f"__k{i}" for i in range(size)]).alias("__k")))), lambda x: x["__k"])), 1, gridsize).alias("__k"))
    norm = F.col("__n") * F.col("bandwidth") * math.sqrt(2 * math.pi)
    dens = sums.join(spread, group).select(group, F.posexplode("__k").alias("grid_idx", "__d"), (
        F.array_max("__k") / norm).alias("__peak"), "__glo", "__step", norm.alias("__norm")).select(
        group, "grid_idx", (F.col("__glo") + F.col("grid_idx") * F.col("__step")).alias("grid_x"),
        (F.col("__d") / F.col("__norm")).alias("density"),
        (F.col("__d") / F.col("__norm") / F.col("__peak")).alias("width"))
    flat = stats.filter("bandwidth is null or not bandwidth > 0").select(
        group, F.lit(0).alias("grid_idx"), F.col("__min").alias("grid_x"),
        F.lit(None).cast("double").alias("density"), F.lit(1.0).alias("width"))
    quart = exact_quantiles(base, [group], "__v", (0.25, 0.5, 0.75), ["q1", "median", "q3"]).drop("n")
    return (dens.unionByName(flat).join(quart, group, "left")
            .join(stats.select(group, "n", "bandwidth"), group, "left"))


# A11 -----------------------------------------------------------------------------------
def month_pivot(df: DataFrame, category: str, value: str, month_1: str, month_2: str,
                month: str = "Month name", threshold: float = 1_000_000) -> DataFrame:
    """Mean per (category, month) for two months side by side (slope chart).

    Missing cells are 0; the frame is empty unless both months occur; rows need both
    months ≥ ``threshold``; ``color`` is green when the second is not below the first.
    """
    m1, m2 = str(month_1).upper(), str(month_2).upper()
    src = _drop_null_keys(df, [category, month])
    both = src.filter(F.col(month).isin(m1, m2))
    # With a positive threshold a category without either month (0 and 0 after filling)
    # can never pass, so the aggregation only needs the two months' rows.
    piv_src = both if threshold > 0 else src
    piv = (piv_src.groupBy(category)
           .agg(*[F.avg(F.when(F.col(month) == m, _num(value))).alias(m) for m in (m1, m2)])
           .na.fill(0, [m1, m2]))
    present = both.select(F.countDistinct(F.col(month))).scalar()
    piv = piv.filter(present == 2)
    piv = both_over_threshold(piv, m1, m2, threshold)
    return piv.withColumns({
        "color": classify_change(m1, m2),
        "ratio": F.try_divide(F.col(m2), F.col(m1)),
        "label_1": millions_label(F.col(category), F.col(m1)),
        "label_2": millions_label(F.col(category), F.col(m2)),
    })


# A12 -----------------------------------------------------------------------------------
def month_week_mean(df: DataFrame, group_col: str, group_value: str, value: str,
                    month: str = "Month name", week: str = "Week no") -> DataFrame:
    src = group_value_filter(df, group_col, group_value)
    return _drop_null_keys(src, [month, week]).groupBy(month, week).agg(F.avg(_num(value)).alias("mean"))


# U2 ------------------------------------------------------------------------------------
def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
