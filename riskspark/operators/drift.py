"""Drift, calibration and alerting (O-45..O-52, O-101, O-103).

PSI for many features runs as one plan: unpivot both samples to (feature, sample,
value), compute every feature's reference deciles in one grouped ``percentile``,
broadcast the per-feature edge arrays (one small row per feature), bin by counting edges,
and count with conditional aggregates. No per-feature job, no driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.quantiles import exact_quantiles

# ---- fixed values --------------------------------------------------------------------
PSI_BUCKETS = 10
PSI_EPS = 1e-6
PSI_ALERT = 0.25
PSI_RETRAIN = 0.2
LATENCY_FLOOR_MS = 250.0
LATENCY_FACTOR = 1.5
FLAG_RATE_BAND = (0.5, 1.5)
SEVERITY_LEVELS = {"info": 10, "warn": 20, "error": 30}
# --------------------------------------------------------------------------------------


def _fractions(buckets: int) -> list[float]:
    # i * (1 / buckets) as doubles, like an evenly spaced grid (0.30000000000000004 ...)
    step = 1.0 / buckets
    return [i * step for i in range(buckets + 1)]


def tag_samples(ref: DataFrame, cur: DataFrame, sample_col: str = "sample") -> DataFrame:
    """One frame with a ``sample`` column ('ref' / 'cur')."""
    return ref.withColumn(sample_col, F.lit("ref")).unionByName(cur.withColumn(sample_col, F.lit("cur")),
                                                                allowMissingColumns=True)


def unpivot_samples(df: DataFrame, features: Sequence[str], sample_col: str = "sample",
                    as_string: bool = False) -> DataFrame:
    """(feature, sample, value) long form of a sample-tagged frame; NULLs (and NaN) dropped."""
    vt = "string" if as_string else "double"
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast(vt).alias("value")) for f in features])
    u = df.select(F.col(sample_col).alias("sample"), F.explode(arr).alias("_p")) \
          .select("_p.feature", "sample", "_p.value")
    if not as_string:
        u = u.where(~F.isnan("value"))
    return u.where(F.col("value").isNotNull())


def psi_numeric(ref: DataFrame, cur: DataFrame, features: Sequence[str], buckets: int = PSI_BUCKETS,
                eps: float = PSI_EPS, out_of_range: str = "drop") -> DataFrame:
    """O-45 for two frames; see :func:`psi_numeric_tagged`."""
    return psi_numeric_tagged(tag_samples(ref, cur), features, "sample", buckets, eps, out_of_range)


def psi_numeric_tagged(df: DataFrame, features: Sequence[str], sample_col: str = "sample",
                       buckets: int = PSI_BUCKETS, eps: float = PSI_EPS, out_of_range: str = "drop") -> DataFrame:
    """O-45: (feature, psi). Edges = distinct linear-interpolated quantiles of ref at
    i/buckets; bins [e_i, e_i+1) with the last closed; values outside the edges are
    dropped (D11; ``out_of_range='clip'`` puts them in the end bins instead).
    Fewer than 2 edges or an empty sample -> NULL.

    The long form is read twice: once for the edges (grouped exact percentile over ref),
    once for the binned conditional counts (edges broadcast: one row per feature)."""
    long = unpivot_samples(df, features, sample_col)
    fr = _fractions(buckets)
    edges = exact_quantiles(long.where(F.col("sample") == "ref"), "value", fr, by=["feature"], out="q") \
        .select("feature", F.array_sort(F.array_distinct("q")).alias("edges"))
    nb = F.size("edges") - 1
    d = long.join(F.broadcast(edges), "feature", "left")
    idx = F.size(F.filter(F.col("edges"), lambda e: e <= F.col("value")))
    lo, hi = F.element_at("edges", 1), F.element_at("edges", -1)
    if out_of_range == "clip":
        binc = F.least(F.greatest(idx, F.lit(1)), nb)
    else:
        binc = F.when((F.col("value") >= lo) & (F.col("value") <= hi), F.least(idx, nb))
    d = d.select("feature", "sample", nb.alias("nb"), F.when(nb >= 1, binc).alias("bin"))
    # bin NULL = out of range (or < 2 edges): counted for sample presence only
    counts = d.groupBy("feature", "nb", "bin").agg(F.count_if(F.col("sample") == "ref").alias("r"),
                                                   F.count_if(F.col("sample") == "cur").alias("c"))
    # a feature's bins are few, so they meet in one row: empty ones are filled in there, without another pass for edges or totals
    known = F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", F.struct("r", "c"))))
    g = counts.groupBy("feature").agg(F.max("nb").alias("nb"), F.sum("r").alias("nr"), F.sum("c").alias("nc"), F.map_from_entries(known).alias("m"))
    none = F.struct(F.lit(0).cast("bigint").alias("r"), F.lit(0).cast("bigint").alias("c"))
    bins = F.when(F.col("nb") >= 1, F.transform(F.sequence(F.lit(1), "nb"), lambda b: F.coalesce(F.try_element_at("m", b), none)))
    total = lambda f: F.aggregate("bins", F.lit(0).cast("bigint"), lambda acc, x: acc + x[f])
    g = g.withColumn("bins", bins).select("feature", "nb", "nr", "nc", "bins", total("r").alias("rt"), total("c").alias("ct"))

    def share(x: Column, f: str) -> Column:
        return (x[f] + F.lit(eps)) / (F.col(f"{f}t") + F.lit(eps) * F.col("nb"))

    psi = F.aggregate("bins", F.lit(0.0), lambda acc, x: acc + (share(x, "c") - share(x, "r")) * F.log(share(x, "c") / share(x, "r")))
    ok = (F.col("nr") > 0) & (F.col("nc") > 0) & (F.col("rt") > 0)
    return g.select("feature", F.when(ok, psi).alias("psi"))


def psi_categorical(ref: DataFrame, cur: DataFrame, features: Sequence[str], eps: float = PSI_EPS) -> DataFrame:
    """O-46 for two frames; see :func:`psi_categorical_tagged`."""
    return psi_categorical_tagged(tag_samples(ref, cur), features, "sample", eps)


def psi_categorical_tagged(df: DataFrame, features: Sequence[str], sample_col: str = "sample",
                           eps: float = PSI_EPS) -> DataFrame:
    """O-46: (feature, psi) over the union of categories (values compared as text)."""
    long = unpivot_samples(df, features, sample_col, as_string=True)
    counts = long.groupBy("feature", F.col("value").alias("bin")).agg(
        F.count_if(F.col("sample") == "ref").alias("r"), F.count_if(F.col("sample") == "cur").alias("c"))
    present = counts.groupBy("feature").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    return _psi_from_counts(counts, eps, present)


def _psi_from_counts(full: DataFrame, eps: float, present: DataFrame) -> DataFrame:
    """PSI from (feature, bin, r, c) counts: per-feature totals are an aggregate joined
    back (one row per feature, broadcast), so many bins/categories never meet in one task."""
    tot = full.groupBy("feature").agg(F.sum("r").alias("_rt"), F.sum("c").alias("_ct"), F.count(F.lit(1)).alias("_nb"))
    t = full.join(F.broadcast(tot), "feature", "inner")
    rp = (F.col("r") + F.lit(eps)) / (F.col("_rt") + F.lit(eps) * F.col("_nb"))
    cp = (F.col("c") + F.lit(eps)) / (F.col("_ct") + F.lit(eps) * F.col("_nb"))
    t = t.select("feature", rp.alias("rp"), cp.alias("cp"))
    psi = t.groupBy("feature").agg(F.sum((F.col("cp") - F.col("rp")) * F.log(F.col("cp") / F.col("rp"))).alias("psi"))
    out = present.join(F.broadcast(tot.select("feature", "_rt")), "feature", "left").join(psi, "feature", "left")
    ok = (F.col("nr") > 0) & (F.col("nc") > 0) & (F.col("_rt") > 0)
    return out.select("feature", F.when(ok, F.col("psi")).alias("psi"))


def drift_table(ref: DataFrame, cur: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                buckets: int = PSI_BUCKETS) -> DataFrame:
    """O-48 for two frames; see :func:`drift_table_tagged`."""
    return drift_table_tagged(tag_samples(ref, cur), numeric, categorical, "sample", buckets)


def drift_table_tagged(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                       sample_col: str = "sample", buckets: int = PSI_BUCKETS) -> DataFrame:
    """O-48: numeric + categorical PSI, one table (feature, type, psi), largest PSI first (NULL last,
    then by name); a table without any feature is one row that says so."""
    parts = []
    if numeric:
        parts.append(psi_numeric_tagged(df, numeric, sample_col, buckets).withColumn("type", F.lit("numeric")))
    if categorical:
        parts.append(psi_categorical_tagged(df, categorical, sample_col).withColumn("type", F.lit("categorical")))
    if not parts:
        none = df.sparkSession.createDataFrame([("(no features)", "none", None)], "feature string, type string, psi double")
        return none
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("feature", "type", "psi").orderBy(F.col("psi").desc_nulls_last(), "feature", "type")


def calibration_bins(df: DataFrame, pd_col: str, label: str, q: int = 10) -> DataFrame:
    """O-47: quantile bins of the score (duplicate edges dropped, right-closed, lowest
    value in bin 1); mean score vs observed rate per bin. NULL rows dropped."""
    d = df.where(F.col(pd_col).isNotNull() & F.col(label).isNotNull())
    fr = _fractions(q)
    edges = exact_quantiles(d, pd_col, fr, out="q").select(F.array_sort(F.array_distinct("q")).alias("e"))
    inner = F.slice(F.col("e"), 2, F.greatest(F.size("e") - 2, F.lit(0)))
    binc = F.lit(1) + F.size(F.filter(inner, lambda x: x < F.col(pd_col).cast("double")))
    d = d.crossJoin(F.broadcast(edges)).withColumn("bin", binc)  # edges: one row
    return d.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(pd_col).cast("double")).alias("mean_pd"),
                                F.avg((F.col(label).cast("int") == 1).cast("double")).alias("rate_observed"))


def calibration_slope(bins: DataFrame) -> DataFrame:
    """O-101: slope of observed rate on mean PD over the calibration bins; alert < 0.9."""
    return bins.agg(F.regr_slope("rate_observed", "mean_pd").alias("slope")) \
               .withColumn("alert", F.col("slope") < F.lit(0.9))


def feature_guard(df: DataFrame, features: Sequence[str], sample_col: str = "sample", min_count: int = 3) -> DataFrame:
    """O-49: keep a feature when both samples have >= min_count non-NULL values and the
    pooled standard deviation is > 0 (sample-tagged input)."""
    long = unpivot_samples(df, features, sample_col)
    g = long.groupBy("feature").agg(F.count_if(F.col("sample") == "ref").alias("n_ref"),
                                    F.count_if(F.col("sample") == "cur").alias("n_cur"),
                                    F.stddev_samp("value").alias("pooled_std"))
    keep = (F.col("n_ref") >= min_count) & (F.col("n_cur") >= min_count) & (F.coalesce(F.col("pooled_std"), F.lit(0.0)) > 0)
    all_f = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return all_f.join(g, "feature", "left").fillna(0, ["n_ref", "n_cur"]).withColumn("keep", F.coalesce(keep, F.lit(False)))


def coverage_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """O-50: per expected column: present?, non-NULL rate (one aggregate)."""
    present = [c for c in expected if c in df.columns]
    n = F.count(F.lit(1))
    row = df.agg(n.alias("_n"), *[F.count(F.col(c)).alias(c) for c in present])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(c in present).alias("present"),
                             (F.try_divide(F.col(c).cast("double"), F.nullif(F.col("_n").cast("double"), F.lit(0.0)))
                              if c in present else F.lit(None).cast("double")).alias("non_null_rate"))
                    for c in expected])
    return row.select(F.explode(arr).alias("r")).select("r.*")


def drift_alerts(drift: DataFrame, kpis: DataFrame | None = None, ref_kpis: DataFrame | None = None,
                 threshold: float = PSI_ALERT, top: int = 5) -> DataFrame:
    """O-51: alert rows (kind, severity, subject, value, limit).

    PSI >= threshold (top offenders); p95 latency > max(250, 1.5 x reference); flag rate
    outside [0.5x, 1.5x] of a positive reference rate. ``kpis``/``ref_kpis`` are one-row
    monitor KPI frames (O-38)."""
    w = Window.orderBy(F.col("psi").desc_nulls_last(), F.col("feature"))
    psi = (drift.where(F.col("psi") >= F.lit(threshold))
           .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top)
           .select(F.lit("psi").alias("kind"), F.lit("warn").alias("severity"), F.col("feature").alias("subject"),
                   F.col("psi").alias("value"), F.lit(threshold).alias("limit")))
    if kpis is None or ref_kpis is None:
        return psi
    k = kpis.select(F.col("p95_latency_ms").alias("p95"), F.col("flag_rate").alias("fr")) \
            .crossJoin(ref_kpis.select(F.col("p95_latency_ms").alias("rp95"), F.col("flag_rate").alias("rfr")))
    lat_lim = F.greatest(F.lit(LATENCY_FLOOR_MS), F.lit(LATENCY_FACTOR) * F.col("rp95"))
    lat = k.where(F.col("p95") > lat_lim).select(
        F.lit("latency").alias("kind"), F.lit("warn").alias("severity"), F.lit("p95_latency_ms").alias("subject"),
        F.col("p95").alias("value"), lat_lim.alias("limit"))
    lo, hi = FLAG_RATE_BAND
    fr = k.where((F.col("rfr") > 0) & ((F.col("fr") < F.lit(lo) * F.col("rfr")) | (F.col("fr") > F.lit(hi) * F.col("rfr")))) \
          .select(F.lit("flag_rate").alias("kind"), F.lit("warn").alias("severity"), F.lit("flag_rate").alias("subject"),
                  F.col("fr").alias("value"), F.col("rfr").alias("limit"))
    return psi.unionByName(lat).unionByName(fr)


def meets_threshold(severity: Column, minimum: str) -> Column:
    """O-52: severity rank (info < warn < error) at or above ``minimum``."""
    ranks = F.create_map(*[x for k, v in SEVERITY_LEVELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(ranks[F.lower(severity)], F.lit(0)) >= F.lit(SEVERITY_LEVELS[minimum])


def retrain_triggers(drift: DataFrame, kpis: DataFrame, psi_limit: float = PSI_RETRAIN,
                     precision_floor: float = 0.85) -> DataFrame:
    """O-103: retrain when any PSI > 0.2 or precision < 0.85."""
    d = drift.agg(F.max("psi").alias("max_psi"))
    k = kpis.agg(F.min("precision").alias("min_precision"))
    return d.crossJoin(k).withColumn(
        "retrain", F.coalesce(F.col("max_psi") > psi_limit, F.lit(False))
        | F.coalesce(F.col("min_precision") < precision_floor, F.lit(False)))


def psi_numeric_by_period(ref: DataFrame, cur: DataFrame, features: Sequence[str], period: str,
                          buckets: int = PSI_BUCKETS, eps: float = PSI_EPS) -> DataFrame:
    """O-45 per period (a daily drift table): one reference sample, one current sample per
    ``period`` value -> (period, feature, psi). Reference edges and counts are computed
    once; current counts are one grouped aggregate; totals are aggregates joined back."""
    lr = unpivot_samples(ref.withColumn("sample", F.lit("ref")), features)
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    lc = cur.select(F.col(period).alias("period"), F.explode(arr).alias("_p")) \
            .select("period", "_p.feature", "_p.value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    fr = _fractions(buckets)
    edges = exact_quantiles(lr, "value", fr, by=["feature"], out="q") \
        .select("feature", F.array_sort(F.array_distinct("q")).alias("edges"))
    nb = F.size("edges") - 1
    idx = F.size(F.filter(F.col("edges"), lambda e: e <= F.col("value")))
    binc = F.when((nb >= 1) & (F.col("value") >= F.element_at("edges", 1)) & (F.col("value") <= F.element_at("edges", -1)),
                  F.least(idx, nb))
    e_b = F.broadcast(edges)  # one row per feature
    rc = lr.join(e_b, "feature", "left").withColumn("bin", binc) \
           .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("r"))
    cc = lc.join(e_b, "feature", "left").withColumn("bin", binc) \
           .groupBy("period", "feature", "bin").agg(F.count(F.lit(1)).alias("c"))
    nr = rc.groupBy("feature").agg(F.sum("r").alias("nr"))
    nc = cc.groupBy("period", "feature").agg(F.sum("c").alias("nc"))
    grid = nc.select("period", "feature").join(e_b.where(F.size("edges") >= 2), "feature", "inner") \
             .select("period", "feature", F.explode(F.sequence(F.lit(1), nb)).alias("bin"))
    full = (grid.join(rc.where(F.col("bin").isNotNull()), ["feature", "bin"], "left")
                .join(cc.where(F.col("bin").isNotNull()), ["period", "feature", "bin"], "left")
                .fillna(0, ["r", "c"]))
    rt = full.groupBy("period", "feature").agg(F.sum("r").alias("_rt"), F.sum("c").alias("_ct"),
                                               F.count(F.lit(1)).alias("_nb"))
    t = full.join(rt, ["period", "feature"], "inner")
    rp = (F.col("r") + F.lit(eps)) / (F.col("_rt") + F.lit(eps) * F.col("_nb"))
    cp = (F.col("c") + F.lit(eps)) / (F.col("_ct") + F.lit(eps) * F.col("_nb"))
    psi = t.groupBy("period", "feature").agg(F.sum((cp - rp) * F.log(cp / rp)).alias("psi"), F.max("_rt").alias("_rt"))
    out = nc.join(F.broadcast(nr), "feature", "left").join(psi, ["period", "feature"], "left")
    ok = (F.coalesce(F.col("nr"), F.lit(0)) > 0) & (F.col("nc") > 0) & (F.col("_rt") > 0)
    return out.select(F.col("period"), "feature", F.when(ok, F.col("psi")).alias("psi"))
