"""Daily / monthly roll-ups and KPI tables (O-09, O-30, O-31, O-41, O-42, O-105).

KPI tables hold one row per (day, system); windows over them are over days, whose count
is bounded by the calendar, not by the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_number(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_date(c.cast("date"))


def trailing_baseline(daily: DataFrame, value_cols: Sequence[str], date_col: str = "date", days: int = 7,
                      by: Sequence[str] = (), drift_long: DataFrame | None = None) -> DataFrame:
    """O-30: for each day, the mean of each value over days d-days..d-1 (today excluded)
    and the delta today - baseline. With a long drift table (date, feature, psi): today's
    mean / max PSI and the trailing mean over *feature-days* (not a mean of daily means)
    and trailing max."""
    w = Window.partitionBy(*by).orderBy(day_number(date_col)).rangeBetween(-days, -1)
    out = daily
    for c in value_cols:
        out = out.withColumn(f"{c}_trailing", F.avg(F.col(c)).over(w)) \
                 .withColumn(f"{c}_delta", F.col(c) - F.col(f"{c}_trailing"))
    if drift_long is not None:
        dd = drift_long.groupBy(*by, date_col).agg(F.sum("psi").alias("_ps"), F.count("psi").alias("_pn"),
                                                   F.max("psi").alias("psi_max"))
        out = out.join(dd, [*by, date_col], "left")
        out = (out.withColumn("psi_mean", F.try_divide(F.col("_ps"), F.nullif(F.col("_pn").cast("double"), F.lit(0.0))))
                  .withColumn("psi_mean_trailing", F.try_divide(F.sum("_ps").over(w),
                                                                F.nullif(F.sum("_pn").over(w).cast("double"), F.lit(0.0))))
                  .withColumn("psi_max_trailing", F.max("psi_max").over(w))
                  .withColumn("psi_mean_delta", F.col("psi_mean") - F.col("psi_mean_trailing"))
                  .drop("_ps", "_pn"))
    return out


def latest_by_date(daily: DataFrame, date_col: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """O-31: the latest row per group (``max_by`` over the date)."""
    other = [c for c in daily.columns if c not in by]
    g = daily.groupBy(*by).agg(F.max_by(F.struct(*[F.col(c) for c in other]), F.col(date_col)).alias("_r"))
    return g.select(*by, *[F.col(f"_r.`{c}`").alias(c) for c in other])


def last_n(daily: DataFrame, n: int = 30, date_col: str = "date") -> DataFrame:
    """O-31: last n rows by date (TakeOrderedAndProject)."""
    return daily.orderBy(F.col(date_col).desc()).limit(n)


def freshness_across(tables: Sequence[DataFrame], date_col: str = "date") -> DataFrame:
    """O-31: max date over several systems' KPI tables."""
    parts = [t.agg(F.max(F.col(date_col)).alias("d")) for t in tables]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.max("d").alias("freshest_date"))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str] | None, order: Sequence[str] = ()) -> DataFrame:
    """O-09: old + new with missing columns allowed; per key the **last** row wins: new over old, and
    inside a batch the last by ``order``, then by position in the frame. Without keys, exact
    duplicate rows collapse to one.

    Written as a new version of the table (no in-place MERGE here)."""
    at = lambda df, k: df.withColumns({"_batch": F.lit(k), "_at": F.monotonically_increasing_id()})
    u = at(old, 0).unionByName(at(new, 1), allowMissingColumns=True)
    if not keys:
        return u.drop("_batch", "_at").distinct()
    other = [c for c in u.columns if c not in keys and c not in ("_batch", "_at")]
    last = F.struct("_batch", *[F.col(c) for c in order], "_at")
    g = u.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in other]), last).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in other])


def month_rollup_credit(daily: DataFrame, drift_long: DataFrame | None = None, date_col: str = "date",
                        psi_alert: float = 0.25, top: int = 5) -> DataFrame:
    """O-42: per month: days with reports, mean daily PD/EL, and (with a long drift table
    (date, feature, psi)) alert days, max/mean PSI and the top drifted features by mean PSI."""
    m = F.date_format(F.col(date_col).cast("date"), "yyyy-MM")
    base = daily.groupBy(m.alias("month")).agg(
        F.count_distinct(F.col(date_col)).alias("days_with_reports"),
        F.avg("avg_PD").alias("mean_daily_PD"), F.avg("total_EL").alias("mean_daily_EL"))
    if drift_long is None:
        return base
    d = drift_long.withColumn("month", m)
    stats = d.groupBy("month").agg(
        F.count_distinct(F.when(F.col("psi") >= psi_alert, F.col(date_col))).alias("alert_days"),
        F.max("psi").alias("max_psi"), F.avg("psi").alias("avg_psi"))
    fm = d.groupBy("month", "feature").agg(F.avg("psi").alias("mean_psi"))
    w = Window.partitionBy("month").orderBy(F.col("mean_psi").desc_nulls_last(), F.col("feature"))
    topf = fm.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top) \
             .groupBy("month").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "feature"))),
                                                            lambda s: s["feature"]), ",").alias("top_features"))
    return base.join(stats, "month", "left").join(topf, "month", "left")


def defaults_vs_recoveries(snap_prev: DataFrame, snap_cur: DataFrame, id_col: str = "borrower_id",
                           flag: str = "default_flag") -> DataFrame:
    """O-105: borrower transitions between two label snapshots (new defaults, recoveries)."""
    j = snap_prev.select(id_col, F.col(flag).alias("prev")).join(
        snap_cur.select(id_col, F.col(flag).alias("cur")), id_col, "full_outer")
    return j.agg(F.count_if((F.coalesce("prev", F.lit(0)) == 0) & (F.col("cur") == 1)).alias("new_defaults"),
                 F.count_if((F.col("prev") == 1) & (F.coalesce("cur", F.lit(0)) == 0)).alias("recoveries"),
                 F.count_if(F.col("cur") == 1).alias("defaults_now"))


def delinquency_trend(loans: DataFrame, period: str = "vintage_year", delinquencies: str = "delinq_2yrs") -> DataFrame:
    """O-105: per period the share of loans with a delinquency, and its change on the period before
    (a window over the periods, not the loans)."""
    g = loans.groupBy(period).agg(F.count(F.lit(1)).alias("loans"),
                                  F.avg((F.coalesce(F.col(delinquencies), F.lit(0)) > 0).cast("double")).alias("delinquency_rate"))
    return g.withColumn("change", F.col("delinquency_rate") - F.lag("delinquency_rate").over(Window.orderBy(period)))
