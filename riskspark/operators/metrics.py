"""KPIs and model-quality statistics (O-37..O-44, O-53..O-59).

Curves (AUC, KS, average precision, PR/ROC points) first pre-aggregate to one row per
distinct score (map-side combine, so a hot score value is one row), then take global
prefix sums with :func:`score_prefix`: distinct scores are range-bucketed by approximate
quantiles (bucket edges only shape partitions, never results), each bucket is summed,
the bucket offsets come from a window over the (few) bucket rows, and a window inside each
bucket finishes the running sums. No step moves all scores into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.quantiles import same_partition

from riskspark.operators.rules import report_flagged

# ---- fixed values --------------------------------------------------------------------
FRAUD_PREVENTED_PER_CASE_USD = 200.0
TOP_RULES_DAILY = 20
TOP_RULES_MONTHLY = 30
RECALL_GRID = [round(0.05 * i, 2) for i in range(1, 20)]  # 0.05 .. 0.95, 19 cuts
TARGET_RECALL = 0.90
PROFILE_TOP_VALUES = 8
# --------------------------------------------------------------------------------------


def _div(a: Column, b: Column) -> Column:
    """a / b with a zero (or NULL) denominator -> NULL."""
    return F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0)))


def fraud_kpis(log: DataFrame, by: Sequence[str] = ("date",), per_case_usd: float = FRAUD_PREVENTED_PER_CASE_USD) -> DataFrame:
    """O-37 (+ O-59 counts): total, flagged (report definition, D3), flagged_pct,
    p50/p95 latency, precision/recall/FPR of the flag vs label, fraud prevented $.

    Percentiles are exact (``percentile``, linear interpolation) with an entry for each distinct
    latency of a group; for latencies that are no whole milliseconds over very many rows use
    :mod:`riskspark.operators.sketches`.
    """
    fl = report_flagged(F.col("decision"), F.col("rules_count"))
    has_label = F.max(F.col("label").isNotNull().cast("int")) == 1
    y = F.coalesce(F.col("label"), F.lit(0)) == 1
    pct = F.percentile(F.col("latency_ms").cast("double"), F.array(F.lit(0.5), F.lit(0.95)))
    g = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.count_if(fl).alias("flagged"),
        pct.alias("_lat"),
        F.count_if(fl & y).alias("tp"), F.count_if(fl & ~y).alias("fp"),
        F.count_if(~fl & y).alias("fn"), F.count_if(~fl & ~y).alias("tn"),
        has_label.alias("_has_label"))
    return g.select(
        *by, "total_txns", "flagged",
        _div(F.col("flagged"), F.col("total_txns")).alias("flagged_pct"),
        F.col("_lat")[0].alias("p50_latency_ms"), F.col("_lat")[1].alias("p95_latency_ms"),
        F.when(F.col("_has_label"), _div(F.col("tp"), F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("_has_label"), _div(F.col("tp"), F.col("tp") + F.col("fn"))).alias("recall"),
        F.when(F.col("_has_label"), _div(F.col("fp"), F.col("fp") + F.col("tn"))).alias("fpr"),
        (F.when(F.col("_has_label"), F.col("tp")).otherwise(F.col("flagged")) * F.lit(per_case_usd))
        .alias("fraud_prevented_usd"))


def monitor_kpis(log: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """O-38: requests, flag rate (decision == 'flag', D3), review rate, mean proba,
    p95 latency (empty -> 0)."""
    dec = F.lower(F.col("decision").cast("string"))
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg((dec == "flag").cast("double")).alias("flag_rate"),
        F.avg((dec == "review").cast("double")).alias("review_rate"),
        F.coalesce(F.avg(F.col("proba").cast("double")), F.lit(0.0)).alias("mean_proba"),
        F.coalesce(F.percentile(F.col("latency_ms").cast("double"), F.lit(0.95)), F.lit(0.0)).alias("p95_latency_ms"))


def arm_kpis(log: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """O-39: per arm (NULL -> 'unknown'): volume, flagged, flagged_pct."""
    fl = report_flagged(F.col("decision"), F.col("rules_count"))
    g = log.groupBy(*by, F.coalesce(F.col("arm"), F.lit("unknown")).alias("arm")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(fl).alias("flagged"))
    return g.withColumn("flagged_pct", _div(F.col("flagged"), F.col("n")))


def top_rules(log: DataFrame, by: Sequence[str] = ("date",), k: int = TOP_RULES_DAILY) -> DataFrame:
    """O-40: rule hit counts from the hit arrays, top k per group (ties by rule name)."""
    e = log.select(*by, F.explode(F.col("rules_hit")).alias("rule"))
    c = e.groupBy(*by, "rule").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*by).orderBy(F.col("count").desc(), F.col("rule"))
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def weighted_mean(value: str, weight: str) -> Column:
    """O-41: sum(v*w) / sum(w over non-NULL v); zero weight -> NULL."""
    v = F.col(value).cast("double")
    w = F.col(weight).cast("double")
    return F.try_divide(F.sum(v * w), F.nullif(F.sum(F.when(v.isNotNull(), w)), F.lit(0.0)))


def month_rollup_fraud(daily: DataFrame, date_col: str = "date") -> DataFrame:
    """O-41: per month: summed counts, volume-weighted p50/p95/precision/recall/FPR,
    days covered."""
    m = F.date_format(F.col(date_col).cast("date"), "yyyy-MM").alias("month")
    return daily.groupBy(m).agg(
        F.count_distinct(F.col(date_col)).alias("days_covered"),
        F.sum("total_txns").alias("total_txns"), F.sum("flagged").alias("flagged"),
        *[weighted_mean(c, "total_txns").alias(c) for c in
          ("p50_latency_ms", "p95_latency_ms", "precision", "recall", "fpr")],
        F.sum("fraud_prevented_usd").alias("fraud_prevented_usd"))


def month_rollup_arms(daily: DataFrame, date_col: str = "date") -> DataFrame:
    """O-41: the daily arm table (O-39) summed again per month and arm."""
    m = F.date_format(F.col(date_col).cast("date"), "yyyy-MM").alias("month")
    g = daily.groupBy(m, "arm").agg(F.sum("n").alias("n"), F.sum("flagged").alias("flagged"))
    return g.withColumn("flagged_pct", _div(F.col("flagged"), F.col("n")))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """O-44: class counts, and positive weight neg/pos (>= 1) on every row."""
    c = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    pos = F.sum(F.when(F.col("label") == 1, F.col("n"))).over(w)
    neg = F.sum(F.when(F.col("label") == 0, F.col("n"))).over(w)
    return c.withColumn("pos_weight", F.greatest(F.lit(1.0), F.coalesce(_div(neg, pos), F.lit(1.0))))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, k: int = PROFILE_TOP_VALUES) -> DataFrame:
    """O-43: top-k values per string column with counts, with the column's type and the table's
    row count (one unpivot + one aggregate)."""
    from pyspark.sql.types import StringType

    cols = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)])
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("_p")).select("_p.*")
    c = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    # two-stage top-k: first inside hash slices of each column's values, then over the
    # at most slices x k survivors, so a high-cardinality column never sorts in one task
    order = [F.col("count").desc(), F.col("value").asc_nulls_first()]
    slices = max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "16")))
    c = c.withColumn("_s", F.pmod(F.hash("value"), F.lit(slices)))
    c = c.withColumn("_r", F.row_number().over(Window.partitionBy("column", "_s").orderBy(*order))) \
         .where(F.col("_r") <= k).drop("_s", "_r")
    w = Window.partitionBy("column").orderBy(*order)
    top = c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    types = F.create_map(*[x for f in df.schema.fields if f.name in cols for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    rows = df.agg(F.count(F.lit(1)).alias("row_count"))
    return top.withColumn("dtype", types[F.col("column")]).join(F.broadcast(rows))  # one row


# ---- score curves -----------------------------------------------------------------------

def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score: pos, neg (labels: 1 positive, anything else negative)."""
    y = F.coalesce(F.col(label).cast("int"), F.lit(0)) == 1
    return (df.where(F.col(score).isNotNull())
              .groupBy(F.col(score).cast("double").alias("score"))
              .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def score_prefix(counts: DataFrame, descending: bool = True, buckets: int | None = None) -> DataFrame:
    """Adds inclusive running ``cpos``/``cneg`` over distinct scores (descending by
    default) and the totals ``P``/``N``, without a single-partition window over scores: they
    are range-partitioned (``buckets``, by default the session's shuffle partitions) in one exchange
    that is read twice, for the totals of the partitions and for the running sums in each."""
    n = buckets or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions", "16"))
    order = F.col("score").desc() if descending else F.col("score").asc()
    d = counts.select("score", "pos", "neg").repartitionByRange(n, order).withColumn("_bk", F.spark_partition_id())
    tot = d.groupBy("_bk").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    before, whole = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()  # n rows
    tot = tot.select(F.col("_bk").alias("_b"), F.coalesce(F.sum("_bp").over(before), F.lit(0)).alias("_op"),
                     F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_on"), (F.col("_bp") + F.col("_bn")).alias("_all"),
                     F.sum("_bp").over(whole).alias("P"), F.sum("_bn").over(whole).alias("N"))
    d = d.join(F.broadcast(tot), F.col("_bk") == F.col("_b"))  # one row for each partition
    part = Window.partitionBy("_bk")
    wi = part.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    here = F.sum(F.col("pos") + F.col("neg")).over(part)
    return d.select("score", "pos", "neg", "P", "N",
                    same_partition(F.col("_op") + F.sum("pos").over(wi), here, F.col("_all")).alias("cpos"),
                    (F.col("_on") + F.sum("neg").over(wi)).alias("cneg"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """O-53: ROC-AUC with tied scores counted 1/2, and Gini = 2*AUC - 1."""
    p = score_prefix(score_counts(df, score, label), descending=False)
    # ascending: negatives strictly below = cneg - neg
    part = F.col("pos") * ((F.col("cneg") - F.col("neg")) + F.lit(0.5) * F.col("neg"))
    a = p.agg(F.sum(part).alias("_s"), F.max("P").alias("P"), F.max("N").alias("N"))
    auc = _div(F.col("_s"), F.col("P") * F.col("N"))
    return a.select(auc.alias("auc"), (F.lit(2.0) * auc - F.lit(1.0)).alias("gini"))


def ks_stat(df: DataFrame, score: str, label: str) -> DataFrame:
    """O-54: KS = max(TPR - FPR) over thresholds at the distinct scores (>= 0)."""
    p = score_prefix(score_counts(df, score, label), descending=True)
    d = _div(F.col("cpos"), F.col("P")) - _div(F.col("cneg"), F.col("N"))
    return p.agg(F.greatest(F.max(d), F.lit(0.0)).alias("ks"))


def brier(df: DataFrame, score: str, label: str) -> DataFrame:
    """O-55: mean squared error of the probability."""
    y = F.coalesce(F.col(label).cast("double"), F.lit(0.0))
    return df.agg(F.avg(F.pow(F.col(score).cast("double") - y, 2)).alias("brier"))


def pr_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """O-56: precision/recall/TPR/FPR at every distinct-score threshold (score >= t)."""
    p = score_prefix(score_counts(df, score, label), descending=True)
    return p.select(F.col("score").alias("threshold"),
                    _div(F.col("cpos"), F.col("cpos") + F.col("cneg")).alias("precision"),
                    _div(F.col("cpos"), F.col("P")).alias("recall"),
                    _div(F.col("cneg"), F.col("N")).alias("fpr"), "cpos", "cneg", "pos", "P")


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """O-56: AP = sum over thresholds of (R_n - R_{n-1}) * P_n (step, not trapezoid)."""
    p = pr_points(df, score, label)
    return p.agg(F.sum(_div(F.col("pos"), F.col("P")) * F.col("precision")).alias("average_precision"))


def threshold_recall_grid(df: DataFrame, score: str, label: str, cuts: Sequence[float] = RECALL_GRID,
                          target_recall: float = TARGET_RECALL) -> DataFrame:
    """O-57: over the cut grid, the best precision with recall >= target (first cut wins
    ties); else the first cut with the best F1. One aggregate over the data."""
    y = F.coalesce(F.col(label).cast("int"), F.lit(0)) == 1
    s = F.col(score).cast("double")
    aggs = []
    for i, t in enumerate(cuts):
        pr = s >= F.lit(float(t))
        aggs += [F.count_if(pr & y).alias(f"tp{i}"), F.count_if(pr & ~y).alias(f"fp{i}"),
                 F.count_if(~pr & y).alias(f"fn{i}")]
    a = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(t)).alias("t"),
                              F.coalesce(_div(F.col(f"tp{i}"), F.col(f"tp{i}") + F.col(f"fp{i}")), F.lit(0.0)).alias("p"),
                              F.coalesce(_div(F.col(f"tp{i}"), F.col(f"tp{i}") + F.col(f"fn{i}")), F.lit(0.0)).alias("r"))
                     for i, t in enumerate(cuts)])
    g = a.select(F.explode(rows).alias("c")).select("c.*")
    g = g.withColumn("f1", F.when(F.col("p") + F.col("r") == 0, F.lit(0.0))
                     .otherwise(F.lit(2.0) * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))))
    ok = F.col("r") >= F.lit(float(target_recall))
    best = g.agg(F.min_by(F.col("t"), F.when(ok, F.struct(-F.col("p"), F.col("i")))).alias("t_rec"),
                 F.min_by(F.col("t"), F.struct(-F.col("f1"), F.col("i"))).alias("t_f1"))
    return best.select(
        F.coalesce(F.col("t_rec"), F.col("t_f1"), F.lit(0.5)).alias("threshold"),
        F.when(F.col("t_rec").isNotNull(), F.lit("recall_target")).when(F.col("t_f1").isNotNull(), F.lit("best_f1"))
         .otherwise(F.lit("default")).alias("rule"))


def threshold_pr_f1(df: DataFrame, score: str, label: str, target_recall: float = TARGET_RECALL) -> DataFrame:
    """O-58: on the PR curve (thresholds from the highest full-recall one up), the lowest
    threshold with max F1 (F1 denominator + 1e-9) among recall >= target; else max F1."""
    p = pr_points(df, score, label)
    full = p.where(F.col("cpos") == F.col("P")).agg(F.max("threshold").alias("_tmin"))
    c = p.crossJoin(full).where(F.col("threshold") >= F.col("_tmin"))
    f1 = F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-9))
    c = c.withColumn("f1", f1).withColumn("_ok", F.col("recall") >= F.lit(float(target_recall)))
    pick = c.agg(F.max_by(F.struct("threshold", "f1", "precision", "recall"),
                          F.struct(F.col("_ok"), F.col("f1"), -F.col("threshold"))).alias("b"))
    return pick.select(F.col("b.threshold").alias("threshold"), F.col("b.f1").alias("f1"),
                       F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"))


def confusion(df: DataFrame, pred: Column, label: str, by: Sequence[str] = ()) -> DataFrame:
    """O-59: tp/fp/fn/tn and precision/recall of a boolean prediction."""
    y = F.coalesce(F.col(label).cast("int"), F.lit(0)) == 1
    pr = F.coalesce(pred, F.lit(False))
    g = df.groupBy(*by).agg(F.count_if(pr & y).alias("tp"), F.count_if(pr & ~y).alias("fp"),
                            F.count_if(~pr & y).alias("fn"), F.count_if(~pr & ~y).alias("tn"))
    return g.withColumn("precision", _div(F.col("tp"), F.col("tp") + F.col("fp"))) \
            .withColumn("recall", _div(F.col("tp"), F.col("tp") + F.col("fn")))
