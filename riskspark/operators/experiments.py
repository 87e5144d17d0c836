"""A/B and shadow experiments (O-60..O-63)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.metrics import _div

# ---- fixed values --------------------------------------------------------------------
LATENCY_MAX_RATIO = 2.0   # candidate p95 latency <= 2 x prod
FPR_SLACK = 0.005         # candidate FPR <= prod FPR + 0.005
# --------------------------------------------------------------------------------------


def ab_arm_metrics(log: DataFrame, labels: DataFrame | None = None, tx_id: str = "transaction_id") -> DataFrame:
    """O-60: per arm: n, p95 latency, precision/recall/FPR of decision == 'flag' against
    labels joined by transaction (left join; missing labels stay NULL)."""
    d = log
    if labels is not None:
        d = d.drop("label").join(labels.select(tx_id, "label"), tx_id, "left")
    flag = F.lower(F.col("decision")) == "flag"
    y = F.col("label") == 1
    n = F.col("label") == 0
    g = d.groupBy(F.coalesce(F.col("arm"), F.lit("prod")).alias("arm")).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile(F.col("latency_ms").cast("double"), F.lit(0.95)).alias("p95_latency_ms"),
        F.count_if(flag & y).alias("tp"), F.count_if(flag & n).alias("fp"),
        F.count_if(~flag & y).alias("fn"), F.count_if(~flag & n).alias("tn"))
    return g.select("arm", "n", "p95_latency_ms",
                    _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    _div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                    _div(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"))


def promotion_decision(arms: DataFrame) -> DataFrame:
    """O-63: one row: promoted, reason, labels_missing. Latency within 2x prod; recall
    >= prod and FPR <= prod + 0.005; a NULL metric passes (D13); a missing arm -> no."""
    p = arms.where(F.col("arm") == "prod").select(*[F.col(c).alias(f"prod_{c}") for c in
                                                    ("n", "p95_latency_ms", "recall", "fpr")])
    c = arms.where(F.col("arm") == "cand").select(*[F.col(c).alias(f"cand_{c}") for c in
                                                    ("n", "p95_latency_ms", "recall", "fpr")])
    one = arms.sparkSession.range(1)
    j = one.join(p, how="left").join(c, how="left")  # each side has at most one row
    ok_lat = (F.col("cand_p95_latency_ms").isNull() | F.col("prod_p95_latency_ms").isNull()
              | (F.col("cand_p95_latency_ms") <= F.lit(LATENCY_MAX_RATIO) * F.col("prod_p95_latency_ms")))
    ok_lab = (F.col("prod_recall").isNull() | F.col("cand_recall").isNull()
              | ((F.col("cand_recall") >= F.col("prod_recall"))
                 & (F.col("cand_fpr").isNull() | F.col("prod_fpr").isNull()
                    | (F.col("cand_fpr") <= F.col("prod_fpr") + F.lit(FPR_SLACK)))))
    missing = F.col("prod_n").isNull() | F.col("cand_n").isNull()
    promoted = ~missing & ok_lat & ok_lab
    return j.select(
        promoted.alias("promoted"),
        F.when(missing, F.lit("Missing arms")).when(promoted, F.lit("Promoted")).otherwise(F.lit("Not promoted"))
         .alias("reason"),
        (F.col("prod_recall").isNull() | F.col("cand_recall").isNull()).alias("labels_missing"),
        ok_lat.alias("ok_latency"), ok_lab.alias("ok_labels"))


def shadow_transitions(shadow: DataFrame) -> DataFrame:
    """O-62: prod x cand decision transition counts."""
    return shadow.groupBy(F.col("prod.decision").alias("prod_decision"),
                          F.col("cand.decision").alias("cand_decision")).agg(F.count(F.lit(1)).alias("n"))


def shadow_summary(shadow: DataFrame) -> DataFrame:
    """O-62: agreement rate, mean |score delta|, p95 latency of each side."""
    return shadow.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("prod.decision") == F.col("cand.decision")).cast("double")).alias("agreement_rate"),
        F.avg(F.col("cand.proba") - F.col("prod.proba")).alias("mean_score_delta"),
        F.avg(F.abs(F.col("cand.proba") - F.col("prod.proba"))).alias("mean_abs_score_delta"),
        F.percentile(F.col("latency_ms.prod").cast("double"), F.lit(0.95)).alias("p95_latency_prod"),
        F.percentile(F.col("latency_ms.cand").cast("double"), F.lit(0.95)).alias("p95_latency_cand"))
