"""Credit queries: loans -> borrower features -> PD -> EL -> segment / portfolio tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators import credit as CR
from riskspark.plans.common import final
from riskspark.sources import tables as T

CARRY = ["loan_amount", "grade", "state", "vintage_year"]


def scored_borrowers(spark: SparkSession, sf: str) -> DataFrame:
    """Borrower features with the first loan's EAD/segments (one aggregate), PD and EL."""
    feats = CR.borrower_features(T.loans(spark, sf), "borrower_id", carry=CARRY, carry_order="loan_id")
    return CR.expected_loss(CR.score_pd(feats), ead_col="loan_amount")


def segment_el_rollup(spark: SparkSession, sf: str) -> DataFrame:
    out = CR.segment_rollup(scored_borrowers(spark, sf))
    return final(out, ratios=["avg_PD"], money=["total_EAD", "total_EL"], longs=["borrowers"])


def portfolio_summary(spark: SparkSession, sf: str) -> DataFrame:
    return final(CR.portfolio_summary(scored_borrowers(spark, sf)), ratios=["avg_PD"], money=["total_EL"],
                 longs=["n"])


def borrower_features(spark: SparkSession, sf: str) -> DataFrame:
    out = CR.borrower_features(T.loans(spark, sf))
    return final(out, ratios=["income_to_loan_ratio", "credit_utilization_pct", "num_past_delinquencies"],
                 longs=["n_records"])


def default_labels(spark: SparkSession, sf: str) -> DataFrame:
    return CR.default_labels(T.loans(spark, sf), "borrower_id", label_column="loan_status", label_kind="status",
                             bad_words=["Charged Off", "Default", "Write Off", "Written Off"])


def credit_decisions(spark: SparkSession, sf: str) -> DataFrame:
    s = CR.credit_decision(scored_borrowers(spark, sf))
    return final(s.select("borrower_id", "PD", "EAD", "EL", "decision"), ratios=["PD"], money=["EAD", "EL"])


def pd_histogram(spark: SparkSession, sf: str) -> DataFrame:
    out = CR.pd_histogram(scored_borrowers(spark, sf), by=["grade"])
    return final(out, money=["exposure"], longs=["n"])


def stress_el(spark: SparkSession, sf: str) -> DataFrame:
    scen = spark.createDataFrame([("base", 1.0, 1.0), ("adverse", 1.5, 1.2), ("severe", 2.0, 1.5)],
                                 "scenario string, pd_mult double, lgd_mult double")
    s = CR.stress_el(scored_borrowers(spark, sf), scen)
    out = s.groupBy("scenario").agg(F.sum("EL_stressed").alias("total_EL"), F.count(F.lit(1)).alias("n"))
    return final(out, money=["total_EL"], longs=["n"])


def woe_iv_ratio(spark: SparkSession, sf: str) -> DataFrame:
    labels = default_labels(spark, sf)
    feats = CR.borrower_features(T.loans(spark, sf))
    d = feats.join(labels, "borrower_id", "inner")
    out = CR.woe_iv(d, "income_to_loan_ratio", "default_flag").select("bin", "bad", "good", "woe", "iv")
    return final(out, ratios=["woe", "iv"], longs=["bad", "good"])


def reason_codes(spark: SparkSession, sf: str) -> DataFrame:
    """O-73: top-2 scorecard contributions per borrower."""
    feats = CR.borrower_features(T.loans(spark, sf))
    out = CR.reason_codes(feats, k=2)
    return out.select("borrower_id", F.array_join("top_features", ",").alias("top_features"))


def loan_keep_first_join(spark: SparkSession, sf: str) -> DataFrame:
    """O-74 generic form: borrower features LEFT JOIN loans deduplicated keep-first."""
    loans = T.loans(spark, sf)
    feats = CR.borrower_features(loans)
    attrs = loans.select("borrower_id", "loan_id", "loan_amount", "grade", "state", "vintage_year")
    j = CR.left_join_keep_first(feats, attrs, "borrower_id", ["loan_id"])
    return final(j.select("borrower_id", "loan_id", "loan_amount", "grade", "state", "vintage_year", "n_records"),
                 money=["loan_amount"])


def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """O-21: model feature order, absent column -> 0, NULL -> median."""
    from riskspark.functions.coerce import align_features

    feats = CR.borrower_features(T.loans(spark, sf))
    cols = ["income_to_loan_ratio", "num_past_delinquencies", "credit_utilization_pct", "n_records", "bureau_score"]
    out = align_features(feats, cols, fill="median", keep=["borrower_id"])
    return final(out, ratios=cols)


def defaults_vs_recoveries(spark: SparkSession, sf: str) -> DataFrame:
    """O-105: label snapshot of loans originated before 1996 vs all loans."""
    from riskspark.operators.rollups import defaults_vs_recoveries as dvr

    loans = T.loans(spark, sf)
    words = ["Charged Off", "Default", "Write Off", "Written Off"]
    prev = CR.default_labels(loans.where(F.col("vintage_year") < 1996), "borrower_id", "loan_status", "status", words)
    cur = CR.default_labels(loans, "borrower_id", "loan_status", "status", words)
    return dvr(prev, cur)


def segment_rollup_levels(spark: SparkSession, sf: str) -> DataFrame:
    """O-35 sub-totals: grade x state, grade, portfolio in one rollup aggregate."""
    out = CR.segment_rollup_levels(scored_borrowers(spark, sf))
    return final(out, ratios=["avg_PD"], money=["total_EAD", "total_EL"], longs=["borrowers", "level"])
