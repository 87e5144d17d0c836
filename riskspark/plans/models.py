"""Model training queries (rows-only: trained models are not bit-comparable to SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import ml as ML
from riskspark.plans.common import final
from riskspark.plans.credit import default_labels
from riskspark.plans.fraud import decision_log_table as score_log
from riskspark.operators import credit as CR
from riskspark.session import ensure_checkpoint_dir
from riskspark.sources import tables as T

CREDIT_FEATURES = ["income_to_loan_ratio", "num_past_delinquencies", "credit_utilization_pct", "n_records"]


def train_pd_metrics(spark, sf):
    """O-71: logistic PD (balanced, standardised) and a boosted-tree candidate, hash
    split 75/25; test-set AUC/Gini/KS/Brier/AP per model."""
    feats = CR.borrower_features(T.loans(spark, sf)).join(default_labels(spark, sf), "borrower_id")
    m = ML.prepare_matrix(feats, CREDIT_FEATURES, keep=["borrower_id", "default_flag"])
    m = ML.hash_split(m, "borrower_id", label="default_flag").withColumn("default_flag", F.col("default_flag").cast("double"))
    # iterative training and four metric passes: cut the feature lineage once
    ensure_checkpoint_dir(spark)
    m = m.checkpoint(eager=True)
    train, test = m.where(~F.col("is_test")), m.where(F.col("is_test"))
    # a third of the training rows calibrates what the others fitted
    train = ML.hash_split(train.drop("is_test"), "borrower_id", 33, seed=7)
    fit, held = train.where(~F.col("is_test")), train.where(F.col("is_test"))
    out = []
    for name, model in (("logistic", ML.train_pd_logistic(fit, CREDIT_FEATURES, "default_flag")),
                        ("gbt", ML.train_gbt(fit, CREDIT_FEATURES, [], "default_flag", max_iter=10))):
        sigmoid = ML.calibrate_sigmoid(ML.score_with(model, held), "default_flag")
        out.append(ML.evaluate(sigmoid(ML.score_with(model, test)), "score", "default_flag").withColumn("model", F.lit(name)))
    res = out[0].unionByName(out[1])
    return final(res, ratios=["auc", "gini", "ks", "brier", "average_precision"])


def train_fraud_metrics(spark, sf):
    """O-72: fraud candidate = numeric + one-hot categoricals into boosted trees (label
    dropped from the features), evaluated on a 25% hash validation split."""
    log = score_log(spark, sf).withColumn("label", F.col("label").cast("double"))
    numeric = ["amount", "hour_of_day", "account_age_days", "rolling_amount_last_1h", "avg_amount_user"]
    d = log.select("transaction_id", "label", *numeric, "country", "merchant_id",
                   F.coalesce("device_id", F.lit("unknown")).alias("device_id"))
    ensure_checkpoint_dir(spark)
    d = ML.hash_split(d, "transaction_id", label="label").checkpoint(eager=True)
    model = ML.train_gbt(d.where(~F.col("is_test")), numeric, ["country", "merchant_id", "device_id"], "label",
                         max_iter=10)
    res = ML.evaluate(ML.score_with(model, d.where(F.col("is_test"))), "score", "label")
    return final(res, ratios=["auc", "gini", "ks", "brier", "average_precision"])


def train_split_balance(spark, sf):
    """O-71 / O-72: rows of each class on each side of the stratified splits."""
    pd = ML.hash_split(default_labels(spark, sf), "borrower_id", label="default_flag").select(
        F.lit("pd").alias("model"), F.col("default_flag").alias("label"), "is_test")
    tx = ML.hash_split(T.txn(spark, sf), "transaction_id", label="is_chargeback").select(
        F.lit("fraud").alias("model"), F.col("is_chargeback").alias("label"), "is_test")
    return pd.unionByName(tx).groupBy("model", "label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test"))
