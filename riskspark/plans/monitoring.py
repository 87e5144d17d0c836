"""Monitoring queries: KPIs, experiments, drift, calibration, model quality, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators import credit as CR
from riskspark.operators import drift as DR
from riskspark.operators import experiments as EX
from riskspark.operators import metrics as M
from riskspark.operators import quality as QL
from riskspark.operators import rollups as RO
from riskspark.plans.common import date_str, final
from riskspark.plans.credit import scored_borrowers
from riskspark.plans.fraud import decision_log_table as score_log
from riskspark.session import ensure_checkpoint_dir
from riskspark.sources import tables as T

REF_END = "2024-01-16"  # reference sample: transactions before this date; current: the rest
NUMERIC_DRIFT = ["amount", "hour_of_day", "latency_ms", "account_age_days"]
CATEGORICAL_DRIFT = ["country", "device_id", "merchant_id", "decision"]


def _tagged(log: DataFrame) -> DataFrame:
    """ref = transactions before REF_END, cur = the rest (one pass, a sample column)."""
    return log.withColumn("sample", F.when(F.col("ts") < F.lit(REF_END).cast("timestamp_ntz"), F.lit("ref"))
                          .otherwise(F.lit("cur")))


# ---- KPIs -------------------------------------------------------------------------------

def fraud_daily(spark, sf, per_case_usd=M.FRAUD_PREVENTED_PER_CASE_USD) -> DataFrame:
    return M.fraud_kpis(score_log(spark, sf), per_case_usd=per_case_usd)


R_KPI = ["flagged_pct", "p50_latency_ms", "p95_latency_ms", "precision", "recall", "fpr"]


def fraud_kpis_daily(spark, sf):
    k = fraud_daily(spark, sf).withColumn("date", date_str("date"))
    return final(k, ratios=R_KPI, money=["fraud_prevented_usd"])


def monitor_kpis_daily(spark, sf):
    k = M.monitor_kpis(score_log(spark, sf)).withColumn("date", date_str("date"))
    return final(k, ratios=["flag_rate", "review_rate", "mean_proba", "p95_latency_ms"])


def arm_kpis_daily(spark, sf):
    k = M.arm_kpis(score_log(spark, sf)).withColumn("date", date_str("date"))
    return final(k, ratios=["flagged_pct"])


def top_rules_daily(spark, sf):
    return M.top_rules(score_log(spark, sf)).withColumn("date", date_str("date"))


def top_rules_monthly(spark, sf):
    log = score_log(spark, sf).withColumn("month", F.date_format("date", "yyyy-MM"))
    return M.top_rules(log, by=("month",), k=M.TOP_RULES_MONTHLY)


def fraud_month_rollup(spark, sf):
    out = M.month_rollup_fraud(fraud_daily(spark, sf))
    return final(out, ratios=["p50_latency_ms", "p95_latency_ms", "precision", "recall", "fpr"],
                 money=["fraud_prevented_usd"])


# ---- experiments ------------------------------------------------------------------------

def ab_arm_metrics(spark, sf):
    log = score_log(spark, sf)
    labels = log.select("transaction_id", "label")
    return final(EX.ab_arm_metrics(log.drop("label"), labels), ratios=["p95_latency_ms", "precision", "recall", "fpr"])


def promotion_decision(spark, sf):
    log = score_log(spark, sf)
    return EX.promotion_decision(EX.ab_arm_metrics(log))


def shadow_log(spark, sf) -> DataFrame:
    """Shadow records derived from the decision log: the production decision next to a
    candidate score (its own logistic, no rules, as the shadow path does)."""
    log = score_log(spark, sf)
    cand_p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("amount") - F.lit(5000.0)) / F.lit(1500.0)))
    return log.select(
        "transaction_id", "ts",
        F.struct("amount", "account_age_days", "country", "device_id", "hour_of_day").alias("payload"),
        F.struct("proba", "decision", "rules_hit").alias("prod"),
        F.struct(cand_p.alias("proba"),
                 F.when(cand_p >= 0.5, F.lit("flag")).otherwise(F.lit("allow")).alias("decision")).alias("cand"),
        F.struct(F.col("latency_ms").alias("prod"),
                 (F.lit(3) + (F.col("transaction_id") * 31) % 20).cast("int").alias("cand")).alias("latency_ms"))


def shadow_transitions(spark, sf):
    return EX.shadow_transitions(shadow_log(spark, sf))


def shadow_summary(spark, sf):
    return final(EX.shadow_summary(shadow_log(spark, sf)),
                 ratios=["agreement_rate", "mean_score_delta", "mean_abs_score_delta", "p95_latency_prod",
                         "p95_latency_cand"])


# ---- drift --------------------------------------------------------------------------------

def psi_numeric(spark, sf):
    return final(DR.psi_numeric_tagged(_tagged(score_log(spark, sf)), NUMERIC_DRIFT), ratios=["psi"])


def psi_categorical(spark, sf):
    return final(DR.psi_categorical_tagged(_tagged(score_log(spark, sf)), CATEGORICAL_DRIFT), ratios=["psi"])


def drift_summary(spark, sf):
    return final(DR.drift_table_tagged(_tagged(score_log(spark, sf)), NUMERIC_DRIFT, CATEGORICAL_DRIFT),
                 ratios=["psi"])


def drift_alerts(spark, sf):
    log = _tagged(score_log(spark, sf))
    drift = DR.drift_table_tagged(log, NUMERIC_DRIFT, CATEGORICAL_DRIFT)
    k = M.monitor_kpis(log, by=("sample",))
    k_cur = k.where(F.col("sample") == "cur")
    k_ref = k.where(F.col("sample") == "ref")
    return final(DR.drift_alerts(drift, k_cur, k_ref), ratios=["value", "limit"])


def feature_guard(spark, sf):
    return final(DR.feature_guard(_tagged(score_log(spark, sf)), NUMERIC_DRIFT + ["proba"]), ratios=["pooled_std"],
                 longs=["n_ref", "n_cur"])


def credit_labelled(spark, sf) -> DataFrame:
    from riskspark.plans.credit import default_labels
    return scored_borrowers(spark, sf).join(default_labels(spark, sf), "borrower_id", "inner")


def calibration_deciles(spark, sf):
    out = DR.calibration_bins(credit_labelled(spark, sf), "PD", "default_flag")
    return final(out, ratios=["mean_pd", "rate_observed"])


# ---- model quality (fraud score vs chargeback label) ---------------------------------------

def roc_auc_gini(spark, sf):
    return final(M.roc_auc(score_log(spark, sf), "proba", "label"), ratios=["auc", "gini"])


def ks_stat(spark, sf):
    return final(M.ks_stat(score_log(spark, sf), "proba", "label"), ratios=["ks"])


def brier(spark, sf):
    return final(M.brier(score_log(spark, sf), "proba", "label"), ratios=["brier"])


def average_precision(spark, sf):
    return final(M.average_precision(score_log(spark, sf), "proba", "label"), ratios=["average_precision"])


def threshold_recall_grid(spark, sf):
    return final(M.threshold_recall_grid(score_log(spark, sf), "proba", "label"), ratios=["threshold"])


def threshold_pr_f1(spark, sf):
    return final(M.threshold_pr_f1(score_log(spark, sf), "proba", "label"),
                 ratios=["threshold", "f1", "precision", "recall"])


def credit_auc(spark, sf):
    return final(M.roc_auc(credit_labelled(spark, sf), "PD", "default_flag"), ratios=["auc", "gini"])


def confusion_combined(spark, sf):
    log = score_log(spark, sf)
    pred = (F.col("proba") >= 0.5) | (F.col("rules_count") > 0)
    return final(M.confusion(log, pred, "label"), ratios=["precision", "recall"])


# ---- credit daily / monthly -------------------------------------------------------------------

def credit_daily(spark, sf) -> DataFrame:
    """Daily credit KPIs: loans scored with their borrower's PD, by origination date."""
    loans = T.loans(spark, sf)
    pdf = CR.score_pd(CR.borrower_features(loans, "borrower_id")).select("borrower_id", "PD")
    s = CR.expected_loss(loans.join(pdf, "borrower_id", "left"), ead_col="loan_amount")
    return s.groupBy(F.col("origination_date").alias("date")).agg(
        F.count(F.lit(1)).alias("n_loans"), F.avg("PD").alias("avg_PD"), F.sum("EL").alias("total_EL"))


def trailing_7d_kpis(spark, sf):
    """O-30: today vs the trailing 7 days (today excluded) for mean PD, total EL and PSI."""
    out = RO.trailing_baseline(credit_daily(spark, sf), ["avg_PD", "total_EL"], days=7,
                               drift_long=credit_drift_daily(spark, sf))
    out = out.withColumn("date", date_str("date"))
    return final(out, ratios=["avg_PD", "avg_PD_trailing", "avg_PD_delta", "psi_max", "psi_mean", "psi_mean_trailing",
                              "psi_max_trailing", "psi_mean_delta"],
                 money=["total_EL", "total_EL_trailing", "total_EL_delta"])


CREDIT_DRIFT = ["PD", "loan_amount", "income_to_loan_ratio", "credit_utilization_pct"]
CREDIT_REF_VINTAGE = 1998  # reference: loans of earlier vintages; daily current samples after


def credit_drift_daily(spark, sf) -> DataFrame:
    """Daily credit drift table (date, feature, psi): each origination day from 1998 on
    against the loans of earlier vintages."""
    loans = T.loans(spark, sf)
    feats = CR.score_pd(CR.borrower_features(loans, "borrower_id"))
    s = loans.join(feats.select("borrower_id", "PD", "income_to_loan_ratio", "credit_utilization_pct"),
                   "borrower_id", "left").select("origination_date", "vintage_year", *CREDIT_DRIFT)
    # the scored loans feed both samples and several passes (edges, reference counts,
    # daily counts): written once to the checkpoint folder instead of re-scoring per pass
    ensure_checkpoint_dir(spark)
    s = s.checkpoint(eager=True)
    ref = s.where(F.col("vintage_year") < CREDIT_REF_VINTAGE)
    cur = s.where(F.col("vintage_year") >= CREDIT_REF_VINTAGE)
    return DR.psi_numeric_by_period(ref, cur, CREDIT_DRIFT, "origination_date").withColumnRenamed("period", "date")


def credit_month_rollup(spark, sf):
    """O-42: days with reports, mean daily PD / EL, alert days (any PSI >= 0.25), max and
    mean PSI over feature-days, top drifted features by mean PSI."""
    out = RO.month_rollup_credit(credit_daily(spark, sf), credit_drift_daily(spark, sf))
    return final(out, ratios=["mean_daily_PD", "max_psi", "avg_psi"], money=["mean_daily_EL"])


def latest_kpis(spark, sf):
    c = credit_daily(spark, sf).select(F.lit("credit").alias("system"), "date",
                                       F.col("n_loans").alias("volume"))
    f = fraud_daily(spark, sf).select(F.lit("fraud").alias("system"), "date", F.col("total_txns").alias("volume"))
    out = RO.latest_by_date(c.unionByName(f), by=["system"])
    return out.withColumn("date", date_str("date"))


def kpi_upsert(spark, sf):
    old = fraud_daily(spark, sf).where(F.col("date") <= F.lit("2024-01-20").cast("date"))
    new = fraud_daily(spark, sf, per_case_usd=250.0).where(F.col("date") >= F.lit("2024-01-15").cast("date"))
    out = RO.upsert(old, new, ["date"]).withColumn("date", date_str("date"))
    return final(out, ratios=R_KPI, money=["fraud_prevented_usd"])


# ---- profiles and contracts --------------------------------------------------------------------

def column_profile(spark, sf):
    return M.column_profile(T.txn(spark, sf), ["merchant_id", "device_id", "country"])


def class_balance(spark, sf):
    return final(M.class_balance(T.txn(spark, sf), "is_chargeback"), ratios=["pos_weight"])


def contract_pd_scores(spark, sf):
    return final(QL.run_expectations(scored_borrowers(spark, sf), QL.pd_scores_suite(), "pd_scores"),
                 ratios=["observed"])


def contract_rollups(spark, sf):
    from riskspark.plans.credit import segment_el_rollup
    return final(QL.run_expectations(segment_el_rollup(spark, sf), QL.rollup_suite(), "rollups"),
                 ratios=["observed"])


def expectations_log(spark, sf):
    return final(QL.run_expectations(score_log(spark, sf), QL.fraud_log_suite(), "fraud_api_logs"),
                 ratios=["observed"])


def feature_health(spark, sf):
    from riskspark.operators import fraud as FR
    tx = T.txn(spark, sf)
    out = QL.run_expectations(CR.borrower_features(T.loans(spark, sf)), QL.credit_feature_health(), "credit_features")
    for df, suite, name in ((FR.user_daily_velocity(tx), QL.fraud_feature_health(), "fraud_batch"),
                            (FR.merchant_chargeback_rate(tx), QL.merchant_rate_health(), "fraud_merchants"),
                            (FR.rolling_amount(tx), QL.rolling_amount_health(), "fraud_stream")):
        out = out.unionByName(QL.run_expectations(df, suite, name))
    return final(out, ratios=["observed"])


def score_health(spark, sf):
    from riskspark.plans.credit import segment_el_rollup
    a = QL.run_expectations(scored_borrowers(spark, sf).withColumn("LGD", F.lit(CR.DEFAULT_LGD)), QL.score_health(), "credit_scores")
    b = QL.run_expectations(segment_el_rollup(spark, sf), QL.rollup_health(), "rollups")
    return final(a.unionByName(b), ratios=["observed"])


def checks_on_damaged_data(spark, sf):
    """Every contract and health check over damaged copies of its table: each damaged column fails."""
    from riskspark.operators import fraud as FR
    from riskspark.plans.credit import segment_el_rollup
    k = F.col("borrower_id") % 10
    pd = scored_borrowers(spark, sf)
    pd = pd.withColumn("PD", F.when(k == 1, F.lit(1.5)).when(k != 0, F.col("PD"))).withColumn("EL", F.when(k == 2, F.lit(-1.0)).otherwise(F.col("EL")))
    seg = segment_el_rollup(spark, sf)
    seg = seg.withColumn("avg_PD", F.when(F.col("vintage_year") != 1995, F.col("avg_PD"))).withColumn("grade", F.lit(None).cast("string")) \
        .withColumn("total_EL", F.when(F.col("vintage_year") == 1996, F.lit(-1.0)).otherwise(F.col("total_EL")))
    tx = T.txn(spark, sf)
    rate = FR.merchant_chargeback_rate(tx).withColumn(
        "merchant_chargeback_rate", F.when(F.col("merchant_id") == "M1", F.lit(1.2)).otherwise(F.col("merchant_chargeback_rate")))
    roll = FR.rolling_amount(tx).withColumn("rolling_amount_last_1h", F.when(F.col("transaction_id") % 100 == 0, F.lit(-5.0))
                                            .otherwise(F.col("rolling_amount_last_1h")))
    out = QL.run_expectations(pd, QL.pd_scores_suite(date_col="as_of_date"), "pd_scores")
    for df, suite, name in ((pd, QL.score_health(), "credit_scores"), (seg, QL.rollup_suite(), "rollup_contract"),
                            (seg, QL.rollup_health(), "rollups"), (rate, QL.merchant_rate_health(), "fraud_merchants"),
                            (roll, QL.rolling_amount_health(), "fraud_stream")):
        out = out.unionByName(QL.run_expectations(df, suite, name))
    return final(out, ratios=["observed"])


def el_total_by_name(spark, sf):
    """O-20: total expected loss of the roll-up through the tolerant column choice, from locale text."""
    from riskspark.functions import coerce as CO
    from riskspark.plans.credit import segment_el_rollup
    seg = segment_el_rollup(spark, sf).select("grade", F.concat(F.format_number("total_EL", 2), F.lit(" ")).alias("Total_EL"))
    return final(CO.el_total(seg), money=["el_total"])


def log_contract(spark, sf):
    lines = score_log(spark, sf).select(F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), "arm", "proba", "decision", "rules_hit",
        "latency_ms")).alias("value"))
    return QL.log_contract(lines)


def coverage_report(spark, sf):
    """O-50: expected log columns: present? non-NULL rate."""
    exp = ["ts", "decision", "proba", "latency_ms", "arm", "rules_hit", "model_ts"]
    return final(DR.coverage_report(score_log(spark, sf), exp), ratios=["non_null_rate"])


def alerts_min_severity(spark, sf):
    """O-52: drift rows graded info/warn/error by PSI, filtered at a minimum severity."""
    d = DR.drift_table_tagged(_tagged(score_log(spark, sf)), NUMERIC_DRIFT, CATEGORICAL_DRIFT)
    sev = F.when(F.col("psi") >= 0.25, "error").when(F.col("psi") >= 0.1, "warn").otherwise("info")
    d = d.withColumn("severity", sev)
    return final(d.where(DR.meets_threshold(F.col("severity"), "info")), ratios=["psi"])


def calibration_slope(spark, sf):
    """O-101: slope of observed default rate on mean PD across the deciles."""
    b = DR.calibration_bins(credit_labelled(spark, sf), "PD", "default_flag")
    return final(DR.calibration_slope(b), ratios=["slope"])


def retrain_triggers(spark, sf):
    """O-103: max PSI vs 0.2, min daily precision vs 0.85."""
    log = score_log(spark, sf)
    drift = DR.drift_table_tagged(_tagged(log), NUMERIC_DRIFT, CATEGORICAL_DRIFT)
    return final(DR.retrain_triggers(drift, M.fraud_kpis(log)), ratios=["max_psi", "min_precision"])


def log_sanity(spark, sf):
    """O-104: timestamps going backwards in arrival order per user; decision enum."""
    return QL.monotonic_and_enum(score_log(spark, sf), "user_id", "ts", "transaction_id", "decision",
                                 ["allow", "flag"])


def label_coverage(spark, sf):
    """O-77: labels exist only for transactions that went through the chargeback process
    (purchases and errors); coverage of the labelled join."""
    ev = T.read_table(spark, sf, "events").where(F.col("event_type").isin("purchase", "error"))
    labels = ev.select(F.col("event_id").alias("transaction_id"))
    tx = T.txn(spark, sf).select("transaction_id", "is_chargeback")
    j = tx.join(labels.withColumn("_lab", F.lit(1)), "transaction_id", "left")
    return j.agg(F.count(F.lit(1)).alias("total"), F.count("_lab").alias("labelled"),
                 F.round(F.count("_lab") / F.count(F.lit(1)), 6).alias("coverage"),
                 F.count_if((F.col("_lab") == 1) & (F.col("is_chargeback") == 1)).alias("labelled_positives"))


def log_roundtrip_latest2(spark, sf):
    """O-03/O-05/O-07: the decision log written as JSON lines partitioned by day, read back
    tolerantly (nested tx flattened, defaults), the latest two days selected by the
    partition column (pruned scan), monitor KPIs per day."""
    from riskspark.sources import files as FS
    from riskspark.streaming.ops import work_dir

    out = work_dir(spark, "decision_log")
    log = score_log(spark, sf)
    rec = log.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), "arm",
        F.struct("amount", "account_age_days", "country", "device_id", "hour_of_day").alias("tx"),
        "proba", "decision", "rules_hit", "latency_ms", F.lit("model_1").alias("model_ts"),
        F.col("transaction_id").cast("string").alias("transaction_id"), "label", date_str("date").alias("as_of_date"))
    rec.write.mode("overwrite").partitionBy("as_of_date").json(out)
    back = FS.read_decision_log(spark, out, latest=2)
    k = M.monitor_kpis(back, by=("as_of_date",)).withColumn("as_of_date", date_str("as_of_date"))
    return final(k, ratios=["flag_rate", "review_rate", "mean_proba", "p95_latency_ms"])


def rollup_csv_roundtrip(spark, sf):
    """O-08/O-01: segment roll-up exported as header CSV and read back with tolerant types."""
    from riskspark.plans.credit import segment_el_rollup
    from riskspark.sources import files as FS
    from riskspark.streaming.ops import work_dir

    out = work_dir(spark, "rollup_csv")
    FS.write_csv_export(segment_el_rollup(spark, sf), out)
    types = {"vintage_year": "int", "borrowers": "bigint", "total_EAD": "double", "avg_PD": "double",
             "total_EL": "double"}
    return FS.read_csv_tolerant(spark, out, types=types)


def freshness_check(spark, sf):
    """O-87: the decision log table is not older than its input transactions and is
    younger than 24h at the reporting time (fixed here to the end of the input month)."""
    log = score_log(spark, sf)
    ev = T.read_table(spark, sf, "events")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    out = QL.freshness(log, ev, "ts", "ts", 24.0, now=now)
    return final(out.select(F.date_format("out_max", "yyyy-MM-dd HH:mm:ss").alias("out_max"),
                            F.date_format("in_max", "yyyy-MM-dd HH:mm:ss").alias("in_max"),
                            "age_hours", "fresh", "not_stale_vs_inputs"), ratios=["age_hours"])


def describe_txn(spark, sf):
    """O-43 fallback: count / mean / stddev / min / max of the numeric transaction columns
    (one aggregate, like ``DataFrame.summary``)."""
    tx = T.txn(spark, sf)
    cols = ["amount", "hour_of_day", "account_age_days"]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    row = tx.agg(*aggs)
    recs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                              F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                              F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in cols])
    return final(row.select(F.explode(recs).alias("r")).select("r.*"), ratios=["mean", "std", "min", "max"])
