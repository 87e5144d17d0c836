"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.plans import credit, fraud, lifecycle, models, monitoring, sources, streams
from riskspark.session import apply_defaults

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "segment_el_rollup": credit.segment_el_rollup,
    "portfolio_summary": credit.portfolio_summary,
    "borrower_features": credit.borrower_features,
    "default_labels": credit.default_labels,
    "credit_decisions": credit.credit_decisions,
    "pd_histogram": credit.pd_histogram,
    "stress_el": credit.stress_el,
    "woe_iv_ratio": credit.woe_iv_ratio,
    "rolling_amount_1h": fraud.rolling_amount_1h,
    "velocity_spike": fraud.velocity_spike,
    "geo_mismatch": fraud.geo_mismatch,
    "new_device": fraud.new_device,
    "device_changes": fraud.device_changes,
    "rolling_amount_last_3": fraud.rolling_amount_last_3,
    "geo_mismatch_profiles": fraud.geo_mismatch_profiles,
    "user_prior_avg_amount": fraud.user_prior_avg_amount,
    "hot_rolling_amount_1h": fraud.hot_rolling_amount_1h,
    "hot_velocity_spike": fraud.hot_velocity_spike,
    "hot_geo_mismatch": fraud.hot_geo_mismatch,
    "hot_new_device": fraud.hot_new_device,
    "hot_device_changes": fraud.hot_device_changes,
    "hot_final_decisions": fraud.hot_final_decisions,
    "user_avg_amount": fraud.user_avg_amount,
    "user_daily_velocity": fraud.user_daily_velocity,
    "merchant_chargeback_rate": fraud.merchant_chargeback_rate,
    "rule_hits_flat": fraud.rule_hits_flat,
    "rule_hits_failing": fraud.rule_hits_failing,
    "rule_hits_structured": fraud.rule_hits_structured,
    "final_decisions": fraud.final_decisions,
    "arm_assignment": fraud.arm_assignment,
    "fraud_kpis_daily": monitoring.fraud_kpis_daily,
    "monitor_kpis_daily": monitoring.monitor_kpis_daily,
    "arm_kpis_daily": monitoring.arm_kpis_daily,
    "top_rules_daily": monitoring.top_rules_daily,
    "top_rules_monthly": monitoring.top_rules_monthly,
    "fraud_month_rollup": monitoring.fraud_month_rollup,
    "ab_arm_metrics": monitoring.ab_arm_metrics,
    "promotion_decision": monitoring.promotion_decision,
    "shadow_transitions": monitoring.shadow_transitions,
    "shadow_summary": monitoring.shadow_summary,
    "psi_numeric": monitoring.psi_numeric,
    "psi_categorical": monitoring.psi_categorical,
    "drift_summary": monitoring.drift_summary,
    "drift_alerts": monitoring.drift_alerts,
    "feature_guard": monitoring.feature_guard,
    "calibration_deciles": monitoring.calibration_deciles,
    "roc_auc_gini": monitoring.roc_auc_gini,
    "ks_stat": monitoring.ks_stat,
    "brier": monitoring.brier,
    "average_precision": monitoring.average_precision,
    "threshold_recall_grid": monitoring.threshold_recall_grid,
    "threshold_pr_f1": monitoring.threshold_pr_f1,
    "credit_auc": monitoring.credit_auc,
    "confusion_combined": monitoring.confusion_combined,
    "trailing_7d_kpis": monitoring.trailing_7d_kpis,
    "credit_month_rollup": monitoring.credit_month_rollup,
    "latest_kpis": monitoring.latest_kpis,
    "kpi_upsert": monitoring.kpi_upsert,
    "column_profile": monitoring.column_profile,
    "class_balance": monitoring.class_balance,
    "contract_pd_scores": monitoring.contract_pd_scores,
    "contract_rollups": monitoring.contract_rollups,
    "expectations_log": monitoring.expectations_log,
    "feature_health": monitoring.feature_health,
    "score_health": monitoring.score_health,
    "log_contract": monitoring.log_contract,
    "checks_on_damaged_data": monitoring.checks_on_damaged_data,
    "el_total_by_name": monitoring.el_total_by_name,
    "stream_daily_kpis": streams.stream_daily_kpis,
    "stream_daily_kpis_restart": streams.stream_daily_kpis_restart,
    "stream_sliding_velocity": streams.stream_sliding_velocity,
    "stream_scored": streams.stream_scored,
    "stream_user_state": streams.stream_user_state,
    "stream_dedupe": streams.stream_dedupe,
    "reason_codes": credit.reason_codes,
    "segment_rollup_levels": credit.segment_rollup_levels,
    "loan_keep_first_join": credit.loan_keep_first_join,
    "feature_matrix": credit.feature_matrix,
    "defaults_vs_recoveries": credit.defaults_vs_recoveries,
    "quarantine_txn": fraud.quarantine_txn,
    "account_age": fraud.account_age,
    "flagged_per_rule": fraud.flagged_per_rule,
    "fraud_by_country": fraud.fraud_by_country,
    "coverage_report": monitoring.coverage_report,
    "alerts_min_severity": monitoring.alerts_min_severity,
    "calibration_slope": monitoring.calibration_slope,
    "retrain_triggers": monitoring.retrain_triggers,
    "log_sanity": monitoring.log_sanity,
    "label_coverage": monitoring.label_coverage,
    "stream_shadow_join": streams.stream_shadow_join,
    "stream_log_kpis": streams.stream_log_kpis,
    "log_roundtrip_latest2": monitoring.log_roundtrip_latest2,
    "freshness_check": monitoring.freshness_check,
    "describe_txn": monitoring.describe_txn,
    "rollup_csv_roundtrip": monitoring.rollup_csv_roundtrip,
    "train_pd_metrics": models.train_pd_metrics,
    "train_fraud_metrics": models.train_fraud_metrics,
    "train_split_balance": models.train_split_balance,
    **sources.QUERIES,
    **lifecycle.QUERIES,
}


def _with_defaults(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Every query runs under the package session settings (UTC clock, ANSI, AQE)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_defaults(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _with_defaults(v) for k, v in _QUERIES.items()}
