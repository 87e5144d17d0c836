"""Fraud queries: behaviour features, rules, decisions, and the scored decision log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.hashing import assign_arm, sha1_mod100
from riskspark.operators import fraud as FR
from riskspark.operators import rules as RU
from riskspark.plans.common import date_str, final
from riskspark.session import arrow_by_rows
from riskspark.sources import tables as T

AB_PERCENT = 10
#: Partitions of the ``hot_*`` queries: so many that the rows of one user lie in several.
HOT_PARTS = 48


def txn(spark: SparkSession, sf: str) -> DataFrame:
    return T.txn(spark, sf)


def score_log(spark: SparkSession, sf: str, parts: int | None = None) -> DataFrame:
    """Decision log derived from the transactions: rule
    context -> structured rules -> model score -> decision, with arm, latency, label."""
    ctx = FR.fraud_context(txn(spark, sf), parts=parts)
    ctx = RU.evaluate_structured(ctx)
    ctx = ctx.withColumns({
        "proba": F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("amount") - F.lit(6000.0)) / F.lit(2000.0))),
        "latency_ms": (F.lit(5) + (F.col("transaction_id") * 7919) % 40).cast("int"),
        "arm": assign_arm(F.col("user_id").cast("string"), AB_PERCENT),
        "rules_count": F.size("rules_hit"),
        "label": F.col("is_chargeback"),
        "date": F.to_date(F.col("ts")),
    })
    return RU.final_decision(ctx)


_LOG_TABLES: dict[tuple, str] = {}


def decision_log_table(spark: SparkSession, sf: str) -> DataFrame:
    """The decision log as a *written table*: built once per Spark application from the
    transactions and stored as Parquet under the shared checkpoint folder; monitoring
    queries read it like the daily log files the scoring service writes. Writing it
    cuts the long feature/rules lineage, so several passes over the log (edges then
    counts, prefix sums) and executor loss never recompute the scoring chain."""
    from riskspark.streaming.ops import path_exists, work_dir

    key = (spark.sparkContext.applicationId, sf, T.fingerprint(spark, f"{sf.rstrip('/')}/events.parquet"))
    path = _LOG_TABLES.get(key)
    if path is None or not path_exists(spark, path):
        path = work_dir(spark, "decision_log_table")
        with arrow_by_rows(spark):
            score_log(spark, sf).write.mode("overwrite").parquet(path)
        _LOG_TABLES[key] = path
    return spark.read.parquet(path)


# ---- feature queries ----------------------------------------------------------------

def rolling_amount_1h(spark, sf):
    r = FR.rolling_amount(txn(spark, sf), "1h")
    return final(r.select("transaction_id", "user_id", "rolling_amount_last_1h"), money=["rolling_amount_last_1h"])


def velocity_spike(spark, sf):
    r = FR.velocity_spike(txn(spark, sf))
    return final(r.select("transaction_id", "user_id", "amount_30m", "baseline_avg", "velocity_spike"),
                 money=["amount_30m"], ratios=["baseline_avg"])


def geo_mismatch(spark, sf):
    r = FR.geo_mismatch(txn(spark, sf))
    return r.select("transaction_id", "user_id", "country", "home_country", "geo_location_mismatch")


def new_device(spark, sf):
    return FR.new_device(txn(spark, sf)).select("transaction_id", "user_id", "device_id", "device_is_new")


def device_changes(spark, sf):
    return FR.device_changes(txn(spark, sf)).select("transaction_id", "user_id", "device_id", "device_changed")


def user_avg_amount(spark, sf):
    r = FR.user_avg_amount(txn(spark, sf))
    return final(r.select("transaction_id", "user_id", "avg_amount_user"), ratios=["avg_amount_user"])


def rolling_amount_last_3(spark, sf):
    """O-23, positional: the sum over the user's last three rows, whatever their times."""
    r = FR.rolling_amount(txn(spark, sf), positional=3, out="rolling_amount_last_3")
    return final(r.select("transaction_id", "user_id", "rolling_amount_last_3"), money=["rolling_amount_last_3"])


def geo_mismatch_profiles(spark, sf):
    """O-25 from profiles: the home country is that of the user's account (a nation of the user's number; one in ten has none)."""
    t = txn(spark, sf)
    home = F.when(F.col("user_id") % 10 != 0, F.element_at(F.array(*[F.lit(c) for c in ("US", "GB", "CA", "IN")]), (F.col("user_id") % 4 + 1).cast("int")))
    profiles = t.select("user_id", home.alias("home_country")).distinct()
    r = FR.geo_mismatch(t, profiles=profiles)
    return r.select("transaction_id", "user_id", "country", "home_country", "geo_location_mismatch")


def user_prior_avg_amount(spark, sf):
    """O-29, as of each row: the mean of the user's earlier amounts."""
    r = FR.user_prior_avg_amount(txn(spark, sf))
    return final(r.select("transaction_id", "user_id", "avg_amount_before"), ratios=["avg_amount_before"])


def user_daily_velocity(spark, sf):
    r = FR.user_daily_velocity(txn(spark, sf))
    r = r.withColumn("date", date_str("date"))
    return final(r, money=["user_txn_amount_day"], longs=["user_txn_count_day", "device_change_count_day"])


def merchant_chargeback_rate(spark, sf):
    return final(FR.merchant_chargeback_rate(txn(spark, sf)), ratios=["merchant_chargeback_rate"])


# ---- the same features with users spread over many partitions --------------------------

def hot_rolling_amount_1h(spark, sf):
    r = FR.rolling_amount(txn(spark, sf), "1h", parts=HOT_PARTS)
    return final(r.select("transaction_id", "user_id", "rolling_amount_last_1h"), money=["rolling_amount_last_1h"])


def hot_velocity_spike(spark, sf):
    r = FR.velocity_spike(txn(spark, sf), parts=HOT_PARTS)
    return final(r.select("transaction_id", "user_id", "amount_30m", "baseline_avg", "velocity_spike"),
                 money=["amount_30m"], ratios=["baseline_avg"])


def hot_geo_mismatch(spark, sf):
    r = FR.geo_mismatch(txn(spark, sf), parts=HOT_PARTS)
    return r.select("transaction_id", "user_id", "country", "home_country", "geo_location_mismatch")


def hot_new_device(spark, sf):
    r = FR.new_device(txn(spark, sf), parts=HOT_PARTS)
    return r.select("transaction_id", "user_id", "device_id", "device_is_new")


def hot_device_changes(spark, sf):
    r = FR.device_changes(txn(spark, sf), parts=HOT_PARTS)
    return r.select("transaction_id", "user_id", "device_id", "device_changed")


def hot_final_decisions(spark, sf):
    """Rule context over many small partitions, then rules and decision."""
    r = score_log(spark, sf, parts=HOT_PARTS)
    return final(r.select("transaction_id", "arm", "proba", "rules_count", "decision"), ratios=["proba"], longs=["rules_count"])


# ---- rules / decisions --------------------------------------------------------------

FLAT_RULES = [
    {"name": "high_amount_new_account", "condition": "amount > 5000 and account_age_days < 30", "action": "flag"},
    {"name": "night_cross_border", "condition": "country != 'US' and hour_of_day < 6", "action": "review"},
    {"name": "unknown_column", "condition": "account_age > 3", "action": "flag"},
    {"name": "integer_division", "condition": "account_age_days div 100 = 3", "action": "review"},
    {"name": "any_case_text", "condition": "device_id ILIKE 'd%'", "action": "note"},
    {"name": "text_as_number", "condition": "country > 5", "action": "flag"},
    {"name": "unknown_function", "condition": "nosuchfn(amount) > 1", "action": "flag"},
    {"name": "syntax", "condition": "amount > and", "action": "flag"},
]


def rule_hits_flat(spark, sf):
    r = RU.evaluate_flat(txn(spark, sf), FLAT_RULES)
    return r.select("transaction_id", *[f"rule__{x['name']}" for x in FLAT_RULES], "rule_flag", "rule_review")


#: Conditions that fail on some rows: each gives 0 there and the right answer on the others.
FAILING_RULES = [{"name": n, "condition": c, "action": "flag"} for n, c in (
    ("zero_denominator", "amount / days > 2000"), ("zero_modulus", "100 % days = 0"), ("text_below", "5 < code"),
    ("text_between", "code between 1 and 9"), ("text_in", "code in (1, 2, 7)"), ("text_sum", "code + 1 > 3"), ("text_cast", "int(code) = 7"),
    ("index_past_end", "element_at(array(1, 2), days) = 1"), ("overflow", "days * 2000000000 > 5"), ("bad_date", "to_date(code) is null"),
    ("bad_date_or", "amount > 5000 or to_date(code) is null"), ("not_reached", "amount > 5000 and amount / days > 2000"),
    ("chained", "1 < days <= 3 & not code == 7"), ("case_branch", "case when days = 0 then amount > 100 else amount / days > 2000 end"))]


def rule_hits_failing(spark, sf):
    """O-64 on rows where conditions fail: text that is no number or date, zeros, an index past the end, overflow."""
    k = F.col("transaction_id") % 5
    t = txn(spark, sf).withColumns({
        "days": (F.col("account_age_days") % 4).cast("int"),
        "code": F.when(k == 0, F.lit("7")).when(k == 1, F.lit("2024-02-30")).when(k == 2, F.lit("2024-02-28")).when(k == 3, F.col("country"))})
    r = RU.evaluate_flat(t, FAILING_RULES)
    return r.select("transaction_id", *[f"rule__{x['name']}" for x in FAILING_RULES], "rule_flag")


def rule_hits_structured(spark, sf):
    r = score_log(spark, sf)
    return final(r.select("transaction_id", F.array_join("rules_hit", ",").alias("rules_hit"), "score_delta",
                          "severity", F.array_join("reasons", ",").alias("reasons")), ratios=["score_delta"])


def final_decisions(spark, sf):
    r = score_log(spark, sf)
    return final(r.select("transaction_id", "arm", "proba", "rules_count", "decision"), ratios=["proba"],
                 longs=["rules_count"])


def arm_assignment(spark, sf):
    users = txn(spark, sf).select(F.col("user_id").cast("string").alias("key")).distinct()
    return users.select("key", sha1_mod100("key").alias("bucket"), assign_arm("key", AB_PERCENT).alias("arm"))


def quarantine_txn(spark, sf):
    """O-19: request defaults + range checks; invalid rows carry their error list."""
    from riskspark.functions.coerce import validate_requests

    v = validate_requests(txn(spark, sf))
    return v.select("transaction_id", "device_id", "valid", F.array_join("errors", ",").alias("errors"))


def account_age(spark, sf):
    """O-18: account age in days from the user's first signup event (default 9999)."""
    ev = T.read_table(spark, sf, "events")
    r = FR.signup_account_age(txn(spark, sf), ev)
    return r.select("transaction_id", "user_id", "hour_of_day", "account_age_from_signup")


def flagged_per_rule(spark, sf):
    """O-102: transactions flagged per rule over the whole log."""
    e = decision_log_table(spark, sf).select(F.explode("rules_hit").alias("rule"))
    return e.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def fraud_by_country(spark, sf):
    """O-102: attempts (chargebacks) and flags by country."""
    log = decision_log_table(spark, sf)
    return log.groupBy("country").agg(F.count(F.lit(1)).alias("txns"),
                                      F.sum("is_chargeback").cast("bigint").alias("chargebacks"),
                                      F.count_if(F.col("decision") == "flag").alias("flagged"))
