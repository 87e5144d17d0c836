"""Streaming queries: each runs a Structured Streaming job over the events file
(availableNow trigger, checkpointed under the shared checkpoint dir) and returns the
sink table it wrote. On complete input each equals its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import fraud as FR
from riskspark.plans.common import final
from riskspark.sources import tables as T
from riskspark.streaming import ops as S


PARTS = 4  # files, and so micro-batches, of the events table
SPAN = "60 days"  # watermark that no event of the shuffled files is later than


def stream_daily_kpis(spark, sf):
    """Four micro-batches with late rows; each day is rewritten only by the epochs that touch it."""
    out = S.work_dir(spark, "daily_kpis")
    ev = S.event_files(spark, sf, PARTS, disorder=True)
    path = S.run_upsert_stream(S.daily_txn_kpis(ev.stream(spark), SPAN), ["w"], out, F.col("w.start"))
    r = S.read_upserted(spark, path).select(F.date_format("w.start", "yyyy-MM-dd").alias("date"), "txns", "amount",
                                            "chargebacks", "max_amount")
    return final(r, money=["amount", "max_amount"])


def stream_daily_kpis_restart(spark, sf):
    """The same, stopped after half of the files and started again with the same folders."""
    out = S.work_dir(spark, "daily_kpis_restart")
    ev = S.event_files(spark, sf, PARTS)
    files = S.parquet_files(spark, ev.path)
    first = S.work_dir(spark, "event_files")
    for k, f in enumerate(files):  # the source folder fills up between the runs
        spark.read.schema(S.EVENTS_SCHEMA).parquet(f).write.mode("append").parquet(first)
        if k % 2 or k == len(files) - 1:
            path = S.run_upsert_stream(S.daily_txn_kpis(S.txn_stream(spark, first), SPAN), ["w"], out, F.col("w.start"))
    r = S.read_upserted(spark, path).select(F.date_format("w.start", "yyyy-MM-dd").alias("date"), "txns", "amount",
                                            "chargebacks", "max_amount")
    return final(r, money=["amount", "max_amount"])


def stream_sliding_velocity(spark, sf):
    out = S.work_dir(spark, "sliding_velocity")
    ev = S.event_files(spark, sf, PARTS)
    path = S.run_upsert_stream(S.sliding_velocity(ev.stream(spark)), ["user_id", "w"], out, F.col("w.start"))
    r = S.read_upserted(spark, path).select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                                            "txns", "amount")
    return final(r, money=["amount"])


def stream_scored(spark, sf):
    """O-94: streamed decisions with the whole rule context equal the batch decisions."""
    out = S.work_dir(spark, "scored")
    ev = S.event_files(spark, sf, PARTS, disorder=True, closing=True)
    rates = FR.merchant_chargeback_rate(T.txn(spark, sf))
    ctx = S.stateful_user_features(ev.stream(spark), SPAN, keys=ev.keys)
    scored = S.enrich_and_score(ctx, rates).select(
        "transaction_id", "merchant_chargeback_rate", "proba", F.array_join("rules_hit", ",").alias("rules_hit"),
        "decision")
    r = spark.read.parquet(S.run_append_stream(scored, out))
    return final(r, ratios=["merchant_chargeback_rate", "proba"])


def stream_user_state(spark, sf):
    out = S.work_dir(spark, "user_state")
    ev = S.event_files(spark, sf, PARTS, disorder=True, closing=True)
    feats = S.stateful_user_features(ev.stream(spark), SPAN, keys=ev.keys).select(
        "transaction_id", "user_id", "rolling_amount_last_1h", "home_country", "geo_location_mismatch", "velocity_spike", "device_is_new")
    r = spark.read.parquet(S.run_append_stream(feats, out))
    return final(r, money=["rolling_amount_last_1h"])


def stream_dedupe(spark, sf):
    """O-96: every event arrives twice, in files that overlap; each is kept once."""
    out = S.work_dir(spark, "dedupe")
    ev = S.event_files(spark, sf, PARTS, disorder=True)
    for f in S.parquet_files(spark, ev.path):
        spark.read.schema(S.EVENTS_SCHEMA).parquet(f).where("event_id % 3 = 0").write.mode("append").parquet(ev.path)
    d = S.dedupe_late(ev.stream(spark), watermark=SPAN).select("transaction_id", "user_id")
    return spark.read.parquet(S.run_append_stream(d, out))


def stream_shadow_join(spark, sf):
    """O-95: production decisions joined to candidate decisions (logged up to 1 minute
    later) as two streams over the same transaction file."""
    out = S.work_dir(spark, "shadow_join")
    logistic = lambda mid, scale: F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("amount") - F.lit(mid)) / F.lit(scale)))
    ev = S.event_files(spark, sf, PARTS)
    prod = ev.stream(spark).select(
        "transaction_id", "ts", F.when(logistic(6000.0, 2000.0) >= 0.5, "flag").otherwise("allow").alias("prod_decision"))
    cand = ev.stream(spark).select(
        F.col("transaction_id").alias("c_transaction_id"),
        (F.col("ts") + F.expr("INTERVAL 3 SECONDS")).alias("c_ts"),
        F.when(logistic(5000.0, 1500.0) >= 0.5, "flag").otherwise("allow").alias("cand_decision"))
    j = S.shadow_stream_join(prod, cand).select("transaction_id", "prod_decision", "cand_decision")
    return spark.read.parquet(S.run_append_stream(j, out))


def stream_log_kpis(spark, sf):
    """O-89 + O-92: the decision log written as JSON lines, consumed as a file stream,
    aggregated into a watermarked per-day latency histogram (update mode, upserted), then
    daily KPIs with an exact p95 from the histogram."""
    from riskspark.plans.fraud import decision_log_table

    src = S.work_dir(spark, "log_files")
    log = decision_log_table(spark, sf)
    log.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), "arm",
               F.struct("amount", "account_age_days", "country", "device_id", "hour_of_day").alias("tx"),
               "proba", "decision", "rules_hit", "latency_ms").write.mode("overwrite").json(src)
    out = S.work_dir(spark, "log_kpis")
    hist = S.daily_latency_histogram(S.decision_log_stream(spark, src))
    path = S.run_upsert_stream(hist, ["w", "latency_ms"], out, F.col("w.start"))
    k = S.histogram_kpis(S.read_upserted(spark, path))
    return final(k, ratios=["flag_rate", "mean_proba", "p95_latency_ms"])
