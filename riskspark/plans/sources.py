"""Queries over scans, sinks and coercions: each writes data derived from the given tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from riskspark.functions import coerce as C
from riskspark.operators import credit as CR
from riskspark.operators import metrics as M
from riskspark.operators import rollups as RO
from riskspark.plans.common import date_str, final
from riskspark.plans.fraud import decision_log_table, score_log
from riskspark.sources import files as FS
from riskspark.sources import tables as T
from riskspark.streaming.ops import work_dir


def any_table_roundtrip(spark, sf):
    """O-01 / O-02: loans as CSV and as Parquet through one reader; totals by format."""
    loans = T.loans(spark, sf).select("loan_id", "loan_amount", "revol_util", "grade")
    out = work_dir(spark, "any_table")
    loans.write.option("header", True).csv(f"{out}/loans.csv")
    loans.write.parquet(f"{out}/loans")
    parts = []
    for fmt, path in (("csv", f"{out}/loans.csv"), ("parquet", f"{out}/loans")):
        df = FS.read_table_any(spark, path)
        parts.append(df.agg(F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("n"),
                            F.sum(F.col("loan_amount").try_cast("double")).alias("loan_amount"),
                            F.sum(C.coerce_percent("revol_util")).alias("utilisation")))
    return final(parts[0].unionByName(parts[1]), money=["loan_amount", "utilisation"])


def kpi_json_scan(spark, sf):
    """O-04: daily KPI files in JSON over a partition glob; a glob without files is empty."""
    daily = T.txn(spark, sf).groupBy(F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("txns"), F.sum("amount").alias("amount"))
    out = work_dir(spark, "kpi_json")
    daily.select(date_str("d").alias("date"), date_str("d").alias("day"), "txns", "amount").write.partitionBy("day").json(out)
    schema = T_.StructType().add("date", "string").add("txns", "long").add("amount", "double").add("model", "string")
    got = FS.read_json_records(spark, f"{out}/day=*", schema).unionByName(FS.read_json_records(spark, f"{out}/none=*", schema))
    return final(got, money=["amount"])


def evolving_union(spark, sf):
    """O-06 / O-78: roll-ups of two layouts in one table; absent columns are NULL."""
    tx = T.txn(spark, sf)
    old = tx.where("transaction_id % 2 = 0").groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    new = tx.where("transaction_id % 2 = 1").groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    return final(FS.union_evolving([old, new]), money=["amount"])


def dated_sink_rerun(spark, sf):
    """O-07: a day is written again; the other days stay."""
    tx = T.txn(spark, sf).select(date_str(F.to_date("ts")).alias("as_of_date"), "transaction_id", "amount")
    out = work_dir(spark, "dated")
    FS.write_dated_parquet(tx, out)
    last = tx.agg(F.max("as_of_date")).first()[0]
    FS.write_dated_parquet(tx.where(F.col("as_of_date") == last).withColumn("amount", F.lit(1.0)), out)
    g = spark.read.parquet(out).groupBy(date_str("as_of_date").alias("date")).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    return final(g, money=["amount"])


def flatten_log(spark, sf):
    """O-10: nested records as flat columns, arrays as JSON text."""
    log = score_log(spark, sf).select("transaction_id", F.struct("amount", F.struct("country", "device_id").alias("who")).alias("tx"), "rules_hit")
    flat = C.flatten_struct(log, sep="_")
    return final(flat, money=["tx_amount"])


def autoscan_labels(spark, sf):
    """O-13: no known label name: the text column that holds default words is found by its values."""
    loans = T.loans(spark, sf).select("borrower_id", F.col("loan_status").alias("remark"), F.col("grade").alias("kind"))
    return CR.default_labels(loans)


def chargeback_spellings(spark, sf):
    """O-15: flags spelled in many ways, one count for each spelling."""
    k = F.col("transaction_id") % 9
    words = ["Y", "no", " TRUE ", "f", "1", "0", "2.0", "maybe"]
    text = F.when(k == 8, F.lit(None)).otherwise(F.element_at(F.array(*[F.lit(w) for w in words]), (k % 8 + 1).cast("int")))
    d = T.txn(spark, sf).select(text.alias("spelling"))
    return d.groupBy("spelling").agg(F.count(F.lit(1)).alias("n"), F.sum(C.chargeback_flag("spelling")).cast("bigint").alias("chargebacks"))


def last_30_days(spark, sf):
    """O-31: the last 30 days of the daily table."""
    daily = T.txn(spark, sf).groupBy(date_str(F.to_date("ts")).alias("date")).agg(F.count(F.lit(1)).alias("txns"))
    return RO.last_n(daily, 30)


def freshness_of_systems(spark, sf):
    """O-31: the freshest date over the systems' tables."""
    tx = T.txn(spark, sf).select(F.to_date("ts").alias("date"))
    loans = T.loans(spark, sf).select(F.col("origination_date").alias("date"))
    return RO.freshness_across([tx, loans]).select(date_str("freshest_date").alias("freshest_date"))


def pr_curve(spark, sf):
    """O-56: precision, recall and false positive rate at every distinct score (to two places)."""
    log = decision_log_table(spark, sf).withColumn("s", F.round("proba", 2))
    return final(M.pr_points(log, "s", "label").select("threshold", "precision", "recall", "fpr"), ratios=["precision", "recall", "fpr"])


def arms_month_rollup(spark, sf):
    """O-41: daily arm counts summed again by month."""
    return final(M.month_rollup_arms(M.arm_kpis(decision_log_table(spark, sf))), ratios=["flagged_pct"], longs=["n", "flagged"])


def label_source_fallback(spark, sf):
    """O-77: labels from the chargeback feed, else from the log itself; which source gave how many."""
    ev = T.read_table(spark, sf, "events").where(F.col("event_type").isin("purchase", "error"))
    feed = ev.select(F.col("event_id").alias("transaction_id"), (F.col("event_type") == "error").cast("int").alias("feed_label"))
    j = T.txn(spark, sf).select("transaction_id", "is_chargeback").join(feed, "transaction_id", "left")
    source = F.when(F.col("feed_label").isNotNull(), "feed").when(F.col("is_chargeback").isNotNull(), "log").otherwise("none")
    j = j.select(source.alias("source"), F.coalesce("feed_label", "is_chargeback").alias("label"))
    return j.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("positives"))


def delinquency_trend(spark, sf):
    """O-105: delinquency rate of each vintage and its change on the vintage before."""
    return final(RO.delinquency_trend(T.loans(spark, sf)), ratios=["delinquency_rate", "change"])


QUERIES = {f.__name__: f for f in (
    any_table_roundtrip, kpi_json_scan, evolving_union, dated_sink_rerun, flatten_log, autoscan_labels, chargeback_spellings,
    last_30_days, freshness_of_systems, pr_curve, arms_month_rollup, label_source_fallback, delinquency_trend)}
