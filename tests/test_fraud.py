"""Fraud features, rules and arms on the transaction fixture (FIXTURES F3, F7, F8)."""

import pytest
from pyspark.sql import functions as F

from riskspark.functions.hashing import assign_arm, sha1_mod100
from riskspark.operators import fraud as FR
from riskspark.operators import rules as RU

TX = [("T1", "U1", "M1", "D_A", 120.50, "2025-09-25 09:00:00", 0, "US"),
      ("T2", "U1", "M1", "D_A", 80.00, "2025-09-25 09:15:00", 0, "US"),
      ("T3", "U2", "M2", "D_X", 15.75, "2025-09-25 09:40:00", 1, "GB"),
      ("T4", "U1", "M3", "D_B", 500.00, "2025-09-25 10:05:00", 0, "CA"),
      ("T5", "U2", "M2", "D_X", 40.25, "2025-09-25 10:20:00", 0, "GB")]


def tx(spark, rows=TX):
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, merchant_id string, device_id string, "
                                     "amount double, ts string, is_chargeback int, country string")
    return df.withColumn("ts", F.to_timestamp("ts"))


def test_rolling_geo_device(spark):
    d = tx(spark)
    roll = {r.transaction_id: r.rolling_amount_last_1h for r in FR.rolling_amount(d).collect()}
    assert roll == {"T1": 120.5, "T2": 200.5, "T3": 15.75, "T4": 580.0, "T5": 56.0}
    geo = {r.transaction_id: r.geo_location_mismatch for r in FR.geo_mismatch(d).collect()}
    assert geo == {"T1": False, "T2": False, "T3": False, "T4": True, "T5": False}
    dev = {r.transaction_id: r.device_changed for r in FR.device_changes(d).collect()}
    assert dev == {"T1": False, "T2": False, "T3": False, "T4": True, "T5": False}


def test_user_day_and_merchant(spark):
    d = tx(spark)
    ud = {r.user_id: r for r in FR.user_daily_velocity(d).collect()}
    assert (ud["U1"].user_txn_count_day, ud["U1"].user_txn_amount_day, ud["U1"].device_change_count_day) == (3, 700.5, 1)
    assert (ud["U2"].user_txn_count_day, ud["U2"].user_txn_amount_day, ud["U2"].device_change_count_day) == (2, 56.0, 0)
    m = {r.merchant_id: (r.txn_count, r.chargeback_count, r.merchant_chargeback_rate)
         for r in FR.merchant_chargeback_rate(d).collect()}
    assert m == {"M1": (2, 0, 0.0), "M2": (2, 1, 0.5), "M3": (1, 0, 0.0)}


def test_window_edges(spark):
    rows = [("A1", "U", "M", "D1", 10.0, "2025-01-01 00:00:00", 0, "US"),
            ("A2", "U", "M", None, 20.0, "2025-01-01 01:00:00", 0, None),   # exactly 1h later: A1 excluded
            ("A3", "U", "M", "D1", 5.0, "2025-01-01 01:00:00", 0, "GB"),    # peer ts: both included
            ("A4", "U", "M", "D1", 1.0, "2025-01-01 01:30:00", 0, "GB")]
    d = tx(spark, rows)
    roll = {r.transaction_id: r.rolling_amount_last_1h for r in FR.rolling_amount(d).collect()}
    assert roll == {"A1": 10.0, "A2": 25.0, "A3": 25.0, "A4": 26.0}
    dev = {r.transaction_id: r.device_changed for r in FR.device_changes(d).collect()}
    assert dev == {"A1": False, "A2": True, "A3": True, "A4": False}  # NULL device counts as a change
    geo = {r.transaction_id: (r.home_country, r.geo_location_mismatch) for r in FR.geo_mismatch(d).collect()}
    # A3: prior {US:1, NULL:1} tie -> earliest (US); A4: prior {US:1, NULL:1, GB:1} -> US
    assert geo["A2"] == ("US", True) and geo["A3"] == ("US", True) and geo["A4"] == ("US", True)


def test_structured_rules_example(spark):
    df = spark.createDataFrame(
        [(1, 12000.0, 10, True, False, "US", "US", 12), (2, 12000.0, None, True, False, "US", "US", 12),
         (3, 100.0, 500, False, False, "GB", "US", 2)],
        "id int, amount double, account_age_days int, device_is_new boolean, velocity_spike boolean, "
        "country string, home_country string, hour_of_day int")
    got = {r.id: r for r in RU.evaluate_structured(df).collect()}
    assert got[1].rules_hit == ["R001_HIGH_AMOUNT_NEW_ACCOUNT", "R004_HIGH_AMOUNT_NEW_DEVICE"]
    assert got[1].score_delta == pytest.approx(0.65)
    assert got[1].severity == "high"
    assert got[2].rules_hit == []          # NULL age -> neither hits
    assert got[3].rules_hit == ["R003_CROSS_BORDER_ODD_HOURS"] and got[3].severity == "medium"
    dec = {r.id: r.decision for r in RU.final_decision(
        RU.evaluate_structured(df).withColumn("proba", F.lit(0.1))).collect()}
    assert dec == {1: "flag", 2: "allow", 3: "flag"}


def test_flat_rules_unresolvable_gives_zero(spark):
    df = spark.createDataFrame([(6000.0, 10)], "amount double, account_age int")
    rules = [{"name": "r1", "condition": "amount > 5000 and account_age < 30", "action": "flag"},
             {"name": "r2", "condition": "missing_col > 1", "action": "review"}]
    r = RU.evaluate_flat(df, rules).collect()[0]
    assert (r["rule__r1"], r["rule__r2"], r.rule_flag, r.rule_review) == (1, 0, 1, 0)


def test_arm_buckets(spark):
    keys = ["D_A", "D_B", "D_X", "unknown", "7", ""]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: (r.b, r.arm) for r in df.select("k", sha1_mod100("k").alias("b"),
                                               assign_arm("k", 10).alias("arm")).collect()}
    assert {k: got[k][0] for k in keys[:5]} == {"D_A": 39, "D_B": 81, "D_X": 0, "unknown": 46, "7": 38}
    assert [k for k in keys if got[k][1] == "cand"] == ["D_X"]
    assert got[""][1] == "prod"


def test_fraud_context_partitions_agree(spark):
    """One partition and many give identical context rows."""
    from riskspark.sources import tables as T

    tx = T.txn(spark, "/root/testdata/sf0.001")
    cols = ["transaction_id", "rolling_amount_last_1h", "velocity_spike", "home_country", "geo_location_mismatch",
            "device_is_new", "avg_amount_user"]
    a, b, c = ({r.transaction_id: tuple(r) for r in FR.fraud_context(tx, parts=p).select(*cols).collect()} for p in (1, 7, 64))
    assert len(a) == tx.count()
    assert a == b == c


def test_positional_profiles_and_prior_average(spark):
    d = tx(spark)
    last2 = {r.transaction_id: r.rolling_amount_last_1h for r in FR.rolling_amount(d, positional=2).collect()}
    assert last2 == {"T1": 120.5, "T2": 200.5, "T3": 15.75, "T4": 580.0, "T5": 56.0}
    profiles = spark.createDataFrame([("U1", "CA")], "user_id string, home_country string")
    geo = {r.transaction_id: (r.home_country, r.geo_location_mismatch) for r in FR.geo_mismatch(d, profiles=profiles).collect()}
    assert geo == {"T1": ("CA", True), "T2": ("CA", True), "T3": (None, False), "T4": ("CA", False), "T5": (None, False)}
    before = {r.transaction_id: r.avg_amount_before for r in FR.user_prior_avg_amount(d).collect()}
    assert before == {"T1": None, "T2": 120.5, "T3": None, "T4": 100.25, "T5": 15.75}
