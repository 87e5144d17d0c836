"""Drift, KPIs, model quality, experiments, contracts (FIXTURES F4, F9, F10, F12)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import drift as DR
from riskspark.operators import experiments as EX
from riskspark.operators import metrics as M
from riskspark.operators import quality as QL
from riskspark.operators import rollups as RO

# two samples of our own: numbers with ties and a shift, categories with one missing and one new
REF = {"amount": [5, 8, 8, 13, 21, 34, 55, 70], "proba": [.04, .04, .1, .2, .3, .5, .6, .9],
       "latency_ms": [3, 4, 4, 5, 6, 9, 12, 20], "decision": ["allow"] * 5 + ["review", "flag", "flag"],
       "channel": ["web", "web", "app", "app", "app", "pos", "pos", "web"]}
CUR = {"amount": [6, 9, 20, 22, 40, 68], "proba": [.05, .2, .2, .4, .7, .8], "latency_ms": [4, 5, 5, 8, 11, 19],
       "decision": ["allow", "allow", "review", "review", "flag", "allow"], "channel": ["web", "app", "atm", "atm", "app", "app"]}
NUMBERS = ["amount", "proba", "latency_ms"]
SCHEMA = "amount double, proba double, latency_ms double, decision string, channel string"


def frame(spark, d):
    rows = [tuple(float(v) if isinstance(v, (int, float)) else v for v in r) for r in zip(*d.values())]
    return spark.createDataFrame(rows, SCHEMA)


def psi_by_hand(ref, cur, eps=DR.PSI_EPS):
    """Index over shares smoothed by eps, from bin counts."""
    r, c = ([(x + eps) / (sum(n) + eps * len(n)) for x in n] for n in (ref, cur))
    return sum((y - x) * math.log(y / x) for x, y in zip(r, c))


def bins_by_hand(values, edges):
    n = [0] * (len(edges) - 1)
    for v in values:
        if edges[0] <= v <= edges[-1]:
            n[min(sum(e <= v for e in edges) - 1, len(n) - 1)] += 1
    return n


def test_psi_by_hand(spark):
    ref, cur = frame(spark, REF), frame(spark, CUR)
    num = {r.feature: r.psi for r in DR.psi_numeric(ref, cur, NUMBERS).collect()}
    for f in NUMBERS:
        edges = sorted(set(np.quantile(REF[f], [i * 0.1 for i in range(11)]).tolist()))
        assert num[f] == pytest.approx(psi_by_hand(bins_by_hand(REF[f], edges), bins_by_hand(CUR[f], edges)), abs=1e-9)
    cat = {r.feature: r.psi for r in DR.psi_categorical(ref, cur, ["channel"]).collect()}
    names = sorted(set(REF["channel"]) | set(CUR["channel"]))
    assert cat["channel"] == pytest.approx(psi_by_hand([REF["channel"].count(x) for x in names], [CUR["channel"].count(x) for x in names]), abs=1e-9)


def test_psi_identity_and_constant(spark):
    ref = frame(spark, REF)
    same = {r.feature: r.psi for r in DR.psi_numeric(ref, ref, ["amount", "proba"]).collect()}
    assert all(abs(v) < 1e-12 for v in same.values())
    const = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert DR.psi_numeric(const, const, ["x"]).collect()[0].psi is None


def test_drift_table_order_and_sentinel(spark):
    t = DR.drift_table(frame(spark, REF), frame(spark, CUR), NUMBERS, ["channel"]).collect()
    assert [r.psi for r in t] == sorted((r.psi for r in t), reverse=True) and len(t) == 4
    assert [r.feature for r in DR.drift_table(frame(spark, REF), frame(spark, CUR), [], []).collect()] == ["(no features)"]


def test_drift_alerts_fire(spark):
    kpis = M.monitor_kpis(frame(spark, CUR), by=())
    assert kpis.first().flag_rate > 0
    drift = DR.drift_table(frame(spark, REF), frame(spark, CUR), NUMBERS, ["channel"])
    graded = drift.withColumn("severity", F.when(F.col("psi") >= 0.25, "error").otherwise("info"))
    kept = graded.where(DR.meets_threshold(F.col("severity"), "error")).count()
    assert 0 < kept == graded.where("psi >= 0.25").count()


def test_monitor_kpis_by_hand(spark):
    k = M.monitor_kpis(frame(spark, CUR), by=()).collect()[0]
    assert (k.requests, k.flag_rate, k.review_rate) == (6, pytest.approx(1 / 6), pytest.approx(2 / 6))
    assert k.mean_proba == pytest.approx(np.mean(CUR["proba"])) and k.p95_latency_ms == pytest.approx(np.quantile(CUR["latency_ms"], .95))


Y = [0, 0, 1, 1, 0, 1]
P = [.1, .4, .35, .8, .4, .4]


def test_model_quality_fixture(spark):
    df = spark.createDataFrame(list(zip(P, Y)), "p double, y int")
    a = M.roc_auc(df, "p", "y").collect()[0]
    assert a.auc == pytest.approx(0.666667, abs=1e-6) and a.gini == pytest.approx(0.333333, abs=1e-6)
    assert M.ks_stat(df, "p", "y").collect()[0].ks == pytest.approx(0.333333, abs=1e-6)
    assert M.average_precision(df, "p", "y").collect()[0].average_precision == pytest.approx(0.7)
    assert M.brier(df, "p", "y").collect()[0].brier == pytest.approx(0.192083, abs=1e-6)


def test_auc_bruteforce_random(spark):
    import random

    rnd = random.Random(7)
    rows = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "p double, y int")
    pos = [p for p, y in rows if y == 1]
    neg = [p for p, y in rows if y == 0]
    exp = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg) / (len(pos) * len(neg))
    assert M.roc_auc(df, "p", "y").collect()[0].auc == pytest.approx(exp, abs=1e-12)


def test_threshold_grid_and_pr(spark):
    df = spark.createDataFrame(list(zip(P, Y)), "p double, y int")
    g = M.threshold_recall_grid(df, "p", "y").collect()[0]
    # recall >= 0.9 needs all 3 positives: cuts <= 0.35 -> best precision 0.6 (cuts 0.15..0.35), first wins
    assert g.threshold == pytest.approx(0.15) and g.rule == "recall_target"
    t = M.threshold_pr_f1(df, "p", "y").collect()[0]
    assert t.threshold == pytest.approx(0.35) and t.recall == 1.0


def test_promotion_labels_missing(spark):
    arms = spark.createDataFrame([("prod", 10, 10.4, None, None, None), ("cand", 2, 4.8, None, None, None)],
                                 "arm string, n long, p95_latency_ms double, precision double, recall double, fpr double")
    r = EX.promotion_decision(arms).collect()[0]
    assert r.promoted and r.labels_missing and r.reason == "Promoted"
    r2 = EX.promotion_decision(arms.where("arm = 'prod'")).collect()[0]
    assert not r2.promoted and r2.reason == "Missing arms"


def test_expectation_mostly_boundary(spark):
    df = spark.createDataFrame([(0.5,)] * 99 + [(2.0,)], "proba double")
    r = QL.run_expectations(df, [QL.expect_between("proba", 0, 1, mostly=0.99),
                                 QL.expect_between("proba", 0, 1, mostly=0.995)]).collect()
    assert r[0].success and not r[1].success and r[0].observed == pytest.approx(0.99)


def test_upsert_last_wins(spark):
    old = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-02", 2.0)], "date string, v double")
    new = spark.createDataFrame([("2024-01-02", 20.0, "x"), ("2024-01-03", 3.0, "y")], "date string, v double, w string")
    got = {r.date: (r.v, r.w) for r in RO.upsert(old, new, ["date"]).collect()}
    assert got == {"2024-01-01": (1.0, None), "2024-01-02": (20.0, "x"), "2024-01-03": (3.0, "y")}


def test_calibration_bins(spark):
    rows = [(i / 100.0, 1 if i % 3 == 0 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "pd double, y int")
    bins = {r.bin: r for r in DR.calibration_bins(df, "pd", "y").collect()}
    assert sorted(bins) == list(range(1, 11)) and sum(b.n for b in bins.values()) == 100
    assert bins[1].n == 10 and bins[1].mean_pd == pytest.approx(0.045)
    assert not math.isnan(DR.calibration_slope(DR.calibration_bins(df, "pd", "y")).collect()[0].slope)


def test_trailing_baseline_excludes_today(spark):
    daily = spark.createDataFrame([(f"2024-01-{d:02d}", float(d)) for d in range(1, 11)], "date string, v double") \
                 .withColumn("date", F.to_date("date"))
    got = {r.date.day: r.v_trailing for r in RO.trailing_baseline(daily, ["v"]).collect()}
    assert got[1] is None and got[2] == 1.0 and got[9] == pytest.approx(sum(range(2, 9)) / 7)


def test_decision_log_reader_tolerant(spark, tmp_path):
    from riskspark.sources import files as FS

    p = tmp_path / "log.jsonl"
    p.write_text("\n".join([
        '{"ts": "2025-10-01T10:00:00", "arm": "prod", "tx": {"amount": 12.5, "account_age_days": 3, '
        '"country": "us", "device_id": "D1", "hour_of_day": 10}, "proba": 0.1, "decision": "allow", '
        '"rules_hit": ["R1"], "latency_ms": 10, "model_ts": "m"}',
        "",
        "{not json",
        '{"ts": "2025-10-01T11:00:00", "tx": {"amount": 5.0}, "proba": 0.9, "latency_ms": 7}',
    ]) + "\n")
    good = FS.read_decision_log(spark, str(p)).orderBy("ts").collect()
    assert len(good) == 2
    assert good[0].country == "US" and good[0].rules_count == 1 and good[0].arm == "prod"
    assert good[1].decision == "allow" and good[1].rules_hit == [] and good[1].arm is None
    bad = FS.read_decision_log(spark, str(p), quarantine=True).collect()
    assert [r.raw_line for r in bad] == ["{not json"]


def test_psi_by_period_matches_single(spark):
    ref, cur = frame(spark, REF), frame(spark, CUR)
    both = cur.withColumn("d", F.lit("p1")).unionByName(ref.withColumn("d", F.lit("p2")))
    got = {(r.period, r.feature): r.psi for r in
           DR.psi_numeric_by_period(ref, both, NUMBERS, "d").collect()}
    whole = {r.feature: r.psi for r in DR.psi_numeric(ref, cur, NUMBERS).collect()}
    for f in NUMBERS:
        assert got[("p1", f)] == pytest.approx(whole[f], abs=1e-9)
        assert abs(got[("p2", f)]) < 1e-12   # PSI(x, x) = 0
