"""Smaller operators: rule files, label autoscan, keep-last, stress, reason codes,
request validation, expectations on contracts, alias-driven features."""

import pytest
from pyspark.sql import functions as F

from riskspark.functions import coerce as C
from riskspark.operators import credit as CR
from riskspark.operators import drift as DR
from riskspark.operators import rules as RU


def test_rule_file_both_dialects(spark, tmp_path):
    flat = tmp_path / "flat.yml"
    flat.write_text("- name: High Amount, New Account\n  condition: amount > 5000 and account_age < 30\n  action: flag\n")
    rules = RU.load_rules(str(flat))
    df = spark.createDataFrame([(6000.0, 10), (6000.0, 40)], "amount double, account_age int")
    got = [r["rule__High Amount, New Account"] for r in RU.evaluate_flat(df, rules).orderBy("account_age").collect()]
    assert got == [1, 0]
    structured = tmp_path / "rules.yml"
    structured.write_text(
        "defaults: {action: review, score_delta: 0.2, severity: medium}\n"
        "rules:\n"
        "  - id: R9\n    params: {hours: [1, 2]}\n    when: {all: ['tx.hour_of_day in params.hours']}\n"
        "    effect: {reasons: [night]}\n"
        "  - id: R10\n    enabled: false\n    when: {all: ['tx.amount >= 0']}\n")
    r = RU.evaluate_structured(spark.createDataFrame([(1, 5.0)], "hour_of_day int, amount double"),
                               RU.load_rules(str(structured))).collect()[0]
    assert r.rules_hit == ["R9"] and r.score_delta == pytest.approx(0.2) and r.severity == "medium"
    assert r.reasons == ["night"]


def test_autoscan_and_binary_labels(spark):
    df = spark.createDataFrame([("b1", "x", "charged off"), ("b2", "y", "ok")], "id string, note string, outcome2 string")
    assert CR.autoscan_status_column(df) == "outcome2"
    lab = spark.createDataFrame([("b1", "yes"), ("b1", "no"), ("b2", "0")], "id string, Default_Flag string")
    got = {r.id: r.default_flag for r in CR.default_labels(lab, "id").collect()}
    assert got == {"b1": 1, "b2": 0}


def test_keep_last_and_stress(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 20.0), ("b", 1, 5.0)], "k string, v int, x double")
    assert {r.k: r.x for r in CR.dedupe_keep_last(df, ["k"], ["v"]).collect()} == {"a": 20.0, "b": 5.0}
    assert {r.k: r.x for r in CR.dedupe_keep_first(df, ["k"], ["v"]).collect()} == {"a": 10.0, "b": 5.0}
    s = spark.createDataFrame([(0.8, 0.45, 100.0)], "PD double, LGD double, EAD double")
    sc = spark.createDataFrame([("adverse", 1.5, 1.2)], "scenario string, pd_mult double, lgd_mult double")
    r = CR.stress_el(s, sc).collect()[0]
    assert r.EL_stressed == pytest.approx(1.0 * 0.54 * 100.0)  # PD capped at 1


def test_reason_codes_order(spark):
    df = spark.createDataFrame([(0.5, 3.0, 90.0, 12)], "income_to_loan_ratio double, num_past_delinquencies double, "
                                                       "credit_utilization_pct double, n_records long")
    top = CR.reason_codes(df, k=2).collect()[0].top_features
    # |contributions|: ratio 0.6, delinq 2.7, util 1.8, n 0.24
    assert top == ["num_past_delinquencies", "credit_utilization_pct"]


def test_validate_requests(spark):
    df = spark.createDataFrame([(10.0, None, "us", None, None), (-1.0, 5, "USA", "d", 30)],
                               "amount double, account_age_days int, country string, device_id string, hour_of_day int")
    rows = C.validate_requests(df).orderBy("amount").collect()
    assert rows[0].errors == ["amount", "country", "hour_of_day"] and not rows[0].valid
    assert rows[1].valid and rows[1].account_age_days == 365 and rows[1].country == "US"
    assert rows[1].device_id == "unknown" and rows[1].hour_of_day == 12


def test_psi_clip_option_and_guard(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    cur = spark.createDataFrame([(float(i),) for i in range(5, 25)], "x double")
    dropped = DR.psi_numeric(ref, cur, ["x"]).collect()[0].psi
    clipped = DR.psi_numeric(ref, cur, ["x"], out_of_range="clip").collect()[0].psi
    assert clipped > dropped > 0
    g = DR.feature_guard(DR.tag_samples(ref, cur), ["x"]).collect()[0]
    assert g.keep and g.n_ref == 10 and g.n_cur == 20
    assert DR.psi_categorical(ref.where("x < 0"), cur, ["x"]).collect()[0].psi is None


def test_alias_resolution_in_features(spark):
    df = spark.createDataFrame([("m1", "1000", "50000", "2", 300.0, 1000.0)],
                               "member_id string, loan_amnt string, annual_inc string, delinq_2yrs string, "
                               "revol_bal double, total_rev_hi_lim double")
    r = CR.borrower_features(df).collect()[0]
    assert r.member_id == "m1" and r.income_to_loan_ratio == 50.0 and r.credit_utilization_pct == pytest.approx(30.0)
    assert r.num_past_delinquencies == 2.0
    assert F is not None


def test_flat_rules_are_analysed_by_spark(spark):
    from riskspark.operators.rules import evaluate_flat

    df = spark.createDataFrame([(100, "US", "D_1"), (5, "7", None)], "amount int, country string, device_id string")
    rules = [{"name": n, "condition": c} for n, c in (
        ("div", "amount div 10 > 3"), ("ilike", "device_id ilike 'd%'"), ("text", "country > 5"), ("fn", "nosuchfn(amount) > 1"),
        ("col", "absent = 1"), ("syntax", "amount > and"), ("case", "AMOUNT between 1 and 10"), ("cast", "cast(country as int) = 7"),
        ("lit", "country = 'cast(x)'"), ("number", "amount"))]
    got = evaluate_flat(df, rules).collect()
    assert [tuple(r[f"rule__{x['name']}"] for x in rules) for r in got] == [(1, 1, 0, 0, 0, 0, 0, 0, 0, 1), (0, 0, 1, 0, 0, 0, 1, 1, 0, 1)]


def test_structured_rules_ignore_case_and_absent_operands(spark):
    from riskspark.operators.rules import evaluate_structured

    rules = {"rules": [{"id": "A", "when": {"any": ["tx.absent == 1", "tx.Amount > 10"]}}]}
    got = evaluate_structured(spark.createDataFrame([(20.0,), (1.0,)], "AMOUNT double"), rules).orderBy("AMOUNT").collect()
    assert [r.rules_hit for r in got] == [[], ["A"]]


def test_el_column_choice():
    from riskspark.functions.coerce import pick_el_column

    assert pick_el_column(["grade", "label", "total_EL"]) == "total_EL"
    assert pick_el_column(["model_ts", "Expected_Loss"]) == "Expected_Loss"
    assert pick_el_column(["EL_x", "loss_rate"]) == "loss_rate" and pick_el_column(["a", "EL_x"]) == "EL_x"
    assert pick_el_column(["grade", "model"]) is None
