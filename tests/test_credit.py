"""Credit operators on the hand-computed loan fixture (FIXTURES F1, F2)."""

import pytest
from pyspark.sql import functions as F

from riskspark.operators import credit as CR

LOANS = [
    ("B001", 10000.0, 60000.0, 0, "12.5%", "Charged Off", "A", "MS", 2022),
    ("B002", 45000.0, 40000.0, 1, "44.0%", "Default", "C", "CO", 2012),
    ("B003", 8000.0, 60000.0, 0, "15%", "Write Off", "A", "OK", 2019),
    ("B004", 18000.0, 160000.0, 0, "11%", "Written Off", "A", "WA", 2007),
    ("B005", 500000.0, 90000.0, 1, "10%", "Current", "B", "LA", 2023),
    ("B006", 5000.0, 120000.0, 0, "5%", "Fully Paid", "A", "PA", 2020),
]
SCHEMA = ("borrower_id string, loan_amount double, annual_income double, delinq_2yrs int, revol_util string, "
          "loan_status string, grade string, state string, vintage_year int")


def test_borrower_features_fixture(spark):
    df = spark.createDataFrame(LOANS, SCHEMA)
    got = {r.borrower_id: r for r in CR.borrower_features(df).collect()}
    exp_ratio = {"B001": 6.0, "B002": 0.888889, "B003": 7.5, "B004": 8.888889, "B005": 0.18, "B006": 24.0}
    exp_util = {"B001": 12.5, "B002": 44.0, "B003": 15.0, "B004": 11.0, "B005": 10.0, "B006": 5.0}
    for b in exp_ratio:
        assert got[b].income_to_loan_ratio == pytest.approx(exp_ratio[b], abs=1e-6)
        assert got[b].credit_utilization_pct == pytest.approx(exp_util[b])
        assert got[b].n_records == 1


def test_default_labels_fixture(spark):
    df = spark.createDataFrame(LOANS, SCHEMA)
    got = {r.borrower_id: r.default_flag for r in CR.default_labels(df, "borrower_id").collect()}
    assert [got[f"B00{i}"] for i in range(1, 7)] == [1, 1, 1, 1, 0, 0]


def test_edge_rows_keep_first_and_junk(spark):
    rows = LOANS + [("B007", 0.0, None, 0, "n/a", "Current", None, "TX", 2021),
                    ("B001", 20000.0, 60000.0, 2, "20%", "Current", "Z", "ZZ", 1999)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("loan_id", F.monotonically_increasing_id())
    feats = {r.borrower_id: r for r in CR.borrower_features(df, carry=["grade"], carry_order="loan_id").collect()}
    assert feats["B007"].income_to_loan_ratio is None       # amount 0 -> NULL, not inf
    assert feats["B007"].credit_utilization_pct is None      # 'n/a' -> NULL
    assert feats["B001"].n_records == 2
    assert feats["B001"].income_to_loan_ratio == pytest.approx((6.0 + 3.0) / 2)
    assert feats["B001"].num_past_delinquencies == 2
    assert feats["B001"].grade == "A"                        # keep-first by loan_id
    # the generic keep-first left join gives the same first row
    j = CR.left_join_keep_first(spark.createDataFrame([("B001",)], "borrower_id string"),
                                df.select("borrower_id", "loan_id", "grade"), "borrower_id", ["loan_id"])
    assert j.collect()[0].grade == "A"


SEG = [("A", "MS", 2022, 10000.0, 0.7093806204607123, 3192.212792073205),
       ("A", "OK", 2019, 8000.0, 0.6886062676294299, 2478.9825634659474),
       ("A", "PA", 2020, 5000.0, 0.2259704242377429, 508.43345453492157),
       ("A", "WA", 2007, 18000.0, 0.632775257097084, 5125.479582486381),
       ("B", "LA", 2023, 500000.0, 0.8487925308973514, 190978.31945190407),
       ("C", "CO", 2012, 45000.0, 0.9241226312501832, 18713.48328281621)]


def test_expected_loss_and_rollup_golden(spark):
    df = spark.createDataFrame([(f"B{i}", *r[:3], r[3], r[4]) for i, r in enumerate(SEG)],
                               "borrower_id string, grade string, state string, vintage_year int, "
                               "loan_amount double, PD double")
    scored = CR.expected_loss(df, ead_col="loan_amount")
    roll = {(r.grade, r.state): r for r in CR.segment_rollup(scored).collect()}
    for g, s, _, ead, _, el in SEG:
        assert roll[(g, s)].total_EL == pytest.approx(el, rel=1e-12)
        assert roll[(g, s)].total_EAD == ead
        assert roll[(g, s)].borrowers == 1
    p = CR.portfolio_summary(scored).collect()[0]
    assert p.total_EL == pytest.approx(220996.9111272808, rel=1e-12)
    assert p.avg_PD == pytest.approx(0.6716079552620839, rel=1e-12)
    assert p.n == 6
