"""File scans and sinks: dated files, evolving unions, dated parquet overwrite, CSV."""

from pyspark.sql import functions as F

from riskspark.functions import coerce as C
from riskspark.sources import files as FS


def test_dated_files_and_latest_two(spark, tmp_path):
    for d, v in (("20251001", 1.0), ("20251002", 2.0), ("20251003", 3.0)):
        spark.createDataFrame([(f"B{d}", v)], "borrower_id string, PD double").write.parquet(
            str(tmp_path / f"pd_scores_{d}.parquet"))
    df = FS.with_file_date(spark.read.parquet(str(tmp_path / "pd_scores_*.parquet")))
    got = sorted(r.PD for r in FS.latest_n_dates(df, 2).collect())
    assert got == [2.0, 3.0]


def test_union_evolving_and_dated_overwrite(spark, tmp_path):
    a = spark.createDataFrame([("2025-10-01", "A", 1)], "as_of_date string, grade string, n int")
    b = spark.createDataFrame([("2025-10-02", "B", 2, 0.5)], "as_of_date string, grade string, n int, avg_PD double")
    u = FS.union_evolving([a, b])
    assert sorted(u.columns) == ["as_of_date", "avg_PD", "grade", "n"] and u.count() == 2
    out = str(tmp_path / "rollups")
    FS.write_dated_parquet(u, out)
    FS.write_dated_parquet(spark.createDataFrame([("2025-10-02", "C", 9, 0.1)], u.schema), out)  # re-run one day
    back = {(str(r.as_of_date), r.grade) for r in spark.read.parquet(out).collect()}
    assert back == {("2025-10-01", "A"), ("2025-10-02", "C")}


def test_csv_tolerant_and_flatten(spark, tmp_path):
    p = tmp_path / "loans.csv"
    p.write_text("borrower_id,loan_amount,revol_util\nB1,100,12.5%\nB2,abc,n/a\n")
    df = FS.read_csv_tolerant(spark, str(p), types={"loan_amount": "double"})
    rows = {r.borrower_id: r for r in df.withColumn("u", C.coerce_percent("revol_util")).collect()}
    assert rows["B1"].loan_amount == 100.0 and rows["B1"].u == 12.5
    assert rows["B2"].loan_amount is None and rows["B2"].u is None
    nested = spark.createDataFrame([(1, (2.0, "US"), ["a", "b"])], "id int, tx struct<amount:double,country:string>, r array<string>")
    flat = C.flatten_struct(nested)
    assert flat.columns == ["id", "tx.amount", "tx.country", "r"]
    assert flat.collect()[0]["r"] == '["a","b"]'


def test_aliases_and_locale(spark):
    df = spark.createDataFrame([("1,234 ", "x")], "Loan_Amnt string, LOAN_STATUS string")
    assert C.pick_col(df, ["loan_amount", "loan_amnt"], case_insensitive=True) == "Loan_Amnt"
    assert C.pick_col_fuzzy(df, "loan_status") == "LOAN_STATUS"
    assert df.select(C.locale_number("Loan_Amnt")).collect()[0][0] == 1234.0
    r = C.rename_aliases(df, {"loan_amount": ["loan_amnt"]}, case_insensitive=True)
    assert "loan_amount" in r.columns
    assert df.select(C.chargeback_flag(F.lit("Y")), C.chargeback_flag(F.lit("maybe"))).collect()[0] == (1, 0)


def test_scratch_folders_go(spark):
    from riskspark import session as SE
    from riskspark.streaming.ops import path_exists, work_dir

    app = spark.sparkContext.applicationId
    before = SE._SCRATCH.pop(app, [])  # those of other tests stay
    table = SE.stage_table(spark.range(5))
    folder = work_dir(spark, "t_scratch")
    spark.range(2).write.parquet(folder)
    made = list(SE._SCRATCH[app])
    assert table.count() == 5 and len(made) == 2 and all(path_exists(spark, p) for p in made)
    assert SE.clear_scratch(spark) == 2 and not any(path_exists(spark, p) for p in made) and app not in SE._SCRATCH
    SE._SCRATCH[app] = before
