"""Saved models, splits and folds, changing files, file times, sketches."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import scoring as SC
from riskspark.operators import sketches as SK
from riskspark.sources import files as FS
from riskspark.streaming.ops import work_dir


def test_share_and_folds_by_rarity():
    assert [SC.test_share({0: 1000, 1: n}) for n in (1, 2, 5, 1000)] == [10, 25, 25, 25]
    assert [SC.fold_count({0: 1000, 1: n}) for n in (1, 2, 3, 50)] == [0, 2, 3, 3]
    with pytest.raises(ValueError):
        SC.test_share({0: 10, 1: 0})


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows = [(i, x := rng.gauss(0, 1), rng.gauss(0, 1), 1.0 if x + rng.gauss(0, .7) > 1 else 0.0) for i in range(240)]
    return spark.createDataFrame(rows, "id long, x double, z double, y double").cache()


def test_saved_model_round_trip_and_feature_list(spark, data):
    model, scored = SC.train_calibrated(data, ["x", "z", "y"], "y", "id")
    assert model.features == ["x", "z"] and model.folds == 3 and scored.count() == 240 and scored.where("oof is null").count() == 0
    path = work_dir(spark, "t_model")
    model.save(path)
    loaded = SC.ScoreModel.load(spark, path)
    a = {r.id: r.PD for r in model.score(data).collect()}
    other = data.select(F.lit(1).alias("more"), F.col("z").cast("string").alias("Z"), "id", "x")
    b = {r.id: r.PD for r in loaded.score(other).collect()}
    assert all(abs(a[i] - b[i]) < 1e-12 and 0 <= a[i] <= 1 for i in a) and "more" in loaded.score(other).columns
    odd = spark.createDataFrame([(1, float("nan")), (2, None), (3, float("inf")), (4, 0.0)], "id long, x double")  # z is absent
    assert len({round(r.PD, 12) for r in loaded.score(odd).collect()}) == 1


def test_calibration_beats_none_and_rare_classes_have_no_folds(spark, data):
    model, scored = SC.train_calibrated(data, ["x"], "y", "id")
    brier = lambda df, c: df.agg(F.avg(F.pow(F.col(c) - F.col("y"), 2))).first()[0]
    assert brier(model.score(data), "PD") < brier(scored, "oof")  # balanced weights overstate the rarer class
    few = data.where("y = 0").limit(20).unionByName(data.where("y = 1").limit(1))
    one, rows = SC.train_calibrated(few, ["x"], "y", "id")
    assert one.folds == 0 and one.sigmoids == [None] and rows.where("fold is not null").count() == 0


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("boolean", "int", "int"), ("int", "string", "string"), ("date", "timestamp", "timestamp"),
    ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(10,2)", "int", "double"), ("array<int>", "array<string>", "array<string>"),
    ("struct<a:int>", "struct<a:double,b:string>", "struct<a:double,b:string>"), ("struct<a:int>", "int", "string"), ("float", "double", "double"), ("void", "int", "int")])
def test_wider_types(spark, a, b, want):
    kind = lambda t: spark.createDataFrame([], f"c {t}").schema["c"].dataType
    for x, y in ((a, b), (b, a)):
        assert FS.wider_type(kind(x), kind(y)).simpleString() == kind(want).simpleString()


def test_evolving_files_with_nested_and_renamed_case(spark):
    at = work_dir(spark, "t_evolving")
    spark.createDataFrame([(1, (5,), [1, 2])], "id int, s struct<a:int>, l array<int>").write.parquet(f"{at}/d1")
    spark.createDataFrame([("two", (1.5, "b"), ["x"], True)], "ID string, s struct<a:double,b:string>, l array<string>, ok boolean").write.parquet(f"{at}/d2")
    spark.createDataFrame([(3, "plain")], "id long, s string").write.parquet(f"{at}/d3")
    got = FS.read_evolving(spark, f"{at}/d*")
    assert [f.name for f in got.schema.fields] == ["id", "s", "l", "ok"] and got.schema["id"].dataType == T.StringType()
    assert {r.id: (r.s, r.l, r.ok) for r in got.collect()} == {"1": ('{"a":5}', ["1", "2"], None), "two": ('{"a":1.5,"b":"b"}', ["x"], True), "3": ("plain", None, None)}
    with pytest.raises(FileNotFoundError):
        FS.read_evolving(spark, f"{at}/none*")


def test_file_times(spark):
    import time

    at = work_dir(spark, "t_times")
    spark.range(3).write.parquet(f"{at}/in")
    time.sleep(.02)
    spark.range(3).write.parquet(f"{at}/out")
    stale = lambda: FS.stale_against(spark.read.parquet(f"{at}/out"), spark.read.parquet(f"{at}/in")).first()["stale"]
    assert stale() is False
    time.sleep(.02)
    spark.range(4).write.mode("overwrite").parquet(f"{at}/in")
    assert stale() is True


def test_sketches_merge_within_their_bound(spark):
    d = spark.range(50_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 2).alias("odd"), (F.rand(5) * 100).alias("v"))
    d = d.unionByName(spark.createDataFrame([(99, 0, None), (99, 0, float("nan"))], "day long, odd long, v double"))
    d.cache()
    days = SK.value_sketches(d, ["day"], "v")
    assert {r.day: r.n for r in days.collect()}[99] == 0
    whole = SK.sketch_quantiles(SK.merge_sketches(days.withColumn("all", F.lit(1)), ["all"]), {"p50": .5, "p99": .99})
    for name, p in (("p50", .5), ("p99", .99)):
        r = SK.rank_error(d.withColumn("all", F.lit(1)), whole, ["all"], "v", name, p).first()
        assert r.n == 50_000 and r.rank_error <= SK.RANK_ERROR
    assert SK.sketch_quantiles(days, {"p": .5}).where("day = 99").first()["p"] is None


def test_contract_of_the_rows_as_they_are_written(spark):
    from riskspark.operators import quality as QL

    at = work_dir(spark, "t_checked")
    d = spark.createDataFrame([("a", .5), ("b", 1.5), (None, None)], "borrower_id string, PD double")
    suites = {"pd": QL.pd_scores_suite(), "health": [QL.expect_between("PD", 0, 2), QL.expect_exists("nothing")]}
    got = QL.write_checked(d, at, suites).collect()
    want = [r for name, suite in suites.items() for r in QL.run_expectations(spark.read.parquet(at), suite, name).collect()]
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str) and not all(r.success for r in got)
    assert QL.write_checked(d.limit(0), at, {"pd": QL.pd_scores_suite()}).where("idx = 4").first()["success"] is False


def test_a_repeated_key_ends_the_validated_join(spark):
    from riskspark.operators.credit import left_join_keep_first

    left = spark.createDataFrame([(1,), (2,)], "k int")
    once, twice = (spark.createDataFrame(rows, "k int, v int") for rows in ([(1, 5), (None, 6)], [(1, 5), (1, 6)]))
    assert {(r.k, r.v) for r in left_join_keep_first(left, once, "k", ["v"], validate=True).collect()} == {(1, 5), (2, None)}
    checked = left_join_keep_first(left, twice, "k", ["v"], validate=True)  # no job yet
    with pytest.raises(Exception, match="duplicate k"):
        checked.collect()


def test_folds_are_cut_once(spark, data):
    _, scored = SC.train_calibrated(data, ["x", "z"], "y", "id")
    assert "Window" not in scored._jdf.queryExecution().optimizedPlan().toString()  # the cuts are read, not found again


def test_tree_training_tasks_are_bounded_by_rows(spark, data, monkeypatch):
    from riskspark.operators import ml as ML

    seen, weigh = [], ML.balanced_weights
    monkeypatch.setattr(ML, "TRAIN_ROWS", 50, raising=False)
    monkeypatch.setattr(ML, "balanced_weights", lambda d, label: (seen.append(d.rdd.getNumPartitions()), weigh(d, label))[1])
    ML.train_gbt(data.coalesce(1), ["x", "z"], [], "y", max_iter=1)
    assert seen == [5]


def test_decision_log_is_written_in_batches_by_rows(spark, monkeypatch):
    from riskspark.plans import fraud as PF

    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key, None)
    monkeypatch.setattr(PF, "_LOG_TABLES", {})
    monkeypatch.setattr(PF, "score_log", lambda s, sf: (seen.append(s.conf.get(key, None)), s.range(1))[1])
    PF.decision_log_table(spark, "/root/testdata/sf0.001")
    assert seen == [str((1 << 31) - 1)] and spark.conf.get(key, None) == before
