import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from riskspark.llm.mixing import mix_documents


def test_stages_keep_columns_and_take_effect(spark):
    d = "/root/testdata/sf0.001"
    docs = P.table(spark, d, "documents")
    cols, n = docs.columns, docs.count()
    counts = [n]
    for name, f in P.STAGES[:-1]:
        docs = P.stage(f(spark, docs, d), f"{P.stage_dir(spark)}/{name}")
        assert docs.columns == cols, name
        counts.append(docs.count())
        if name == "near_dedup":
            assert docs.select("doc_id").distinct().count() == counts[-1]
    assert counts[1] < n and counts[2] == counts[1] and counts[3] < counts[2] and counts[4] > 0
    out = P.STAGES[-1][1](spark, docs, d)
    assert out.count() == counts[4] and out.where(F.col("n_tokens") == 0).count() == 0


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b c", "en", None, 5), (3, "", "en", "s", 0),
            (4, "x y z " * 2000, "en", "s", 1), (4, "x y z " * 2000, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, f in P.STAGES:
            got = f(spark, df, "").collect()
            if name == "near_dedup":
                assert len(got) == (5 if df.count() else 0)  # one of the two copies with text goes; wordless rows are no copies


def test_mix_meets_targets(spark):
    """Kept words of each source against its target, with documents far longer and far shorter than a block."""
    rng = random.Random(4)
    for scale in (1, 40):  # total words under 65,536 (blocks of one word), and far over
        rows = []
        for s, n, sizes in (("a", 60, (300, 5)), ("b", 40, (150, 1)), ("c", 30, (90, 30, 2)), (None, 20, (200,)), ("hot", 120, (250, 1))):
            rows += [(len(rows) + k if s != "b" else None, " ".join([f"w{k}"] * rng.choice(sizes)), "en", s, 0) for k in range(n * scale)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        plan = {r["source"]: r for r in mix_documents(df).groupBy("row.source").agg(
            F.first("target").alias("target"), F.first("source_size").alias("size"), F.max("size").alias("longest")).collect()}
        words = F.size(F.split("text", " "))
        got = P.mixed(spark, df, "").groupBy("source").agg(F.sum(words).alias("kept"), F.count(F.lit(1)).alias("n")).collect()
        kept = {r["source"]: r["kept"] for r in got}
        assert any(p["target"] % p["size"] / p["size"] < .5 for p in plan.values())
        for s, p in plan.items():
            assert abs(kept.get(s, 0) - p["target"]) <= p["longest"] + 1, (scale, s)
