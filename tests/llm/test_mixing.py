import random

from pyspark.sql import functions as F

from riskspark.llm.mixing import _hypergeometric, mix, mix_documents, shuffled_shards


def reshare(sizes):
    """Targets by repeated resharing, as the contract words it."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, out, free = float(sum(sizes.values())), {}, set(names)
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        full = [s for s in free if share[s] > 3 * sizes[s]]
        if not full:
            return out | share
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def table(spark, rng, n):
    rows, k = [], 0
    for s, c in (("b", n), ("a", 3), ("é", n // 4), ("Z", 9), (None, 20), ("hot", 2 * n), ("empty", 4)):
        for _ in range(c):
            m = 0 if s == "empty" else rng.choice([0, 1, 5, 30, 400])
            rows.append((k, " ".join(["w"] * m) if m or rng.random() < .5 else None, s, k))
            k += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string, taken long")


def test_targets_and_draws(spark):
    df = table(spark, random.Random(1), 300)
    got = mix_documents(df).select("row.*", "size", "source_size", "target", F.col("taken").alias("t"), "draws").collect()
    assert len(got) == df.count()
    sizes = {}
    for r in got:
        assert r["size"] == len((r["text"] or "").split())
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = reshare(sizes)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {sizes[s]}
        assert all(abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) for r in mine)
        block = max(1, -(-sizes[s] // 8192))
        assert abs(sum(r["t"] for r in mine) - want[s]) <= block + 1
    assert all(0 <= r["t"] <= 3 * r["size"] for r in got)
    # shards: disjoint draws, nearly equal block counts
    blocks = {}
    for r in got:
        for d in r["draws"]:
            blocks.setdefault((r["source"], d["pass"], d["block"]), set()).add(d["shard"])
    assert all(len(v) == 1 for v in blocks.values())
    per = [sum(1 for v in blocks.values() if i in v) for i in range(16)]
    assert max(per) - min(per) <= 16 and min(per) > 0
    again = mix_documents(df.repartition(7)).select("row.doc_id", "taken").collect()
    assert {(r[0], r[1]) for r in again} == {(r["doc_id"], r["t"]) for r in got}
    out = shuffled_shards(mix_documents(df))
    assert out.agg(F.sum("words")).first()[0] == sum(r["t"] for r in got)


def test_hypergeometric_moments(spark):
    df = spark.range(4000).select(_hypergeometric(F.lit(500), F.lit(120), F.lit(200), F.rand(3)).alias("x"))
    r = df.agg(F.avg("x"), F.var_samp("x"), F.min("x"), F.max("x")).first()
    assert abs(r[0] - 48) < .5 and abs(r[1] / (200 * .24 * .76 * 300 / 499) - 1) < .15 and r[2] >= 0 and r[3] <= 120
    edge = spark.range(1).select(_hypergeometric(F.lit(0), F.lit(0), F.lit(0), F.lit(.5)).alias("a"),
                                 _hypergeometric(F.lit(10), F.lit(10), F.lit(4), F.lit(.5)).alias("b"),
                                 _hypergeometric(F.lit(10), F.lit(3), F.lit(10), F.lit(.5)).alias("c")).first()
    assert tuple(edge) == (0, 4, 3)


def test_empty_and_sizeless(spark):
    df = table(spark, random.Random(2), 4)
    assert mix_documents(df.limit(0)).collect() == []
    none = mix(df, F.col("source"), F.lit(0), F.col("doc_id")).collect()
    assert len(none) == df.count() and all(r["taken"] == 0 and r["target"] == 0 for r in none)


def test_the_tree_decides_the_shards(spark, monkeypatch):
    """Other quotas from the tree, and trees of few sources: other shards, the same words from every source."""
    from riskspark.llm import mixing as M

    df = table(spark, random.Random(3), 40)
    shards = lambda m: {(r["row"]["doc_id"], d["pass"], d["block"]): d["shard"] for r in m.collect() for d in r["draws"]}
    one = shards(mix_documents(df))
    other = shards(mix(df, F.col("source"), M.word_count(F.col("text")), F.struct("doc_id", F.xxhash64("text")), shards=5))
    assert one.keys() == other.keys() and max(other.values()) <= 4 < max(one.values())
    monkeypatch.setattr(M, "TREE_SOURCES", 2)
    small = shards(mix_documents(df))
    assert small.keys() == one.keys() and small != one


def test_many_small_sources_meet_their_targets(spark):
    rows = [(i * 10 + k, "w " * (1 + (i + k) % 4), f"s{i:05d}") for i in range(3000) for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    off = mix_documents(df).groupBy("row.source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).where("abs(t - target) > 0.5 + 1e-9")
    assert off.count() == 0


def test_whole_documents_come_by_shard_and_place(spark):
    from riskspark.llm.mixing import whole_copies

    df = table(spark, random.Random(5), 60)
    out = whole_copies(mix_documents(df), parts=7).withColumn("part", F.spark_partition_id()).collect()
    keys = [(r["part"], r["shard"], r["place"]) for r in out]
    assert keys == sorted(keys) and {r["shard"] for r in out} == set(range(16))
    by_shard = {}
    for r in out:
        by_shard.setdefault(r["shard"], []).append((r["part"], r["place"]))
    assert all(v == sorted(v) for v in by_shard.values())
