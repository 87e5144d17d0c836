"""The segmented scan against plain Python, on data with ties, NULLs and keys over many partitions."""

import random

import pytest
from pyspark.sql import functions as F

from riskspark.functions import segscan as SS

DAY, HOUR = SS.DAY_US, SS.HOUR_US
PARTS = [1, 3, 17, 60]


def data(seed=3, n=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        u = rnd.choice([1, 1, 1, 2, 3, None]) if i % 50 else 1
        t = rnd.randrange(0, 4 * DAY, 600_000_000) if i % 40 else None  # 10-minute grid: many ties, some without a time
        rows.append((i, u, t, rnd.choice([None, 100, 250, 1000, 725]), rnd.choice(["US", "GB", None, "CA"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, u long, t long, v long, c string")


def of_key(rows, u):
    first = lambda x: (x is not None, x if x is not None else 0)
    return sorted([r for r in rows if r[1] == u], key=lambda r: (first(r[2]), r[0]))


def brute(rows, frames, last):
    out = {}
    for u in {r[1] for r in rows}:
        seq, counts, devices = of_key(rows, u), {}, set()
        known = [r[3] for r in seq if r[3] is not None]
        for k, r in enumerate(seq):
            got = {}
            for name, (lo, hi) in frames.items():
                vals = [x[3] for x in seq if x[3] is not None and (x[2] is None if r[2] is None else
                        x[2] is not None and r[2] + lo <= x[2] <= r[2] + hi)]
                got[f"{name}_cnt"], got[f"{name}_sum"] = len(vals), sum(vals) if vals else None
            got["mode"], got["has_mode"] = (max(counts, key=counts.get), True) if counts else (None, False)
            got["prev"], got["has_prev"] = (seq[k - 1][4], True) if k else (None, False)
            got["first"] = r[4] not in devices
            tail = [x[3] for x in seq[max(0, k + 1 - last): k + 1] if x[3] is not None]
            got["rows_sum"] = sum(tail) if tail else None
            got["total"] = sum(known) / len(known)
            counts[r[4]] = counts.get(r[4], 0) + 1
            devices.add(r[4])
            out[r[0]] = got
    return out


@pytest.mark.parametrize("parts", PARTS)
def test_all_features_match_brute_force(spark, parts):
    rows = data()
    frames = {"a": (1 - HOUR, 0), "b": (-2 * DAY, -1_800_000_000), "after": (1, HOUR), "ever": (-(1 << 60), -1)}
    got = SS.scan(frame(spark, rows), "u", "t", ["id"], units=F.col("v"), frames=frames, mode="c", first="c", prev="c",
                  last_rows=3, total=F.avg("v"), parts=parts).collect()
    want = brute(rows, frames, 3)
    assert len(got) == len(rows)
    for r in got:
        assert {k: r[k] for k in want[r.id]} == want[r.id], (r.id, parts)


@pytest.mark.parametrize("ask", [{"mode": "c"}, {"first": "c"}, {"prev": "c"}, {"last_rows": 4}, {"frames": {"a": (1 - HOUR, 0)}}])
def test_each_feature_alone_over_many_partitions(spark, ask):
    """Each asks for other columns in the exchange that both passes read."""
    rows = data(5)
    units = {"units": F.col("v")} if "frames" in ask or "last_rows" in ask else {}
    got = SS.scan(frame(spark, rows), "u", "t", ["id"], parts=13, **ask, **units).collect()
    want = brute(rows, ask.get("frames", {}), ask.get("last_rows", 1))
    names = [n for n in got[0].asDict() if n not in ("id", "u", "t", "v", "c")]
    assert names and len(got) == len(rows)
    for r in got:
        assert all(r[n] == want[r.id][n] for n in names), r


def test_one_exchange_serves_both_passes(spark):
    df = SS.scan(frame(spark, data(2)), "u", "t", ["id"], mode="c", parts=7)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange rangepartitioning") == 2 and plan.count("ReusedExchange") == 1


def test_constant_key_empty_table_and_many_keys(spark):
    rows = [(i, None, i, 1, str(i % 3)) for i in range(50)]
    d = frame(spark, rows).withColumn("k", F.lit("all"))
    got = {r.id: r for r in SS.scan(d, "k", "t", ["id"], prev="c", units=F.col("v"), last_rows=5, parts=9).collect()}
    assert all(got[i].prev == (str((i - 1) % 3) if i else None) and got[i].rows_sum == min(i + 1, 5) for i in range(50))
    assert SS.scan(d.limit(0), "k", "t", ["id"], prev="c").collect() == []
    each = SS.scan(frame(spark, [(i, i, 5, 2, "x") for i in range(400)]), "u", "t", ["id"], mode="c", first="c", parts=5).collect()
    assert len(each) == 400 and all(r["first"] and not r.has_mode for r in each)


def test_a_hot_key_lies_in_many_partitions(spark):
    rows = [(i, 7, i * 1000, 1, "a") for i in range(3000)] + [(10_000 + i, i, 5, 1, "b") for i in range(3000)]
    dealt = frame(spark, rows).repartitionByRange(20, "u", "t").withColumn("p", F.spark_partition_id())
    assert dealt.where("u = 7").select("p").distinct().count() >= 8
    got = SS.scan(frame(spark, rows), "u", "t", ["id"], units=F.col("v"), frames={"a": (-(1 << 60), 0)}, parts=20).where("u = 7 and id < 5000")
    assert got.where("a_sum <> id + 1 + (case when id * 1000 >= 5 then 1 else 0 end)").count() == 0


ODD = [(1, 10.0, "US", "D1", "2024-01-01 10:00:00"), (1, 5.0, "US", "D1", "2024-01-01 10:20:00"), (1, 7.0, "GB", "D2", "2024-01-01 10:20:00"),
       (None, 3.0, "GB", "D2", "2024-01-01 10:25:00"), (2, 2.0, None, None, None), (3, 4.0, "US", "D1", None),
       (4, 1.0, "CA", "D3", "2024-01-03 11:00:00"), (4, 1.0, "CA", "D3", "2024-01-03 11:00:00"), (None, 9.0, "CA", None, "2024-01-03 11:10:00")]


def odd_rows(spark):
    """One user: a repeated id, a repeated row, missing ids and times."""
    rows = [(i, 7, a, c, d, t) for i, a, c, d, t in ODD] + [(9, None, 1.0, "US", "D1", "2024-01-01 00:00:00")]
    return spark.createDataFrame(rows, "transaction_id long, user_id long, amount double, country string, device_id string, s string") \
        .withColumn("ts", F.col("s").cast("timestamp_ntz")).drop("s")


def test_every_row_is_kept_whatever_the_partitions(spark):
    from riskspark.operators import fraud as FR

    df = odd_rows(spark)
    for f in (FR.rolling_amount, FR.velocity_spike, FR.geo_mismatch, FR.device_changes, FR.new_device, FR.fraud_context):
        one = f(df, parts=1)
        cols = sorted(one.columns)
        want = sorted(map(str, one.select(*cols).collect()))
        assert len(want) == df.count()
        for parts in (4, 30):
            assert sorted(map(str, f(df, parts=parts).select(*cols).collect())) == want, (f.__name__, parts)


def test_checkpoint_folder_by_master():
    from riskspark.session import is_local

    assert [is_local(m) for m in ("local", "local[4]", "local[*]", "local[2,3]", "local-cluster[3,2,3000]", "yarn", None,
                                  "k8s://https://kubernetes.default.svc.cluster.local", "spark://x.local:7077")] \
        == [True] * 4 + [False] * 5
