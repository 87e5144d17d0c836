"""Streaming operators equal their batch twins on complete input."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskspark.operators import fraud as FR
from riskspark.streaming import ops as S

SF = "/root/testdata/sf0.001"


def test_stateful_features_equal_batch(spark):
    out = S.work_dir(spark, "t_state")
    path = S.run_append_stream(S.stateful_user_features(
        S.event_files(spark, SF, 3, disorder=True, closing=True).stream(spark), "60 days"), out)
    got = spark.read.parquet(path).toPandas().set_index("transaction_id").sort_index()
    from riskspark.sources import tables as T

    tx = T.txn(spark, SF)
    roll = FR.rolling_amount(tx).select("transaction_id", "rolling_amount_last_1h").toPandas()
    geo = FR.geo_mismatch(tx).select("transaction_id", "home_country", "geo_location_mismatch").toPandas()
    exp = roll.merge(geo, on="transaction_id").set_index("transaction_id").sort_index()
    assert len(got) == len(exp)
    pd.testing.assert_series_equal(got["rolling_amount_last_1h"].round(2), exp["rolling_amount_last_1h"].round(2),
                                   check_names=False)
    assert (got["geo_location_mismatch"] == exp["geo_location_mismatch"]).all()
    assert (got["home_country"].fillna("-") == exp["home_country"].fillna("-")).all()


class _State:
    """What the stateful function uses of Spark's group state."""

    def __init__(self):
        self.get, self.exists, self.mark, self.timeout = None, False, 0, None

    def getCurrentWatermarkMs(self):
        return self.mark

    def update(self, value):
        self.get, self.exists = value, True

    def remove(self):
        self.get, self.exists = None, False

    def setTimeoutTimestamp(self, t):
        assert t > self.mark
        self.timeout = t


def _user_rows(n=240, users=5):
    r = np.random.default_rng(7)
    pick = lambda k, c: [None if x == 0 else f"{c}{x}" for x in r.integers(0, k, n)]
    amount = [None if r.random() < 0.1 else round(float(x), 2) for x in r.random(n) * 100 * np.where(r.random(n) < 0.1, 40, 1)]
    return pd.DataFrame({"user": r.integers(0, users, n), "id": np.arange(n), "ts_us": r.integers(0, 30 * 1440, n) // 7 * 7 * FR.MINUTE_US // 4,
                         "amount": pd.Series(amount, dtype="float64"), "country": pick(4, "C"), "device_id": pick(6, "D"),
                         "row": [f"r{k}" for k in range(n)]})


def _expected(df):
    out = {}
    for _, g in df.groupby("user"):
        rows = sorted(g.itertuples(), key=lambda x: (x.ts_us, x.id))
        for k, x in enumerate(rows):
            cents = lambda lo, hi: [round(y.amount * 100) for y in rows if lo <= y.ts_us < hi and y.amount == y.amount]
            roll, short = cents(x.ts_us - S.ROLL_US + 1, x.ts_us + 1), cents(x.ts_us - S.SHORT_US + 1, x.ts_us + 1)
            base = cents(x.ts_us - S.BASE_US, x.ts_us - S.SHORT_US + 1)
            seen = [y.country for y in rows[:k]]
            home = max(dict.fromkeys(seen), key=seen.count) if seen else None
            out[x.row] = (sum(roll) / 100 if roll else None, bool(base) and 2 * sum(short) * len(base) > 7 * sum(base), home,
                          bool(seen) and (home is None or x.country is None or home != x.country),
                          x.device_id not in [y.device_id for y in rows[:k]])
    return out


def test_one_call_works_on_all_users_of_a_key():
    df, state, got = _user_rows(), _State(), {}
    day = 86_400_000
    late = df["id"] % 7 == 0  # these come a batch after the others of their time
    part = df["ts_us"] * 3 // (df["ts_us"].max() + 1) + late
    for k, mark in enumerate((0, 2 * day, 4 * day, 6 * day, 500 * day)):
        state.mark = mark
        new = df[(part == k) & (df["ts_us"] >= mark * 1000)]
        if k == 2:
            df = df[~((part == k) & (df["ts_us"] < mark * 1000))]  # Spark drops what is later than the watermark
            part = part[df.index]
        for o in S._user_features((0,), iter([new[::2], new[1::2]]), state, None):
            for x in o.itertuples(index=False):
                assert x.row not in got
                got[x.row] = tuple(None if v is None or v != v else v for v in x[1:])
        if mark < 500 * day:
            assert state.timeout > mark
    seen = df[df["row"].isin(got)]
    assert len(seen) == len(got) > 200
    assert got == _expected(seen)


def test_idle_users_leave_the_state_of_their_key():
    df, state = _user_rows(), _State()
    df.loc[df["user"] == 1, "ts_us"] += 90 * FR.DAY_US
    list(S._user_features((0,), iter([df]), state, 10 * FR.DAY_US))
    state.mark = 60 * 86_400_000
    assert len(pd.concat(S._user_features((0,), iter([]), state, 10 * FR.DAY_US))) == (df["user"] != 1).sum()
    assert {u for t in map(S._unpack, state.get) for u in t["user"].to_pylist()} == {1}
    state.mark = 200 * 86_400_000
    assert len(pd.concat(S._user_features((0,), iter([]), state, 10 * FR.DAY_US))) == (df["user"] == 1).sum()
    assert not state.exists


def test_state_keys_grow_with_the_rows():
    assert S.EventFiles("", 1, 100).keys == S.MIN_KEYS
    for rows in (10**6, 36 * 10**6, 10**9):
        assert S.KEY_ROWS * 0.9 < rows / S.EventFiles("", 1, rows).keys <= S.KEY_ROWS


def test_daily_kpi_stream_equals_batch(spark):
    out = S.work_dir(spark, "t_daily")
    path = S.run_upsert_stream(S.daily_txn_kpis(S.txn_stream(spark, SF, glob="events.parquet")), ["w"], out, F.col("w.start"))
    got = {r.d: (r.txns, round(r.amount, 2)) for r in
           S.read_upserted(spark, path).select(F.to_date("w.start").alias("d"), "txns", "amount").collect()}
    from riskspark.sources import tables as T

    exp = {r.d: (r.n, round(r.a, 2)) for r in T.txn(spark, SF).groupBy(F.to_date("ts").alias("d"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("a")).collect()}
    assert got == exp


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
