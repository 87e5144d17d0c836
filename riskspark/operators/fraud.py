"""Fraud behaviour features (O-23..O-29, O-33, O-34).

Per-row sequence features come from one segmented scan (``riskspark.functions.segscan``): rows
range-partitioned by (user, time), so the rows of any user are spread evenly over the tasks.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.segscan import DAY_US, HOUR_US, scan, ts_micros

MINUTE_US = 60_000_000

# ---- fixed values (rule context parameters of the baseline rule set) -----------------
VELOCITY_WINDOW_MINUTES = 30
VELOCITY_BASELINE_DAYS = 14
VELOCITY_MULTIPLIER = 3.5
# --------------------------------------------------------------------------------------


def with_ts_us(df: DataFrame, ts: str = "ts", out: str = "ts_us") -> DataFrame:
    return df if out in df.columns else df.withColumn(out, ts_micros(ts))


def parse_window(w: str) -> int:
    """'1h' / '30min' / '2h' / '15m' / '1d' / '90s' -> microseconds."""
    s = w.strip().lower()
    for suf, mult in (("min", MINUTE_US), ("ms", 1000), ("us", 1), ("h", HOUR_US), ("d", DAY_US),
                      ("m", MINUTE_US), ("s", 1_000_000)):
        if s.endswith(suf):
            return int(float(s[: -len(suf)]) * mult)
    return int(float(s) * 1_000_000)


def cents(c) -> Column:
    """Amounts as whole cents: running sums that add and take away stay exact."""
    c = F.col(c) if isinstance(c, str) else c
    return (c.cast("decimal(20,2)") * 100).cast("bigint")


def _money(c: str) -> Column:
    return F.col(c) / F.lit(100.0)


def _spike(short_sum: Column, base_sum: Column, base_cnt: Column, multiplier: float) -> Column:
    # short > m * (base_sum / base_cnt)  <=>  short * base_cnt > m * base_sum  (base_cnt > 0),
    # in whole numbers of any size; no baseline -> false.
    m = Fraction(Decimal(str(multiplier)))
    wide = lambda c, k: c.cast("decimal(19,0)") * F.lit(k).cast("decimal(6,0)")
    left = (wide(short_sum, m.denominator).cast("decimal(25,0)") * base_cnt.cast("decimal(13,0)"))
    return F.coalesce(F.when(base_cnt > 0, left > wide(base_sum, m.numerator)), F.lit(False))


def _mismatch(known: Column, country: Column, home: Column) -> Column:
    """A NULL on either side counts as a mismatch; without an earlier row there is none."""
    return F.coalesce(known & (country.isNull() | home.isNull() | (country != home)), F.lit(False))


def rolling_amount(txn: DataFrame, window: str = "1h", user: str = "user_id", ts: str = "ts",
                   tx_id: str = "transaction_id", amount: str = "amount",
                   out: str = "rolling_amount_last_1h", positional: int | None = None,
                   parts: int | None = None) -> DataFrame:
    """O-23: sum of the user's amounts over the half-open window (ts - w, ts] (peers
    with the same ts included); ``positional`` sums the last so many rows by (ts, id)
    instead, whatever their times. ``parts`` tasks share the rows evenly."""
    d = with_ts_us(txn, ts)
    if positional:
        r = scan(d, user, "ts_us", [tx_id], units=cents(amount), last_rows=positional, parts=parts)
        return r.withColumn(out, _money("rows_sum")).drop("rows_sum")
    r = scan(d, user, "ts_us", [tx_id], units=cents(amount), frames={"_roll": (1 - parse_window(window), 0)}, parts=parts)
    return r.withColumn(out, _money("_roll_sum")).drop("_roll_sum", "_roll_cnt")


def velocity_spike(txn: DataFrame, window_minutes: int = VELOCITY_WINDOW_MINUTES,
                   baseline_days: int = VELOCITY_BASELINE_DAYS, multiplier: float = VELOCITY_MULTIPLIER,
                   user: str = "user_id", ts: str = "ts", tx_id: str = "transaction_id",
                   amount: str = "amount", parts: int | None = None) -> DataFrame:
    """O-24: spike = sum(amount) over (ts - 30m, ts] > multiplier x avg(amount) over
    [ts - 14d, ts - 30m]; no baseline rows -> false."""
    w, b = window_minutes * MINUTE_US, baseline_days * DAY_US
    r = scan(with_ts_us(txn, ts), user, "ts_us", [tx_id], units=cents(amount),
             frames={"_short": (1 - w, 0), "_base": (-b, -w)}, parts=parts)
    base_avg = F.when(F.col("_base_cnt") > 0, _money("_base_sum") / F.col("_base_cnt"))
    return (r.withColumn("amount_30m", _money("_short_sum"))
             .withColumn("baseline_avg", base_avg)
             .withColumn("velocity_spike", _spike(F.col("_short_sum"), F.col("_base_sum"), F.col("_base_cnt"),
                                                  multiplier))
             .drop("_short_sum", "_short_cnt", "_base_sum", "_base_cnt"))


def geo_mismatch(txn: DataFrame, user: str = "user_id", ts: str = "ts", tx_id: str = "transaction_id",
                 country: str = "country", profiles: DataFrame | None = None, profile_country: str = "home_country",
                 parts: int | None = None) -> DataFrame:
    """O-28 / O-25: ``home_country`` = modal country of the user's earlier rows (ties ->
    earliest first seen), or, where ``profiles`` (one row per user) is given, the country of
    the user's profile; ``geo_location_mismatch`` = country differs from it (a NULL on
    either side counts as a mismatch); the user's first row, or one without a profile, is false."""
    d = with_ts_us(txn, ts)
    if profiles is not None:
        known = profiles.select(F.col(user).alias("_pu"), F.col(profile_country).alias("home_country"))
        r = d.join(known, d[user].eqNullSafe(known["_pu"]), "left").drop("_pu")
        has = F.col("home_country").isNotNull()
    else:
        r = scan(d, user, "ts_us", [tx_id], mode=country, parts=parts).withColumnRenamed("mode", "home_country")
        has = F.col("has_mode")
    return r.withColumn("geo_location_mismatch", _mismatch(has, F.col(country), F.col("home_country"))).drop("has_mode")


def device_changes(txn: DataFrame, user: str = "user_id", ts: str = "ts", tx_id: str = "transaction_id",
                   device: str = "device_id", parts: int | None = None) -> DataFrame:
    """O-27: changed = the user has an earlier row AND (either device NULL or they differ)."""
    r = scan(with_ts_us(txn, ts), user, "ts_us", [tx_id], prev=device, parts=parts)
    text = F.col(device).cast("string")
    return r.withColumn("device_changed", _mismatch(F.col("has_prev"), text, F.col("prev"))).drop("prev", "has_prev")


def new_device(txn: DataFrame, user: str = "user_id", ts: str = "ts", tx_id: str = "transaction_id",
               device: str = "device_id", parts: int | None = None) -> DataFrame:
    """O-26: ``device_is_new`` on the first row (by (ts, id)) of each (user, device);
    a NULL device is one unknown device."""
    return scan(with_ts_us(txn, ts), user, "ts_us", [tx_id], first=device, parts=parts).withColumnRenamed("first", "device_is_new")


def user_avg_amount(txn: DataFrame, user: str = "user_id", amount: str = "amount",
                    out: str = "avg_amount_user", as_of: str | None = None, ts: str = "ts") -> DataFrame:
    """O-29: the user's mean amount on every row (aggregate + join, no per-user window);
    ``as_of`` (a timestamp literal) takes the mean over rows before it only."""
    value = F.col(amount)
    if as_of:
        value = F.when(F.col(ts) < F.lit(as_of).cast(txn.schema[ts].dataType), value)
    mean = txn.groupBy(F.col(user).alias("_mu")).agg(F.avg(value).alias(out))
    return txn.join(mean, txn[user].eqNullSafe(mean["_mu"]), "left").drop("_mu")


def user_prior_avg_amount(txn: DataFrame, user: str = "user_id", amount: str = "amount", ts: str = "ts",
                          tx_id: str = "transaction_id", out: str = "avg_amount_before", parts: int | None = None) -> DataFrame:
    """O-29, per row: the mean of the user's amounts at times strictly before the row's own, in whole
    cents; NULL where there is none. A row without a time has the user's rows without one."""
    ever = 1 << 60
    r = scan(with_ts_us(txn, ts), user, "ts_us", [tx_id], units=cents(amount), frames={"_before": (-ever, -1)}, parts=parts)
    return r.withColumn(out, F.when(F.col("_before_cnt") > 0, _money("_before_sum") / F.col("_before_cnt"))) \
        .drop("_before_sum", "_before_cnt")


def user_daily_velocity(txn: DataFrame, user: str = "user_id", ts: str = "ts", tx_id: str = "transaction_id",
                        amount: str = "amount", device: str | None = "device_id") -> DataFrame:
    """O-33 + O-27: per (user, date): count, amount (all-NULL -> 0) and device changes,
    folded into one aggregate (no join back; NULL groups kept)."""
    d = device_changes(txn, user, ts, tx_id, device) if device else txn.withColumn("device_changed", F.lit(None))
    g = d.groupBy(F.col(user), F.to_date(F.col(ts)).alias("date")).agg(
        F.count(F.lit(1)).alias("user_txn_count_day"),
        F.coalesce(F.sum(F.col(amount)), F.lit(0.0)).alias("user_txn_amount_day"),
        F.sum(F.col("device_changed").cast("int")).cast("bigint").alias("device_change_count_day"))
    return g


def merchant_chargeback_rate(txn: DataFrame, merchant: str = "merchant_id",
                             chargeback: str | None = "is_chargeback") -> DataFrame:
    """O-34: per merchant (NULL kept): count, chargebacks (NULL if none recorded), rate."""
    cb = F.sum(F.col(chargeback)).cast("bigint") if chargeback else F.lit(0).cast("bigint")
    g = txn.groupBy(merchant).agg(F.count(F.lit(1)).alias("txn_count"), cb.alias("chargeback_count"))
    return g.withColumn("merchant_chargeback_rate",
                        F.try_divide(F.col("chargeback_count").cast("double"), F.col("txn_count").cast("double")))


def fraud_context(txn: DataFrame, user: str = "user_id", ts: str = "ts", tx_id: str = "transaction_id",
                  amount: str = "amount", country: str = "country", device: str = "device_id",
                  parts: int | None = None) -> DataFrame:
    """Rule context for every transaction: rolling 1h amount, velocity spike, home country /
    geo mismatch, new device, user mean amount.

    All features come from one scan: the rows are exchanged once, by ranges of (user, time), and
    every input row comes back once, whatever ids or times repeat or are missing.
    """
    w30 = VELOCITY_WINDOW_MINUTES * MINUTE_US
    frames = {"_roll": (1 - HOUR_US, 0), "_short": (1 - w30, 0), "_base": (-VELOCITY_BASELINE_DAYS * DAY_US, -w30)}
    r = scan(with_ts_us(txn, ts), user, "ts_us", [tx_id], units=cents(amount), frames=frames, mode=country, first=device,
             total=F.avg(F.col(amount)), parts=parts)
    return r.withColumns({
        "rolling_amount_last_1h": _money("_roll_sum"),
        "velocity_spike": _spike(F.col("_short_sum"), F.col("_base_sum"), F.col("_base_cnt"), VELOCITY_MULTIPLIER),
        "geo_location_mismatch": _mismatch(F.col("has_mode"), F.col(country), F.col("mode")),
    }).withColumnsRenamed({"mode": "home_country", "first": "device_is_new", "total": "avg_amount_user"}) \
        .drop("has_mode", *[f"{f}_{x}" for f in frames for x in ("sum", "cnt")])


def signup_account_age(txn: DataFrame, events: DataFrame, user: str = "user_id", ts: str = "ts",
                       default: int = 9999) -> DataFrame:
    """O-18: account age in days at each transaction from the user's first signup event
    (aggregate per user + join); no signup -> default."""
    from riskspark.functions.coerce import days_between

    su = events.where(F.col("event_type") == "signup").groupBy(user).agg(F.min("ts").alias("_created"))
    j = txn.join(su, txn[user].eqNullSafe(su[user]), "left").drop(su[user])
    return j.withColumn("account_age_from_signup", days_between(F.col(ts), F.col("_created"), default)).drop("_created")
