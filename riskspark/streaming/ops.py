"""Structured Streaming operators (O-89..O-97).

* O-89 file streams (decision-log JSON lines, transaction parquet) with explicit schemas;
* O-92 tumbling daily KPIs with a watermark, kept exact by an *update*-mode stream whose
  ``foreachBatch`` upserts each micro-batch's changed windows into a versioned table
  (O-97), so the final table equals the batch aggregate;
* O-93 sliding 30-minute velocity windows;
* O-94 stream-static enrichment (broadcast merchant rates) + rules + decision;
* O-96 late-data bound and duplicate removal within the watermark;
* O-90/O-91 exact per-user rolling amount and prior-mode country with
  ``applyInPandasWithState`` (state = the users' baseline amounts, country counts, devices and
  waiting rows, as compressed Arrow tables; one call works on all users of a key).

Checkpoints and sink tables live under the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster), so a restarted query resumes after executor or driver loss.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType

from riskspark.operators import fraud as FR
from riskspark.operators import rules as RU
from riskspark.session import ensure_checkpoint_dir, scratch
from riskspark.sources import files as FS
from riskspark.sources import tables as T
from riskspark.sources.snapshots import SnapshotTable

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

ROLL_US = FR.HOUR_US
SHORT_US = FR.VELOCITY_WINDOW_MINUTES * FR.MINUTE_US
BASE_US = FR.VELOCITY_BASELINE_DAYS * FR.DAY_US


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return scratch(spark, os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex[:8]}"))


def txn_stream(spark: SparkSession, path: str, max_files: int | None = 1, glob: str | None = None) -> DataFrame:
    """O-89: event files in a folder as a stream, ``max_files`` to a micro-batch, projected to
    transactions; with ``glob`` only files of such names."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return T.txn_from_events(r.parquet(path.rstrip("/"))).withColumn("ts", F.col("ts").cast("timestamp"))


@dataclass(frozen=True)
class EventFiles:
    """A folder of event files in time order; every part of it is ``files`` files, ``rows`` events in all."""

    path: str
    files: int
    rows: int

    def stream(self, spark: SparkSession) -> DataFrame:
        """The transactions, a part to a micro-batch."""
        return txn_stream(spark, self.path, self.files)

    @property
    def keys(self) -> int:
        """State keys for the users of these events."""
        return max(MIN_KEYS, -(-self.rows // KEY_ROWS))


def decision_log_stream(spark: SparkSession, path: str) -> DataFrame:
    """O-89 / O-03: JSON-lines decision log as a stream (blank and malformed lines dropped,
    the same parsing as the batch reader)."""
    from pyspark.sql import types as T_

    raw = spark.readStream.text(path).where(F.length(F.trim(F.col("value"))) > 0)
    raw = raw.where(F.get_json_object(F.col("value"), "$").isNotNull())
    schema = T_.StructType([f for f in FS.DECISION_LOG_SCHEMA.fields if f.name != "_corrupt_record"])
    r = raw.select(F.from_json(F.col("value"), schema).alias("r")).select("r.*")
    return r.select(
        F.try_to_timestamp("ts").alias("ts"), "arm", "tx.*", "proba",
        F.coalesce(F.col("decision"), F.lit("allow")).alias("decision"),
        F.coalesce(F.col("rules_hit"), F.array().cast("array<string>")).alias("rules_hit"), "latency_ms")


def daily_txn_kpis(stream: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """O-92: tumbling one-day windows: transactions, amount, chargebacks, distinct-free."""
    return (stream.withWatermark("ts", watermark)
            .groupBy(F.window("ts", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("txns"), F.sum("amount").alias("amount"),
                 F.sum("is_chargeback").cast("bigint").alias("chargebacks"),
                 F.max("amount").alias("max_amount")))


def sliding_velocity(stream: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """O-93: per user, 30-minute windows sliding every 5 minutes (bucketed form)."""
    return (stream.withWatermark("ts", watermark)
            .groupBy("user_id", F.window("ts", "30 minutes", "5 minutes").alias("w"))
            .agg(F.count(F.lit(1)).alias("txns"), F.sum("amount").alias("amount")))


def dedupe_late(stream: DataFrame, key: str = "transaction_id", watermark: str = "1 hour") -> DataFrame:
    """O-96: rows later than the watermark are dropped; duplicates of a key within it too."""
    return stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark([key])


def enrich_and_score(stream: DataFrame, merchant_rates: DataFrame, rules=RU.BASELINE_RULES,
                     threshold: float = RU.DEFAULT_FRAUD_THRESHOLD) -> DataFrame:
    """O-94: stream x static merchant table (one row per merchant), rules, model score,
    decision. The stream must carry the rule context (:func:`stateful_user_features`); a rule
    whose fields are absent is false. The merchant table is not force-broadcast (its size
    grows with the merchant base); Spark broadcasts it only under the runtime size
    threshold and otherwise plans a shuffled stream-static join."""
    s = stream.join(merchant_rates.select("merchant_id", "merchant_chargeback_rate"), "merchant_id", "left")
    s = RU.evaluate_structured(s, rules)
    s = s.withColumn("proba", F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("amount") - F.lit(6000.0)) / F.lit(2000.0))))
    return RU.final_decision(s, threshold=threshold)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def parquet_files(spark: SparkSession, path: str) -> list[str]:
    """The data files in a folder, oldest first (their number is bounded by the writes that made them)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    files = sorted(found, key=lambda f: (f.getModificationTime(), f.getPath().getName()))
    return [f.getPath().toString() for f in files if f.getPath().getName().endswith(".parquet")]


#: Rows of an event file.
FILE_ROWS = 1_000_000
#: Events to a key of the user state, and the least number of keys.
KEY_ROWS, MIN_KEYS = 4096, 64


def event_files(spark: SparkSession, sf_dir: str, parts: int = 4, disorder: bool = False, closing: bool = False) -> EventFiles:
    """The events table in ``parts`` parts in time order, for streams of several micro-batches.

    The table is read once and dealt to a folder for each part; each part then lands in turn as
    so many files as its rows ask for. ``disorder`` moves every seventh row to the next part, so
    events arrive late; ``closing`` adds a last file with one event of user -1 far in the future,
    which moves the watermark past all others (and itself waits for later events for ever)."""
    out, dealt = work_dir(spark, "event_files"), work_dir(spark, "event_parts")
    ev = T.read_table(spark, sf_dir, "events").select(*[c.split()[0] for c in EVENTS_SCHEMA.split(", ")])
    b = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (b["lo"], b["hi"]))
    span = F.unix_micros(hi.cast("timestamp")) - F.unix_micros(lo.cast("timestamp")) + 1
    part = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(lo.cast("timestamp"))) * parts / span)
    if disorder:
        part = F.least(F.lit(parts - 1), part + (F.col("event_id") % 7 == 0).cast("long"))
    ev.withColumn("_part", F.coalesce(part, F.lit(0)).cast("int")).write.partitionBy("_part").parquet(dealt)
    files = max(1, -(-b["n"] // (parts * FILE_ROWS)))
    for k in range(parts):  # one landing each: the file source takes files by modification time
        if path_exists(spark, f"{dealt}/_part={k}"):
            spark.read.schema(EVENTS_SCHEMA).parquet(f"{dealt}/_part={k}").repartition(files).write.mode("append").parquet(out)
    remove(spark, dealt)
    if closing:
        last = spark.range(1).select(
            F.lit(None).cast("bigint").alias("event_id"), (hi + F.expr("INTERVAL 400 DAYS")).alias("ts"),
            F.lit(-1).cast("bigint").alias("user_id"), F.lit(None).cast("string").alias("event_type"),
            F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("props"))
        last.write.mode("append").parquet(out)
    return EventFiles(out, files, b["n"])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def run_upsert_stream(agg: DataFrame, key_cols: list[str], out_dir: str, day: Column) -> str:
    """O-97: run an update-mode aggregate; every micro-batch upserts its changed rows into
    the table below ``out_dir``; returns the table's path (read it with :func:`read_upserted`).

    The table is a :class:`riskspark.sources.snapshots.SnapshotTable` by ``day`` (a date of the row,
    e.g. of its window): an epoch reads and writes only the days it touches, spread by the hash
    of their keys, and is one commit. With the same ``out_dir`` a restarted query goes on from
    what is there, and a retried epoch finds itself committed. Old folders go every few epochs."""
    spark = agg.sparkSession
    table = SnapshotTable(spark, os.path.join(out_dir, "table"))

    def sink(batch: DataFrame, epoch: int) -> None:
        if table.upsert(batch, key_cols, day, epoch, writer="stream") and epoch % VACUUM_EPOCHS == VACUUM_EPOCHS - 1:
            table.vacuum(keep=2)

    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", os.path.join(out_dir, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    if not table.versions():
        raise RuntimeError("stream produced no batches")
    return table.path


#: Epochs between two clean-ups of a stream's table.
VACUUM_EPOCHS = 8


def read_upserted(spark: SparkSession, table: str) -> DataFrame:
    """The current rows of a table written by :func:`run_upsert_stream`."""
    return SnapshotTable(spark, table).read()


def run_append_stream(df: DataFrame, out_dir: str) -> str:
    """Append-mode stream to a parquet table (exactly-once file sink)."""
    path = os.path.join(out_dir, "table")
    q = (df.writeStream.outputMode("append").format("parquet").option("path", path)
         .option("checkpointLocation", os.path.join(out_dir, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return path


# ---- O-90 / O-91 and the rule context: stateful per-user features ----------------------------

STATE_SCHEMA = "past binary, homes binary, devices binary, last binary, waiting binary"
OUT_SCHEMA = ("row string, rolling_amount_last_1h double, velocity_spike boolean, home_country string, "
              "geo_location_mismatch boolean, device_is_new boolean")
TEXT = pa.large_string()


def _pack(t: pa.Table) -> bytes:
    """A table as one compressed value of the state."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return out.getvalue().to_pybytes()


def _unpack(b: bytes) -> pa.Table:
    with pa.ipc.open_stream(b) as r:
        return r.read_all()


def _ints(t: pa.Table, c: str) -> np.ndarray:
    return t[c].to_numpy()


def _codes(*cols: pa.ChunkedArray) -> tuple[list[np.ndarray], pa.Array]:
    """Numbers of the values of several columns, and the values; NULL is a value too."""
    d = pc.dictionary_encode(pa.chunked_array([k for c in cols for k in c.chunks], cols[0].type).combine_chunks(),
                             null_encoding="encode")
    at = np.cumsum([len(c) for c in cols])[:-1]
    return np.split(d.indices.to_numpy(zero_copy_only=False).astype(np.int64), at), d.dictionary


def _window_sums(user: np.ndarray, ts: np.ndarray, cents: np.ndarray, known: np.ndarray, of: np.ndarray,
                 bounds: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each (lo, hi): sum and count of the known amounts with lo <= ts < hi of the user ``of``; rows sorted by (user, ts)."""
    s, n = np.concatenate([[0], np.cumsum(cents * known)]), np.concatenate([[0], np.cumsum(known)])
    times = np.unique(ts)  # places among the times: (user, place) is one number, whatever the times are
    width = len(times) + 1
    keys = user * width + np.searchsorted(times, ts)
    out = []
    for lo, hi in bounds:
        a, b = (np.searchsorted(keys, of * width + np.searchsorted(times, x)) for x in (lo, hi))
        out.append((s[b] - s[a], n[b] - n[a]))
    return out


def _prior_modes(user: np.ndarray, value: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Most frequent earlier value of the user before each row (ties to the first seen; -1: no earlier row), the first
    row of each (user, value) in order, and its total. Row k stands for ``n[k]`` rows; a user's rows are in order."""
    rows = np.arange(len(user))
    _, first, pair = np.unique(user * (value.max(initial=0) + 1) + value, return_index=True, return_inverse=True)
    by_pair = np.argsort(pair, kind="stable")
    total = np.cumsum(n[by_pair])
    starts = np.searchsorted(pair[by_pair], np.arange(len(first)))
    ends = np.append(starts[1:], len(user)) - 1
    before = total[starts] - n[by_pair][starts]
    count = np.empty(len(user), np.int64)
    count[by_pair] = total - before[pair[by_pair]]
    # the value whose latest row has the greatest (count, first sight reversed) is the mode
    ranked = np.lexsort((-first[pair], count))
    rank = np.empty_like(rows)
    rank[ranked] = rows
    by_user = np.argsort(user, kind="stable")
    base = user[by_user] * len(user)
    best = value[ranked[np.maximum.accumulate(base + rank[by_user]) - base]]
    same = user[by_user][1:] == user[by_user][:-1]
    prior = np.full(len(user), -1, np.int64)
    prior[by_user[1:][same]] = best[:-1][same]
    order = np.argsort(first)
    return prior, first[order], (total[ends] - before)[order]


#: Rows of an output batch.
STEP_ROWS = 20_000


def _input_rows(df: pd.DataFrame) -> pa.Table:
    text = lambda c: pa.array(df[c], TEXT, from_pandas=True)
    return pa.table({
        "user": pa.array(df["user"]), "ts": df["ts_us"].to_numpy(np.int64), "id": df["id"].to_numpy(np.int64),
        "cents": np.rint(df["amount"].fillna(0).to_numpy(np.float64) * 100).astype(np.int64),
        "known": df["amount"].notna().to_numpy(), "country": text("country"), "device": text("device_id"), "row": text("row")})


def _user_features(key, pdfs: Iterator[pd.DataFrame], state: GroupState, idle_us: int | None) -> Iterator[pd.DataFrame]:
    """The rows of a key's users; ``row`` is the whole input row. Rows wait in the state until the watermark has passed
    them, then leave in event-time order of their user."""
    new = [_input_rows(df) for df in pdfs if len(df)]
    if state.exists:
        past, homes, devices, last, waiting = (_unpack(b) for b in state.get)
    else:
        waiting = new[0].slice(0, 0)
        past = waiting.select(["user", "ts", "cents", "known"])
        homes = waiting.select(["user", "country"]).append_column("n", pa.chunked_array([], pa.int64()))
        devices, last = waiting.select(["user", "device"]), waiting.select(["user", "ts"])
    mark = state.getCurrentWatermarkMs() * 1000
    rows = pa.concat_tables([waiting, *new])
    is_ready = _ints(rows, "ts") < mark  # a row at the watermark itself may still get peers
    waiting, ready = rows.filter(pa.array(~is_ready)), rows.filter(pa.array(is_ready))
    if len(ready):
        (user,), _ = _codes(ready["user"])
        ready = ready.take(pa.array(np.lexsort((_ints(ready, "id"), _ints(ready, "ts"), user))))
        (u_past, u_homes, u_devices, user), _ = _codes(*(t["user"] for t in (past, homes, devices, ready)))
        ts = _ints(ready, "ts")
        sums = pa.concat_tables([past, ready.select(past.column_names)])
        order = np.lexsort((_ints(sums, "ts"), np.concatenate([u_past, user])))
        (roll, n_roll), (short, _), (base, n_base) = _window_sums(
            np.concatenate([u_past, user])[order], *(_ints(sums, c)[order] for c in ("ts", "cents", "known")), user,
            [(ts - ROLL_US + 1, ts + 1), (ts - SHORT_US + 1, ts + 1), (ts - BASE_US, ts - SHORT_US + 1)])
        past = sums.take(pa.array(order))
        m = Fraction(str(FR.VELOCITY_MULTIPLIER))

        (c_homes, country), names = _codes(homes["country"], ready["country"])
        home, kept, n = _prior_modes(np.concatenate([u_homes, user]), np.concatenate([c_homes, country]),
                                     np.concatenate([_ints(homes, "n"), np.ones(len(ready), np.int64)]))
        home = home[len(homes):]
        homes = pa.concat_tables([homes.select(["user", "country"]), ready.select(["user", "country"])]).take(pa.array(kept)) \
            .append_column("n", pa.array(n))
        unknown = np.array([not v.is_valid for v in names], bool)
        differs = (home >= 0) & ((home != country) | unknown[country])
        home = names.take(pa.array(home, mask=home < 0))

        (d_known, device), kinds = _codes(devices["device"], ready["device"])
        first = np.sort(np.unique(np.concatenate([u_devices, user]) * len(kinds) + np.concatenate([d_known, device]), return_index=True)[1])
        fresh = np.zeros(len(ready), bool)
        fresh[first[first >= len(devices)] - len(devices)] = True
        devices = pa.concat_tables([devices, ready.select(["user", "device"])]).take(pa.array(first))

        last = pa.concat_tables([last, ready.select(["user", "ts"])]).group_by("user").aggregate([("ts", "max")]) \
            .rename_columns(["user", "ts"])
        for a in range(0, len(ready), STEP_ROWS):
            b = min(a + STEP_ROWS, len(ready))
            yield pd.DataFrame({
                "row": ready["row"].slice(a, b - a).to_pandas(),
                "rolling_amount_last_1h": np.where(n_roll[a:b] > 0, roll[a:b] / 100.0, np.nan),
                "velocity_spike": (n_base[a:b] > 0) & (short[a:b] * n_base[a:b] * m.denominator > m.numerator * base[a:b]),
                "home_country": home.slice(a, b - a).to_pandas(),
                "geo_location_mismatch": differs[a:b],
                "device_is_new": fresh[a:b]})
    past = past.filter(pa.array(_ints(past, "ts") >= mark - BASE_US))
    due = [int(_ints(waiting, "ts").min())] if len(waiting) else []
    if idle_us is not None:
        resting = ~pc.is_in(last["user"], value_set=waiting["user"].combine_chunks()).to_numpy()
        end = _ints(last, "ts") + idle_us
        gone = last.filter(pa.array(resting & (mark >= end)))["user"].combine_chunks()
        past, homes, devices, last = (t.filter(pc.invert(pc.is_in(t["user"], value_set=gone))) for t in (past, homes, devices, last))
        due += end[resting & (mark < end)].tolist()
    if not len(homes) and not len(waiting):
        state.remove()
        return
    state.update(tuple(_pack(t) for t in (past, homes, devices, last, waiting)))
    if due:
        state.setTimeoutTimestamp(max(min(due) // 1000 + 1, mark // 1000 + 1))


def stateful_user_features(stream: DataFrame, watermark: str = "1 hour", idle_us: int | None = None,
                           keys: int | None = None) -> DataFrame:
    """O-90 / O-91 with ``applyInPandasWithState``, and the rest of the rule context:
    rolling hour amount, velocity spike, home country and mismatch, new device.

    A row is scored when the watermark has passed its time, so rows that arrive out of order
    within the watermark get the values of the batch operators; later rows are dropped, as
    are rows without a time or user. State per user: amounts of the baseline period, counts per
    country, devices seen, and waiting rows; with ``idle_us`` the state of a user goes when
    that much event time has passed since the last row (its history is then forgotten). Rows
    after the last watermark wait for later events. All input columns are passed on.

    A state belongs to one user, or with ``keys`` to all users of one of so many hash values: a
    micro-batch then costs a call for each of these instead of each user, and takes all their state
    through it. Let ``keys`` grow with the rows, and keep it for as long as the checkpoint lives."""
    cols = stream.columns
    whole = isinstance(stream.schema["user_id"].dataType, IntegralType)
    user = F.col("user_id") if whole else F.col("user_id").cast("string")
    by = F.col("user_id") if keys is None else F.pmod(F.xxhash64("user_id"), F.lit(keys))
    s = stream.where(F.col("ts").isNotNull() & F.col("user_id").isNotNull()).withWatermark("ts", watermark) \
        .select(F.coalesce("transaction_id", F.lit(-1 << 63)).alias("id"), user.alias("user"), "ts",
                F.unix_micros("ts").alias("ts_us"), "amount", F.col("country").cast("string").alias("country"),
                F.col("device_id").cast("string").alias("device_id"), by.alias("key"),
                F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("row"))

    def fn(key, pdfs, state):
        return _user_features(key, pdfs, state, idle_us)

    out = s.groupBy("key").applyInPandasWithState(fn, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumn("row", F.from_json("row", stream.schema)).select("row.*", *[c.split()[0] for c in OUT_SCHEMA.split(", ")[1:]])


def shadow_stream_join(prod: DataFrame, cand: DataFrame, key: str = "transaction_id",
                       watermark: str = "10 minutes", bound: str = "1 minute") -> DataFrame:
    """O-95: stream-stream inner join of the production and candidate decision streams on
    the transaction, the candidate record arriving within ``bound`` after production;
    both sides watermarked so join state is dropped after the bound."""
    p = prod.withWatermark("ts", watermark).alias("p")
    c = cand.withWatermark("c_ts", watermark).alias("c")
    cond = (F.col(f"p.{key}") == F.col(f"c.c_{key}")) & (F.col("c.c_ts") >= F.col("p.ts")) \
        & (F.col("c.c_ts") <= F.col("p.ts") + F.expr(f"INTERVAL {bound}"))
    return p.join(c, cond, "inner")


def daily_latency_histogram(log_stream: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """O-92 for the decision log: per day and integer latency, request / flag counts and
    the proba sum. State stays bounded (distinct latencies per open day), and exact daily
    percentiles are read from the histogram afterwards (:func:`histogram_kpis`)."""
    return (log_stream.withWatermark("ts", watermark)
            .groupBy(F.window("ts", "1 day").alias("w"), F.col("latency_ms").cast("int").alias("latency_ms"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.lower(F.col("decision")) == "flag").alias("flags"),
                 F.sum("proba").alias("proba_sum")))


def histogram_kpis(hist: DataFrame, p: float = 0.95) -> DataFrame:
    """Daily KPIs from the latency histogram: requests, flag rate, mean proba and the
    linear-interpolated ``p`` latency quantile (the same interpolation as ``percentile``).
    Windows run per day over its distinct latencies (bounded)."""
    from pyspark.sql import Window

    day = F.date_format(F.col("w.start"), "yyyy-MM-dd")
    h = hist.withColumn("date", day)
    w = Window.partitionBy("date").orderBy("latency_ms").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("_hi", F.sum("n").over(w)).withColumn("_lo", F.col("_hi") - F.col("n")) \
         .withColumn("_N", F.sum("n").over(Window.partitionBy("date")))
    h = h.withColumn("_pos", (F.col("_N") - 1).cast("double") * F.lit(p)) \
         .withColumn("_r0", F.floor("_pos").cast("bigint")).withColumn("_r1", F.ceil("_pos").cast("bigint"))
    has = lambda r: (F.col("_lo") <= F.col(r)) & (F.col(r) < F.col("_hi"))
    g = h.groupBy("date").agg(
        F.sum("n").alias("requests"), F.sum("flags").alias("_flags"), F.sum("proba_sum").alias("_ps"),
        F.max(F.when(has("_r0"), F.col("latency_ms"))).cast("double").alias("_v0"),
        F.max(F.when(has("_r1"), F.col("latency_ms"))).cast("double").alias("_v1"),
        F.first("_pos").alias("_pos"), F.first("_r0").alias("_r0"), F.first("_r1").alias("_r1"))
    q = F.when((F.col("_r1") == F.col("_r0")) | (F.col("_v1") == F.col("_v0")), F.col("_v0")).otherwise(
        (F.col("_r1").cast("double") - F.col("_pos")) * F.col("_v0")
        + (F.col("_pos") - F.col("_r0").cast("double")) * F.col("_v1"))
    return g.select("date", "requests", (F.col("_flags") / F.col("requests")).alias("flag_rate"),
                    (F.col("_ps") / F.col("requests")).alias("mean_proba"), q.alias("p95_latency_ms"))
