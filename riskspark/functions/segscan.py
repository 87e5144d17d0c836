"""Per-key sequence features by one segmented scan over sorted partitions.

A window over a key sends all rows of the key to one task. Here the rows are range-partitioned
once by (key, time), so a key with a third of all rows lies in many neighbouring partitions, and
every partition is read as a sorted stream. What a partition must know of the key that began
before it is a small carry: running sums, counts per value, the last value, the last few amounts.

* Frames over time are running sums: a row adds its amount to a frame when it enters it and
  takes it away when it leaves it, and these moments are events of their own in the sorted
  stream (no payload: key, time, amount). So no row ever looks back.
* The first row of each (key, value) and a total per key are aggregates that enter the stream as
  markers in front of the row, or the key, that they speak of.
* One pass over the exchanged rows summarises the first and last key of every partition; the
  summaries (a row per partition) are combined in order into carries, which are broadcast (a row
  per partition, with one count per value of the carried key); the second pass over the same
  exchange computes all features.

The carry of a value column grows with the values of one key, so ``mode`` is for columns of a
small domain (a country); ``first`` needs no carry and may have any number of values.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US

#: Kinds of events in the stream, in the order of equal keys: totals, moments of frames, first-row markers, rows.
_TOTAL, _FIRST, _ROW = -1, 90, 100
_UNTIMED = np.iinfo(np.int64).min
_LOW = (1 << 31) - 1


def ts_micros(c) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ (session zone UTC)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


@dataclass
class _State:
    """What is known of a key up to some row."""

    sums: np.ndarray
    names: list[str | None] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)
    prev: str | None = None
    has: bool = False
    tail: list[int | None] = field(default_factory=list)
    total: float | None = None

    def text(self) -> str:
        return json.dumps([self.sums.tolist(), self.names, self.counts, self.prev, self.has, self.tail, self.total])

    @staticmethod
    def read(text: str) -> _State:
        v = json.loads(text)
        return _State(np.array(v[0], np.int64), *v[1:])

    def then(self, later: _State, keep: int) -> _State:
        """The state after this one's rows and ``later``'s, which follow them."""
        counts = dict(zip(self.names, self.counts, strict=True))
        for name, n in zip(later.names, later.counts, strict=True):
            counts[name] = counts.get(name, 0) + n
        tail = [*self.tail, *later.tail]
        return _State(self.sums + later.sums, list(counts), list(counts.values()), later.prev if later.has else self.prev,
                      self.has or later.has, tail[len(tail) - keep:] if len(tail) > keep else tail,
                      self.total if later.total is None else later.total)


@dataclass(frozen=True)
class _Spec:
    """Which features a scan computes. ``moments``: offset of each kind of frame event, the row's own (0) first."""

    frames: tuple[tuple[str, int, int], ...]
    moments: tuple[int, ...]
    mode: bool
    first: bool
    prev: bool
    last_rows: int
    total: bool

    def sign(self, frame: int, kinds: np.ndarray) -> np.ndarray:
        """+1 where an event puts its amount into the frame, -1 where it takes it out."""
        _, lo, hi = self.frames[frame]
        table = np.zeros(_ROW + 2, np.int64)
        for k, offset in enumerate(self.moments):
            table[_ROW if offset == 0 else k] += (offset == -hi) - (offset == 1 - lo)
        return table[kinds]  # markers: kinds -1 and 90 have no sign

    def empty(self) -> _State:
        return _State(np.zeros(2 * len(self.frames), np.int64))


def _codes(a: pa.Array) -> np.ndarray:
    return a.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _name(a: pa.Array, i: int) -> str | None:
    v = a[i].as_py()
    return None if v is None else str(v)


class _Scanner:
    """Reads chunks of the sorted stream, each of whole (key, time) groups, and keeps the state of the last key."""

    def __init__(self, spec: _Spec) -> None:
        self.spec, self.key, self.state = spec, None, None

    def start(self, key: str | None, state: _State) -> None:
        self.key, self.state = (key,), state

    def advance(self, b: pa.RecordBatch) -> tuple[np.ndarray, dict[str, Any]]:
        """Row numbers of the input rows in the chunk, and their features."""
        spec, n = self.spec, b.num_rows
        user = b.column("_u")
        codes = _codes(user)
        new = np.concatenate([[True], codes[1:] != codes[:-1]])
        run = np.cumsum(new) - 1
        goes_on = self.key == (_name(user, 0),)
        old = self.state if goes_on else spec.empty()
        self.key = (_name(user, n - 1),)
        last, same = int(run[-1]), goes_on and run[-1] == 0
        after = _State(np.zeros_like(old.sums), total=None)
        kind = b.column("_k").to_numpy()
        t = pc.fill_null(b.column("_t"), _UNTIMED).to_numpy()
        rows = np.flatnonzero(kind == _ROW)
        of = run[rows]
        own = bool(len(rows)) and of[-1] == last  # the last key has rows here
        out: dict[str, Any] = {}
        if spec.frames:
            self._frames(b, kind, t, new, rows, old, goes_on, after, out)
        if spec.prev:
            p = b.column("_p").take(pa.array(rows))
            if len(rows):
                has = np.concatenate([[goes_on and of[0] == 0 and old.has], of[1:] == of[:-1]])
                lead = pa.array([old.prev if has[0] else None], pa.string())
                moved = pa.concat_arrays([lead, p.slice(0, len(rows) - 1)])
                out["prev"] = pc.if_else(pa.array(has), moved, pa.scalar(None, pa.string()))
                out["has_prev"] = pa.array(has)
            else:
                out["prev"], out["has_prev"] = p, pa.array([], pa.bool_())
            after.prev, after.has = (p[len(rows) - 1].as_py(), True) if own else (old.prev, old.has) if same else (None, False)
        if spec.first:
            out["first"] = pa.array((kind[rows - 1] == _FIRST) & (rows > 0))
        if spec.last_rows:
            self._last_rows(b, rows, of, old, goes_on, last, same, after, out)
        if spec.mode:
            self._mode(b, rows, of, old, goes_on, last, own, same, after, out)
        if spec.total:
            total = np.full(last + 1, np.nan)
            known = np.zeros(last + 1, bool)
            if goes_on and old.total is not None:
                total[0], known[0] = old.total, True
            marks = np.flatnonzero(kind == _TOTAL)
            d = b.column("_d").take(pa.array(marks))
            ok = d.is_valid().to_numpy(zero_copy_only=False)
            total[run[marks[ok]]], known[run[marks[ok]]] = d.filter(pa.array(ok)).to_numpy(zero_copy_only=False), True
            out["total"] = pa.array(total[of], mask=~known[of])
            after.total = float(total[last]) if known[last] else None
        self.state = after
        return rows, out

    def _frames(self, b, kind, t, new, rows, old, goes_on, after, out) -> None:
        spec = self.spec
        amount = b.column("_c")
        known = amount.is_valid().to_numpy(zero_copy_only=False)
        units = pc.fill_null(amount, 0).to_numpy()
        untimed = t == _UNTIMED
        moved = np.concatenate([[True], t[1:] != t[:-1]])
        group = np.cumsum(new | moved) - 1
        end = np.concatenate([np.flatnonzero((new | moved)[1:]), [len(t) - 1]])  # last event of each (key, time)
        # rows without a time are a section of their own: their frames are all of them, and later frames have none of them
        section_start = new | np.concatenate([[False], untimed[:-1] & ~untimed[1:]])
        section = np.cumsum(section_start) - 1
        starts = np.flatnonzero(section_start)
        at = end[group[rows]]
        for f, (name, _, _) in enumerate(spec.frames):
            sign = spec.sign(f, kind)
            sign = np.where(untimed, kind == _ROW, sign)
            for j, (what, d) in enumerate((("cnt", sign * known), ("sum", sign * units))):
                total = np.cumsum(d)
                base = (total[starts] - d[starts])
                if goes_on and not untimed[0]:
                    base[0] -= old.sums[2 * f + j]
                out[f"{name}_{what}"] = total[at] - base[section[rows]]
                after.sums[2 * f + j] = 0 if untimed[-1] else total[-1] - base[section[-1]]
            n = out[f"{name}_cnt"]
            out[f"{name}_cnt"], out[f"{name}_sum"] = pa.array(n, pa.int64()), pa.array(out[f"{name}_sum"], pa.int64(), mask=n == 0)

    def _last_rows(self, b, rows, of, old, goes_on, last, same, after, out) -> None:
        keep = self.spec.last_rows - 1
        amount = b.column("_c").take(pa.array(rows))
        before = old.tail if goes_on else []
        known = np.concatenate([[v is not None for v in before], amount.is_valid().to_numpy(zero_copy_only=False)]).astype(bool)
        units = np.concatenate([[v or 0 for v in before], pc.fill_null(amount, 0).to_numpy()]).astype(np.int64)
        runs = np.concatenate([np.zeros(len(before), np.int64), of])
        total, count = np.concatenate([[0], np.cumsum(units)]), np.concatenate([[0], np.cumsum(known)])
        at = np.arange(len(before), len(runs))
        lo = np.maximum(at - keep, np.searchsorted(runs, runs[at]))
        n = count[at + 1] - count[lo]
        out["rows_sum"] = pa.array(total[at + 1] - total[lo], pa.int64(), mask=n == 0)
        mine = np.flatnonzero(runs == last)
        if len(mine) and keep:
            after.tail = [int(units[i]) if known[i] else None for i in mine[-keep:]]

    def _mode(self, b, rows, of, old, goes_on, last, own, same, after, out) -> None:
        value = b.column("_m").take(pa.array(rows)).dictionary_encode(null_encoding="encode")
        names = value.dictionary.to_pylist()
        where = {v: i for i, v in enumerate(names)}
        carried = len(old.names) if goes_on else 0
        for v in old.names[:carried]:
            if v not in where:
                where[v] = len(names)
                names.append(v)
        width = max(len(names), 1)
        pairs = np.concatenate([np.array([where[v] for v in old.names[:carried]], np.int64),
                                of * width + value.indices.to_numpy(zero_copy_only=False)]).astype(np.int64)
        slot, pair = pd.factorize(pairs)  # (key, value) numbered in order of first sight
        count = np.zeros(len(pair), np.int64)
        count[:carried] = old.counts[:carried]
        slot = slot[carried:]
        each = pd.Series(slot)
        so_far = each.groupby(slot).cumcount().to_numpy() + 1 + count[slot]
        score = (so_far << 31) | (_LOW - slot)
        best = pd.Series(score).groupby(of).cummax().to_numpy()
        start = max(((n << 31) | (_LOW - i) for i, n in enumerate(old.counts[:carried])), default=-1)
        if carried:
            best = np.where(of == 0, np.maximum(best, start), best)
        if len(rows):
            prior = np.concatenate([[start if of[0] == 0 else -1], np.where(of[1:] == of[:-1], best[:-1], -1)])
        else:
            prior = best
        has = prior >= 0
        code = pair[np.where(has, _LOW - (prior & _LOW), 0)] % width if len(pair) else np.zeros(0, np.int64)
        out["mode"] = pc.if_else(pa.array(has), pa.array(names, pa.string()).take(pa.array(code)), pa.scalar(None, pa.string()))
        out["has_mode"] = pa.array(has)
        if own or same:
            count += np.bincount(slot, minlength=len(pair))
            mine = np.flatnonzero(pair // width == last)
            after.names, after.counts = [names[pair[i] % width] for i in mine], count[mine].tolist()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stream cut between (key, time) groups."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pc.fill_null(b.column("_t"), _UNTIMED).to_numpy()
        codes = _codes(b.column("_u"))
        edge = np.flatnonzero((codes[1:] != codes[:-1]) | (t[1:] != t[:-1])) + 1
        if held:
            lead = held[-1]
            end = lead.num_rows - 1
            if _name(lead.column("_u"), end) != _name(b.column("_u"), 0) or lead.column("_t")[end] != b.column("_t")[0]:
                yield _joined(held)
                held = []
        if len(edge):
            cut = int(edge[-1])
            yield _joined([*held, b.slice(0, cut)])
            held = [b.slice(cut)]
        else:
            held.append(b)
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_SUMMARY = "part long, head string, first_key string, first_state string, last_key string, last_state string"


def _head(b: pa.RecordBatch) -> str:
    return json.dumps([_name(b.column("_u"), 0), b.column("_t")[0].as_py()])


def _summarise(spec: _Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, head = _Scanner(spec), None, None
        for b in _chunks(batches):
            codes = _codes(b.column("_u"))
            edges = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), b.num_rows]
            if head is None:
                head = _head(b)
                first.start(_name(b.column("_u"), 0), spec.empty())
            if last is None and first.key == (_name(b.column("_u"), 0),):
                first.advance(b.slice(0, edges[1]))
                edges = edges[1:]
            if len(edges) > 1:  # only the last key of the partition goes on in the next one
                a = edges[-2]
                if last is None:
                    last = _Scanner(spec)
                last.advance(b.slice(a))
        if head is not None:
            end = last or first
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64() if i == 0 else pa.string()) for i, v in enumerate(
                    [TaskContext.get().partitionId(), head, first.key[0], first.state.text(), end.key[0],
                     None if last is None else last.state.text()])], [c.split()[0] for c in _SUMMARY.split(", ")])

    return run


def _carry(spec: _Spec):
    """Summaries in order of their partitions -> the state with which each partition begins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        parts: list[int] = []
        carries: list[str] = []
        for b in batches:
            for r in b.to_pylist():
                begins = (r["first_key"],)
                before = state if key == begins else spec.empty()
                parts.append(r["part"])
                carries.append(json.dumps([r["head"], r["first_key"], before.text() if key == begins else None]))
                if r["last_state"] is None:
                    key, state = begins, before.then(_State.read(r["first_state"]), max(spec.last_rows - 1, 0))
                else:
                    key, state = (r["last_key"],), _State.read(r["last_state"])
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(carries, pa.string())], ["_part", "_carry"])

    return run


def _features(spec: _Spec, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, begun = _Scanner(spec), False
        for b in _chunks(batches):
            if not begun:
                head, key, state = json.loads(b.column("_carry")[0].as_py())
                if head != _head(b):
                    raise RuntimeError("the two passes of the scan saw other partitions")
                if state is not None:
                    scanner.start(key, _State.read(state))
                begun = True
            rows, out = scanner.advance(b)
            if len(rows):
                yield pa.RecordBatch.from_arrays([b.column("_row").take(pa.array(rows)), *(out[n] for n in names)], ["_row", *names])

    return run


def scan(df: DataFrame, key: str, ts_us: str, order: Sequence[str], *, units: Column | None = None,
         frames: Mapping[str, tuple[int, int]] | None = None, mode: str | None = None, first: str | None = None,
         prev: str | None = None, last_rows: int = 0, total: Column | None = None, parts: int | None = None) -> DataFrame:
    """``df`` with sequence features of each row among the rows of its ``key`` (NULL is a key), ordered by
    (``ts_us``, ``order``); ties beyond these by the mode, first and prev columns.

    ``frames`` {name: (lo, hi)}: sum and count of ``units`` (whole numbers, e.g. cents) over rows of
    the key with ts + lo <= ts' <= ts + hi in microseconds, peers included: ``{name}_sum`` (NULL
    where no amount is known) and ``{name}_cnt``. Rows without a time have each other as frame.
    ``mode``: the most frequent value of earlier rows, ties to the one first seen, NULL being a
    value: ``mode`` (text), ``has_mode``. ``first``: whether the row is the first of its (key,
    value): ``first``. ``prev``: the value of the row before: ``prev`` (text), ``has_prev``.
    ``last_rows``: sum of ``units`` over the last so many rows: ``rows_sum``. ``total``: a double
    aggregate over all rows of the key: ``total``.

    Every input row comes back once, whatever ids or times repeat or are missing. ``parts``
    partitions (by default the session's shuffle partitions) share the work evenly whatever the
    keys are; rows of one key and one time stay together.
    """
    frames = dict(frames or {})
    offsets = [0] + sorted({x for lo, hi in frames.values() for x in (-hi, 1 - lo)} - {0})
    spec = _Spec(tuple((n, lo, hi) for n, (lo, hi) in frames.items()), tuple(offsets), mode is not None, first is not None,
                 prev is not None, last_rows, total is not None)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"_i{i}" for i in range(len(order))]
    given = {"_u": F.col(f"`{key}`"), "_t": F.col(f"`{ts_us}`").cast("bigint"), **{k: F.col(f"`{o}`") for k, o in zip(keys, order, strict=True)}}
    given |= {"_m": F.col(f"`{mode}`").cast("string")} if mode else {}
    given |= {"_f": F.col(f"`{first}`")} if first else {}
    given |= {"_p": F.col(f"`{prev}`").cast("string")} if prev else {}
    given |= {"_c": units.cast("bigint")} if units is not None else {}
    base = df.select(*[c.alias(n) for n, c in given.items()], F.struct(*[F.col(f"`{x}`") for x in df.columns]).alias("_row"))
    ties = [*keys, *[n for n in ("_m", "_f", "_p") if n in given]]
    null = F.lit(None)
    types = dict(base.dtypes)

    def event(kind: int, offset: int) -> Column:
        return F.struct(*[(F.lit(kind) if n == "_k" else (F.col("_t") + offset) if n == "_t" and offset else F.col(n)
                           if not offset or n in ("_u", "_c") else null.cast(types[n])).alias(n) for n in (*given, "_k", "_row")])

    happen = F.array(event(_ROW, 0))
    if len(offsets) > 1:  # rows without a time or an amount move no frame
        moves = F.array(event(_ROW, 0), *[event(k, offset) for k, offset in enumerate(offsets) if offset])
        happen = F.when(F.col("_t").isNotNull() & F.col("_c").isNotNull(), moves).otherwise(happen)
    stream = base.select(F.explode(happen).alias("_e")).select("_e.*")

    def marker(d: DataFrame, kind: int, known: Mapping[str, Column]) -> DataFrame:
        return d.select(*[(F.lit(kind) if x == "_k" else known[x] if x in known else null.cast(t)).alias(x) for x, t in stream.dtypes])

    if first is not None:
        at = [n for n in ("_t", *ties) if n != "_f"]
        least = base.groupBy("_u", "_f").agg(F.min(F.struct(*at)).alias("_l"))
        stream = stream.unionByName(marker(least, _FIRST, {"_u": F.col("_u"), "_f": F.col("_f"), **{x: F.col(f"_l.{x}") for x in at}}))
    if total is not None:
        stream = stream.withColumn("_d", null.cast("double"))
        whole = df.groupBy(F.col(f"`{key}`").alias("_u")).agg(total.cast("double").alias("_d"))
        stream = stream.unionByName(marker(whole, _TOTAL, {"_u": F.col("_u"), "_d": F.col("_d")}))

    # Both passes read one exchange: both use all its columns (the first only a hash of the row), and none is a constant
    # that Spark would pull out of one. Should they ever see different partitions, the second finds another first row and fails.
    by = ["_u", "_t", *ties, "_k"]
    dealt = stream.repartitionByRange(parts, "_u", "_t")
    slim = [c for c in dealt.columns if c != "_row"]
    summary = dealt.select(*slim, F.xxhash64("_row").alias("_held")).sortWithinPartitions(*by).mapInArrow(_summarise(spec), _SUMMARY)
    carry = summary.repartition(1).sortWithinPartitions("part").mapInArrow(_carry(spec), "_part long, _carry string")
    # the first row of a partition gets the carry: its number is the partition's, shifted
    numbered = dealt.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    carry = F.broadcast(carry.select(F.shiftleft("_part", 33).alias("_start"), "_carry"))  # one row for each partition
    begun = numbered.join(carry, F.col("_at") == F.col("_start"), "left").drop("_at", "_start")
    names = [f"{n}_{w}" for n in frames for w in ("sum", "cnt")] + ["mode", "has_mode"] * spec.mode + ["first"] * spec.first \
        + ["prev", "has_prev"] * spec.prev + ["rows_sum"] * bool(last_rows) + ["total"] * spec.total
    kinds = {"mode": "string", "prev": "string", "has_mode": "boolean", "first": "boolean", "has_prev": "boolean", "total": "double"}
    schema = T.StructType([base.schema["_row"]])
    for n in names:
        schema = schema.add(n, kinds.get(n, "long"))
    result = begun.mapInArrow(_features(spec, names), schema)
    return result.select(*[F.col(f"_row.`{x}`").alias(x) for x in df.columns], *[F.col(f"`{n}`") for n in names])
