"""Shared helpers: table scans, stage tables in the shared folder, and vectorised text work on Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import ensure_checkpoint_dir, scratch

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a Python task works on at once (a longer document is one piece).
PIECE_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE_VALUE = np.random.RandomState(20240229).randint(0, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers can be divided out modulo 2^64
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir`` (shared by driver and executors) for one operator run."""
    return scratch(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    df.write.option("compression", "zstd").mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stage table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with value computed once."""
    return F.transform(F.array(value), then)[0]


def word_count(text: Column) -> Column:
    """Number of words (long), in SQL functions only; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """Array of the words of a text in order (SQL functions only); null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


# --- Arrow text -> numpy -------------------------------------------------------------------


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and the len+1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text",
           size: int = PIECE_BYTES, most: int = 1 << 30) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``size`` bytes of text and ``most`` rows (at least one row), with bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, off = text_bytes(batch.column(column))
        a = 0
        while a < batch.num_rows:
            b = min(max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1), a + most)
            yield batch.slice(a, b - a), data[off[a]: off[b]], off[a: b + 1] - off[a]
            a = b


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data + np.uint8(32), data).astype(np.uint8)


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each document the index of its first word (len+1)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    text = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)  # a document begins here
    edge[off] = True
    before, after = edge[:n].copy(), edge[1:].copy()
    before[0] = after[-1] = True
    before[1:] |= ~text[:-1]
    after[:-1] |= ~text[1:]
    starts, ends = np.flatnonzero(text & before), np.flatnonzero(text & after) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser that spreads every input bit over 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in (("up", _P), ("down", _P_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: the same word has the same hash anywhere."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rolling hash of every run of ``size`` consecutive values (len - size + 1 of them, not split by document)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64, out=total[1:])
    return mix((total[size:] - total[:n]) * down[:n] + np.uint64(size))


def inside(word_off: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of the ``total - size + 1`` rolling windows lie in one document."""
    n = total - size + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    doc_end = np.repeat(word_off[1:], np.diff(word_off))[:n]
    return np.arange(n) + size <= doc_end
