"""Token-ID files in patched frame-of-reference blocks (numbered operator 5).

Documents are encoded in ascending id order and written as segments of whole documents. A
segment holds the ids of its documents end to end, in blocks of ``BLOCK`` ids: each block
subtracts its minimum and packs the rest at the width that ``PERCENTILE`` of its ids need;
the high bits of the others go to an exception list. An index of block starts allows any
block to be read alone.

Segment layout, little-endian::

    "PFR1" | u32 ids | u32 blocks | u32 exceptions | u32 bytes of packed bits
    u32 minimum[blocks] | u8 width[blocks] | u32 start[blocks] (byte, in the packed bits)
    u32 first exception[blocks] | packed bits | u16 place[exceptions] | u32 high bits[exceptions]

Files are written by Spark's own committed writer, one row per segment (part, segment, the
documents' ids and lengths, payload), so a lost or repeated task leaves no half file. A
document's start follows from segment totals: a prefix sum over a part's segments and one
over parts; no document rows are gathered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from riskspark.llm.common import pieces
from riskspark.llm.tokens import word_encoder

MAGIC = b"PFR1"
BLOCK = 256
PERCENTILE = 90
#: Text bytes whose documents make up one segment (a longer document is a segment of its own).
SEGMENT_BYTES = 2 << 20

_SCHEMA = "part int, segment int, n long, doc_ids array<long>, lengths array<long>, payload binary"


def pack(ids: np.ndarray) -> bytes:
    """One segment of unsigned 32-bit ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    if n:
        padded[n:] = ids[-1]
    rows = padded.reshape(blocks, BLOCK)
    low = rows.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rest = rows - low[:, None]
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)  # 0 for 0, else the bit length
    width = np.sort(bits, axis=1)[:, -(-BLOCK * PERCENTILE // 100) - 1] if blocks else np.zeros(0, np.uint8)
    start = np.concatenate([[0], np.cumsum(width.astype(np.int64) * (BLOCK // 8))])
    body = np.zeros(int(start[-1]), np.uint8)
    for w in np.unique(width[width > 0]).tolist():  # all blocks of one width at once
        at = np.flatnonzero(width == w)
        plane = (rest[at][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
        packed = np.packbits(plane.astype(np.uint8).reshape(len(at), -1), axis=1, bitorder="little")
        body[start[at][:, None] + np.arange(w * BLOCK // 8)] = packed
    high = rest >> np.minimum(width, 31).astype(np.uint32)[:, None]
    high[width >= 32] = 0
    r, c = np.nonzero(high)
    first = np.searchsorted(r, np.arange(blocks))
    head = np.array([n, blocks, len(r), len(body)], "<u4").tobytes()
    return b"".join([MAGIC, head, low.astype("<u4").tobytes(), width.astype(np.uint8).tobytes(), start[:-1].astype("<u4").tobytes(),
                     first.astype("<u4").tobytes(), body.tobytes(), c.astype("<u2").tobytes(), high[r, c].astype("<u4").tobytes()])


def unpack(payload: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """Ids of a segment, or of a range of its blocks through the index."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token segment")
    n, blocks, exceptions, size = (int(x) for x in np.frombuffer(payload, "<u4", 4, 4))
    at = 20
    parts = []
    for dtype, count in (("<u4", blocks), ("u1", blocks), ("<u4", blocks), ("<u4", blocks), ("u1", size), ("<u2", exceptions), ("<u4", exceptions)):
        parts.append(np.frombuffer(payload, dtype, count, at))
        at += parts[-1].nbytes
    low, width, start, first, body, place, high = parts
    a, b = first_block, blocks if last_block is None else min(last_block, blocks)
    out = np.zeros((max(0, b - a), BLOCK), np.uint32)
    for w in np.unique(width[a:b][width[a:b] > 0]).tolist():
        mine = a + np.flatnonzero(width[a:b] == w)
        plane = np.unpackbits(body[start[mine].astype(np.int64)[:, None] + np.arange(w * BLOCK // 8)], axis=1, bitorder="little")
        out[mine - a] = plane.reshape(len(mine), BLOCK, w).astype(np.uint32) @ (np.uint32(1) << np.arange(w, dtype=np.uint32))
    bounds = np.append(first, exceptions).astype(np.int64)
    e = np.arange(bounds[a], bounds[b]) if b > a else np.zeros(0, np.int64)
    r = np.searchsorted(bounds, e, "right") - 1
    out[r - a, place[e]] |= high[e] << width[r].astype(np.uint32)
    out += low[a:b, None]
    return out.ravel()[: max(0, min(n, b * BLOCK) - a * BLOCK)]


def _write(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, segment = word_encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.dtype).tobytes()
        width = int(enc.dtype[-1])
        for rows, data, off in pieces(batches, size=SEGMENT_BYTES):
            text = data.tobytes()
            docs = [enc.encode(text[a:b]) + end for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            ids = np.frombuffer(b"".join(docs), enc.dtype)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([rows.column("id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([[len(d) // width for d in docs]], pa.list_(pa.int64())), pa.array([pack(ids)], pa.binary())],
                ["part", "segment", "n", "doc_ids", "lengths", "payload"])
            segment += 1

    return run


def write_token_files(docs: DataFrame, out: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text with the tokenizer file ``path``, append ``end_id`` and write the segments to ``out``.

    Documents go in ascending id order, null ids first; rows with one id follow in text
    order. Null and empty texts are just the end id. A text of any length is one segment.
    An empty table writes no segment. Other columns are ignored. The tokenizer must drop
    white space (each word's ids do not depend on its neighbours).
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = src.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    ordered.mapInArrow(_write(path, end_id), _SCHEMA).write.option("compression", "none").mode("overwrite").parquet(out)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, doc_ids, lengths, payload in zip(*(batch.column(c).to_pylist() for c in ("start", "doc_ids", "lengths", "payload")), strict=True):
            raw = unpack(payload).astype("<u4").tobytes()
            n = np.array(lengths, np.int64)
            ends = np.cumsum(n)
            crc = [zlib.crc32(raw[4 * (e - k): 4 * e]) for e, k in zip(ends.tolist(), lengths, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(start + ends - n), pa.array(n), pa.array(crc, pa.int64())],
                                             ["id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, out: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the files; start counts the ids of all documents before it."""
    files = spark.read.schema(_SCHEMA).parquet(out)
    sizes = files.select("part", "segment", "n")
    in_part = W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, 0)
    segs = sizes.withColumn("before", F.sum("n").over(in_part) - F.col("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("total"))
    parts = parts.select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("offset"))
    starts = segs.join(parts, "part").select("part", "segment", (F.col("before") + F.col("offset")).alias("start"))
    return files.join(starts, ["part", "segment"]).select("start", "doc_ids", "lengths", "payload") \
        .mapInArrow(_read, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)
