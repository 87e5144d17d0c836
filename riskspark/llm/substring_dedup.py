"""Removal of repeated passages by fixed-block anchors (numbered operator 2).

A window of ``WINDOW`` words that occurs twice holds, wherever its first occurrence stands, one
whole block of the ``BLOCK``-word grid of that document (2 * BLOCK - 1 <= WINDOW). So the
index takes only the non-overlapping grid blocks, and every rolling BLOCK-word window of
every document probes it. Hits (grid blocks that occur anywhere else) are the only places
where repeats can be; they are extended word by word: every WINDOW-word window around a hit
is compared with all such windows, and runs of windows that recur are the maximal exact
repeats. Their words are removed.

Documents are packed into batches (one table row each), and all matching is between batches:
a batch sends the distinct hashes of its windows, sorted, as byte differences, to hash-range
buckets, and gets back one bit per hash. A window that a third of all documents share is one
entry per batch. Probe hashes have PROBE_SPARE bits more than the index needs, so their few
false hits only cost a comparison; repeats are decided on 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import PIECE_BYTES, inside, pieces, stage, stage_dir, window_hashes, word_hashes, word_spans

WINDOW = 35
BLOCK = 18
BATCH_BYTES = 6 << 20
#: Distinct hashes in a bucket, about.
BUCKET_HASHES = 1_500_000
PROBE_SPARE = 17

_BATCH = "batch long, ids array<long>, lengths binary, body binary, marks binary"
_PROBE = "bucket int, batch long, hashes binary, flags binary"
_REPLY = "batch long, bucket int, hits binary"
_DOC = "id long, n_words long, n_removed long, kept_sha256 string"


def _row(batch: int, ids: pa.Array, data: bytes, off: np.ndarray, marks: bytes | None = None) -> list[pa.Array]:
    body = zstandard.ZstdCompressor(level=3).compress(data)
    return [pa.array([batch], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
            pa.array([np.diff(off).astype("<i8").tobytes()], pa.binary()), pa.array([body], pa.binary()), pa.array([marks], pa.binary())]


_NAMES = ["batch", "ids", "lengths", "body", "marks"]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, k = TaskContext.get().partitionId(), 0
    for rows, data, off in pieces(batches, size=BATCH_BYTES):
        yield pa.RecordBatch.from_arrays(_row((part << 32) + k, rows.column("id"), data.tobytes(), off), _NAMES)
        k += 1


class _Words:
    """Words of a batch row: hashes and the first word of each document."""

    def __init__(self, lengths: bytes, body: bytes):
        self.text = zstandard.ZstdDecompressor().decompress(body) if body else b""
        self.off = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, "<i8"))]).astype(np.int64)
        data, hashes, firsts, done, a = np.frombuffer(self.text, np.uint8), [np.zeros(0, np.uint64)], [], 0, 0
        while a < len(self.off) - 1:  # in slices: hashing needs a few dozen bytes for each byte of text
            b = max(a + 1, int(np.searchsorted(self.off, self.off[a] + PIECE_BYTES, "right")) - 1)
            part, off = data[self.off[a]: self.off[b]], self.off[a: b + 1] - self.off[a]
            starts, ends, word_off = word_spans(part, off)
            hashes.append(word_hashes(part, starts, ends))
            firsts.append(word_off[:-1] + done)
            done += len(starts)
            a = b
        self.hashes = np.concatenate(hashes)
        self.word_off = np.concatenate([*firsts, [done]]).astype(np.int64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each window that lies in one document."""
        ok = inside(self.word_off, size, len(self.hashes))
        return window_hashes(self.hashes, size)[ok], np.flatnonzero(ok)

    def grid(self, at: np.ndarray) -> np.ndarray:
        """Which of the words at these indices begin a block of their document's grid."""
        doc = np.searchsorted(self.word_off, at, "right") - 1
        return (at - self.word_off[doc]) % BLOCK == 0


def _squeeze(sorted_hashes: np.ndarray) -> bytes:
    """Sorted distinct hashes as their first value, 3-byte differences, and a list of differences that need more."""
    d = np.diff(sorted_hashes)
    high = d >> np.uint64(24)
    big = np.flatnonzero(high)
    wide = 3 if len(big) * 8 < len(d) else 6
    if wide == 6:
        high = d >> np.uint64(48)
        big = np.flatnonzero(high)
    head = np.array([wide, len(d), len(big)], "<u8").tobytes() + sorted_hashes[:1].astype("<u8").tobytes()
    low = d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
    return head + low.tobytes() + big.astype("<u4").tobytes() + high[big].astype("<u8").tobytes()


def _expand(blob: bytes) -> np.ndarray:
    wide, n, k = (int(x) for x in np.frombuffer(blob, "<u8", 3))
    d = np.zeros((n, 8), np.uint8)
    d[:, :wide] = np.frombuffer(blob, np.uint8, n * wide, 32).reshape(n, wide)
    d = d.reshape(-1).view("<u8") if n else np.zeros(0, np.uint64)
    at = 32 + n * wide
    d[np.frombuffer(blob, "<u4", k, at)] |= np.frombuffer(blob, "<u8", k, at + 4 * k) << np.uint64(8 * wide)
    return np.cumsum(np.concatenate([np.frombuffer(blob, "<u8", 1, 24), d]), dtype=np.uint64)


def _edges(sorted_hashes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """First index of each bucket's range, and the end."""
    bucket = ((sorted_hashes >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1))


def _probes(bits: int, buckets: int):
    """Distinct rolling BLOCK-word windows of each batch by bucket; flags: grid block, occurs twice in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                w = _Words(rows.column("lengths")[i].as_py(), rows.column("body")[i].as_py())
                h, at = w.windows(BLOCK)
                u, back, count = np.unique(h >> np.uint64(64 - bits), return_inverse=True, return_counts=True)
                grid = np.zeros(len(u), np.uint8)
                grid[back[w.grid(at)]] = 1
                yield _by_bucket(rows.column("batch")[i].as_py(), u, grid + 2 * (count > 1).astype(np.uint8), bits, buckets)

    return run


def _windows(buckets: int):
    """Distinct WINDOW-word windows around the hits of each batch by bucket, with the flag for twice in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                w = _Words(rows.column("lengths")[i].as_py(), rows.column("body")[i].as_py())
                h, _ = _marked(w, rows.column("marks")[i].as_py())
                u, count = np.unique(h, return_counts=True)
                yield _by_bucket(rows.column("batch")[i].as_py(), u, 1 + 2 * (count > 1).astype(np.uint8), 64, buckets)

    return run


def _marked(w: _Words, marks: bytes) -> tuple[np.ndarray, np.ndarray]:
    h, at = w.windows(WINDOW)
    keep = np.unpackbits(np.frombuffer(marks, np.uint8), count=len(h)).astype(bool)
    return h[keep], at[keep]


def _by_bucket(batch: int, u: np.ndarray, flags: np.ndarray, bits: int, buckets: int) -> pa.RecordBatch:
    e = _edges(u, bits, buckets)
    full = np.flatnonzero(np.diff(e))
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32()), pa.array([batch] * len(full), pa.int64()),
         pa.array([_squeeze(u[e[k]: e[k + 1]]) for k in full], pa.binary()),
         pa.array([np.packbits(np.stack([flags[e[k]: e[k + 1]] & 1, flags[e[k]: e[k + 1]] >> 1])).tobytes() for k in full], pa.binary())],
        ["bucket", "batch", "hashes", "flags"])


def _match(group: pa.Table) -> pa.Table:
    """For one bucket: which hashes are indexed (first flag, anywhere) and occur twice or more in all."""
    batch, bucket = group.column("batch").to_pylist(), group.column("bucket")[0].as_py()
    sent = [_expand(x) for x in group.column("hashes").to_pylist()]
    flags = [np.unpackbits(np.frombuffer(f, np.uint8), count=2 * len(s)).reshape(2, -1) for s, f in zip(sent, group.column("flags").to_pylist(), strict=True)]
    u, back = np.unique(np.concatenate(sent), return_inverse=True)
    weight = np.concatenate([1 + f[1].astype(np.int64) for f in flags])
    indexed = np.concatenate([f[0] for f in flags])
    hit = (np.bincount(back, weight, minlength=len(u)) > 1) & (np.bincount(back, indexed, minlength=len(u)) > 0)
    ends = np.cumsum([len(s) for s in sent])
    out = [(b, np.packbits(hit[back[e - len(s): e]]).tobytes()) for b, s, e in zip(batch, sent, ends, strict=True) if hit[back[e - len(s): e]].any()]
    return pa.table({"batch": pa.array([o[0] for o in out], pa.int64()), "bucket": pa.array([bucket] * len(out), pa.int32()),
                     "hits": pa.array([o[1] for o in out], pa.binary())})


def _hits(h: np.ndarray, replies: pa.Table, bits: int, buckets: int) -> np.ndarray:
    """Which hashes of a batch were hits, from the replies by bucket."""
    u, back = np.unique(h, return_inverse=True)
    e, hit = _edges(u, bits, buckets), np.zeros(len(u), dtype=bool)
    for bucket, bitmap in zip(replies.column("bucket").to_pylist(), replies.column("hits").to_pylist(), strict=True):
        a, b = e[bucket], e[bucket + 1]
        hit[a:b] = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=b - a)
    return hit[back]


def _doc_table(ids: list, n: list, removed: list, sha: list) -> pa.Table:
    return pa.table({"id": pa.array(ids, pa.int64()), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                     "kept_sha256": pa.array(sha, pa.string())})


def _around_hits(bits: int, buckets: int):
    """Batch and its probe replies -> documents without a window around a hit (finished), and one row of the others."""

    def run(batch: pa.Table, replies: pa.Table) -> pa.Table:
        w = _Words(batch.column("lengths")[0].as_py(), batch.column("body")[0].as_py())
        ids = batch.column("ids")[0].as_py()
        h, at = w.windows(BLOCK)
        hit = np.zeros(len(w.hashes) + 1, np.int64)
        hit[at[_hits(h >> np.uint64(64 - bits), replies, bits, buckets)] + 1] = 1
        before = np.cumsum(hit)  # hits that begin before a word
        _, first = w.windows(WINDOW)
        mark = before[first + WINDOW - BLOCK + 1] > before[first]
        doc = np.searchsorted(w.word_off, first[mark], "right") - 1
        open_ = np.zeros(len(ids), dtype=bool)
        open_[doc] = True
        of_window = np.searchsorted(w.word_off, first, "right") - 1
        text = [w.text[a:b] for a, b in zip(w.off[:-1].tolist(), w.off[1:].tolist(), strict=True)]
        n = np.diff(w.word_off)
        done = np.flatnonzero(~open_).tolist()
        sha = [hashlib.sha256(b" ".join(text[i].split())).hexdigest() for i in done]
        out = _doc_table([ids[i] for i in done], n[done].tolist(), [0] * len(done), sha)
        none = {c: pa.nulls(len(done), t) for c, t in zip(_NAMES, (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()), strict=True)}
        out = pa.table({**{c: out.column(c) for c in out.column_names}, **none})
        if open_.any():
            rest = np.flatnonzero(open_).tolist()
            size = np.array([len(text[i]) for i in rest], np.int64)
            marks = np.packbits(mark[open_[of_window]]).tobytes()
            row = _row(batch.column("batch")[0].as_py(), pa.array([ids[i] for i in rest], pa.int64()), b"".join(text[i] for i in rest),
                       np.concatenate([[0], np.cumsum(size)]), marks)
            blank = _doc_table([None], [None], [None], [None])
            out = pa.concat_tables([out, pa.table({**{c: blank.column(c) for c in blank.column_names}, **dict(zip(_NAMES, row, strict=True))})])
        return out

    return run


def _remove(buckets: int, keep_text: bool):
    """Documents around hits and the replies for their windows -> finished documents."""

    def run(batch: pa.Table, replies: pa.Table) -> pa.Table:
        w = _Words(batch.column("lengths")[0].as_py(), batch.column("body")[0].as_py())
        h, at = _marked(w, batch.column("marks")[0].as_py())
        at = at[_hits(h, replies, 64, buckets)]
        cover = np.zeros(len(w.hashes) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + WINDOW, -1)
        keep = np.cumsum(cover)[:-1] == 0
        ids = batch.column("ids")[0].as_py()
        n, removed, out = [], [], []
        for i in range(len(ids)):
            mine = keep[w.word_off[i]: w.word_off[i + 1]]
            words = compress(w.text[w.off[i]: w.off[i + 1]].split(), mine.tolist())
            n.append(len(mine))
            removed.append(int(len(mine) - mine.sum()))
            kept = b" ".join(words)
            out.append(kept.decode("utf-8") if keep_text else hashlib.sha256(kept).hexdigest())
        return _doc_table(ids, n, removed, out)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row: words in all, words removed, and the
    digest of the kept words joined by one space.

    Words are runs of anything but ASCII white space, unchanged. A word goes when a window
    of 35 consecutive words of its document covers it whose word sequence also starts anywhere
    else, same document included; all windows are judged on the input, so every occurrence goes.

    Null and empty texts have no words; with fewer than 35 words nothing is removed; equal
    rows repeat each other and lose all their windows; null ids come back as they are; a very
    long text is a batch of its own; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    at = stage_dir(spark)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    packed = stage(src.mapInArrow(_pack, _BATCH), f"{at}/batches")
    size = docs.select(F.octet_length(F.col(text_col)).alias("n")).agg(F.sum("n")).first()[0] or 0
    words = size // 4 + 1  # at least about so many, from the bytes alone
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, -(-words // BUCKET_HASHES))
    bits = min(64, max(36, (words // BLOCK + 1).bit_length() + PROBE_SPARE))
    replies = packed.mapInArrow(_probes(bits, buckets), _PROBE).groupBy("bucket").applyInArrow(_match, _REPLY)
    second = packed.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(_around_hits(bits, buckets), f"{_DOC}, {_BATCH}")
    second = stage(second, f"{at}/second")
    done = second.where("batch is null").select("id", "n_words", "n_removed", "kept_sha256")
    rest = second.where("batch is not null").select(*_NAMES)
    replies = rest.mapInArrow(_windows(buckets), _PROBE).groupBy("bucket").applyInArrow(_match, _REPLY)
    found = rest.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(_remove(buckets, False), _DOC)
    return done.union(found).withColumnRenamed("id", id_col)
