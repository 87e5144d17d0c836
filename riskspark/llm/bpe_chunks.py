"""BPE encoding and decoding with content-defined chunk reuse (numbered operator 3).

Texts are cut where a rolling hash of the last bytes says so, so a passage that documents
share is cut alike wherever it stands. Each task sends every distinct chunk of its texts
once; chunks meet by hash, each distinct one is encoded once, and its ids go back to the
tasks' batches, where documents are put together again.

Cuts prefer a single space between two words, where the tokenizer's own split provably
begins anew: such a join needs no repair. Stretches without one are cut between any two
characters, and those joins are repaired: the text from the last provable boundary before
the join to the first one after it is encoded again, over more chunks while there is none,
so the ids agree exactly with those of the whole text.

What moves: each distinct chunk per batch once as compressed text, and back as compressed
ids. A chunk that a third of the corpus repeats is one entry per batch, and no group of
documents, chunk or bucket grows with the corpus: buckets hold about BUCKET_BYTES of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import _BYTE_VALUE, _powers, mix, pieces
from riskspark.llm.tokens import id_bytes, load, spaced_encoder

#: Bytes that the rolling hash looks back at.
LOOK = 24
#: One in so many word spaces is a cut (about 0.8 kB of prose).
EVERY = 128
#: Stretches of more bytes than this without a cut are cut between any characters, one in EVERY * 8.
LONG = 4096
BATCH_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20

TEXT_LEVEL = 5

_SCHEMA = "bucket int, batch long, sizes binary, body binary"


def _plain(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that surely end, and that surely begin, a character that is not white space."""
    ascii_ = (data > 32) & (data < 127)
    ends, begins = ascii_.copy(), ascii_ | ((data >= 0xC3) & (data != 0xE1) & (data != 0xE2) & (data != 0xE3))
    ends[1:] |= (data[1:] >= 128) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)  # two-byte characters from U+00C0 on
    return ends, begins


def cut_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all chunks (document starts included) and whether the join before each is a provable boundary."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, dtype=bool)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[:n], dtype=np.uint64, out=total[1:])

    def chosen(at: np.ndarray, every: int) -> np.ndarray:
        doc = off[np.searchsorted(off, at, "right") - 1]
        at = at[at - doc >= 2 * LOOK]
        h = mix((total[at] - total[at - LOOK]) * down[at - LOOK])
        return at[h % np.uint64(every) == 0]

    ends, begins = _plain(data)
    space = np.flatnonzero(data[1:-1] == 32) + 1 if n > 2 else np.zeros(0, np.int64)
    space = space[ends[space - 1] & begins[space + 1]]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    space = space[~edge[space] & ~edge[space + 1]]  # both neighbours in the same document
    safe = chosen(space, EVERY)
    first = np.unique(off[:-1][np.diff(off) > 0])
    starts = np.union1d(first, safe)
    lengths = np.diff(np.append(starts, n))
    wide = np.flatnonzero(lengths > LONG)
    extra = [np.zeros(0, np.int64)]
    for k in wide:
        a, b = starts[k] + 1, starts[k] + lengths[k]
        at = np.arange(a, b)[(data[a:b] & 0xC0) != 0x80]
        extra.append(chosen(at, EVERY * 8))
    starts = np.union1d(starts, np.concatenate(extra))
    return starts, np.isin(starts, safe)


def pack_ids(ids: np.ndarray) -> bytes:
    """Compressed ids: the frequent ones of this list as one byte, others as two, with the list of ids by frequency."""
    count = np.bincount(ids)  # ids are below the size of the vocabulary: counted without sorting the list
    u = np.flatnonzero(count)
    order = np.argsort(-count[u], kind="stable")
    rank = np.empty(len(count), np.int64)
    rank[u[order]] = np.arange(len(u))
    r, one = rank[ids], 256
    if len(u) > 256:
        one = next((c for c in range(255, -1, -1) if c + ((len(u) - 1 - c) >> 8) <= 255), -1)
    kind = "<u2" if not len(u) or u[-1] < 1 << 16 else "<u4"
    head = np.array([len(ids), len(u), one, int(kind[-1])], "<i8").tobytes() + u[order].astype(kind).tobytes()
    if one < 0:  # too many distinct ids for two bytes
        body = r.astype("<u4").tobytes()
    else:
        single = r < one
        end = np.cumsum(np.where(single, 1, 2))
        body_ = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
        body_[end[single] - 1] = r[single]
        rest = r[~single] - one
        body_[end[~single] - 2], body_[end[~single] - 1] = one + (rest >> 8), rest & 255
        body = body_.tobytes()
    return zstandard.ZstdCompressor(level=6).compress(head + body)


def unpack_ids(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, distinct, one, wide = (int(x) for x in np.frombuffer(raw, "<i8", 4))
    u, at = np.frombuffer(raw, f"<u{wide}", distinct, 32), 32 + wide * distinct
    if one < 0:
        return u[np.frombuffer(raw, "<u4", n, at)]
    body = np.frombuffer(raw, np.uint8, offset=at).astype(np.int64)
    # a byte that begins a pair makes the next one a second byte, whatever it holds: runs of such bytes alternate
    pair = body >= one
    if not pair.any():
        return u[body]
    at, run = np.arange(len(body)), np.where(pair, 0, np.arange(len(body)) + 1)
    since = at - np.maximum.accumulate(run)  # place in the run of possible first bytes, from 0
    first = pair & (since % 2 == 0)
    second = np.concatenate([[False], first[:-1]])
    lead = ~second
    value = np.where(first, 0, body)
    value[first] = one + ((body[first] - one) << 8) + body[np.flatnonzero(first) + 1]
    return u[value[lead]]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Pieces of BATCH_BYTES in all with their cut points (found piece by piece, which needs many bytes for each byte of text)."""
    held: list[tuple] = []
    for rows, data, off in pieces(batches):
        if held and sum(len(h[1]) for h in held) + len(data) > BATCH_BYTES:
            yield _joined(held)
            held = []
        held.append((rows.column("id"), data.copy(), off, *cut_points(data, off)))
    if held:
        yield _joined(held)


def _joined(held: list[tuple]) -> tuple:
    base = np.concatenate([[0], np.cumsum([len(h[1]) for h in held])])
    off = np.concatenate([[0], *(h[2][1:] + b for h, b in zip(held, base, strict=False))])
    return (pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]), off,
            np.concatenate([h[3] + b for h, b in zip(held, base, strict=False)]), np.concatenate([h[4] for h in held]))


def _send(buckets: int):
    """Batches of texts -> their distinct chunks by bucket, and one manifest row (bucket -1 - batch) each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=TEXT_LEVEL)
        part, number = TaskContext.get().partitionId(), 0
        for ids, data, off, starts, safe in _gathered(batches):
            batch = (part << 32) + number
            number += 1
            text, ends = data.tobytes(), np.append(starts[1:], len(data))
            seen: dict[bytes, int] = {}
            where = np.fromiter((seen.setdefault(text[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)),
                                np.int64, len(starts))
            bucket = np.fromiter((int.from_bytes(hashlib.blake2b(c, digest_size=8).digest(), "little") % buckets for c in seen),
                                 np.int64, len(seen))
            unique = list(seen)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            place = np.empty(len(unique), np.int64)
            place[order] = np.arange(len(unique))  # chunks arrive back in this order
            out = [[], [], [], []]
            for a, b in zip(edges, np.append(edges[1:], len(order))[: len(edges)], strict=True):
                mine = [unique[i] for i in order[a:b]]
                out[0].append(int(bucket[order[a]]))
                out[1].append(batch)
                out[2].append(np.array([len(c) for c in mine], "<u4").tobytes())
                out[3].append(pack.compress(b"".join(mine)))
            doc = np.searchsorted(off, starts, "right") - 1  # the last document that starts at or before it
            manifest = pa.table({"id": ids, "chunks": np.bincount(doc, minlength=len(ids))})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, manifest.schema) as w:
                w.write_table(manifest)
            out[0].append(-1 - batch % buckets)
            out[1].append(batch)
            out[2].append(place[where].astype("<u4").tobytes() + safe.astype(np.uint8).tobytes())
            out[3].append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
                                             ["bucket", "batch", "sizes", "body"])

    return run


def _encode(path: str):
    """Chunk rows -> rows of ids; each distinct chunk of a partition is encoded once. Manifests pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = spaced_encoder(path)
        unpack = zstandard.ZstdDecompressor()
        width, done, now = int(enc.dtype[-1]), {}, None
        for batch in batches:
            sizes, bodies = [], []
            for bucket, s, b in zip(*(batch.column(c).to_pylist() for c in ("bucket", "sizes", "body")), strict=True):
                if bucket >= 0:
                    if bucket != now:  # rows come sorted by bucket
                        now, done = bucket, {}
                    text, at, got = unpack.decompress(b), 0, []
                    for n in np.frombuffer(s, "<u4").tolist():
                        c = text[at: at + n]
                        at += n
                        ids = done.get(c)
                        if ids is None:
                            ids = done[c] = enc.encode(c.decode("utf-8"))
                        got.append(ids)
                    s = np.array([len(x) // width for x in got], "<u4").tobytes()
                    b = pack_ids(np.frombuffer(b"".join(got), enc.dtype))
                sizes.append(s)
                bodies.append(b)
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), batch.column("batch"), pa.array(sizes, pa.binary()),
                                              pa.array(bodies, pa.binary())], ["bucket", "batch", "sizes", "body"])

    return run


def repair(chunks: list[np.ndarray], safe: list[bool], path: str) -> np.ndarray:
    """Ids of the joined text of ``chunks`` (ids each); safe[k] says that the join before chunk k needs no repair."""
    if all(safe[1:]):
        return np.concatenate(chunks) if chunks else np.zeros(0, np.int64)
    table, encode = id_bytes(path), load(path).encode
    out: list[np.ndarray] = []
    run: list[np.ndarray] = []

    def close() -> None:
        if len(run) == 1:
            out.append(run[0])
        elif run:
            left, right = run[0], run[-1]
            a, b = _boundary(left, table, last=True), _boundary(right, table, last=False)
            middle = [left[a:], *run[1:-1], right[:b]]
            text = b"".join(table[i] for part in middle for i in part).decode("utf-8")
            out.extend([left[:a], np.array(encode(text, add_special_tokens=False).ids, np.int64), right[b:]])

    for k, c in enumerate(chunks):
        if k and safe[k]:
            close()
            run = []
        run.append(c)
    close()
    return np.concatenate(out)


def _boundary(ids: np.ndarray, table: list[bytes], last: bool) -> int:
    """Index of an id that begins at a provable boundary inside these ids; 0 or len(ids) if there is none."""
    order = range(len(ids) - 1, 0, -1) if last else range(1, len(ids))
    for k in order:
        t, before = table[ids[k]], table[ids[k - 1]]
        if t[:1] == b" " and len(t) > 1 and 32 < t[1] < 127 and 32 < before[-1] < 127:
            return k
    return 0 if last else len(ids)


def _assemble(path: str, finish):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("bucket", "sizes", "body")), strict=True), key=lambda r: r[0])
        assert sum(r[0] < 0 for r in rows) == 1, "a batch came back without its manifest"
        manifest = pa.ipc.open_stream(rows[0][2]).read_all()
        dtype = spaced_encoder(path).dtype
        lengths = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r[1], "<u4").astype(np.int64) for r in rows[1:])])
        ids = np.concatenate([np.zeros(0, dtype), *(unpack_ids(r[2]).astype(dtype) for r in rows[1:])])
        ends = np.cumsum(lengths)
        per_doc = manifest.column("chunks").to_numpy()
        total = int(per_doc.sum())
        where, safe = np.frombuffer(rows[0][1], "<u4", total), np.frombuffer(rows[0][1], np.uint8, total, 4 * total)
        assert not total or where.max() < len(lengths), "a batch came back without all its chunks"
        docs, k = [], 0
        for n in per_doc.tolist():
            parts = [ids[ends[w] - lengths[w]: ends[w]] for w in where[k: k + n].tolist()]
            docs.append(repair(parts, [bool(x) for x in safe[k: k + n]], path) if n else np.zeros(0, dtype))
            k += n
        return finish(manifest.column("id"), docs)

    return run


def _digest(path: str):
    def finish(id_: pa.ChunkedArray, docs: list[np.ndarray]) -> pa.Table:
        table = id_bytes(path)
        n, sha, text = [], [], []
        for ids in docs:
            n.append(len(ids))
            sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            raw = b"".join(map(table.__getitem__, ids.tolist()))
            text.append(hashlib.sha256(raw.decode("utf-8", "replace").encode("utf-8")).hexdigest())
        return pa.table({"id": id_, "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(sha, pa.string()),
                         "decoded_sha256": pa.array(text, pa.string())})

    return finish


def _full(path: str):
    def finish(id_: pa.ChunkedArray, docs: list[np.ndarray]) -> pa.Table:
        table = id_bytes(path)
        text = [b"".join(map(table.__getitem__, d.tolist())).decode("utf-8", "replace") for d in docs]
        return pa.table({"id": id_, "ids": pa.array([d.astype(np.int32) for d in docs], pa.list_(pa.int32())), "decoded": text})

    return finish


def _apply(docs: DataFrame, path: str, id_col: str, text_col: str, finish, schema: str) -> DataFrame:
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    sent = src.mapInArrow(_send(buckets), _SCHEMA).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    back = sent.mapInArrow(_encode(path), _SCHEMA)
    return back.groupBy("batch").applyInArrow(_assemble(path, finish), schema).withColumnRenamed("id", id_col)


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: ids as little-endian unsigned 32-bit integers, decoded text in UTF-8.

    ``path`` names a byte-level BPE file whose words take the space before them. Null and
    empty texts have no ids; null and repeated ids and equal rows come back as they are; one
    very long text is one piece of work; an empty table gives no rows; other columns are
    ignored. ``docs`` should be a table (or staged): a lost task's batches are made again from it.
    """
    return _apply(docs, path, id_col, text_col, _digest(path),
                  "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row, with the rules of ``encode_digests``."""
    return _apply(docs, path, id_col, text_col, _full(path), "id long, ids array<int>, decoded string")
