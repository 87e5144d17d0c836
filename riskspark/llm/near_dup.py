"""MinHash near-duplicates by a multi-index Hamming join (numbered operator 6).

Each document's set of distinct 5-word shingles gets a signature of ``POSITIONS`` b-bit
minimum hashes. Two signatures are close when few positions differ. By pigeonhole, if at
most ``CHUNKS * (ERRORS + 1) - 1`` of the positions differ, some chunk of a split signature
has at most ``ERRORS`` differing positions; so each chunk is indexed once for every way of
leaving out ``ERRORS`` of its positions, and equal keys meet. That finds every pair up to
19 differing positions of 40, and at similarity 0.75 misses a pair with probability 2e-6.
Links are then confirmed on the full shingle sets.

Copies of one shingle set are one class from the start, so exact copies never form pairs.
Inside a bucket, members are first compared with one centre only (the member that meets
most others) and the verified links are contracted to components, so a bucket of n mutual
near copies costs n comparisons. Where a bucket then still holds several components, the
members outside its main component are a query set: they are compared with that component's
members and with each other, in blocks of full sets, and a block pair returns one spanning
link per component it joins, never its pairs. So no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import (inside, lower_ascii, mix, pieces, stage, stage_dir, text_bytes, window_hashes,
                                  word_hashes, word_spans)
from riskspark.llm.components import components

SHINGLE = 5
CHUNKS, CHUNK, ERRORS = 10, 4, 1
POSITIONS = CHUNKS * CHUNK
#: Star pairs whose 64-bit sketches (low bits of the positions) differ in more bits are not confirmed: at similarity
#: 0.75 eight are expected, and more than 28 have a probability below 1e-7.
FAR_BITS = 28
#: Classes, and shingles, in a block of the second comparison.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 400_000
PERCENT = 75

_RNG = np.random.RandomState(7)
_MUL = _RNG.randint(0, 2**63 - 1, POSITIONS, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_ADD = _RNG.randint(0, 2**63 - 1, POSITIONS, dtype=np.int64).astype(np.uint64)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document (empty without words)."""
    data = lower_ascii(data)
    starts, ends, word_off = word_spans(data, off)
    h = word_hashes(data, starts, ends)
    rolled = window_hashes(h, SHINGLE)
    out = []
    for a, b in zip(word_off[:-1], word_off[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a: b - SHINGLE + 1]))
        else:  # fewer words: the whole sequence is the one shingle
            out.append(window_hashes(h[a:b], int(b - a))[:1] if b > a else np.zeros(0, np.uint64))
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in pieces(batches):
        sets = shingle_sets(data, off)
        n = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(n)
        h1, h2, sig = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.zeros((len(n), POSITIONS), np.int32)
        if len(full):
            at = np.concatenate([[0], np.cumsum(n[full])[:-1]])
            every = np.concatenate([sets[i] for i in full])
            h1[full] = np.add.reduceat(mix(every ^ np.uint64(0xA5A5A5A5)), at).astype(np.int64)
            h2[full] = np.add.reduceat(mix(every ^ np.uint64(0x5A5A5A5A5A)), at).astype(np.int64)
            for j in range(POSITIONS):
                low = np.minimum.reduceat(every * _MUL[j] + _ADD[j], at)
                sig[full, j] = (mix(low) >> np.uint64(48)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * POSITIONS), pa.array(sig.ravel()))
        yield pa.RecordBatch.from_arrays([rows.column("id").cast(pa.int64()), pa.array(n), pa.array(h1), pa.array(h2), lists],
                                         ["id", "n", "h1", "h2", "sig"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose full sets reach the similarity."""
    for batch in batches:
        a, b = [], []
        last, left = None, None
        for i in range(batch.num_rows):
            ia, ib = batch.column("a")[i].as_py(), batch.column("b")[i].as_py()
            if last != ia:  # rows come sorted by the left end
                last, left = ia, shingle_sets(*text_bytes(batch.column("text_a").slice(i, 1)))[0]
            right = shingle_sets(*text_bytes(batch.column("text_b").slice(i, 1)))[0]
            both = len(np.intersect1d(left, right, assume_unique=True))
            if both and 100 * both >= PERCENT * (len(left) + len(right) - both):
                a.append(ia)
                b.append(ib)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _keys(sig: str):
    """The index keys of a signature: per chunk, each choice of the positions that must agree."""
    keys = []
    for c in range(CHUNKS):
        for kept in combinations(range(CHUNK), CHUNK - ERRORS):
            key = F.lit(len(keys)).cast("long")
            for p in kept:
                key = F.shiftleft(key, 16).bitwiseOR(F.col(sig)[c * CHUNK + p].cast("long"))
            keys.append(key)
    return F.explode(F.array(*keys))


def _sketch(sig: str):
    """The lowest bit of every position and the next bit of the first ones, in one long."""
    out = F.lit(0).cast("long")
    for k in range(64):
        bit = F.shiftright(F.col(sig)[k % POSITIONS], k // POSITIONS).bitwiseAND(F.lit(1)).cast("long")
        out = F.shiftleft(out, 1).bitwiseOR(bit)
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in pieces(batches):
        packed = [x.tobytes() for x in shingle_sets(data, off)]
        yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(packed, pa.binary())], ["id", "shingles"])


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, over the shingles that both sides hold."""
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), 4096):
        part = shared[at: at + 4096]

        def table(sets: list[np.ndarray]) -> np.ndarray:
            m = np.zeros((len(sets), len(part)), np.float32)
            for i, x in enumerate(sets):
                x = x[np.searchsorted(x, part[0]): np.searchsorted(x, part[-1], "right")]
                k = np.searchsorted(part, x)
                m[i, k[part[k] == x]] = 1
            return m

        out += table(left) @ table(right).T
    return out


def _block_links(group: pa.Table) -> pa.Table:
    """Spanning links between the components of one block pair, found on full sets."""
    ids, comp = group.column("id").to_numpy(), group.column("comp").to_numpy()
    ask = group.column("ask").to_numpy(zero_copy_only=False)
    sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
    q, t = np.flatnonzero(ask), np.flatnonzero(~ask)
    links: dict[int, int] = {}  # component -> its parent, as a forest
    a, b = [], []
    if len(q) and len(t):
        both = _common([sets[i] for i in q], [sets[i] for i in t])
        size = np.array([len(x) for x in sets], np.int64)
        hit = (100 * both >= PERCENT * (size[q][:, None] + size[t][None, :] - both)) & (both > 0) & (comp[q][:, None] != comp[t][None, :])

        def root(c: int) -> int:
            while c in links:
                c = links[c]
            return c

        for i, j in zip(*np.nonzero(hit), strict=True):
            x, y = root(int(comp[q[i]])), root(int(comp[t[j]]))
            if x != y:
                links[max(x, y)] = min(x, y)
                a.append(max(int(ids[q[i]]), int(ids[t[j]])))
                b.append(min(int(ids[q[i]]), int(ids[t[j]])))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _apart(members: DataFrame, comp: DataFrame, texts: DataFrame, at: str) -> DataFrame:
    """Links (a, b) that the stars missed, from buckets of three or more that hold several components."""
    named = stage(members.where("size > 2").join(comp, "id", "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("comp")), f"{at}/named")
    per = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("size"))
    main = per.groupBy("key").agg(F.max(F.struct("size", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("comps")) \
        .where("comps > 1").select("key", "main")
    # queries: outside the main component; targets: the main components' members in such buckets, and the queries
    rows = named.join(main, "key").select("main", "id", "comp", "n", (F.col("comp") != F.col("main")).alias("ask")).distinct()
    rows = stage(rows.groupBy("main", "id", "comp", "n").agg(F.max("ask").alias("ask")), f"{at}/rows")
    blocks = lambda n, s: F.greatest(F.lit(1), F.ceil(n / BLOCK_ROWS), F.ceil(s / BLOCK_SHINGLES)).cast("int")
    size = rows.groupBy("main").agg(
        blocks(F.sum(F.col("ask").cast("int")), F.sum(F.when(F.col("ask"), F.col("n")))).alias("nq"),
        blocks(F.count(F.lit(1)), F.sum("n")).alias("nt"))
    sets = texts.join(rows.select("id").distinct(), "id", "left_semi").mapInArrow(_sets, "id long, shingles binary")
    rows = rows.join(size, "main")
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    targets = rows.select("main", "id", "comp", F.lit(False).alias("ask"), every("nq").alias("qb"), mine("nt").alias("tb"))
    queries = rows.where("ask").select("main", "id", "comp", "ask", mine("nq").alias("qb"), every("nt").alias("tb"))
    return targets.union(queries).join(sets, "id").groupBy("main", "qb", "tb") \
        .applyInArrow(lambda g: _block_links(g), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row of ``docs``.

    ``n_shingles`` is the size of the row's set of distinct 5-word shingles over lower-cased
    A-Z (with fewer words the whole sequence is the one shingle); ``component_id`` the least
    id that links of similarity >= 0.75 reach; ``kept`` whether that is the row itself.

    Null or empty text and text without words: an empty set, linked with nothing, kept. A
    null id joins its class but is nobody's representative: it gets the class's component,
    or null and kept when its class has no id. Repeated rows (one id, one text) are each
    returned and share a component. Very long texts are one piece of work of their own size.
    An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    at = stage_dir(spark)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sigs = stage(src.mapInArrow(_signatures, "id long, n long, h1 long, h2 long, sig array<int>"), f"{at}/signatures")
    # a class: all rows with one shingle set; its least id stands for it
    classes = stage(sigs.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("h1", "h2", "n")
                    .agg(F.min("id").alias("rep"), F.first("sig").alias("sig")).withColumn("sketch", _sketch("sig")), f"{at}/classes")
    postings = classes.select(F.col("rep").alias("id"), "n", "sketch", _keys("sig").alias("key"))
    buckets = stage(postings.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), f"{at}/buckets")
    members = stage(postings.join(buckets, "key"), f"{at}/members")
    # centre of a bucket: the member that meets most others in all its buckets together
    score = members.groupBy("id").agg(F.sum("size").alias("score"))
    centre = stage(members.join(score, "id").groupBy("key").agg(
        F.max(F.struct("score", (-F.col("id")).alias("id"), "n", "sketch")).alias("c"))
        .select("key", (-F.col("c.id")).alias("cid"), F.col("c.n").alias("cn"), F.col("c.sketch").alias("cs")), f"{at}/centres")
    texts = stage(src.join(members.select("id").distinct(), "id", "left_semi"), f"{at}/texts")
    close = F.expr(f"100 * least(n, cn) >= {PERCENT} * greatest(n, cn)")  # sizes alone bound the similarity
    alike = F.bit_count(F.col("sketch").bitwiseXOR(F.col("cs"))) <= FAR_BITS
    pairs = members.join(centre, "key").where((F.col("id") != F.col("cid")) & close & alike) \
        .select(F.greatest("id", "cid").alias("a"), F.least("id", "cid").alias("b")).distinct()
    links = stage(_links(pairs, texts), f"{at}/links")
    comp = stage(components(links, f"{at}/cc"), f"{at}/component")
    more = stage(_apart(members, comp, texts, at), f"{at}/links-apart")
    if more.limit(1).count():
        comp = stage(components(comp.select(F.col("id").alias("a"), F.col("component").alias("b"))
                                .union(more), f"{at}/cc-apart"), f"{at}/component-apart")

    named = classes.join(comp, classes["rep"] == comp["id"], "left").select(
        "h1", "h2", F.col("n").alias("_n"), F.coalesce("component", "rep").alias("component"))
    out = sigs.select("id", "n", "h1", "h2").join(
        named, (sigs["h1"] == named["h1"]) & (sigs["h2"] == named["h2"]) & (sigs["n"] == named["_n"]), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), component.isNull()).alias("kept"))


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    j = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a") \
             .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return j.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("text_b").alias("text_a"),
                    F.col("text_a").alias("text_b")).mapInArrow(_confirm, "a long, b long")
