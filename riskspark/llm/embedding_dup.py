"""Embedding near-duplicates by NN-descent (numbered operator 10).

Vectors of one label are linked at cosine >= THRESHOLD. A neighbour graph finds the links: lists
start from vectors that lie side by side in several random-hyperplane orders, then rounds of
NN-descent compare, around every vector, its neighbours with each other, forward and reverse,
and keep each vector's best LIST. Rounds stop when an audit against brute force (AUDIT hashed
vectors, more where few of them have links) reaches RECALL of the links that lists can hold.

A list whose last entry still reaches the threshold is saturated: its vector may have more
links. Such lists are enlarged to all links: the vector is compared, block by block, with every
member of its component, and with every vector outside that the component may reach: no link
is longer than the angle of THRESHOLD, so the angle to the component's representative is at
most that and the greatest angle between the representative and a saturated member. Blocks
return counts per vector, not pairs, and one link for each two components they join.

The audited vectors' final links are held against all their true ones; below RECALL of them,
every vector is enlarged like a saturated one.

Exact copies are one vector with a multiplicity throughout, so they never form pairs. Reverse
neighbours of a hub are split into salted groups, so no vector's neighbourhood is one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import stage, stage_dir
from riskspark.llm.components import components

THRESHOLD = 0.98
LIST = 12
TREES = 8
#: Following vectors in each order that a list starts from.
BESIDE = 2
#: Members of one neighbourhood group; a hub's reverse neighbours go to several.
GROUP = 48
MAX_ROUNDS, MIN_ROUNDS = 6, 2
AUDIT, RECALL = 200, 0.99
#: The audit grows fourfold until its vectors have so many links, or are AUDIT_MOST or all of them.
AUDIT_LINKS, AUDIT_MOST = 200, 12_800
BLOCK = 1024
#: Vectors, and representatives, in a block of the search beyond the components.
FAR_ROWS, FAR_REPS = 4096, 16_384
#: Angle of the threshold, with room for rounding.
ANGLE = float(np.arccos(THRESHOLD)) + 1e-6

_EDGE = "u long, v long, sim double"


def unit(vectors: list[bytes]) -> np.ndarray:
    """Rows of float32 bytes as double-precision unit vectors."""
    x = np.frombuffer(b"".join(vectors), np.float32).reshape(len(vectors), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; null where they cannot be compared."""
    for b in batches:
        out = []
        for x, label in zip(b.column("embedding"), b.column("label"), strict=True):
            ok = x.is_valid and label.is_valid and len(x.values) and not x.values.null_count
            a = x.values.to_numpy(zero_copy_only=False).astype(np.float32) if ok else None
            out.append(a.tobytes() if ok and np.isfinite(a).all() and np.any(a) else None)
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(out, pa.binary())], ["id", "label", "vec"])


def _orders(bits: int):
    """Random-hyperplane code and a projection of each vector, for each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            codes, places, vecs = [], [], b.column("vec").to_pylist()
            for vec in vecs:
                x = np.frombuffer(vec, np.float32)
                if len(x) not in planes:
                    planes[len(x)] = np.random.RandomState(17).randn(TREES, bits + 1, len(x))
                p = planes[len(x)] @ (x / np.linalg.norm(x.astype(np.float64)))
                codes.append(((p[:, :bits] > 0) @ (1 << np.arange(bits))).tolist())
                places.append(p[:, bits].tolist())
            yield pa.RecordBatch.from_arrays([b.column("v"), b.column("g"), b.column("vec"), pa.array(codes, pa.list_(pa.int64())),
                                              pa.array(places, pa.list_(pa.float64()))], ["v", "g", "vec", "codes", "places"])

    return run


def _edges(u: np.ndarray, v: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float64())], ["u", "v", "sim"])


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges, both ways, between rows that follow each other in the partition's order and share a group."""
    last: list[tuple] = []
    for b in batches:
        rows = last + list(zip(b.column("g").to_pylist(), b.column("v").to_pylist(), b.column("vec").to_pylist(), strict=True))
        u, v, s = [], [], []
        at = 0
        while at < len(rows):  # stretches of one group
            end = at
            while end < len(rows) and rows[end][0] == rows[at][0]:
                end += 1
            if end - at > 1:
                x, ids = unit([r[2] for r in rows[at:end]]), np.array([r[1] for r in rows[at:end]], np.int64)
                for k in range(1, min(BESIDE, end - at - 1) + 1):
                    u.append(ids[:-k])
                    v.append(ids[k:])
                    s.append((x[:-k] * x[k:]).sum(axis=1))
            at = end
        if u:
            a, c, sim = np.concatenate(u), np.concatenate(v), np.concatenate(s)
            keep = a != c
            yield _edges(np.concatenate([a[keep], c[keep]]), np.concatenate([c[keep], a[keep]]), np.concatenate([sim[keep]] * 2))
        last = rows[-BESIDE:]


def _lists(edges: DataFrame) -> DataFrame:
    """(u, near): the best LIST neighbours of each vector as (sim, v), best first; one entry for each neighbour."""
    one = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    return one.groupBy("u").agg(F.slice(F.sort_array(F.collect_list(F.struct("sim", "v")), asc=False), 1, LIST).alias("near"))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (c, salt, m, worst, vec) sorted by neighbourhood -> edges that better a member's list."""
    key, ids, worst, vecs = None, [], [], []

    def local():
        m, first = np.unique(np.array(ids, np.int64), return_index=True)
        if len(m) < 2:
            return None
        x, w = unit([vecs[i] for i in first]), np.array([worst[i] for i in first])
        sim = x @ x.T
        np.fill_diagonal(sim, -2)
        better = sim > w[:, None]
        if len(m) > LIST:  # a member's list takes LIST of them at most
            better &= sim >= -np.partition(-sim, LIST - 1, axis=1)[:, LIST - 1: LIST]
        i, j = np.nonzero(better)
        return (m[i], m[j], sim[i, j]) if len(i) else None

    for b in batches:
        out = []
        for c, salt, m, w, vec in zip(*(b.column(k).to_pylist() for k in ("c", "salt", "m", "worst", "vec")), strict=True):
            if key != (c, salt):
                if key is not None and (got := local()):
                    out.append(got)
                key, ids, worst, vecs = (c, salt), [], [], []
            ids.append(m)
            worst.append(w)
            vecs.append(vec)
        if out:
            yield _edges(*(np.concatenate(x) for x in zip(*out, strict=True)))
    if key is not None and (got := local()):
        yield _edges(*got)


def _round(lists: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Round ``k`` of NN-descent: neighbours of a vector, forward and reverse, are compared with each other.

    A hub's are dealt to other groups in every round, so no two of them are kept apart for good."""
    full = F.size("near") >= LIST
    node = nodes.join(lists, nodes["v"] == lists["u"]).select(
        "v", "vec", "near", F.when(full, F.element_at("near", -1)["sim"]).otherwise(F.lit(-2.0)).alias("worst"))
    edge = lists.select(F.col("u").alias("c"), F.explode("near.v").alias("m"))
    both = edge.union(edge.select(F.col("m").alias("c"), F.col("c").alias("m"))).distinct()
    degree = both.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups"))
    both = both.join(degree, "c").select("c", F.pmod(F.xxhash64("m", F.lit(k)), F.col("groups")).alias("salt"), "m")
    own = degree.select("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("salt")).withColumn("m", F.col("c"))
    member = both.union(own).join(node.select(F.col("v").alias("m"), "worst", "vec"), "m")
    found = member.repartition("c", "salt").sortWithinPartitions("c", "salt").mapInArrow(_compare, _EDGE)
    old = lists.select("u", F.explode("near").alias("n")).select("u", "n.v", "n.sim")
    return _lists(found.union(old))


def _truth(ids: list[int], groups: list[str], vecs: list[bytes]):
    """Brute-force links of the audited vectors, as counts per batch of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[str, list[int]] = {}
        for k, g in enumerate(groups):
            mine.setdefault(g, []).append(k)
        count, copies = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for b in batches:
            rows: dict[str, list[int]] = {}
            for k, g in enumerate(b.column("g").to_pylist()):
                if g in mine:
                    rows.setdefault(g, []).append(k)
            v, vec, mult = b.column("v").to_pylist(), b.column("vec"), b.column("mult").to_numpy()
            for g, at in rows.items():
                sim = unit([vecs[k] for k in mine[g]]) @ unit([vec[k].as_py() for k in at]).T
                other = np.array([ids[k] for k in mine[g]])[:, None] != np.array([v[k] for k in at])[None, :]
                count[mine[g]] += ((sim >= THRESHOLD) & other).sum(axis=1)
                copies[mine[g]] += ((sim >= THRESHOLD) & other) @ mult[at]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(count), pa.array(copies)], ["v", "n", "copies"])

    return run


def audit(nodes: DataFrame, n: int) -> tuple[list[int], list]:
    """Hashed vectors and their true links by brute force (rows v, n, copies): so many that they have AUDIT_LINKS links, if the bounds allow."""
    size = AUDIT
    while True:
        chosen = nodes.select("v", "g", "vec").orderBy(F.xxhash64("v"), "v").limit(size).collect()
        ids = [r["v"] for r in chosen]
        truth = nodes.select("v", "g", "vec", "mult").mapInArrow(
            _truth(ids, [r["g"] for r in chosen], [r["vec"] for r in chosen]), "v long, n long, copies long") \
            .groupBy("v").agg(F.sum("n").alias("n"), F.sum("copies").alias("copies")).collect()
        if sum(r["n"] for r in truth) >= AUDIT_LINKS or size >= min(n, AUDIT_MOST):
            return ids, truth
        size *= 4


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Angle between the vector and the representative of each row."""
    for b in batches:
        angle = [float(np.arccos(np.clip((unit([x]) * unit([y])).sum(), -1, 1)))
                 for x, y in zip(b.column("vec").to_pylist(), b.column("rep").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("component"), pa.array(angle, pa.float64())], ["component", "angle"])


def _far(group: pa.Table) -> pa.Table:
    """One block pair: the vectors that representatives of other components (rows with a reach) may reach."""
    reach = group.column("reach").to_numpy(zero_copy_only=False)
    home, vec = group.column("component").to_numpy(), group.column("vec").to_pylist()
    sides: dict[str, tuple[list[int], list[int]]] = {}
    for k, g in enumerate(group.column("g").to_pylist()):
        sides.setdefault(g, ([], []))[int(np.isnan(reach[k]))].append(k)
    reps, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for r, t in sides.values():
        if not r or not t:
            continue
        x, t = unit([vec[k] for k in t]), np.array(t)
        for at in range(0, len(r), BLOCK):
            k = np.array(r[at: at + BLOCK])
            near = unit([vec[i] for i in k]) @ x.T >= np.cos(np.minimum(reach[k], np.pi))[:, None] - 1e-9
            i, j = np.nonzero(near & (home[k][:, None] != home[t][None, :]))
            reps.append(k[i])
            rows.append(t[j])
    reps, rows = np.concatenate(reps), np.concatenate(rows)
    out = group.select(["v", "mult", "vec", "saturated"]).take(pa.array(rows))
    return out.append_column("component", pa.array(home[reps])).append_column("home", pa.array(home[rows]))


def _block_counts(group: pa.Table) -> pa.Table:
    """One block pair: links of each saturated vector by count, links of others by name, and one link (n null) per other component."""
    ask = group.column("ask").to_numpy(zero_copy_only=False)
    ids, mult = group.column("v").to_numpy(), group.column("mult").to_numpy()
    open_ = ~group.column("saturated").to_numpy(zero_copy_only=False)
    away, home = group.column("home").to_numpy() != group.column("component").to_numpy(), group.column("home").to_numpy()
    vec = group.column("vec").to_pylist()
    q, t = np.flatnonzero(ask), np.flatnonzero(~ask)
    if not len(q) or not len(t):
        return pa.table({"v": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
    hit = (unit([vec[i] for i in q]) @ unit([vec[i] for i in t]).T >= THRESHOLD) & (ids[q][:, None] != ids[t][None, :])
    i, j = np.nonzero(hit & open_[t][None, :])
    cross = np.flatnonzero(away[t] & hit.any(axis=0))
    cross = cross[np.unique(home[t][cross], return_index=True)[1]]
    joined = ids[q][hit[:, cross].argmax(axis=0)]
    n = np.concatenate([hit @ mult[t], mult[q][i]])
    return pa.table({"v": pa.array(np.concatenate([ids[q], ids[t][j], joined])), "n": pa.array(n.tolist() + [None] * len(cross), pa.int64()),
                     "other": pa.array([None] * len(q) + ids[q][i].tolist() + ids[t][cross].tolist(), pa.int64())})


def _beyond(member: DataFrame, n: int) -> DataFrame:
    """Vectors outside a component (``component``; their own is ``home``) that its saturated vectors may be linked with."""
    rep = member.where("v = component").select("component", "g", F.col("vec").alias("rep"))
    angle = member.where("saturated").join(rep.drop("g"), "component").select("component", "vec", "rep").mapInArrow(_angles, "component long, angle double")
    rep = rep.join(angle.groupBy("component").agg((F.max("angle") + ANGLE).alias("reach")), "component")
    nt = max(1, -(-n // FAR_ROWS))
    nr = max(1, -(-member.where("saturated").select("component").distinct().count() // FAR_REPS))
    block = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    none = F.lit(None)
    rows = member.select("g", "component", "v", "mult", "vec", "saturated", none.cast("double").alias("reach"), every(nr).alias("rb"), block("v", nt).alias("tb")) \
        .union(rep.select("g", "component", none.cast("long"), none.cast("long"), "rep", none.cast("boolean"), "reach", block("component", nr), every(nt)))
    return rows.groupBy("rb", "tb").applyInArrow(lambda g: _far(g), "v long, mult long, vec binary, saturated boolean, component long, home long")


def _enlarged(nodes: DataFrame, n: int, links: DataFrame, comp: DataFrame, saturated: DataFrame, at: str) -> tuple[DataFrame, DataFrame]:
    """Number of links (v, n) and component (id, component) of the vectors, with all links of the saturated ones."""
    member = nodes.join(comp.withColumnRenamed("id", "v"), "v", "left").join(saturated, "v", "left") \
        .select("g", "v", "mult", "vec", F.coalesce("component", "v").alias("component"), F.coalesce("saturated", F.lit(False)).alias("saturated"))
    member = stage(member, f"{at}/members")
    cols = ["component", "home", "v", "mult", "vec", "saturated"]
    beyond = stage(_beyond(member, n), f"{at}/beyond").select(*cols)
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(c / BLOCK)).cast("int")
    target = member.withColumn("home", F.col("component")).select(*cols).union(beyond)
    asks = F.col("saturated") & (F.col("home") == F.col("component"))
    size = target.groupBy("component").agg(blocks(F.sum(asks.cast("int"))).alias("nq"), blocks(F.count(F.lit(1))).alias("nt"),
                                           F.max(asks).alias("any")).where("any")
    dealt = target.join(size, "component")
    mine = lambda c: F.pmod(F.xxhash64("v"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    pairs = dealt.select(*cols, F.lit(False).alias("ask"), every("nq").alias("qb"), mine("nt").alias("tb")) \
        .union(dealt.where(asks).select(*cols, F.lit(True), mine("nq"), every("nt")))
    wide = stage(pairs.groupBy("component", "qb", "tb").applyInArrow(lambda g: _block_counts(g), "v long, n long, other long"), f"{at}/wide")
    counted = wide.where("other is null").groupBy("v").agg(F.sum("n").alias("n"))
    named = wide.where("other is not null and n is not null").select("v", "other")
    listed = links.join(saturated.select(F.col("v").alias("u")), "u", "left_anti").union(named).distinct()
    listed = listed.join(nodes.select("v", "mult"), "v").groupBy(F.col("u").alias("v")).agg(F.sum("mult").alias("n"))
    more = wide.where("n is null").select(F.col("v").alias("a"), F.col("other").alias("b"))
    if more.limit(1).count():
        comp = stage(components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more), f"{at}/cc"), f"{at}/component")
    return counted.union(listed), comp


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    ``n_links`` counts the other rows linked directly (copies included), ``component_id`` is the
    least id that links reach, itself included, and ``kept`` says whether that is the row itself.

    Rows with a null label, a null, empty or zero vector, or null or non-finite components link
    with nothing; so do vectors of different lengths. Equal rows are other vectors of cosine 1.
    Rows with a null id link through their copies only, and count as links of these: with no id among them they have no
    links and a null component. Ties in a list go to the larger id. An empty table gives no
    rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    at = stage_dir(spark)
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).alias("embedding"))
    rows = stage(src.mapInArrow(_valid, "id long, label string, vec binary")
                 .select("id", F.concat_ws(":", F.length("vec").cast("string"), "label").alias("g"), "vec",
                         F.xxhash64("label", "vec").alias("h1"), F.xxhash64(F.lit(1), "label", "vec").alias("h2")), f"{at}/rows")
    known = rows.where(F.col("vec").isNotNull())
    nodes = known.groupBy("h1", "h2").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("mult"), F.first("g").alias("g"), F.first("vec").alias("vec"))
    nodes = stage(nodes.where("v is not null"), f"{at}/nodes")
    n = nodes.count()
    bits = int(np.clip(np.log2(max(n, 2) / 16), 2, 30))
    placed = stage(nodes.select("v", "g", "vec").mapInArrow(_orders(bits), "v long, g string, vec binary, codes array<long>, places array<double>"), f"{at}/placed")
    trees = placed.select("g", "v", "vec", F.posexplode(F.arrays_zip("codes", "places")).alias("tree", "p")) \
        .select("g", "tree", F.col("p.codes").alias("code"), F.col("p.places").alias("place"), "v", "vec")
    # by range of the whole order, so a dense code is split; the tree is part of the group
    order = ["tree", "g", "code", "place"]
    start = trees.repartitionByRange(*order).sortWithinPartitions(*order) \
        .select(F.concat_ws("/", F.col("tree").cast("string"), "g").alias("g"), "v", "vec").mapInArrow(_beside, _EDGE)
    lists = stage(_lists(start), f"{at}/lists-0")

    ids, truth = audit(nodes, n)
    goal, all_ = sum(min(r["n"], LIST) for r in truth), sum(r["copies"] for r in truth)
    reach = F.size(F.filter("near", lambda x: x["sim"] >= THRESHOLD))
    for k in range(1, MAX_ROUNDS + 1):
        lists = stage(_round(lists, nodes, k), f"{at}/lists-{k}")
        found = lists.where(F.col("u").isin(ids)).agg(F.sum(reach)).first()[0] or 0
        if k >= MIN_ROUNDS and found >= RECALL * goal:
            break

    edges = lists.select("u", F.explode("near").alias("n")).where(F.col("n.sim") >= THRESHOLD).select("u", "n.v")
    links = stage(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), f"{at}/links")
    comp = stage(components(links.where("u > v").select(F.col("u").alias("a"), F.col("v").alias("b")), f"{at}/cc"), f"{at}/component")
    saturated = lists.where((F.size("near") >= LIST) & (F.element_at("near", -1)["sim"] >= THRESHOLD)).select(F.col("u").alias("v"), F.lit(True).alias("saturated"))
    total, whole = _enlarged(nodes, n, links, comp, saturated, f"{at}/enlarged")
    if (total.where(F.col("v").isin(ids)).agg(F.sum("n")).first()[0] or 0) < RECALL * all_:
        total, whole = _enlarged(nodes, n, links, comp, nodes.select("v", F.lit(True).alias("saturated")), f"{at}/all")
    comp = whole

    named = nodes.select("h1", "h2", "v", "mult").join(total, "v", "left").join(comp.withColumnRenamed("id", "v"), "v", "left") \
        .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "v").alias("component"))
    out = rows.select("id", F.when(F.col("vec").isNotNull(), F.col("h1")).alias("h1"), "h2").join(named, ["h1", "h2"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), component.isNull()).alias("kept"))
