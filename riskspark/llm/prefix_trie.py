"""Conversation prefix trie (numbered operator 12): ternary search trees over ranges of dictionary-encoded turns.

Conversations that share their first turns share the nodes of a trie, and the tokens of a
shared node need not be paid for again. Every distinct turn (role, text) gets a number, a
conversation is the list of its turns' numbers, and equal conversations are one sequence with
a count. Distinct sequences are dealt by range, so a shard holds neighbours and a first turn of
a third of all conversations is spread over many shards.

A shard builds a ternary search tree by inserting the middle of its sorted sequences first, then
the middles of both halves, and so on, which balances the tree without rotations; a traversal
with a stack of its own, children before parents, adds up members, leaves and savings. Only
nodes on the path of a shard's first or last sequence can exist in another shard as well.
These travel as paths, meet by their first turn and are merged; every other node is final. The
root is an aggregate over the nodes of depth 1.

The ids of a node's ends are hashed in ascending order by a stream over sorted blocks of ids,
so copies of one conversation, however many, are never one value in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import stage, stage_dir

#: Conversations come in families of so many, whose first member lends its first turns to all.
FAMILY = 5
#: At most so many turns less one are lent.
LENT = 9
#: Ids of one sequence are listed by blocks of so many consecutive numbers.
ID_BLOCK = 4096
#: Turns of distinct sequences a shard stands for.
SHARD_TURNS = 200_000

NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = "first long, own_key string, parent_key string, depth long, conv_id long, parent long, n_convs long, n_children long, " \
        "n_leaves long, saved long, size long, ends string"
_ARROW_NODE = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in _NODE.split(", ")])
_MERGED = "key string, depth long, conv_id long, parent long, n_convs long, n_children long, n_leaves long, saved long, ends string"
_ARROW_MERGED = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in _MERGED.split(", ")])


# --- rebuilt conversations ------------------------------------------------------------------


def _lent(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % F.lit(LENT)


def numbered_turns(turns: DataFrame, at: str) -> DataFrame:
    """(conv, place, id, size) of every turn: its place from 0 and its number in the dictionary of distinct turns."""
    w = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    rows = turns.select("conv", (F.row_number().over(w) - 1).alias("place"), F.unhex(key).alias("key"),
                        F.octet_length("text").cast("long").alias("size"))
    rows = stage(rows, f"{at}/turns")
    # numbers are fixed once the table is written; a retried task gives its rows other numbers of its own range
    ids = stage(rows.select("key").distinct().withColumn("id", F.monotonically_increasing_id()), f"{at}/dictionary")
    return rows.join(ids, "key").select("conv", "place", "id", "size")


def rebuilt_sequences(turns: DataFrame, at: str) -> DataFrame:
    """(conv, seq, sizes) of every conversation of ``turns`` (conv, turn, role, text without nulls)."""
    rows = stage(numbered_turns(turns, at), f"{at}/numbered")
    convs = turns.select("conv").distinct()
    base = F.col("conv") - F.col("conv") % F.lit(FAMILY)
    loans = convs.select(F.col("conv").alias("to"), base.alias("conv"), _lent(F.col("conv")).alias("h"))
    lent = rows.where(F.col("place") < LENT - 1).join(loans, "conv").where(F.col("place") < F.col("h")) \
        .select(F.col("to").alias("conv"), "place", "id", "size")
    # a conversation's own later turns follow the lent ones, however few these are
    own = rows.where(F.col("place") >= _lent(F.col("conv")))
    turns_of = lent.union(own).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("place", "id", "size"))).alias("t"))
    empty = F.array().cast("array<long>")
    return convs.join(turns_of, "conv", "left").select(
        "conv", F.coalesce(F.col("t.id"), empty).alias("seq"), F.coalesce(F.col("t.size"), empty).alias("sizes"))


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, ids) in order of key and ids -> (key, ends): SHA-256 of all ids of a key, comma-joined."""
    key, digest = None, None
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("ids").to_pylist()
        done: list[tuple] = []
        for k, text in zip(keys, ids, strict=True):
            if k != key:
                if digest:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode("ascii"))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["key", "ends"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends"])


def distinct_sequences(convs: DataFrame, at: str) -> DataFrame:
    """(seq, sizes, n, lo, ends) of each distinct sequence: how many conversations, the least id, the digest of all ids."""
    key = F.unhex(F.md5(F.array_join(F.transform("seq", lambda x: x.cast("string")), ",").cast("binary")))
    c = stage(convs.withColumn("key", key), f"{at}/sequences")
    block = F.floor(F.col("conv") / F.lit(ID_BLOCK))
    ids = c.groupBy("key", block.alias("block")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    ids = ids.select("key", "block", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    ends = ids.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInArrow(_hash_ends, "key binary, ends string")
    stats = c.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("lo"))
    one = c.join(stats.select("key", F.col("lo").alias("conv")), ["key", "conv"], "left_semi")  # the least id's row lends the sequence
    return one.join(stats, "key").join(ends, "key").select("seq", "sizes", "n", "lo", "ends")


# --- shards -----------------------------------------------------------------------------------


class TernaryTree:
    """Ternary search tree of sequences of turn numbers; nodes are positions in lists.

    ``turn`` orders siblings: ``left`` and ``right`` lead to siblings with smaller and larger
    numbers, ``down`` to the children's tree.
    """

    def __init__(self) -> None:
        self.turn: list[int] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.down: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.size: list[int] = []
        self.n: list[int] = []
        self.lo: list[int | None] = []
        self.ends: list[str] = []
        self.top = -1

    def _new(self, turn: int, parent: int, size: int) -> int:
        self.turn.append(turn)
        self.left.append(-1)
        self.right.append(-1)
        self.down.append(-1)
        self.parent.append(parent)
        self.depth.append(1 if parent < 0 else self.depth[parent] + 1)
        self.size.append(size)
        self.n.append(0)
        self.lo.append(None)
        self.ends.append(NO_ENDS)
        return len(self.turn) - 1

    def insert(self, seq: list[int], sizes: list[int], n: int, lo: int, ends: str) -> list[int]:
        """The nodes of a sequence, from the first turn to the last; ``n`` conversations end at the last one."""
        path: list[int] = []
        parent = -1
        for turn, size in zip(seq, sizes, strict=True):
            at = self.top if parent < 0 else self.down[parent]
            if at < 0:
                at = self._new(turn, parent, size)
                if parent < 0:
                    self.top = at
                else:
                    self.down[parent] = at
            while turn != self.turn[at]:
                side = self.left if turn < self.turn[at] else self.right
                if side[at] < 0:
                    side[at] = self._new(turn, parent, size)
                at = side[at]
            path.append(at)
            parent = at
        self.n[parent], self.lo[parent], self.ends[parent] = n, lo, ends
        return path

    def children_first(self) -> list[int]:
        """Every node after its children, by a walk with a stack of its own."""
        order, stack = [], [self.top] if self.top >= 0 else []
        while stack:
            at = stack.pop()
            order.append(at)
            stack.extend(x for x in (self.left[at], self.right[at], self.down[at]) if x >= 0)
        order.reverse()
        return order


def median_first(n: int) -> Iterator[int]:
    """0 .. n-1, the middle first, then the middles of both halves."""
    spans = [(0, n)]
    for a, b in spans:  # grows while it is read
        if a < b:
            m = (a + b) // 2
            yield m
            spans += [(a, m), (m + 1, b)]


def shard_nodes(rows: list[tuple]) -> Iterator[dict]:
    """Nodes of one shard from its sequences (seq, sizes, n, lo, ends) in ascending order.

    A node on the path of the first or last sequence has an ``own_key``: it may be in other
    shards too, its members are those of this shard, and its children, leaves and savings leave
    out its children of the same kind. Every other node is final, but for the id of a parent
    named by ``parent_key``.
    """
    tree = TernaryTree()
    paths: dict[int, list[int]] = {}
    for i in median_first(len(rows)):
        p = tree.insert(*rows[i])
        if i in (0, len(rows) - 1):
            paths[i] = p
    keys: dict[int, str] = {}
    for p in paths.values():
        digest = hashlib.md5()
        for at in p:
            digest.update(tree.turn[at].to_bytes(8, "little"))
            keys[at] = digest.hexdigest()
    size = len(tree.turn)
    members, lo, children, leaves, saved = list(tree.n), list(tree.lo), [0] * size, [0] * size, [0] * size
    order = tree.children_first()
    for at in order:
        up = tree.parent[at]
        if at not in keys:
            leaves[at] += not children[at]
            saved[at] += (members[at] - 1) * tree.size[at]
        if up >= 0:
            members[up] += members[at]
            lo[up] = lo[at] if lo[up] is None else min(lo[up], lo[at])
            if at not in keys:
                children[up] += 1
                leaves[up] += leaves[at]
                saved[up] += saved[at]
    first = {at: tree.turn[p[0]] for p in paths.values() for at in p}
    for at in order:
        up = tree.parent[at]
        yield {"first": first.get(at), "own_key": keys.get(at), "parent_key": keys.get(up), "depth": tree.depth[at], "conv_id": lo[at],
               "parent": lo[up] if up >= 0 and up not in keys else None, "n_convs": members[at], "n_children": children[at],
               "n_leaves": leaves[at], "saved": saved[at], "size": tree.size[at], "ends": tree.ends[at]}


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("seq", "sizes", "n", "lo", "ends")), strict=True)]
    held: list[dict] = []
    for node in shard_nodes(rows):
        held.append(node)
        if len(held) == 10_000:
            yield pa.RecordBatch.from_pylist(held, _ARROW_NODE)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, _ARROW_NODE)


# --- edges --------------------------------------------------------------------------------------


def merge_edges(group: pa.Table) -> pa.Table:
    """Edge nodes below one first turn, met by their path: members, leaves and savings over all shards."""
    rows = sorted(group.to_pylist(), key=lambda r: r["depth"])
    nodes: dict[str, dict] = {}
    for r in rows:  # parents first
        m = nodes.get(r["own_key"])
        if m is None:
            nodes[r["own_key"]] = m = dict(r, n_convs=0, n_children=0, n_leaves=0, saved=0, ends=NO_ENDS)
        m["conv_id"] = min(m["conv_id"], r["conv_id"])
        for c in ("n_convs", "n_children", "n_leaves", "saved"):
            m[c] += r[c]
        if r["ends"] != NO_ENDS:
            m["ends"] = r["ends"]
    for m in sorted(nodes.values(), key=lambda m: -m["depth"]):
        m["n_leaves"] += not m["n_children"]
        m["saved"] += (m["n_convs"] - 1) * m["size"]
        up = nodes.get(m["parent_key"])
        if up is not None:
            up["n_children"] += 1
            up["n_leaves"] += m["n_leaves"]
            up["saved"] += m["saved"]
    out = [{"key": k, "depth": m["depth"], "conv_id": m["conv_id"], "parent": nodes[m["parent_key"]]["conv_id"] if m["parent_key"] else None,
            "n_convs": m["n_convs"], "n_children": m["n_children"], "n_leaves": m["n_leaves"], "saved": m["saved"], "ends": m["ends"]}
           for k, m in nodes.items()]
    return pa.Table.from_pylist(out, _ARROW_MERGED)


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node of the trie.

    Turns are in order of their number, null first, equal numbers by role and text. Null role
    and text are empty texts. Rows without a conversation id belong to no conversation. Equal
    rows are turns each. Copies of a conversation, and a first turn of any number of them, are
    spread over tasks; one conversation, as the numbers of its turns, is one value. An empty
    table gives no nodes. Other columns are ignored.
    """
    spark, at = conversations.sparkSession, stage_dir(conversations.sparkSession)
    turns = conversations.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                                 *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    turns = turns.where("conv is not null")
    seqs = stage(distinct_sequences(rebuilt_sequences(turns, at), at), f"{at}/distinct")
    size = seqs.agg(F.sum(F.size("seq"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_TURNS))
    nodes = stage(seqs.where(F.size("seq") > 0).repartitionByRange(shards, "seq").sortWithinPartitions("seq")
                  .mapInArrow(_build, _NODE), f"{at}/nodes")
    merged = stage(nodes.where("own_key is not null").groupBy("first").applyInArrow(merge_edges, _MERGED), f"{at}/merged")

    columns = ["depth", "conv_id", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    final = nodes.where("own_key is null")
    below = final.where("parent_key is not null").drop("parent") \
        .join(merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent")), "parent_key")
    every = final.where("parent_key is null").select(*columns).union(below.select(*columns)).union(merged.select(*columns))
    tops = every.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    root = seqs.agg(F.sum("n").alias("n_convs"), F.min("lo").alias("conv_id"), F.max(F.when(F.size("seq") == 0, F.col("ends"))).alias("ends"))
    root = root.where("n_convs > 0").crossJoin(tops).select(  # one row with one row
        F.lit(0).cast("long").alias("depth"), "conv_id", F.lit(None).cast("long").alias("parent"), "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"))
    least = root.select(F.col("conv_id").alias("least"))
    below_root = every.crossJoin(F.broadcast(least)).withColumn("parent", F.when(F.col("depth") == 1, F.col("least")).otherwise(F.col("parent")))
    return below_root.select(*columns).union(root.select(*columns)).select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
