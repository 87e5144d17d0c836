"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree
(numbered operator 7), in DataFrame functions only.

Targets: sources in code point order (null last) weigh 1, 2, 3, 1, ...; they share the total
size by weight, and no target exceeds ``CAP`` times its source's size (the rest share what that
leaves, by weight). With capped sources first in order of cap / weight this is one level
``lambda`` with target = min(cap, lambda * weight), found with prefix sums over the sources.

Draws: the documents of a source, in hashed order, are one stream of words, cut into blocks
of equal length. A source gives an exact number of blocks: whole passes over its stream, then
a stretch of one more pass from a hashed place. A binary tree over the output shards splits those
block quotas: each node hands its left half a multivariate-hypergeometric part, as if all blocks
had been dealt in random order. Every shard then owns a range of each source's blocks in a
permuted order, so shards are disjoint, need no coordination and are shuffled within themselves.
Taken by whole documents, a document comes once for each drawn block that holds its middle word.

Everything is a seeded hash, so reruns agree. Hot sources are spread: a document's place in
its source's stream comes from per-bucket sums (about sqrt(rows) buckets in a source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from riskspark.llm.common import let, stage, stage_dir, word_count

CAP = 3
SHARDS = 16
SEED = 11
#: A source is cut into about so many blocks, so that rounding to blocks is a small part of any source.
BLOCKS = 1 << 13
#: One splitting tree deals so many sources; more sources have trees of their own.
TREE_SOURCES = 4096
#: The per-source table is broadcast up to so many sources (some 200 bytes each).
BROADCAST_SOURCES = 20_000
_PRIMES = (1_000_003, 998_244_353, 104_729, 15_485_863, 32_452_843, 49_979_687, 67_867_967)


def _uniform(*key: Column | int) -> Column:
    """Uniform in [0, 1) from a hash of the key."""
    k = [F.lit(x) if isinstance(x, int) else x for x in key]
    return F.shiftrightunsigned(F.xxhash64(*k), 11).cast("double") / float(1 << 53)


def _hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Inverse-CDF draw of the good ones among ``draws`` of ``total``, over the mode +- 8 standard deviations."""
    n, k, d = (x.cast("double") for x in (total, good, draws))
    sd = F.sqrt(d * k / F.greatest(n, F.lit(1.0)) * (n - k) / F.greatest(n, F.lit(1.0)) * (n - d) / F.greatest(n - 1, F.lit(1.0)))
    mode = F.floor((d + 1) * (k + 1) / (n + 2))
    low = F.greatest(F.lit(0), draws - (total - good), (mode - F.ceil(sd * 8) - 2).cast("long")).cast("long")
    high = F.least(good, draws, (mode + F.ceil(sd * 8) + 2).cast("long")).cast("long")

    def ratio(x: Column) -> Column:  # P(x + 1) / P(x)
        y = x.cast("double")
        return (k - y) * (d - y) / ((y + 1) * (n - k - d + y + 1))

    def pick(span: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("x"))

        def add(goal: Column | None):
            def step(acc: Column, x: Column) -> Column:
                s = acc["sum"] + acc["p"]
                found = acc["x"] if goal is None else F.when((acc["x"] < 0) & (s >= goal), x).otherwise(acc["x"])
                return F.struct(F.when(x < span["high"], acc["p"] * ratio(x)).otherwise(F.lit(0.0)).alias("p"),
                                s.alias("sum"), found.alias("x"))
            return step

        values = F.sequence(span["low"], span["high"])
        mass = F.aggregate(values, start, add(None), lambda a: a["sum"])
        x = let(mass * u, lambda goal: F.aggregate(values, start, add(goal), lambda a: a["x"]))
        return let(x, lambda v: F.when(v < 0, span["high"]).otherwise(v))

    return let(F.struct(low.alias("low"), high.alias("high")), pick)


def targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds ``rank``, ``weight`` and ``target`` to (source, source_size), one row per source."""
    every = W.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("rank", F.row_number().over(every)).withColumn("weight", (F.col("rank") - 1) % 3 + 1) \
        .withColumn("cap", F.col("source_size") * cap)
    by_level = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_level.rowsBetween(0, W.unboundedFollowing))
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - before) / rest
    s = s.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("cap", "weight", "rank", "level"))
    first = F.min_by("level", F.when(fits.isNotNull(), F.struct(F.col("cap") / F.col("weight"), "rank"))).over(whole)
    target = F.least(F.col("cap").cast("double"), first * F.col("weight"))
    return s.select("source", "source_size", "rank", "weight", target.cast("double").alias("target"))


def shard_quotas(quota: DataFrame, shards: int, seed: int) -> DataFrame:
    """(rank, ends): for each source the cumulative number of its blocks that shards 0, 1, ... take, from (rank, quota).

    A node's row holds the sources of one tree, at most TREE_SOURCES."""
    node = quota.groupBy(F.floor((F.col("rank") - 1) / TREE_SOURCES).alias("tree")).agg(F.array_sort(F.collect_list(F.struct("rank", "quota"))).alias("q")) \
        .select(F.lit(0).alias("lo"), F.lit(shards).alias("m"), "q")
    width = shards
    while width > 1:
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        left_m = F.floor(F.col("m") / 2).cast("int")
        need = F.floor(total * left_m / F.col("m")).cast("long")
        start = F.struct(total.alias("n"), need.alias("d"), F.array().cast("array<bigint>").alias("out"))

        def deal(acc: Column, x: Column) -> Column:
            u = _uniform(seed, F.col("lo"), F.col("m"), x["rank"])
            return let(_hypergeometric(acc["n"], x["quota"], acc["d"], u), lambda k: F.struct(
                (acc["n"] - x["quota"]).alias("n"), (acc["d"] - k).alias("d"),
                F.concat(acc["out"], F.array(k)).alias("out")))

        node = node.withColumn("k", F.when(F.col("m") > 1, F.aggregate("q", start, deal, lambda a: a["out"])))
        part = lambda f: F.zip_with("q", "k", lambda x, k: F.struct(x["rank"].alias("rank"), f(x, k).alias("quota")))
        halves = F.array(F.struct(F.col("lo"), left_m.alias("m"), part(lambda x, k: k).alias("q")),
                         F.struct((F.col("lo") + left_m).alias("lo"), (F.col("m") - left_m).alias("m"),
                                  part(lambda x, k: x["quota"] - k).alias("q")))
        node = node.select(F.explode(F.when(F.col("m") > 1, halves).otherwise(
            F.array(F.struct("lo", "m", "q")))).alias("n")).select("n.*")
        width = (width + 1) // 2
    each = node.select(F.col("lo").alias("shard"), F.explode("q").alias("x")).select("shard", "x.rank", "x.quota")
    each = each.withColumn("end", F.sum("quota").over(W.partitionBy("rank").orderBy("shard")))
    return each.groupBy("rank").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "end"))),
                                                lambda x: x["end"]).alias("ends"))


def mix(docs: DataFrame, source: Column, size: Column, key: Column, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(row, size, source_size, target, draws, taken, middle) for every input row, the row itself as a struct.

    ``draws`` lists what the mix takes of the row: shard, pass, block (of the source's
    stream), words, and ``place``, the key that orders the shard. ``taken`` sums the words;
    it never exceeds CAP times the size, and a source's sum is within one block of its target.
    ``middle`` is the block of the row's middle word.

    Null or empty text has size 0 and no draws; a null source is a source of its own, last in
    order; equal rows are separate documents next to each other in the stream; a source of
    size 0 has target 0; an empty table gives no rows. Input columns come back inside ``row``.
    """
    spark = docs.sparkSession
    at = stage_dir(spark)
    base = docs.select(F.struct("*").alias("row"), source.cast("string").alias("source"), size.cast("long").alias("size"),
                       F.xxhash64(F.lit(seed), key).alias("order"))
    facts = base.select("source", "size", "order")
    sums = stage(facts.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), f"{at}/sources")
    all_ = sums.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sources")).first()
    buckets = max(1, round((all_["n"] or 0) ** 0.5))
    plan = targets(sums.drop("n"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    block = F.col("block")
    plan = plan.withColumn("passes", passes).withColumn("block", F.greatest(F.ceil(F.col("source_size") / BLOCKS), F.lit(1)).cast("long")) \
        .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long")) \
        .withColumn("rest", F.round((F.col("target") - F.col("passes") * F.col("source_size")) / block).cast("long")) \
        .withColumn("quota", F.col("passes") * F.col("blocks") + F.col("rest"))
    plan = stage(plan, f"{at}/targets")
    def permuting(n: Column, salt: int) -> tuple[Column, Column]:
        """Step and shift of a permutation of 0 .. n-1."""
        step = F.coalesce(*[F.when(n % p != 0, F.lit(p)) for p in _PRIMES], F.lit(1)).cast("long")
        return F.when(n > 0, step % n), F.when(n > 0, F.pmod(F.xxhash64(F.lit(seed + salt), F.col("rank")), n))

    plan = plan.join(shard_quotas(plan.select("rank", "quota"), shards, seed), "rank")
    for name, n, salt in (("", F.col("blocks"), 0), ("rest_", F.col("rest"), 1)):
        step, shift = permuting(n, salt)
        plan = plan.withColumn(f"{name}step", step).withColumn(f"{name}shift", shift)
    plan = plan.withColumn("first", F.when(F.col("blocks") > 0, F.pmod(F.xxhash64(F.lit(seed), F.lit("rest"), "rank"), F.col("blocks"))))
    plan = stage(plan, f"{at}/plan")
    plan = plan.withColumnRenamed("source", "_source")
    if all_["sources"] <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)

    bucket = F.pmod("order", F.lit(buckets)).alias("bucket")
    part = stage(facts.select("source", bucket, "size").groupBy("source", "bucket").agg(F.sum("size").alias("sum")), f"{at}/buckets")
    part = part.withColumn("before", F.sum("sum").over(W.partitionBy("source").orderBy("bucket")) - F.col("sum")) \
        .select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "before")
    docs_ = base.withColumn("bucket", bucket)
    in_bucket = W.partitionBy("source", "bucket").orderBy("order", "size").rowsBetween(W.unboundedPreceding, 0)
    docs_ = docs_.withColumn("upto", F.sum("size").over(in_bucket))
    docs_ = docs_.join(part, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))).drop("_source", "_bucket")
    docs_ = docs_.withColumn("start", F.col("before") + F.col("upto") - F.col("size"))
    docs_ = docs_.join(plan, F.col("source").eqNullSafe(F.col("_source")))

    end = F.col("start") + F.col("size")
    mine = F.sequence(F.floor(F.col("start") / block).cast("long"), F.floor((end - 1) / block).cast("long"))

    def draws(b: Column) -> Column:
        part_ = F.least(end, (b + 1) * block) - F.greatest(F.col("start"), b * block)
        place = F.pmod(b * F.col("step") + F.col("shift"), F.col("blocks"))
        along = F.pmod(b - F.col("first"), F.col("blocks"))  # the last pass takes a stretch of blocks, a circle from a hashed one
        in_rest = F.when(F.col("rest") > 0, F.pmod(along * F.col("rest_step") + F.col("rest_shift"), F.col("rest")))
        times = F.filter(F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda t: (t < F.col("passes")) | (along < F.col("rest")))
        at_ = lambda t: t * F.col("blocks") + F.when(t < F.col("passes"), place).otherwise(in_rest)
        return F.transform(times, lambda t: F.struct(
            F.size(F.filter("ends", lambda e: e <= at_(t))).alias("shard"), t.alias("pass"),
            b.alias("block"), part_.alias("words"), F.xxhash64(F.lit(seed), F.col("rank"), t, b).alias("place")))

    taken = F.when((F.col("size") > 0) & (F.col("quota") > 0), F.flatten(F.transform(mine, draws)))
    none = F.array().cast("array<struct<shard:int,pass:bigint,block:bigint,words:bigint,place:bigint>>")
    out = docs_.select("row", "size", "source_size", "target", F.coalesce(taken, none).alias("draws"),
                       F.floor((F.col("start") + F.floor(F.col("size") / 2)) / block).cast("long").alias("middle"))
    return out.withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])) \
        .select("row", "size", "source_size", "target", "draws", "taken", "middle")


def whole_copies(mixed: DataFrame, parts: int | None = None) -> DataFrame:
    """(shard, place, row): the mix in whole documents, in order of shard and place over ``parts`` partitions.

    A document comes once for each draw of the block that holds its middle word: once a whole pass, and once more if
    the last pass's stretch of blocks holds it. So each document of a source has the same chance of one more copy, and a source's
    words are within a document and a block of its target. Documents of one block are in hashed order.
    """
    n = parts or int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.filter("draws", lambda d: d["block"] == F.col("middle"))
    each = mixed.select("row", F.explode(own).alias("d")).select("d.shard", F.xxhash64("d.place", "row").alias("place"), "row")
    return each.repartitionByRange(n, "shard", "place").sortWithinPartitions("shard", "place")


def shuffled_shards(mixed: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per draw, in order of shard and place over ``parts`` partitions: (shard, row, pass, block, words)."""
    n = parts or int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = mixed.select("row", F.explode("draws").alias("d")).select("d.shard", "row", "d.pass", "d.block", "d.words", "d.place")
    return each.repartitionByRange(n, "shard", "place").sortWithinPartitions("shard", "place").drop("place")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix of a documents table: ``mix`` with words as size."""
    return mix(docs, F.col("source"), word_count(F.col("text")), F.struct("doc_id", F.xxhash64("text")))
