"""Exact linear-interpolated quantiles without a single-task buffer.

``percentile`` keeps every distinct value of a group in one aggregation buffer; for a
continuous score over a very large table that buffer is the whole column in one task.
Here the same numbers are computed from distributed prefix counts:

1. distinct values with their counts (map-side combined), per group, are range-partitioned
   by value, in one exchange that both passes read;
2. totals per (group, partition), a table of groups x partitions rows, give each partition's
   rank interval, and so the few partitions that hold a rank that is asked for;
3. a window inside those partitions only finds the values at the ranks floor/ceil of (n-1)p;
4. value = (hi - pos) * v_lo + (pos - lo) * v_hi, the interpolation ``percentile`` uses.

Results equal ``percentile`` exactly (tests compare them). No job runs while the plan is built. That
both passes saw the same partitions is checked: :func:`same_partition` fails the query otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` treating NULL keys as equal (a NULL group is a group)."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "inner").drop(*[f"_r_{k}" for k in keys])


def same_partition(value: Column, here: Column, expected: Column) -> Column:
    """``value``, where a partition's total is what the other pass over the exchange found for it; an error elsewhere."""
    return F.when(here == expected, value).otherwise(F.raise_error(F.lit("the two passes saw other partitions")).cast("bigint"))


def exact_quantiles(df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = (),
                    buckets: int | None = None, out: str = "q") -> DataFrame:
    """One row per group: ``by`` columns + ``out`` = array of quantiles (NULL if the group
    has no non-NULL values), in the order of ``fractions``.

    ``by`` is a low-cardinality grouping (features, a handful of segments). ``buckets`` is the
    number of partitions (the session's shuffle partitions by default)."""
    by = list(by)
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "16"))
    v = F.col(value).cast("double")
    d = (df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by, v.alias("_v"))
           .agg(F.count(F.lit(1)).alias("_c")))
    t = d.repartitionByRange(n, *by, "_v").withColumn("_bk", F.spark_partition_id())
    tot = t.groupBy(*by, "_bk").agg(F.sum("_c").alias("_bc"))
    group = Window.partitionBy(*by)  # partition numbers of one group: at most n rows
    tot = tot.select(*by, "_bk", "_bc", (F.sum("_bc").over(group.orderBy("_bk")) - F.col("_bc")).alias("_off"),
                     F.sum("_bc").over(group).alias("_n"))
    # the ranks floor and ceil of each fraction, in the partition that holds them
    pos = lambda p: (F.col("_n") - 1).cast("double") * F.lit(float(p))
    asked = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), pos(p).alias("pos"), rank(pos(p)).cast("bigint").alias("rank"))
                      for i, p in enumerate(fractions) for side, rank in (("lo", F.floor), ("hi", F.ceil))])
    here = F.filter(asked, lambda a: (a["rank"] >= F.col("_off")) & (a["rank"] < F.col("_off") + F.col("_bc")))
    held = tot.select(*by, "_bk", "_off", "_bc", here.alias("_asked")).where(F.size("_asked") > 0)
    vals = _null_safe(t, F.broadcast(held), [*by, "_bk"])  # at most two rows for each fraction of a group
    part = Window.partitionBy(*by, "_bk")
    upto = F.sum("_c").over(part.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    vals = vals.withColumn("_hi_rank", same_partition(F.col("_off") + upto, F.sum("_c").over(part), F.col("_bc")))
    hit = F.filter("_asked", lambda a: (a["rank"] < F.col("_hi_rank")) & (a["rank"] >= F.col("_hi_rank") - F.col("_c")))
    m = vals.select(*by, "_v", F.explode(hit).alias("_a")).groupBy(*by, F.col("_a.i").alias("_i")).agg(
        F.max(F.when(F.col("_a.side") == "lo", F.col("_v"))).alias("_vlo"), F.max(F.when(F.col("_a.side") == "hi", F.col("_v"))).alias("_vhi"),
        F.max("_a.pos").alias("_pos"))
    lo, hi = F.floor("_pos").cast("bigint"), F.ceil("_pos").cast("bigint")
    q = F.when((hi == lo) | (F.col("_vhi") == F.col("_vlo")), F.col("_vlo")).otherwise(
        (hi.cast("double") - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - lo.cast("double")) * F.col("_vhi"))
    m = m.select(*by, "_i", q.alias("_q"))
    res = m.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))),
                                         lambda s: s["_q"]).alias(out))
    res = res.withColumn(out, F.when(F.size(F.col(out)) > 0, F.col(out)))
    return res if by else res.select(out)  # without groups always one row (NULL when no values)
