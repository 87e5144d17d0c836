"""Quantiles that merge (O-38, O-41, O-92): a stored KLL sketch per day, merged to any period.

An exact percentile keeps every distinct value; of latencies that are no whole numbers that is
every row. A sketch keeps a few kilobytes whatever it has seen, and sketches of days (or of a
stream's micro-batches) merge to the sketch of their union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter: the rank of an answer is off by less than RANK_ERROR of all rows, with 99 % confidence.
SKETCH_K = 800
RANK_ERROR = 0.005


def value_sketches(df: DataFrame, by: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """``by`` + ``n`` (known values), ``sketch`` (NULL without any): one map-side-combined aggregate."""
    v = F.col(value).cast("double")
    known = F.when(~F.isnan(v), v)
    return df.groupBy(*by).agg(F.count(known).alias("n"), F.kll_sketch_agg_double(known, F.lit(k)).alias("sketch")) \
        .withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def merge_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored sketches merged over ``by``, whatever finer groups they were made for."""
    g = sketches.where(F.col("n") > 0).groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return g


def sketch_quantiles(sketches: DataFrame, fractions: dict[str, float]) -> DataFrame:
    """The quantiles {column: fraction} of each row's sketch, in place of the sketch."""
    q = {name: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))) for name, p in fractions.items()}
    return sketches.withColumns(q).drop("sketch")


def rank_error(df: DataFrame, estimates: DataFrame, by: Sequence[str], value: str, estimate: str, fraction: float) -> DataFrame:
    """How far ``estimate`` is from the asked rank: per group the share of values at or below it, and below it, against ``fraction``."""
    v = F.col(value).cast("double")
    e = estimates.select(*[F.col(b).alias(f"_{b}") for b in by], F.col(estimate).alias("_e"))
    cond = [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by]
    g = df.where(v.isNotNull() & ~F.isnan(v)).join(e, cond).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v < F.col("_e")).alias("_below"), F.count_if(v <= F.col("_e")).alias("_upto"))
    off = F.greatest(F.col("_below") / F.col("n") - F.lit(fraction), F.lit(fraction) - F.col("_upto") / F.col("n"), F.lit(0.0))
    return g.withColumn("rank_error", off).drop("_below", "_upto")
