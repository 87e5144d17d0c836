"""Shared helpers for the named queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_DP = 2
RATIO_DP = 6


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), RATIO_DP)


def r2(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), MONEY_DP)


def date_str(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def final(df: DataFrame, ratios=(), money=(), longs=()) -> DataFrame:
    """Final projection: round doubles (only here), cast counts to bigint."""
    cols = []
    for c in df.columns:
        if c in ratios:
            cols.append(r6(c).alias(c))
        elif c in money:
            cols.append(r2(c).alias(c))
        elif c in longs:
            cols.append(F.col(c).cast("bigint").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
