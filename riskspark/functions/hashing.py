"""O-61: deterministic A/B arm assignment, sha1(key) mod 100 < percent -> 'cand'.

The 160-bit digest is reduced mod 100 in pure Spark SQL: split the 40 hex digits into
four 10-digit chunks c0..c3 (40 bits each, so ``conv`` to base 10 fits a bigint) and use
16^10 = 16^20 = 16^30 = 76 (mod 100), so digest mod 100 = (76*(c0+c1+c2) + c3) mod 100.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha1_mod100(key) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    h = F.sha1(key.cast("string").cast("binary"))
    chunks = [F.conv(F.substring(h, 1 + 10 * i, 10), 16, 10).cast("bigint") % 100 for i in range(4)]
    return ((F.lit(76) * (chunks[0] + chunks[1] + chunks[2]) + chunks[3]) % 100).cast("int")


def assign_arm(key, percent: int) -> Column:
    """'cand' when the bucket is below ``percent``; empty/NULL key or percent <= 0 -> 'prod'."""
    key = F.col(key) if isinstance(key, str) else key
    if percent <= 0:
        return F.lit("prod")
    k = key.cast("string")
    return (F.when(k.isNull() | (k == ""), F.lit("prod"))
            .when(sha1_mod100(k) < F.lit(int(percent)), F.lit("cand"))
            .otherwise(F.lit("prod")))
