"""riskspark: credit-risk and fraud analytics as Spark DataFrame operators.

Sub-packages
------------
sources    scans, sinks and the adapter views over the driver tables
functions  column-level helpers (coercions, hashing, skew-safe running windows)
operators  the analytic operators (features, rules, scoring, metrics, drift, ...)
plans      named end-to-end queries built from the operators (+ DuckDB oracles)
streaming  Structured Streaming forms of the log/transaction operators
"""

from riskspark.session import get_session

__all__ = ["get_session"]
