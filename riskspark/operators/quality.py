"""Data contracts, expectations and health checks (O-81..O-88, O-104).

Every suite is a list of expectations evaluated by **one** aggregate over the data;
only the one result row per expectation reaches the driver (if at all).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskspark.functions.segscan import scan


def expect_exists(column: str) -> dict:
    return {"type": "exists", "column": column}


def expect_between(column: str, min_value=None, max_value=None, mostly: float = 1.0,
                   strict_min: bool = False, strict_max: bool = False) -> dict:
    return {"type": "between", "column": column, "min": min_value, "max": max_value, "mostly": mostly,
            "strict_min": strict_min, "strict_max": strict_max}


def expect_in_set(column: str, values: Sequence[Any], mostly: float = 1.0) -> dict:
    return {"type": "in_set", "column": column, "values": list(values), "mostly": mostly}


def expect_not_null(column: str, mostly: float = 1.0) -> dict:
    return {"type": "not_null", "column": column, "mostly": mostly}


def expect_row_count_above(n: int) -> dict:
    return {"type": "row_count_above", "n": n}


def _valid(e: Mapping[str, Any]) -> Column:
    c = F.col(e["column"])
    if e["type"] == "between":
        x = c.try_cast("double")
        ok = F.lit(True)
        if e.get("min") is not None:
            ok = ok & ((x > F.lit(float(e["min"]))) if e.get("strict_min") else (x >= F.lit(float(e["min"]))))
        if e.get("max") is not None:
            ok = ok & ((x < F.lit(float(e["max"]))) if e.get("strict_max") else (x <= F.lit(float(e["max"]))))
        return F.coalesce(ok, F.lit(False))
    if e["type"] == "in_set":
        return F.coalesce(c.cast("string").isin([str(v) for v in e["values"]]), F.lit(False))
    raise ValueError(e["type"])


def expect_some_value(column: str) -> dict:
    """Not NULL in every row (an empty table passes)."""
    return {"type": "some_value", "column": column}


def _measures(cols: set[str], suite: Sequence[Mapping[str, Any]]) -> list[Column]:
    """What a suite needs to know of a frame with these columns, as aggregates."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, e in enumerate(suite):
        if e["type"] in ("between", "in_set", "not_null", "some_value") and e["column"] in cols:
            aggs.append(F.count(F.col(e["column"])).alias(f"_nn{i}"))
            if e["type"] not in ("not_null", "some_value"):
                aggs.append(F.count_if(F.col(e["column"]).isNotNull() & _valid(e)).alias(f"_ok{i}"))
    return aggs


def _judge(row: DataFrame, cols: set[str], suite: Sequence[Mapping[str, Any]], suite_name: str) -> DataFrame:
    """One row for each expectation from the one row of measures."""
    recs = []
    n = F.col("_n")
    for i, e in enumerate(suite):
        col = e.get("column")
        if e["type"] == "exists":
            success, observed = F.lit(col in cols), F.lit(1.0 if col in cols else 0.0)
        elif e["type"] == "row_count_above":
            success, observed = n > F.lit(int(e["n"])), n.cast("double")
        elif col not in cols:
            success, observed = F.lit(False), F.lit(None).cast("double")
        elif e["type"] == "not_null":
            observed = F.try_divide(F.col(f"_nn{i}").cast("double"), F.nullif(n.cast("double"), F.lit(0.0)))
            success = F.coalesce(observed >= F.lit(float(e.get("mostly", 1.0))), F.lit(True))
        elif e["type"] == "some_value":
            observed = F.col(f"_nn{i}").cast("double")
            success = (observed > 0) | (n == 0)
        else:
            observed = F.try_divide(F.col(f"_ok{i}").cast("double"), F.nullif(F.col(f"_nn{i}").cast("double"), F.lit(0.0)))
            success = F.coalesce(observed >= F.lit(float(e.get("mostly", 1.0))), F.lit(True))
        recs.append(F.struct(F.lit(suite_name).alias("suite"), F.lit(i).alias("idx"),
                             F.lit(e["type"]).alias("expectation"), F.lit(col).cast("string").alias("column"),
                             success.alias("success"), observed.cast("double").alias("observed"),
                             n.alias("element_count")))
    return row.select(F.explode(F.array(*recs)).alias("r")).select("r.*")


def run_expectations(df: DataFrame, suite: Sequence[Mapping[str, Any]], suite_name: str = "suite") -> DataFrame:
    """O-84: (suite, idx, expectation, column, success, observed, element_count).

    ``mostly``: pass when valid / non-NULL >= mostly (NULLs are not counted against a
    between/in-set expectation, as in the usual expectation semantics)."""
    cols = set(df.columns)
    return _judge(df.agg(*_measures(cols, suite)), cols, suite, suite_name)


def write_checked(df: DataFrame, path: str, suites: Mapping[str, Sequence[Mapping[str, Any]]]) -> DataFrame:
    """O-81 / O-84 without a second scan: write ``df`` as Parquet and judge it by measures taken of the rows as they are written.

    Returns the rows of all suites; the table is there whatever they say."""
    spark, cols = df.sparkSession, set(df.columns)
    seen = {name: Observation(f"{name}-{uuid.uuid4().hex[:8]}") for name in suites}
    watched = df
    for name, suite in suites.items():
        watched = watched.observe(seen[name], *_measures(cols, suite))
    watched.write.mode("overwrite").parquet(path)
    out = None
    for name, suite in suites.items():
        got = seen[name].get
        row = spark.createDataFrame([tuple(got.values())], ", ".join(f"{k} long" for k in got))
        judged = _judge(row, cols, suite, name)
        out = judged if out is None else out.unionByName(judged)
    return out


# ---- suites (fixed values: the original expectation suites and contract checks) ------

def fraud_log_suite() -> list[dict]:
    """Expectations for the decision log: columns exist, proba in [0,1] (mostly 0.99),
    decision in {allow, review, flag, block}, row count > 0."""
    return [expect_exists("ts"), expect_exists("decision"), expect_exists("proba"),
            expect_between("proba", 0, 1, mostly=0.99),
            expect_in_set("decision", ["allow", "review", "flag", "block"]),
            expect_row_count_above(0)]


def pd_scores_suite(id_col: str = "borrower_id", pd_col: str = "PD", date_col: str | None = None) -> list[dict]:
    """O-81 + pd_scores expectations: id and PD exist and are never NULL, PD in [0,1], rows > 0;
    the date column too, where the table carries one (else its date is in the path)."""
    return [expect_exists(id_col), expect_exists(pd_col), expect_not_null(id_col),
            expect_between(pd_col, 0, 1), expect_row_count_above(0), expect_not_null(pd_col),
            *([expect_exists(date_col)] if date_col else [])]


def rollup_suite() -> list[dict]:
    """O-82: required roll-up columns, avg_PD in [0,1] and never NULL."""
    req = ["grade", "state", "vintage_year", "borrowers", "total_EAD", "avg_PD", "total_EL"]
    return [*[expect_exists(c) for c in req], expect_between("avg_PD", 0, 1), expect_not_null("avg_PD")]


def credit_feature_health() -> list[dict]:
    """O-85: income_to_loan_ratio > 0, delinquencies >= 0, record counts >= 1."""
    return [expect_between("income_to_loan_ratio", 0, None, strict_min=True),
            expect_between("num_past_delinquencies", 0, None), expect_between("n_records", 1, None)]


def fraud_feature_health() -> list[dict]:
    """O-85: user-day counts and amounts >= 0."""
    return [expect_between("user_txn_count_day", 0, None), expect_between("user_txn_amount_day", 0, None),
            expect_between("device_change_count_day", 0, None)]


def merchant_rate_health() -> list[dict]:
    """O-85: chargeback rates in [0,1]."""
    return [expect_between("merchant_chargeback_rate", 0, 1)]


def rolling_amount_health() -> list[dict]:
    """O-85: rolling amounts >= 0."""
    return [expect_between("rolling_amount_last_1h", 0, None)]


def score_health() -> list[dict]:
    """O-86: rows > 0, EL >= 0, required columns, PD in [0,1]; O-88 loan_amount > 0."""
    return [expect_row_count_above(0), expect_between("EL", 0, None), expect_exists("PD"), expect_exists("EAD"),
            expect_between("EAD", 0, None, strict_min=True), expect_exists("LGD"), expect_between("PD", 0, 1)]


def rollup_health(segment_keys: Sequence[str] = ("grade", "state", "vintage_year")) -> list[dict]:
    """O-86: total_EL >= 0, and no segment key is NULL in every row."""
    return [expect_between("total_EL", 0, None), *[expect_some_value(k) for k in segment_keys]]


def log_contract(json_lines: DataFrame, required: Sequence[str] = ("ts", "decision", "proba", "latency_ms"),
                 text_col: str = "value") -> DataFrame:
    """O-83: presence of required keys in raw JSON lines (whole input), one aggregate:
    (key, lines_with_key, lines, success)."""
    keys = F.json_object_keys(F.col(text_col))
    d = json_lines.select(keys.alias("_k"))
    row = d.agg(F.count(F.lit(1)).alias("lines"),
                *[F.count_if(F.coalesce(F.array_contains("_k", k), F.lit(False))).alias(k) for k in required])
    arr = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("lines_with_key"), F.col("lines").alias("lines"),
                             ((F.col(k) == F.col("lines")) & (F.col("lines") > 0)).alias("success")) for k in required])
    return row.select(F.explode(arr).alias("r")).select("r.*")


def freshness(outputs: DataFrame, inputs: DataFrame, out_ts: str, in_ts: str, max_age_hours: float = 24.0,
              now: Column | None = None) -> DataFrame:
    """O-87: outputs not older than max_age and not older than their inputs."""
    now = now if now is not None else F.current_timestamp()
    o = outputs.agg(F.max(F.col(out_ts).cast("timestamp")).alias("out_max"))
    i = inputs.agg(F.max(F.col(in_ts).cast("timestamp")).alias("in_max"))
    j = o.crossJoin(i)
    age_h = (F.unix_micros(now) - F.unix_micros(F.col("out_max"))) / F.lit(3.6e9)
    return j.select("out_max", "in_max", age_h.alias("age_hours"),
                    (age_h <= F.lit(max_age_hours)).alias("fresh"),
                    (F.col("out_max") >= F.col("in_max")).alias("not_stale_vs_inputs"))


def monotonic_and_enum(df: DataFrame, key: str, ts: str, tx_id: str, enum_col: str,
                       allowed: Sequence[str]) -> DataFrame:
    """O-104: rows whose ts goes backwards within the key in arrival (id) order, and rows
    with an enum value outside ``allowed``; one aggregate."""
    # previous row in arrival order: the ids take the place of the times in the scan
    d = scan(df, key, tx_id, [tx_id], prev=ts)
    d = d.withColumn("_back", F.col(ts) < F.col("prev").cast(df.schema[ts].dataType))
    return d.agg(F.count_if(F.coalesce(F.col("_back"), F.lit(False))).alias("non_monotonic_rows"),
                 F.count_if(~F.coalesce(F.col(enum_col).isin(list(allowed)), F.lit(False))).alias("bad_enum_rows"),
                 F.count(F.lit(1)).alias("rows"))
