"""DuckDB oracle SQL for the named queries (driver correctness gate).

Each query restates the Spark plan in plain SQL over the pre-registered base tables.
The adapter views (SURVEY §7.3) are CTEs shared by all queries. Doubles are rounded
only in the final projection, on both sides (6 dp ratios, 2 dp money).
"""

from __future__ import annotations

# --- adapter CTEs ------------------------------------------------------------------------
LOANS = """
loans AS (
  SELECT o.o_custkey AS borrower_id, o.o_orderkey AS loan_id, o.o_totalprice AS loan_amount,
         CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE greatest(c.c_acctbal, 0.0) * 120 END AS annual_income,
         CAST(o.o_orderkey % 4 AS INTEGER) AS delinq_2yrs,
         CASE WHEN o.o_orderkey % 97 = 0 THEN 'n/a'
              ELSE concat(CAST(CAST(o.o_orderkey % 1000 AS DOUBLE) / 10 AS VARCHAR), '%') END AS revol_util,
         CASE o.o_orderstatus WHEN 'F' THEN 'Charged Off' WHEN 'O' THEN 'Current' WHEN 'P' THEN 'Fully Paid' END
           AS loan_status,
         substr(o.o_orderpriority, 1, 1) AS grade, n.n_name AS state,
         CAST(year(o.o_orderdate) AS INTEGER) AS vintage_year, CAST(o.o_orderdate AS DATE) AS origination_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

FEAT = """
feat AS (
  SELECT borrower_id,
         avg(CASE WHEN loan_amount <> 0 THEN CAST(annual_income AS DOUBLE) / loan_amount END) AS income_to_loan_ratio,
         CAST(max(delinq_2yrs) AS DOUBLE) AS num_past_delinquencies,
         avg(try_cast(replace(trim(revol_util), '%', '') AS DOUBLE)) AS credit_utilization_pct,
         count(*) AS n_records,
         arg_min(loan_amount, loan_id) AS loan_amount, arg_min(grade, loan_id) AS grade,
         arg_min(state, loan_id) AS state, arg_min(vintage_year, loan_id) AS vintage_year
  FROM loans GROUP BY borrower_id
)"""

SCORED = """
zs AS (
  SELECT *, 0.0 + (-1.2) * (coalesce(income_to_loan_ratio, 0.0) * 1.0 - 1.5)
              + 0.9 * (coalesce(num_past_delinquencies, 0.0) * 1.0 - 0.0)
              + 2.0 * (coalesce(credit_utilization_pct, 0.0) * 0.01 - 0.4)
              + (-0.02) * (coalesce(CAST(n_records AS DOUBLE), 0.0) * 1.0 - 12.0) AS z
  FROM feat
),
scored AS (
  SELECT *, 1.0 / (1.0 + exp(-least(greatest(z, -30.0), 30.0))) AS PD,
         coalesce(CAST(loan_amount AS DOUBLE), 0.0) AS EAD, 0.45 AS LGD
  FROM zs
),
el AS (SELECT *, PD * LGD * EAD AS EL FROM scored)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


CREDIT = with_(LOANS, FEAT, SCORED)

Q: dict[str, str] = {}

Q["segment_el_rollup"] = CREDIT + """
SELECT grade, state, vintage_year, count(DISTINCT borrower_id) AS borrowers,
       round(sum(EAD), 2) AS total_EAD, round(avg(PD), 6) AS avg_PD, round(sum(EL), 2) AS total_EL
FROM el GROUP BY grade, state, vintage_year"""

Q["portfolio_summary"] = CREDIT + """
SELECT count(*) AS n, round(avg(PD), 6) AS avg_PD, round(coalesce(sum(EL), 0.0), 2) AS total_EL FROM el"""

Q["borrower_features"] = with_(LOANS) + """
SELECT borrower_id,
       round(avg(CASE WHEN loan_amount <> 0 THEN CAST(annual_income AS DOUBLE) / loan_amount END), 6)
         AS income_to_loan_ratio,
       round(CAST(max(delinq_2yrs) AS DOUBLE), 6) AS num_past_delinquencies,
       round(avg(try_cast(replace(trim(revol_util), '%', '') AS DOUBLE)), 6) AS credit_utilization_pct,
       count(*) AS n_records
FROM loans GROUP BY borrower_id"""

Q["default_labels"] = with_(LOANS) + """
SELECT borrower_id, CAST(max(CASE WHEN contains(lower(trim(loan_status)), 'charged off')
                                   OR contains(lower(trim(loan_status)), 'default')
                                   OR contains(lower(trim(loan_status)), 'write off')
                                   OR contains(lower(trim(loan_status)), 'written off') THEN 1 ELSE 0 END) AS INTEGER)
       AS default_flag
FROM loans GROUP BY borrower_id"""

Q["credit_decisions"] = CREDIT + """
SELECT borrower_id, round(PD, 6) AS PD, round(EAD, 2) AS EAD, round(EL, 2) AS EL,
       CAST(PD >= 0.2 AS INTEGER) AS decision
FROM el"""

Q["pd_histogram"] = CREDIT + """
SELECT grade, CAST(least(floor(PD * 10) + 1, 10) AS INTEGER) AS pd_bin, count(*) AS n, round(sum(EAD), 2) AS exposure
FROM el GROUP BY 1, 2"""

Q["stress_el"] = CREDIT + """,
scen(scenario, pd_mult, lgd_mult) AS (VALUES ('base', 1.0, 1.0), ('adverse', 1.5, 1.2), ('severe', 2.0, 1.5))
SELECT scenario, round(sum(least(PD * pd_mult, 1.0) * least(LGD * lgd_mult, 1.0) * EAD), 2) AS total_EL,
       count(*) AS n
FROM el CROSS JOIN scen GROUP BY scenario"""

# --- fraud -------------------------------------------------------------------------------
TXN = """
ev AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
txn AS (
  SELECT event_id AS transaction_id, user_id, ts, round(value * 100, 2) AS amount,
         concat('M', CAST(k % 20 AS VARCHAR)) AS merchant_id,
         CASE WHEN k % 31 = 0 THEN NULL ELSE concat('D_', CAST(k % 7 AS VARCHAR)) END AS device_id,
         CASE WHEN k % 10 < 7 THEN 'US' WHEN k % 10 = 7 THEN 'GB' WHEN k % 10 = 8 THEN 'CA' ELSE 'IN' END AS country,
         CAST(event_type = 'error' AND k % 5 = 0 AS INTEGER) AS is_chargeback,
         CAST(hour(ts) AS INTEGER) AS hour_of_day,
         CAST((user_id * 37) % 1000 AS INTEGER) AS account_age_days
  FROM ev
)"""

CTX = """
c1 AS (
  SELECT *, epoch_us(ts) AS us, CAST(amount AS DECIMAL(18,2)) AS amt,
         row_number() OVER (PARTITION BY user_id, country ORDER BY ts, transaction_id) AS kc,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, transaction_id) AS pos,
         row_number() OVER (PARTITION BY user_id, device_id ORDER BY ts, transaction_id) AS dev_rn,
         avg(amount) OVER (PARTITION BY user_id) AS avg_amount_user
  FROM txn
),
c2 AS (
  SELECT *,
    sum(amt) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS roll1h,
    sum(amt) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 1799999999 PRECEDING AND CURRENT ROW) AS s30,
    sum(amt) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 1209600000000 PRECEDING AND 1800000000 PRECEDING)
      AS bsum,
    count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 1209600000000 PRECEDING AND 1800000000 PRECEDING)
      AS bcnt,
    min(pos) OVER (PARTITION BY user_id, country) AS fp
  FROM c1
),
c3 AS (
  SELECT *, arg_max(country, kc * 1000000 - fp) OVER (PARTITION BY user_id ORDER BY ts, transaction_id
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS home_country
  FROM c2
),
ctx AS (
  SELECT *, CAST(roll1h AS DOUBLE) AS rolling_amount_last_1h,
         coalesce(CASE WHEN bcnt > 0 THEN s30 * bcnt > 3.5 * bsum END, false) AS velocity_spike,
         dev_rn = 1 AS device_is_new,
         CASE WHEN pos = 1 THEN false
              ELSE (country IS NULL OR home_country IS NULL OR country <> home_country) END AS geo_location_mismatch
  FROM c3
)"""

SCORE_LOG = """
r1 AS (
  SELECT *,
    coalesce(amount >= 10000 AND account_age_days < 30, false) AS h1,
    coalesce(velocity_spike = true, false) AS h2,
    coalesce(country <> home_country AND hour_of_day IN (0, 1, 2, 3, 4, 5, 23), false) AS h3,
    coalesce(amount >= 7500 AND device_is_new = true AND account_age_days < 365, false) AS h4
  FROM ctx
),
r2 AS (
  SELECT *,
    list_filter([CASE WHEN h1 THEN 'R001_HIGH_AMOUNT_NEW_ACCOUNT' END, CASE WHEN h2 THEN 'R002_VELOCITY_SPIKE' END,
                 CASE WHEN h3 THEN 'R003_CROSS_BORDER_ODD_HOURS' END, CASE WHEN h4 THEN 'R004_HIGH_AMOUNT_NEW_DEVICE' END],
                lambda x: x IS NOT NULL) AS rules_hit,
    list_filter([CASE WHEN h1 THEN 'high_amount_new_account' END, CASE WHEN h2 THEN 'velocity_spike' END,
                 CASE WHEN h3 THEN 'cross_border_odd_hours' END, CASE WHEN h4 THEN 'high_amount_new_device' END],
                lambda x: x IS NOT NULL) AS reasons,
    0.0 + CASE WHEN h1 THEN 0.35 ELSE 0.0 END + CASE WHEN h2 THEN 0.25 ELSE 0.0 END
        + CASE WHEN h3 THEN 0.2 ELSE 0.0 END + CASE WHEN h4 THEN 0.3 ELSE 0.0 END AS score_delta,
    CASE WHEN h1 OR h4 THEN 'high' WHEN h2 OR h3 THEN 'medium' END AS severity,
    1.0 / (1.0 + exp(-(amount - 6000.0) / 2000.0)) AS proba,
    CAST(5 + (transaction_id * 7919) % 40 AS INTEGER) AS latency_ms,
    sha1(CAST(user_id AS VARCHAR)) AS h,
    is_chargeback AS label, CAST(ts AS DATE) AS date
  FROM r1
),
score_log AS (
  SELECT *, CAST(len(rules_hit) AS INTEGER) AS rules_count,
    CASE WHEN proba >= 0.5 OR len(rules_hit) > 0 THEN 'flag' ELSE 'allow' END AS decision,
    CASE WHEN ((76 * ((CAST(('0x' || substr(h, 1, 10)) AS BIGINT) % 100) + (CAST(('0x' || substr(h, 11, 10)) AS BIGINT) % 100)
                    + (CAST(('0x' || substr(h, 21, 10)) AS BIGINT) % 100))
               + (CAST(('0x' || substr(h, 31, 10)) AS BIGINT) % 100)) % 100) < 10 THEN 'cand' ELSE 'prod' END AS arm
  FROM r2
)"""

FRAUD = with_(TXN, CTX)
LOG = with_(TXN, CTX, SCORE_LOG)

Q["rolling_amount_1h"] = FRAUD + """
SELECT transaction_id, user_id, round(rolling_amount_last_1h, 2) AS rolling_amount_last_1h FROM ctx"""

Q["velocity_spike"] = FRAUD + """
SELECT transaction_id, user_id, round(CAST(s30 AS DOUBLE), 2) AS amount_30m,
       round(CASE WHEN bcnt > 0 THEN CAST(bsum AS DOUBLE) / bcnt END, 6) AS baseline_avg, velocity_spike
FROM ctx"""

Q["geo_mismatch"] = FRAUD + """
SELECT transaction_id, user_id, country, home_country, geo_location_mismatch FROM ctx"""

Q["new_device"] = FRAUD + """
SELECT transaction_id, user_id, device_id, device_is_new FROM ctx"""

Q["device_changes"] = with_(TXN) + """
SELECT transaction_id, user_id, device_id,
       coalesce(rn > 1 AND (device_id IS NULL OR prev IS NULL OR device_id <> prev), false) AS device_changed
FROM (SELECT *, lag(device_id) OVER w AS prev, row_number() OVER w AS rn FROM txn
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, transaction_id))"""

Q["user_avg_amount"] = FRAUD + """
SELECT transaction_id, user_id, round(avg_amount_user, 6) AS avg_amount_user FROM ctx"""

Q["user_daily_velocity"] = with_(TXN) + """
SELECT user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS user_txn_count_day,
       round(coalesce(sum(amount), 0.0), 2) AS user_txn_amount_day,
       CAST(sum(CASE WHEN rn > 1 AND (device_id IS NULL OR prev IS NULL OR device_id <> prev) THEN 1 ELSE 0 END)
            AS BIGINT) AS device_change_count_day
FROM (SELECT *, lag(device_id) OVER w AS prev, row_number() OVER w AS rn FROM txn
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, transaction_id))
GROUP BY 1, 2"""

Q["rolling_amount_last_3"] = with_(TXN) + """
SELECT transaction_id, user_id, round(CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, transaction_id
         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE), 2) AS rolling_amount_last_3
FROM txn"""

Q["geo_mismatch_profiles"] = with_(TXN) + """,
p AS (SELECT *, CASE WHEN user_id % 10 <> 0 THEN ['US', 'GB', 'CA', 'IN'][CAST(user_id % 4 + 1 AS INTEGER)] END AS home_country FROM txn)
SELECT transaction_id, user_id, country, home_country,
       coalesce(home_country IS NOT NULL AND (country IS NULL OR country <> home_country), false) AS geo_location_mismatch
FROM p"""

Q["user_prior_avg_amount"] = with_(TXN) + """
SELECT transaction_id, user_id, round(CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER w AS DOUBLE) / nullif(count(amount) OVER w, 0), 6)
         AS avg_amount_before
FROM txn WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

Q["merchant_chargeback_rate"] = with_(TXN) + """
SELECT merchant_id, count(*) AS txn_count, CAST(sum(is_chargeback) AS BIGINT) AS chargeback_count,
       round(CAST(sum(is_chargeback) AS DOUBLE) / count(*), 6) AS merchant_chargeback_rate
FROM txn GROUP BY merchant_id"""

Q["rule_hits_flat"] = with_(TXN) + """
SELECT transaction_id,
       CAST(coalesce(amount > 5000 AND account_age_days < 30, false) AS INTEGER) AS rule__high_amount_new_account,
       CAST(coalesce(country <> 'US' AND hour_of_day < 6, false) AS INTEGER) AS rule__night_cross_border,
       0 AS rule__unknown_column, CAST(coalesce(account_age_days // 100 = 3, false) AS INTEGER) AS rule__integer_division,
       CAST(coalesce(device_id ILIKE 'd%', false) AS INTEGER) AS rule__any_case_text, 0 AS rule__text_as_number,
       0 AS rule__unknown_function, 0 AS rule__syntax,
       CAST(coalesce(amount > 5000 AND account_age_days < 30, false) AS INTEGER) AS rule_flag,
       CAST(coalesce(country <> 'US' AND hour_of_day < 6, false) OR coalesce(account_age_days // 100 = 3, false) AS INTEGER)
         AS rule_review
FROM txn"""

_FAILING = {
    "zero_denominator": "amount / nullif(days, 0) > 2000", "zero_modulus": "100 % nullif(days, 0) = 0", "text_below": "5 < n",
    "text_between": "n BETWEEN 1 AND 9", "text_in": "n IN (1, 2, 7)", "text_sum": "n + 1 > 3", "text_cast": "n = 7",
    "index_past_end": "days = 1", "overflow": "days = 1", "bad_date": "code IS NULL", "bad_date_or": "amount > 5000 OR code IS NULL",
    "not_reached": "amount > 5000 AND amount / nullif(days, 0) > 2000", "chained": "days > 1 AND days <= 3 AND NOT n = 7",
    "case_branch": "CASE WHEN days = 0 THEN amount > 100 ELSE amount / days > 2000 END"}

Q["rule_hits_failing"] = with_(TXN) + """,
t AS (SELECT *, account_age_days % 4 AS days, CASE transaction_id % 5 WHEN 0 THEN '7' WHEN 1 THEN '2024-02-30' WHEN 2 THEN '2024-02-28'
             WHEN 3 THEN country END AS code FROM txn),
u AS (SELECT *, try_cast(code AS DOUBLE) AS n FROM t),
h AS (SELECT transaction_id, """ + ", ".join(f"CAST(coalesce({c}, false) AS INTEGER) AS rule__{n}" for n, c in _FAILING.items()) + """ FROM u)
SELECT *, greatest(""" + ", ".join(f"rule__{n}" for n in _FAILING) + """) AS rule_flag FROM h"""

Q["rule_hits_structured"] = LOG + """
SELECT transaction_id, array_to_string(rules_hit, ',') AS rules_hit, round(CAST(score_delta AS DOUBLE), 6) AS score_delta, severity,
       array_to_string(reasons, ',') AS reasons
FROM score_log"""

Q["final_decisions"] = LOG + """
SELECT transaction_id, arm, round(proba, 6) AS proba, CAST(rules_count AS BIGINT) AS rules_count, decision
FROM score_log"""

Q["arm_assignment"] = """
WITH u AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS key FROM events),
h AS (SELECT key, sha1(key) AS h FROM u),
b AS (
  SELECT key, CAST((76 * ((CAST(('0x' || substr(h, 1, 10)) AS BIGINT) % 100) + (CAST(('0x' || substr(h, 11, 10)) AS BIGINT) % 100)
                 + (CAST(('0x' || substr(h, 21, 10)) AS BIGINT) % 100))
            + (CAST(('0x' || substr(h, 31, 10)) AS BIGINT) % 100)) % 100 AS INTEGER) AS bucket
  FROM h
)
SELECT key, bucket, CASE WHEN key = '' THEN 'prod' WHEN bucket < 10 THEN 'cand' ELSE 'prod' END AS arm FROM b"""

# --- monitoring --------------------------------------------------------------------------
FL = "(decision IN ('block', 'review', 'manual_review') OR coalesce(rules_count, 0) > 0)"


def _dbl_list(xs) -> str:
    return "[" + ", ".join(f"CAST('{x!r}' AS DOUBLE)" for x in xs) + "]"


DECILES = _dbl_list([i * (1.0 / 10) for i in range(11)])

FRAUD_DAILY = """,
fd AS (
  SELECT date, count(*) AS total_txns, count_if(fl) AS flagged,
         quantile_cont(CAST(latency_ms AS DOUBLE), 0.5) AS p50_latency_ms,
         quantile_cont(CAST(latency_ms AS DOUBLE), 0.95) AS p95_latency_ms,
         count_if(fl AND y) AS tp, count_if(fl AND NOT y) AS fp, count_if(NOT fl AND y) AS fn,
         count_if(NOT fl AND NOT y) AS tn, max(CASE WHEN label IS NOT NULL THEN 1 ELSE 0 END) = 1 AS has_label
  FROM (SELECT *, """ + FL + """ AS fl, coalesce(label, 0) = 1 AS y FROM score_log) GROUP BY date
),
fk AS (
  SELECT date, total_txns, flagged, flagged / nullif(total_txns, 0) AS flagged_pct, p50_latency_ms, p95_latency_ms,
         CASE WHEN has_label THEN tp / nullif(tp + fp, 0) END AS "precision",
         CASE WHEN has_label THEN tp / nullif(tp + fn, 0) END AS recall,
         CASE WHEN has_label THEN fp / nullif(fp + tn, 0) END AS fpr,
         CASE WHEN has_label THEN tp ELSE flagged END * CAST({usd} AS DOUBLE) AS fraud_prevented_usd
  FROM fd
)"""


def _fk(usd: float = 200.0, name: str = "fk", src: str = "fd") -> str:
    return FRAUD_DAILY.replace("{usd}", repr(usd)).replace("\nfk AS", f"\n{name} AS").replace(
        "fd AS (", f"{src} AS (").replace("FROM fd\n", f"FROM {src}\n")


KPI_COLS = """strftime(date, '%Y-%m-%d') AS date, total_txns, flagged, round(flagged_pct, 6) AS flagged_pct,
       round(p50_latency_ms, 6) AS p50_latency_ms, round(p95_latency_ms, 6) AS p95_latency_ms,
       round("precision", 6) AS "precision", round(recall, 6) AS recall, round(fpr, 6) AS fpr,
       round(fraud_prevented_usd, 2) AS fraud_prevented_usd"""

Q["fraud_kpis_daily"] = LOG + _fk() + "\nSELECT " + KPI_COLS + " FROM fk"

Q["monitor_kpis_daily"] = LOG + """
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS requests,
       round(avg(CASE WHEN lower(decision) = 'flag' THEN 1.0 ELSE 0.0 END), 6) AS flag_rate,
       round(avg(CASE WHEN lower(decision) = 'review' THEN 1.0 ELSE 0.0 END), 6) AS review_rate,
       round(coalesce(avg(proba), 0.0), 6) AS mean_proba,
       round(coalesce(quantile_cont(CAST(latency_ms AS DOUBLE), 0.95), 0.0), 6) AS p95_latency_ms
FROM score_log GROUP BY date"""

Q["arm_kpis_daily"] = LOG + """
SELECT strftime(date, '%Y-%m-%d') AS date, coalesce(arm, 'unknown') AS arm, count(*) AS n,
       count_if(""" + FL + """) AS flagged, round(count_if(""" + FL + """) / count(*), 6) AS flagged_pct
FROM score_log GROUP BY 1, 2"""

Q["top_rules_daily"] = LOG + """,
e AS (SELECT date, unnest(rules_hit) AS rule FROM score_log),
c AS (SELECT date, rule, count(*) AS count FROM e GROUP BY 1, 2)
SELECT strftime(date, '%Y-%m-%d') AS date, rule, count, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY date ORDER BY count DESC, rule) AS INTEGER) AS rank FROM c)
WHERE rank <= 20"""

Q["top_rules_monthly"] = LOG + """,
e AS (SELECT strftime(date, '%Y-%m') AS month, unnest(rules_hit) AS rule FROM score_log),
c AS (SELECT month, rule, count(*) AS count FROM e GROUP BY 1, 2)
SELECT month, rule, count, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY month ORDER BY count DESC, rule) AS INTEGER) AS rank FROM c)
WHERE rank <= 30"""


def _wavg(c: str) -> str:
    return (f"round(sum({c} * total_txns) / nullif(sum(CASE WHEN {c} IS NOT NULL THEN total_txns END), 0), 6)"
            f" AS {c}")


Q["fraud_month_rollup"] = LOG + _fk() + """
SELECT strftime(date, '%Y-%m') AS month, count(DISTINCT date) AS days_covered,
       CAST(sum(total_txns) AS BIGINT) AS total_txns, CAST(sum(flagged) AS BIGINT) AS flagged,
       """ + ", ".join(_wavg(c) for c in ("p50_latency_ms", "p95_latency_ms", '"precision"', "recall", "fpr")) + """,
       round(sum(fraud_prevented_usd), 2) AS fraud_prevented_usd
FROM fk GROUP BY 1"""

ARMS = """,
arms AS (
  SELECT coalesce(arm, 'prod') AS arm, count(*) AS n,
         quantile_cont(CAST(latency_ms AS DOUBLE), 0.95) AS p95_latency_ms,
         count_if(f AND label = 1) AS tp, count_if(f AND label = 0) AS fp,
         count_if(NOT f AND label = 1) AS fn, count_if(NOT f AND label = 0) AS tn
  FROM (SELECT *, lower(decision) = 'flag' AS f FROM score_log) GROUP BY 1
),
am AS (
  SELECT arm, n, p95_latency_ms, tp / nullif(tp + fp, 0) AS "precision", tp / nullif(tp + fn, 0) AS recall,
         fp / nullif(fp + tn, 0) AS fpr FROM arms
)"""

Q["ab_arm_metrics"] = LOG + ARMS + """
SELECT arm, n, round(p95_latency_ms, 6) AS p95_latency_ms, round("precision", 6) AS "precision",
       round(recall, 6) AS recall, round(fpr, 6) AS fpr FROM am"""

Q["promotion_decision"] = LOG + ARMS + """,
pc AS (
  SELECT (SELECT n FROM am WHERE arm = 'prod') AS pn, (SELECT p95_latency_ms FROM am WHERE arm = 'prod') AS pl,
         (SELECT recall FROM am WHERE arm = 'prod') AS pr, (SELECT fpr FROM am WHERE arm = 'prod') AS pf,
         (SELECT n FROM am WHERE arm = 'cand') AS cn, (SELECT p95_latency_ms FROM am WHERE arm = 'cand') AS cl,
         (SELECT recall FROM am WHERE arm = 'cand') AS cr, (SELECT fpr FROM am WHERE arm = 'cand') AS cf
),
ok AS (
  SELECT *, (cl IS NULL OR pl IS NULL OR cl <= 2.0 * pl) AS ok_latency,
         (pr IS NULL OR cr IS NULL OR (cr >= pr AND (cf IS NULL OR pf IS NULL OR cf <= pf + 0.005))) AS ok_labels,
         (pn IS NULL OR cn IS NULL) AS missing FROM pc
)
SELECT (NOT missing AND ok_latency AND ok_labels) AS promoted,
       CASE WHEN missing THEN 'Missing arms' WHEN ok_latency AND ok_labels THEN 'Promoted' ELSE 'Not promoted' END
         AS reason,
       (pr IS NULL OR cr IS NULL) AS labels_missing, ok_latency, ok_labels
FROM ok"""

SHADOW = """,
sh AS (
  SELECT transaction_id, proba AS prod_proba, decision AS prod_decision,
         1.0 / (1.0 + exp(-(amount - 5000.0) / 1500.0)) AS cand_proba,
         latency_ms AS prod_latency, CAST(3 + (transaction_id * 31) % 20 AS INTEGER) AS cand_latency
  FROM score_log
),
sh2 AS (SELECT *, CASE WHEN cand_proba >= 0.5 THEN 'flag' ELSE 'allow' END AS cand_decision FROM sh)"""

Q["shadow_transitions"] = LOG + SHADOW + """
SELECT prod_decision, cand_decision, count(*) AS n FROM sh2 GROUP BY 1, 2"""

Q["shadow_summary"] = LOG + SHADOW + """
SELECT count(*) AS n, round(avg(CASE WHEN prod_decision = cand_decision THEN 1.0 ELSE 0.0 END), 6) AS agreement_rate,
       round(avg(cand_proba - prod_proba), 6) AS mean_score_delta,
       round(avg(abs(cand_proba - prod_proba)), 6) AS mean_abs_score_delta,
       round(quantile_cont(CAST(prod_latency AS DOUBLE), 0.95), 6) AS p95_latency_prod,
       round(quantile_cont(CAST(cand_latency AS DOUBLE), 0.95), 6) AS p95_latency_cand
FROM sh2"""


def _long(cols, typ) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, is_ref, CAST({c} AS {typ}) AS value FROM src" for c in cols)


NUM = ["amount", "hour_of_day", "latency_ms", "account_age_days"]
CAT = ["country", "device_id", "merchant_id", "decision"]

PSI_PARTS = """,
src AS (SELECT *, ts < TIMESTAMP '2024-01-16' AS is_ref FROM score_log),
lv AS (SELECT * FROM (""" + _long(NUM, "DOUBLE") + """) WHERE value IS NOT NULL AND NOT isnan(value)),
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, """ + DECILES + """))) AS e
  FROM lv WHERE is_ref GROUP BY feature
),
binned AS (
  SELECT l.feature, l.is_ref,
         CASE WHEN l.value >= e[1] AND l.value <= e[len(e)]
              THEN least(len(list_filter(e, lambda x: x <= l.value)), len(e) - 1) END AS bin
  FROM lv l JOIN edges USING (feature) WHERE len(e) >= 2
),
ncounts AS (SELECT feature, bin, count_if(is_ref) AS r, count_if(NOT is_ref) AS c
            FROM binned WHERE bin IS NOT NULL GROUP BY 1, 2),
grid AS (SELECT feature, unnest(range(1, len(e))) AS bin FROM edges WHERE len(e) >= 2),
nfull AS (SELECT g.feature, CAST(g.bin AS VARCHAR) AS bin, coalesce(r, 0) AS r, coalesce(c, 0) AS c
          FROM grid g LEFT JOIN ncounts n ON g.feature = n.feature AND g.bin = n.bin),
npresent AS (SELECT feature, count_if(is_ref) AS nr, count_if(NOT is_ref) AS nc FROM lv GROUP BY 1),
lc AS (SELECT * FROM (""" + _long(CAT, "VARCHAR") + """) WHERE value IS NOT NULL),
cfull AS (SELECT feature, value AS bin, count_if(is_ref) AS r, count_if(NOT is_ref) AS c FROM lc GROUP BY 1, 2),
cpresent AS (SELECT feature, count_if(is_ref) AS nr, count_if(NOT is_ref) AS nc FROM lc GROUP BY 1)"""


def _psi(full: str, present: str, feats: str, name: str) -> str:
    return f""",
{name}_t AS (SELECT feature, sum(r) AS rt, sum(c) AS ct, count(*) AS nb FROM {full} GROUP BY feature),
{name}_p AS (SELECT f.feature, (f.r + 1e-6) / (t.rt + 1e-6 * t.nb) AS rp, (f.c + 1e-6) / (t.ct + 1e-6 * t.nb) AS cp, t.rt
             FROM {full} f JOIN {name}_t t USING (feature)),
{name}_s AS (SELECT feature, sum((cp - rp) * ln(cp / rp)) AS psi, max(rt) AS rt FROM {name}_p GROUP BY feature),
{name} AS (
  SELECT x.feature, CASE WHEN p.nr > 0 AND p.nc > 0 AND s.rt > 0 THEN s.psi END AS psi
  FROM (SELECT DISTINCT feature FROM {feats}) x LEFT JOIN {name}_s s USING (feature) LEFT JOIN {present} p USING (feature)
)"""


PSI = LOG + PSI_PARTS + _psi("nfull", "npresent", "edges", "npsi") + _psi("cfull", "cpresent", "lc", "cpsi")

Q["psi_numeric"] = PSI + "\nSELECT feature, round(psi, 6) AS psi FROM npsi"
Q["psi_categorical"] = PSI + "\nSELECT feature, round(psi, 6) AS psi FROM cpsi"
Q["drift_summary"] = PSI + """
SELECT feature, 'numeric' AS type, round(psi, 6) AS psi FROM npsi
UNION ALL SELECT feature, 'categorical' AS type, round(psi, 6) AS psi FROM cpsi"""

MON_SPLIT = """,
kcur AS (SELECT avg(CASE WHEN lower(decision) = 'flag' THEN 1.0 ELSE 0.0 END) AS fr,
                coalesce(quantile_cont(CAST(latency_ms AS DOUBLE), 0.95), 0.0) AS p95 FROM src WHERE NOT is_ref),
kref AS (SELECT avg(CASE WHEN lower(decision) = 'flag' THEN 1.0 ELSE 0.0 END) AS rfr,
                coalesce(quantile_cont(CAST(latency_ms AS DOUBLE), 0.95), 0.0) AS rp95 FROM src WHERE is_ref),
alld AS (SELECT * FROM npsi UNION ALL SELECT * FROM cpsi)"""

Q["drift_alerts"] = PSI + MON_SPLIT + """
SELECT 'psi' AS kind, 'warn' AS severity, feature AS subject, round(psi, 6) AS value, 0.25 AS "limit" FROM (
  SELECT *, row_number() OVER (ORDER BY psi DESC NULLS LAST, feature) AS rn FROM alld WHERE psi >= 0.25) WHERE rn <= 5
UNION ALL
SELECT 'latency', 'warn', 'p95_latency_ms', round(p95, 6), round(greatest(250.0, 1.5 * rp95), 6)
FROM kcur, kref WHERE p95 > greatest(250.0, 1.5 * rp95)
UNION ALL
SELECT 'flag_rate', 'warn', 'flag_rate', round(fr, 6), round(rfr, 6)
FROM kcur, kref WHERE rfr > 0 AND (fr < 0.5 * rfr OR fr > 1.5 * rfr)"""

Q["feature_guard"] = LOG + """,
src AS (SELECT *, ts < TIMESTAMP '2024-01-16' AS is_ref FROM score_log),
lv AS (SELECT * FROM (""" + _long(NUM + ["proba"], "DOUBLE") + """) WHERE value IS NOT NULL AND NOT isnan(value)),
g AS (SELECT feature, count_if(is_ref) AS n_ref, count_if(NOT is_ref) AS n_cur, stddev_samp(value) AS pooled_std
      FROM lv GROUP BY feature)
SELECT feature, n_ref, n_cur, round(pooled_std, 6) AS pooled_std,
       coalesce(n_ref >= 3 AND n_cur >= 3 AND coalesce(pooled_std, 0.0) > 0, false) AS keep
FROM g"""

Q["calibration_deciles"] = CREDIT + """,
lab AS (
  SELECT borrower_id, CAST(max(CASE WHEN contains(lower(trim(loan_status)), 'charged off')
                                     OR contains(lower(trim(loan_status)), 'default')
                                     OR contains(lower(trim(loan_status)), 'write off')
                                     OR contains(lower(trim(loan_status)), 'written off') THEN 1 ELSE 0 END) AS INTEGER)
         AS default_flag
  FROM loans GROUP BY borrower_id
),
d AS (SELECT PD, default_flag FROM el JOIN lab USING (borrower_id) WHERE PD IS NOT NULL AND default_flag IS NOT NULL),
ed AS (SELECT list_sort(list_distinct(quantile_cont(PD, """ + DECILES + """))) AS e FROM d),
b AS (SELECT d.*, 1 + len(list_filter(list_slice(e, 2, len(e) - 1), lambda x: x < PD)) AS bin FROM d, ed)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(PD), 6) AS mean_pd,
       round(avg(CASE WHEN default_flag = 1 THEN 1.0 ELSE 0.0 END), 6) AS rate_observed
FROM b GROUP BY bin"""


def _curve(src: str, score: str, label: str) -> str:
    return f""",
sc AS (SELECT CAST({score} AS DOUBLE) AS score, count_if(coalesce(CAST({label} AS INTEGER), 0) = 1) AS pos,
              count_if(coalesce(CAST({label} AS INTEGER), 0) <> 1) AS neg
       FROM {src} WHERE {score} IS NOT NULL GROUP BY 1),
asc_c AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg_asc,
                 sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc),
desc_c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpos,
                  sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg,
                  sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc)"""


AUC_SEL = """
SELECT round(s / nullif(P * N, 0), 6) AS auc, round(2.0 * (s / nullif(P * N, 0)) - 1.0, 6) AS gini
FROM (SELECT sum(pos * ((cneg_asc - neg) + 0.5 * neg)) AS s, max(P) AS P, max(N) AS N FROM asc_c)"""

Q["roc_auc_gini"] = LOG + _curve("score_log", "proba", "label") + AUC_SEL
Q["ks_stat"] = LOG + _curve("score_log", "proba", "label") + """
SELECT round(greatest(max(cpos / nullif(P, 0) - cneg / nullif(N, 0)), 0.0), 6) AS ks FROM desc_c"""
Q["brier"] = LOG + """
SELECT round(avg(pow(proba - coalesce(CAST(label AS DOUBLE), 0.0), 2)), 6) AS brier FROM score_log"""
Q["average_precision"] = LOG + _curve("score_log", "proba", "label") + """
SELECT round(sum(pos / nullif(P, 0) * (cpos / nullif(cpos + cneg, 0))), 6) AS average_precision FROM desc_c"""

GRID = ", ".join(f"({i}, CAST('{round(0.05 * (i + 1), 2)!r}' AS DOUBLE))" for i in range(19))
Q["threshold_recall_grid"] = LOG + """,
cuts(i, t) AS (VALUES """ + GRID + """),
g AS (SELECT i, t, count_if(proba >= t AND y) AS tp, count_if(proba >= t AND NOT y) AS fp,
             count_if(proba < t AND y) AS fn
      FROM (SELECT proba, coalesce(CAST(label AS INTEGER), 0) = 1 AS y FROM score_log) CROSS JOIN cuts GROUP BY i, t),
m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p, coalesce(tp / nullif(tp + fn, 0), 0.0) AS r FROM g),
m2 AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2.0 * p * r / (p + r) END AS f1 FROM m),
a AS (SELECT (SELECT t FROM m2 WHERE r >= 0.9 ORDER BY p DESC, i LIMIT 1) AS t_rec,
             (SELECT t FROM m2 ORDER BY f1 DESC, i LIMIT 1) AS t_f1)
SELECT round(coalesce(t_rec, t_f1, 0.5), 6) AS threshold,
       CASE WHEN t_rec IS NOT NULL THEN 'recall_target' WHEN t_f1 IS NOT NULL THEN 'best_f1' ELSE 'default' END AS rule
FROM a"""

Q["threshold_pr_f1"] = LOG + _curve("score_log", "proba", "label") + """,
pr AS (SELECT score AS threshold, cpos / nullif(cpos + cneg, 0) AS "precision", cpos / nullif(P, 0) AS recall, cpos, P
       FROM desc_c),
c AS (SELECT *, 2.0 * "precision" * recall / ("precision" + recall + 1e-9) AS f1, recall >= 0.9 AS ok FROM pr
      WHERE threshold >= (SELECT max(threshold) FROM pr WHERE cpos = P))
SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1, round("precision", 6) AS "precision",
       round(recall, 6) AS recall
FROM c ORDER BY ok DESC, f1 DESC, threshold ASC LIMIT 1"""

LAB = """,
lab AS (
  SELECT borrower_id, CAST(max(CASE WHEN contains(lower(trim(loan_status)), 'charged off')
                                     OR contains(lower(trim(loan_status)), 'default')
                                     OR contains(lower(trim(loan_status)), 'write off')
                                     OR contains(lower(trim(loan_status)), 'written off') THEN 1 ELSE 0 END) AS INTEGER)
         AS default_flag
  FROM loans GROUP BY borrower_id
),
cl AS (SELECT * FROM el JOIN lab USING (borrower_id))"""

Q["credit_auc"] = CREDIT + LAB + _curve("cl", "PD", "default_flag") + AUC_SEL

Q["confusion_combined"] = LOG + """
SELECT tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall
FROM (SELECT count_if(p AND y) AS tp, count_if(p AND NOT y) AS fp, count_if(NOT p AND y) AS fn,
             count_if(NOT p AND NOT y) AS tn
      FROM (SELECT coalesce(proba >= 0.5 OR rules_count > 0, false) AS p,
                   coalesce(CAST(label AS INTEGER), 0) = 1 AS y FROM score_log))"""

CREDIT_DAILY = CREDIT + """,
lpd AS (SELECT borrower_id, PD FROM el),
ls AS (SELECT l.*, p.PD, coalesce(CAST(l.loan_amount AS DOUBLE), 0.0) AS EAD FROM loans l LEFT JOIN lpd p USING (borrower_id)),
cd AS (SELECT origination_date AS date, count(*) AS n_loans, avg(PD) AS avg_PD, sum(PD * 0.45 * EAD) AS total_EL
       FROM ls GROUP BY 1)"""

Q["trailing_7d_kpis"] = CREDIT_DAILY + """,
tr AS (SELECT *, avg(avg_PD) OVER w AS avg_PD_trailing, avg(total_EL) OVER w AS total_EL_trailing
       FROM (SELECT *, CAST(date - DATE '1970-01-01' AS BIGINT) AS dn FROM cd)
       WINDOW w AS (ORDER BY dn RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT strftime(date, '%Y-%m-%d') AS date, n_loans, round(avg_PD, 6) AS avg_PD, round(total_EL, 2) AS total_EL,
       round(avg_PD_trailing, 6) AS avg_PD_trailing, round(avg_PD - avg_PD_trailing, 6) AS avg_PD_delta,
       round(total_EL_trailing, 2) AS total_EL_trailing, round(total_EL - total_EL_trailing, 2) AS total_EL_delta
FROM tr"""

Q["credit_month_rollup"] = CREDIT_DAILY + """
SELECT strftime(date, '%Y-%m') AS month, count(DISTINCT date) AS days_with_reports,
       round(avg(avg_PD), 6) AS mean_daily_PD, round(avg(total_EL), 2) AS mean_daily_EL
FROM cd GROUP BY 1"""

Q["latest_kpis"] = with_(LOANS, FEAT, SCORED, TXN, CTX, SCORE_LOG) + """,
lpd AS (SELECT borrower_id, PD FROM el),
cd AS (SELECT origination_date AS date, count(*) AS volume FROM loans GROUP BY 1),
fdv AS (SELECT date, count(*) AS volume FROM score_log GROUP BY 1),
u AS (SELECT 'credit' AS system, date, volume FROM cd UNION ALL SELECT 'fraud', date, volume FROM fdv)
SELECT system, strftime(max(date), '%Y-%m-%d') AS date, arg_max(volume, date) AS volume FROM u GROUP BY system"""

Q["kpi_upsert"] = LOG + _fk(200.0, "fk_old", "fd_old") + _fk(250.0, "fk_new", "fd_new") + """,
u AS (SELECT * FROM fk_new WHERE date >= DATE '2024-01-15'
      UNION ALL SELECT * FROM fk_old WHERE date <= DATE '2024-01-20' AND date < DATE '2024-01-15')
SELECT """ + KPI_COLS + " FROM u"

Q["column_profile"] = with_(TXN) + """,
long AS (SELECT 'merchant_id' AS "column", merchant_id AS value FROM txn UNION ALL
         SELECT 'device_id', device_id FROM txn UNION ALL SELECT 'country', country FROM txn),
c AS (SELECT "column", value, count(*) AS count FROM long GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC NULLS FIRST)
                              AS INTEGER) AS rank FROM c) WHERE rank <= 8"""

Q["class_balance"] = with_(TXN) + """,
c AS (SELECT is_chargeback AS label, count(*) AS n FROM txn GROUP BY 1)
SELECT label, n, round(greatest(1.0, coalesce(
         (SELECT sum(n) FROM c WHERE label = 0) / nullif((SELECT sum(n) FROM c WHERE label = 1), 0), 1.0)), 6)
         AS pos_weight
FROM c"""


def _exp_row(suite, idx, typ, col, success, observed, n="n") -> str:
    colv = "CAST(NULL AS VARCHAR)" if col is None else f"'{col}'"
    return (f"SELECT '{suite}' AS suite, CAST({idx} AS INTEGER) AS idx, '{typ}' AS expectation, {colv} AS \"column\", "
            f"{success} AS success, round(CAST({observed} AS DOUBLE), 6) AS observed, {n} AS element_count FROM agg")


def _between_obs(col, lo=None, hi=None, strict_lo=False, strict_hi=False) -> str:
    conds = [f"{col} IS NOT NULL"]
    if lo is not None:
        conds.append(f"CAST({col} AS DOUBLE) {'>' if strict_lo else '>='} {float(lo)!r}")
    if hi is not None:
        conds.append(f"CAST({col} AS DOUBLE) {'<' if strict_hi else '<='} {float(hi)!r}")
    return f"count_if({' AND '.join(conds)}) / nullif(count({col}), 0)"


Q["contract_pd_scores"] = CREDIT + """,
agg AS (SELECT count(*) AS n, count(borrower_id) / nullif(count(*), 0) AS o2, """ + _between_obs("PD", 0, 1) + """ AS o3
        FROM el)
""" + "\nUNION ALL ".join([
    _exp_row("pd_scores", 0, "exists", "borrower_id", "true", "1.0"),
    _exp_row("pd_scores", 1, "exists", "PD", "true", "1.0"),
    _exp_row("pd_scores", 2, "not_null", "borrower_id", "coalesce(o2 >= 1.0, true)", "o2"),
    _exp_row("pd_scores", 3, "between", "PD", "coalesce(o3 >= 1.0, true)", "o3"),
    _exp_row("pd_scores", 4, "row_count_above", None, "n > 0", "n")])

SEG = CREDIT + """,
seg AS (SELECT grade, state, vintage_year, count(DISTINCT borrower_id) AS borrowers,
               round(sum(EAD), 2) AS total_EAD, round(avg(PD), 6) AS avg_PD, round(sum(EL), 2) AS total_EL
        FROM el GROUP BY grade, state, vintage_year)"""

Q["contract_rollups"] = SEG + """,
agg AS (SELECT count(*) AS n, """ + _between_obs("avg_PD", 0, 1) + """ AS o7 FROM seg)
""" + "\nUNION ALL ".join(
    [_exp_row("rollups", i, "exists", c, "true", "1.0") for i, c in
     enumerate(["grade", "state", "vintage_year", "borrowers", "total_EAD", "avg_PD", "total_EL"])]
    + [_exp_row("rollups", 7, "between", "avg_PD", "coalesce(o7 >= 1.0, true)", "o7")])

Q["expectations_log"] = LOG + """,
agg AS (SELECT count(*) AS n, """ + _between_obs("proba", 0, 1) + """ AS o3,
               count_if(decision IS NOT NULL AND decision IN ('allow', 'review', 'flag', 'block'))
                 / nullif(count(decision), 0) AS o4
        FROM score_log)
""" + "\nUNION ALL ".join([
    _exp_row("fraud_api_logs", 0, "exists", "ts", "true", "1.0"),
    _exp_row("fraud_api_logs", 1, "exists", "decision", "true", "1.0"),
    _exp_row("fraud_api_logs", 2, "exists", "proba", "true", "1.0"),
    _exp_row("fraud_api_logs", 3, "between", "proba", "coalesce(o3 >= 0.99, true)", "o3"),
    _exp_row("fraud_api_logs", 4, "in_set", "decision", "coalesce(o4 >= 1.0, true)", "o4"),
    _exp_row("fraud_api_logs", 5, "row_count_above", None, "n > 0", "n")])

Q["feature_health"] = with_(LOANS, TXN) + """,
bf AS (SELECT borrower_id,
              avg(CASE WHEN loan_amount <> 0 THEN CAST(annual_income AS DOUBLE) / loan_amount END) AS income_to_loan_ratio,
              CAST(max(delinq_2yrs) AS DOUBLE) AS num_past_delinquencies, count(*) AS n_records
       FROM loans GROUP BY borrower_id),
ud AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS user_txn_count_day,
              coalesce(sum(amount), 0.0) AS user_txn_amount_day, 0 AS device_change_count_day
       FROM txn GROUP BY 1, 2),
agg AS (SELECT count(*) AS n, """ + _between_obs("income_to_loan_ratio", 0, None, strict_lo=True) + """ AS o0,
               """ + _between_obs("num_past_delinquencies", 0) + """ AS o1, """ + _between_obs("n_records", 1) + """ AS o2
        FROM bf),
agg2 AS (SELECT count(*) AS n, """ + _between_obs("user_txn_count_day", 0) + """ AS o0,
                """ + _between_obs("user_txn_amount_day", 0) + """ AS o1 FROM ud)
""" + "\nUNION ALL ".join([
    _exp_row("credit_features", 0, "between", "income_to_loan_ratio", "coalesce(o0 >= 1.0, true)", "o0"),
    _exp_row("credit_features", 1, "between", "num_past_delinquencies", "coalesce(o1 >= 1.0, true)", "o1"),
    _exp_row("credit_features", 2, "between", "n_records", "coalesce(o2 >= 1.0, true)", "o2"),
    _exp_row("fraud_batch", 0, "between", "user_txn_count_day", "coalesce(o0 >= 1.0, true)", "o0").replace(
        "FROM agg", "FROM agg2"),
    _exp_row("fraud_batch", 1, "between", "user_txn_amount_day", "coalesce(o1 >= 1.0, true)", "o1").replace(
        "FROM agg", "FROM agg2"),
    _exp_row("fraud_batch", 2, "between", "device_change_count_day", "true", "1.0").replace("FROM agg", "FROM agg2")])

Q["score_health"] = CREDIT + """,
agg AS (SELECT count(*) AS n, """ + _between_obs("EL", 0) + """ AS o1,
               """ + _between_obs("EAD", 0, None, strict_lo=True) + """ AS o4 FROM el)
""" + "\nUNION ALL ".join([
    _exp_row("credit_scores", 0, "row_count_above", None, "n > 0", "n"),
    _exp_row("credit_scores", 1, "between", "EL", "coalesce(o1 >= 1.0, true)", "o1"),
    _exp_row("credit_scores", 2, "exists", "PD", "true", "1.0"),
    _exp_row("credit_scores", 3, "exists", "EAD", "true", "1.0"),
    _exp_row("credit_scores", 4, "between", "EAD", "coalesce(o4 >= 1.0, true)", "o4")])

Q["log_contract"] = LOG + """,
agg AS (SELECT count(*) AS lines FROM score_log)
SELECT k AS key, CASE WHEN k IN ('proba', 'decision', 'ts', 'latency_ms') THEN lines END AS lines_with_key, lines,
       lines > 0 AS success
FROM agg, (VALUES ('ts'), ('decision'), ('proba'), ('latency_ms')) v(k)"""

# --- streaming twins -----------------------------------------------------------------------
Q["stream_daily_kpis"] = with_(TXN) + """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS txns, round(sum(amount), 2) AS amount,
       CAST(sum(is_chargeback) AS BIGINT) AS chargebacks, round(max(amount), 2) AS max_amount
FROM txn GROUP BY 1"""

Q["stream_sliding_velocity"] = with_(TXN) + """,
w AS (SELECT user_id, amount, time_bucket(INTERVAL 5 MINUTE, ts) - k * INTERVAL 5 MINUTE AS ws
      FROM txn, (SELECT unnest(range(0, 6)) AS k))
SELECT user_id, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS txns, round(sum(amount), 2) AS amount
FROM w GROUP BY 1, 2"""

Q["stream_daily_kpis_restart"] = Q["stream_daily_kpis"]

Q["stream_scored"] = LOG + """,
mr AS (SELECT merchant_id, CAST(sum(is_chargeback) AS DOUBLE) / count(*) AS merchant_chargeback_rate
       FROM txn GROUP BY 1)
SELECT transaction_id, round(merchant_chargeback_rate, 6) AS merchant_chargeback_rate, round(proba, 6) AS proba,
       array_to_string(rules_hit, ',') AS rules_hit, decision
FROM score_log LEFT JOIN mr USING (merchant_id)"""

Q["stream_user_state"] = FRAUD + """
SELECT transaction_id, user_id, round(rolling_amount_last_1h, 2) AS rolling_amount_last_1h, home_country,
       geo_location_mismatch, velocity_spike, device_is_new
FROM ctx"""

Q["stream_dedupe"] = with_(TXN) + "\nSELECT transaction_id, user_id FROM txn"

# --- extra credit / fraud / monitoring ------------------------------------------------------
Q["reason_codes"] = with_(LOANS) + """,
f AS (SELECT borrower_id,
             avg(CASE WHEN loan_amount <> 0 THEN CAST(annual_income AS DOUBLE) / loan_amount END) AS r,
             CAST(max(delinq_2yrs) AS DOUBLE) AS d,
             avg(try_cast(replace(trim(revol_util), '%', '') AS DOUBLE)) AS u, CAST(count(*) AS DOUBLE) AS n
      FROM loans GROUP BY borrower_id),
c AS (SELECT borrower_id,
             [{'a': -abs((-1.2 * 1.0) * (coalesce(r, 0.0) - 0.0)), 'f': 'income_to_loan_ratio'},
              {'a': -abs((0.9 * 1.0) * (coalesce(d, 0.0) - 0.0)), 'f': 'num_past_delinquencies'},
              {'a': -abs((2.0 * 0.01) * (coalesce(u, 0.0) - 0.0)), 'f': 'credit_utilization_pct'},
              {'a': -abs((-0.02 * 1.0) * (coalesce(n, 0.0) - 0.0)), 'f': 'n_records'}] AS arr
      FROM f)
SELECT borrower_id, array_to_string(list_transform(list_slice(list_sort(arr), 1, 2), lambda s: s.f), ',')
       AS top_features
FROM c"""

Q["loan_keep_first_join"] = with_(LOANS) + """
SELECT borrower_id, arg_min(loan_id, loan_id) AS loan_id, round(arg_min(loan_amount, loan_id), 2) AS loan_amount,
       arg_min(grade, loan_id) AS grade, arg_min(state, loan_id) AS state,
       arg_min(vintage_year, loan_id) AS vintage_year, count(*) AS n_records
FROM loans GROUP BY borrower_id"""

Q["feature_matrix"] = with_(LOANS) + """,
f AS (SELECT borrower_id,
             avg(CASE WHEN loan_amount <> 0 THEN CAST(annual_income AS DOUBLE) / loan_amount END) AS r,
             CAST(max(delinq_2yrs) AS DOUBLE) AS d,
             avg(try_cast(replace(trim(revol_util), '%', '') AS DOUBLE)) AS u, CAST(count(*) AS DOUBLE) AS n
      FROM loans GROUP BY borrower_id),
m AS (SELECT quantile_cont(r, 0.5) AS mr, quantile_cont(d, 0.5) AS md, quantile_cont(u, 0.5) AS mu,
             quantile_cont(n, 0.5) AS mn FROM f)
SELECT borrower_id, round(coalesce(r, mr, 0.0), 6) AS income_to_loan_ratio,
       round(coalesce(d, md, 0.0), 6) AS num_past_delinquencies, round(coalesce(u, mu, 0.0), 6) AS credit_utilization_pct,
       round(coalesce(n, mn, 0.0), 6) AS n_records, CAST(0.0 AS DOUBLE) AS bureau_score
FROM f, m"""

STATUS_FLAG = """CASE WHEN contains(lower(trim(loan_status)), 'charged off') OR contains(lower(trim(loan_status)), 'default')
            OR contains(lower(trim(loan_status)), 'write off') OR contains(lower(trim(loan_status)), 'written off')
            THEN 1 ELSE 0 END"""

Q["defaults_vs_recoveries"] = with_(LOANS) + """,
prev AS (SELECT borrower_id, max(""" + STATUS_FLAG + """) AS p FROM loans WHERE vintage_year < 1996 GROUP BY 1),
cur AS (SELECT borrower_id, max(""" + STATUS_FLAG + """) AS c FROM loans GROUP BY 1),
j AS (SELECT p, c FROM prev FULL OUTER JOIN cur USING (borrower_id))
SELECT count_if(coalesce(p, 0) = 0 AND c = 1) AS new_defaults, count_if(p = 1 AND coalesce(c, 0) = 0) AS recoveries,
       count_if(c = 1) AS defaults_now
FROM j"""

Q["quarantine_txn"] = with_(TXN) + """,
v AS (SELECT transaction_id, coalesce(device_id, 'unknown') AS device_id,
             concat_ws(',', CASE WHEN amount IS NULL OR amount < 0 THEN 'amount' END,
                       CASE WHEN coalesce(account_age_days, 365) < 0 THEN 'account_age_days' END,
                       CASE WHEN length(upper(coalesce(country, 'US'))) <> 2 THEN 'country' END,
                       CASE WHEN coalesce(hour_of_day, 12) < 0 OR coalesce(hour_of_day, 12) > 23 THEN 'hour_of_day' END)
               AS errors
      FROM txn)
SELECT transaction_id, device_id, errors = '' AS valid, errors FROM v"""

Q["account_age"] = with_(TXN) + """,
su AS (SELECT user_id, min(ts) AS created FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT t.transaction_id, t.user_id, t.hour_of_day,
       coalesce(CAST(floor((epoch_us(t.ts) - epoch_us(s.created)) / 86400000000) AS INTEGER), 9999)
         AS account_age_from_signup
FROM txn t LEFT JOIN su s USING (user_id)"""

Q["flagged_per_rule"] = LOG + """
SELECT rule, count(*) AS n FROM (SELECT unnest(rules_hit) AS rule FROM score_log) GROUP BY rule"""

Q["fraud_by_country"] = LOG + """
SELECT country, count(*) AS txns, CAST(sum(is_chargeback) AS BIGINT) AS chargebacks,
       count_if(decision = 'flag') AS flagged
FROM score_log GROUP BY country"""

Q["coverage_report"] = LOG + """,
a AS (SELECT count(*) AS n, count(ts) AS c1, count(decision) AS c2, count(proba) AS c3, count(latency_ms) AS c4,
             count(arm) AS c5, count(rules_hit) AS c6 FROM score_log)
SELECT 'ts' AS "column", true AS present, round(c1 / n, 6) AS non_null_rate FROM a
UNION ALL SELECT 'decision', true, round(c2 / n, 6) FROM a
UNION ALL SELECT 'proba', true, round(c3 / n, 6) FROM a
UNION ALL SELECT 'latency_ms', true, round(c4 / n, 6) FROM a
UNION ALL SELECT 'arm', true, round(c5 / n, 6) FROM a
UNION ALL SELECT 'rules_hit', true, round(c6 / n, 6) FROM a
UNION ALL SELECT 'model_ts', false, CAST(NULL AS DOUBLE) FROM a"""

Q["alerts_min_severity"] = PSI + """,
d AS (SELECT feature, 'numeric' AS type, psi FROM npsi UNION ALL SELECT feature, 'categorical', psi FROM cpsi)
SELECT feature, type, round(psi, 6) AS psi,
       CASE WHEN psi >= 0.25 THEN 'error' WHEN psi >= 0.1 THEN 'warn' ELSE 'info' END AS severity
FROM d"""

Q["calibration_slope"] = CREDIT + """,
lab AS (SELECT borrower_id, CAST(max(""" + STATUS_FLAG + """) AS INTEGER) AS default_flag FROM loans GROUP BY 1),
d AS (SELECT PD, default_flag FROM el JOIN lab USING (borrower_id) WHERE PD IS NOT NULL AND default_flag IS NOT NULL),
ed AS (SELECT list_sort(list_distinct(quantile_cont(PD, """ + DECILES + """))) AS e FROM d),
b AS (SELECT d.*, 1 + len(list_filter(list_slice(e, 2, len(e) - 1), lambda x: x < PD)) AS bin FROM d, ed),
g AS (SELECT bin, avg(PD) AS mean_pd, avg(CASE WHEN default_flag = 1 THEN 1.0 ELSE 0.0 END) AS rate_observed
      FROM b GROUP BY bin)
SELECT round(regr_slope(rate_observed, mean_pd), 6) AS slope, regr_slope(rate_observed, mean_pd) < 0.9 AS alert FROM g"""

Q["retrain_triggers"] = PSI + _fk() + """,
mp AS (SELECT max(psi) AS max_psi FROM (SELECT psi FROM npsi UNION ALL SELECT psi FROM cpsi)),
mk AS (SELECT min("precision") AS min_precision FROM fk)
SELECT round(max_psi, 6) AS max_psi, round(min_precision, 6) AS min_precision,
       coalesce(max_psi > 0.2, false) OR coalesce(min_precision < 0.85, false) AS retrain
FROM mp, mk"""

Q["log_sanity"] = LOG + """
SELECT count_if(coalesce(ts < prev_ts, false)) AS non_monotonic_rows,
       count_if(NOT coalesce(decision IN ('allow', 'flag'), false)) AS bad_enum_rows, count(*) AS rows
FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY transaction_id) AS prev_ts FROM score_log)"""

Q["label_coverage"] = """
WITH lab AS (SELECT event_id AS transaction_id FROM events WHERE event_type IN ('purchase', 'error')),
""" + TXN.lstrip() + """
SELECT count(*) AS total, count(l.transaction_id) AS labelled,
       round(count(l.transaction_id) / count(*), 6) AS coverage,
       count_if(l.transaction_id IS NOT NULL AND t.is_chargeback = 1) AS labelled_positives
FROM txn t LEFT JOIN lab l USING (transaction_id)"""

Q["stream_shadow_join"] = with_(TXN) + """
SELECT transaction_id,
       CASE WHEN 1.0 / (1.0 + exp(-(amount - 6000.0) / 2000.0)) >= 0.5 THEN 'flag' ELSE 'allow' END AS prod_decision,
       CASE WHEN 1.0 / (1.0 + exp(-(amount - 5000.0) / 1500.0)) >= 0.5 THEN 'flag' ELSE 'allow' END AS cand_decision
FROM txn"""

Q["log_roundtrip_latest2"] = LOG + """
SELECT strftime(date, '%Y-%m-%d') AS as_of_date, count(*) AS requests,
       round(avg(CASE WHEN lower(decision) = 'flag' THEN 1.0 ELSE 0.0 END), 6) AS flag_rate,
       round(avg(CASE WHEN lower(decision) = 'review' THEN 1.0 ELSE 0.0 END), 6) AS review_rate,
       round(coalesce(avg(proba), 0.0), 6) AS mean_proba,
       round(coalesce(quantile_cont(CAST(latency_ms AS DOUBLE), 0.95), 0.0), 6) AS p95_latency_ms
FROM score_log WHERE date IN (SELECT DISTINCT date FROM score_log ORDER BY date DESC LIMIT 2) GROUP BY date"""

Q["rollup_csv_roundtrip"] = Q["segment_el_rollup"]

Q["woe_iv_ratio"] = with_(LOANS) + """,
f AS (SELECT borrower_id,
             avg(CASE WHEN loan_amount <> 0 THEN CAST(annual_income AS DOUBLE) / loan_amount END) AS x,
             CAST(max(""" + STATUS_FLAG + """) AS INTEGER) AS y
      FROM loans GROUP BY borrower_id),
ed AS (SELECT list_sort(list_distinct(quantile_cont(x, """ + DECILES + """))) AS e FROM f),
b AS (SELECT f.*, 1 + len(list_filter(list_slice(e, 2, greatest(len(e) - 1, 1)), lambda v: v < x)) AS bin
      FROM f, ed WHERE x IS NOT NULL AND y IS NOT NULL),
g AS (SELECT CAST(bin AS INTEGER) AS bin, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS bad,
             CAST(sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS BIGINT) AS good FROM b GROUP BY 1),
p AS (SELECT *, (bad + 0.5) / sum(bad + 0.5) OVER () AS pb, (good + 0.5) / sum(good + 0.5) OVER () AS pg FROM g),
w AS (SELECT *, ln(pg / pb) AS woe FROM p)
SELECT bin, bad, good, round(woe, 6) AS woe, round(sum((pg - pb) * woe) OVER (), 6) AS iv FROM w"""

Q["freshness_check"] = LOG + """,
o AS (SELECT max(ts) AS out_max FROM score_log), i AS (SELECT max(ts) AS in_max FROM events)
SELECT strftime(out_max, '%Y-%m-%d %H:%M:%S') AS out_max, strftime(in_max, '%Y-%m-%d %H:%M:%S') AS in_max,
       round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(out_max)) / 3.6e9, 6) AS age_hours,
       (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(out_max)) / 3.6e9 <= 24.0 AS fresh,
       out_max >= in_max AS not_stale_vs_inputs
FROM o, i"""

Q["describe_txn"] = with_(TXN) + """
SELECT 'amount' AS "column", count(amount) AS count, round(avg(amount), 6) AS mean, round(stddev_samp(amount), 6) AS std,
       round(min(amount), 6) AS min, round(max(amount), 6) AS max FROM txn
UNION ALL SELECT 'hour_of_day', count(hour_of_day), round(avg(hour_of_day), 6), round(stddev_samp(hour_of_day), 6),
       round(CAST(min(hour_of_day) AS DOUBLE), 6), round(CAST(max(hour_of_day) AS DOUBLE), 6) FROM txn
UNION ALL SELECT 'account_age_days', count(account_age_days), round(avg(account_age_days), 6),
       round(stddev_samp(account_age_days), 6), round(CAST(min(account_age_days) AS DOUBLE), 6),
       round(CAST(max(account_age_days) AS DOUBLE), 6) FROM txn"""

Q["stream_log_kpis"] = LOG + """
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS requests,
       round(count_if(lower(decision) = 'flag') / count(*), 6) AS flag_rate,
       round(sum(proba) / count(*), 6) AS mean_proba,
       round(quantile_cont(CAST(latency_ms AS DOUBLE), 0.95), 6) AS p95_latency_ms
FROM score_log GROUP BY date"""


def _unpivot_sql(src: str, cols, period: str | None = None) -> str:
    p = f"{period} AS period, " if period else ""
    return " UNION ALL ".join(f"SELECT {p}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)


_BIN = ("CASE WHEN len(e) >= 2 AND l.value >= e[1] AND l.value <= e[len(e)] "
        "THEN least(len(list_filter(e, lambda x: x <= l.value)), len(e) - 1) END")
CREDIT_DRIFT_COLS = ["PD", "loan_amount", "income_to_loan_ratio", "credit_utilization_pct"]

DRIFT_DAILY = """,
lf AS (SELECT l.*, p.PD AS PD2, p.income_to_loan_ratio, p.credit_utilization_pct
       FROM loans l LEFT JOIN (SELECT borrower_id, PD, income_to_loan_ratio, credit_utilization_pct FROM el) p
       USING (borrower_id)),
lf2 AS (SELECT * EXCLUDE (PD2), PD2 AS PD FROM lf),
rf AS (SELECT * FROM lf2 WHERE vintage_year < 1998),
cf AS (SELECT * FROM lf2 WHERE vintage_year >= 1998),
lr AS (SELECT * FROM (""" + _unpivot_sql("rf", CREDIT_DRIFT_COLS) + """) WHERE value IS NOT NULL AND NOT isnan(value)),
lc AS (SELECT * FROM (""" + _unpivot_sql("cf", CREDIT_DRIFT_COLS, "origination_date") + """)
       WHERE value IS NOT NULL AND NOT isnan(value)),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, """ + DECILES + """))) AS e
          FROM lr GROUP BY feature),
rb AS (SELECT l.feature, """ + _BIN + """ AS bin FROM lr l LEFT JOIN edges USING (feature)),
rc AS (SELECT feature, bin, count(*) AS r FROM rb GROUP BY 1, 2),
cb AS (SELECT l.period, l.feature, """ + _BIN + """ AS bin FROM lc l LEFT JOIN edges USING (feature)),
cc AS (SELECT period, feature, bin, count(*) AS c FROM cb GROUP BY 1, 2, 3),
nr AS (SELECT feature, sum(r) AS nr FROM rc GROUP BY 1),
nc AS (SELECT period, feature, sum(c) AS nc FROM cc GROUP BY 1, 2),
grid AS (SELECT n.period, n.feature, unnest(range(1, len(e))) AS bin FROM nc n JOIN edges USING (feature)
         WHERE len(e) >= 2),
fullt AS (SELECT g.period, g.feature, g.bin, coalesce(rc.r, 0) AS r, coalesce(cc.c, 0) AS c
          FROM grid g LEFT JOIN rc ON rc.feature = g.feature AND rc.bin = g.bin
          LEFT JOIN cc ON cc.period = g.period AND cc.feature = g.feature AND cc.bin = g.bin),
tt AS (SELECT period, feature, sum(r) AS rt, sum(c) AS ct, count(*) AS nb FROM fullt GROUP BY 1, 2),
pp AS (SELECT f.period, f.feature, (f.r + 1e-6) / (t.rt + 1e-6 * t.nb) AS rp, (f.c + 1e-6) / (t.ct + 1e-6 * t.nb) AS cp,
              t.rt FROM fullt f JOIN tt t USING (period, feature)),
ps AS (SELECT period, feature, sum((cp - rp) * ln(cp / rp)) AS psi, max(rt) AS rt FROM pp GROUP BY 1, 2),
dl AS (SELECT n.period AS date, n.feature,
              CASE WHEN coalesce(x.nr, 0) > 0 AND n.nc > 0 AND ps.rt > 0 THEN ps.psi END AS psi
       FROM nc n LEFT JOIN nr x USING (feature) LEFT JOIN ps USING (period, feature))"""

Q["credit_month_rollup"] = CREDIT_DAILY + DRIFT_DAILY + """,
base AS (SELECT strftime(date, '%Y-%m') AS month, count(DISTINCT date) AS days_with_reports,
                avg(avg_PD) AS mean_daily_PD, avg(total_EL) AS mean_daily_EL FROM cd GROUP BY 1),
st AS (SELECT strftime(date, '%Y-%m') AS month, count(DISTINCT CASE WHEN psi >= 0.25 THEN date END) AS alert_days,
              max(psi) AS max_psi, avg(psi) AS avg_psi FROM dl GROUP BY 1),
fm AS (SELECT strftime(date, '%Y-%m') AS month, feature, avg(psi) AS mean_psi FROM dl GROUP BY 1, 2),
tf AS (SELECT month, string_agg(feature, ',' ORDER BY rn) AS top_features
       FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY mean_psi DESC NULLS LAST, feature) AS rn FROM fm)
       WHERE rn <= 5 GROUP BY month)
SELECT b.month, b.days_with_reports, round(b.mean_daily_PD, 6) AS mean_daily_PD, round(b.mean_daily_EL, 2) AS mean_daily_EL,
       s.alert_days, round(s.max_psi, 6) AS max_psi, round(s.avg_psi, 6) AS avg_psi, t.top_features
FROM base b LEFT JOIN st s USING (month) LEFT JOIN tf t USING (month)"""


Q["trailing_7d_kpis"] = CREDIT_DAILY + DRIFT_DAILY + """,
dd AS (SELECT date, sum(psi) AS ps, count(psi) AS pn, max(psi) AS psi_max FROM dl GROUP BY date),
j AS (SELECT cd.*, dd.ps, dd.pn, dd.psi_max, CAST(cd.date - DATE '1970-01-01' AS BIGINT) AS dn
      FROM cd LEFT JOIN dd USING (date)),
tr AS (SELECT *, avg(avg_PD) OVER w AS avg_PD_trailing, avg(total_EL) OVER w AS total_EL_trailing,
              sum(ps) OVER w / nullif(CAST(sum(pn) OVER w AS DOUBLE), 0) AS psi_mean_trailing,
              max(psi_max) OVER w AS psi_max_trailing, ps / nullif(CAST(pn AS DOUBLE), 0) AS psi_mean
       FROM j WINDOW w AS (ORDER BY dn RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT strftime(date, '%Y-%m-%d') AS date, n_loans, round(avg_PD, 6) AS avg_PD, round(total_EL, 2) AS total_EL,
       round(avg_PD_trailing, 6) AS avg_PD_trailing, round(avg_PD - avg_PD_trailing, 6) AS avg_PD_delta,
       round(total_EL_trailing, 2) AS total_EL_trailing, round(total_EL - total_EL_trailing, 2) AS total_EL_delta,
       round(psi_max, 6) AS psi_max, round(psi_mean, 6) AS psi_mean, round(psi_mean_trailing, 6) AS psi_mean_trailing,
       round(psi_max_trailing, 6) AS psi_max_trailing, round(psi_mean - psi_mean_trailing, 6) AS psi_mean_delta
FROM tr"""

Q["segment_rollup_levels"] = CREDIT + """
SELECT grade, state, CAST(grouping(grade, state) AS BIGINT) AS level, count(DISTINCT borrower_id) AS borrowers,
       round(sum(EAD), 2) AS total_EAD, round(avg(PD), 6) AS avg_PD, round(sum(EL), 2) AS total_EL
FROM el GROUP BY ROLLUP (grade, state)"""

# --- the hot-key path gives the rows of the plain one -----------------------------------------
for _name in ("rolling_amount_1h", "velocity_spike", "geo_mismatch", "new_device", "device_changes", "final_decisions"):
    Q["hot_" + _name] = Q[_name]

# --- contracts and health checks: NULLs, LGD, roll-ups, and damaged copies ------------------------
def _named(agg: str, row: str) -> str:
    return row.replace("FROM agg", "FROM " + agg)


Q["contract_pd_scores"] = Q["contract_pd_scores"].replace("AS o3\n        FROM el", "AS o3, count(PD) / nullif(count(*), 0) AS o5\n        FROM el") \
    + "\nUNION ALL " + _exp_row("pd_scores", 5, "not_null", "PD", "coalesce(o5 >= 1.0, true)", "o5")
Q["contract_rollups"] = Q["contract_rollups"].replace("AS o7 FROM seg", "AS o7, count(avg_PD) / nullif(count(*), 0) AS o8 FROM seg") \
    + "\nUNION ALL " + _exp_row("rollups", 8, "not_null", "avg_PD", "coalesce(o8 >= 1.0, true)", "o8")

_RATES = """
mrate AS (SELECT merchant_id, CAST(sum(is_chargeback) AS DOUBLE) / count(*) AS merchant_chargeback_rate FROM txn GROUP BY 1)"""
Q["feature_health"] = Q["feature_health"].replace(with_(LOANS, TXN), with_(LOANS, TXN, CTX) + "," + _RATES + """,
agg3 AS (SELECT count(*) AS n, """ + _between_obs("merchant_chargeback_rate", 0, 1) + """ AS o0 FROM mrate),
agg4 AS (SELECT count(*) AS n, """ + _between_obs("rolling_amount_last_1h", 0) + """ AS o0 FROM ctx)""", 1) + "\nUNION ALL " \
    + _named("agg3", _exp_row("fraud_merchants", 0, "between", "merchant_chargeback_rate", "coalesce(o0 >= 1.0, true)", "o0")) \
    + "\nUNION ALL " \
    + _named("agg4", _exp_row("fraud_stream", 0, "between", "rolling_amount_last_1h", "coalesce(o0 >= 1.0, true)", "o0"))


def _score_rows(src: str) -> list[str]:
    return [_named(src, r) for r in (
        _exp_row("credit_scores", 0, "row_count_above", None, "n > 0", "n"),
        _exp_row("credit_scores", 1, "between", "EL", "coalesce(o1 >= 1.0, true)", "o1"),
        _exp_row("credit_scores", 2, "exists", "PD", "true", "1.0"), _exp_row("credit_scores", 3, "exists", "EAD", "true", "1.0"),
        _exp_row("credit_scores", 4, "between", "EAD", "coalesce(o4 >= 1.0, true)", "o4"),
        _exp_row("credit_scores", 5, "exists", "LGD", "true", "1.0"),
        _exp_row("credit_scores", 6, "between", "PD", "coalesce(o6 >= 1.0, true)", "o6"))]


def _rollup_rows(src: str) -> list[str]:
    return [_named(src, _exp_row("rollups", 0, "between", "total_EL", "coalesce(r0 >= 1.0, true)", "r0"))] + [
        _named(src, _exp_row("rollups", i + 1, "some_value", k, f"r{i + 1} > 0 OR n = 0", f"r{i + 1}"))
        for i, k in enumerate(["grade", "state", "vintage_year"])]


_SCORE_AGG = "SELECT count(*) AS n, " + _between_obs("EL", 0) + " AS o1, " + _between_obs("EAD", 0, None, strict_lo=True) + " AS o4, " \
    + _between_obs("PD", 0, 1) + " AS o6, count(PD) / nullif(count(*), 0) AS o5, count(borrower_id) / nullif(count(*), 0) AS o2 FROM "
_ROLLUP_AGG = "SELECT count(*) AS n, " + _between_obs("total_EL", 0) + " AS r0, count(grade) AS r1, count(state) AS r2, " \
    "count(vintage_year) AS r3, " + _between_obs("avg_PD", 0, 1) + " AS o7, count(avg_PD) / nullif(count(*), 0) AS o8 FROM "

Q["score_health"] = SEG + ", a1 AS (" + _SCORE_AGG + "el), a2 AS (" + _ROLLUP_AGG + "seg)\n" \
    + "\nUNION ALL ".join(_score_rows("a1") + _rollup_rows("a2"))

Q["checks_on_damaged_data"] = SEG.replace("WITH ", with_(TXN, CTX) + "," + _RATES + ",", 1) + """,
bad_el AS (SELECT * REPLACE (CASE borrower_id % 10 WHEN 1 THEN 1.5 WHEN 0 THEN NULL ELSE PD END AS PD,
                             CASE WHEN borrower_id % 10 = 2 THEN -1.0 ELSE EL END AS EL) FROM el),
bad_seg AS (SELECT * REPLACE (CASE WHEN vintage_year <> 1995 THEN avg_PD END AS avg_PD, CAST(NULL AS VARCHAR) AS grade,
                              CASE WHEN vintage_year = 1996 THEN -1.0 ELSE total_EL END AS total_EL) FROM seg),
a1 AS (""" + _SCORE_AGG + """bad_el), a2 AS (""" + _ROLLUP_AGG + """bad_seg),
a3 AS (SELECT count(*) AS n, """ + _between_obs("x", 0, 1) + """ AS o0
       FROM (SELECT CASE WHEN merchant_id = 'M1' THEN 1.2 ELSE merchant_chargeback_rate END AS x FROM mrate)),
a4 AS (SELECT count(*) AS n, """ + _between_obs("x", 0) + """ AS o0
       FROM (SELECT CASE WHEN transaction_id % 100 = 0 THEN -5.0 ELSE rolling_amount_last_1h END AS x FROM ctx))
""" + "\nUNION ALL ".join(
    [_named("a1", r) for r in (
        _exp_row("pd_scores", 0, "exists", "borrower_id", "true", "1.0"), _exp_row("pd_scores", 1, "exists", "PD", "true", "1.0"),
        _exp_row("pd_scores", 2, "not_null", "borrower_id", "coalesce(o2 >= 1.0, true)", "o2"),
        _exp_row("pd_scores", 3, "between", "PD", "coalesce(o6 >= 1.0, true)", "o6"),
        _exp_row("pd_scores", 4, "row_count_above", None, "n > 0", "n"),
        _exp_row("pd_scores", 5, "not_null", "PD", "coalesce(o5 >= 1.0, true)", "o5"),
        _exp_row("pd_scores", 6, "exists", "as_of_date", "false", "0.0"))]
    + _score_rows("a1")
    + [_named("a2", _exp_row("rollup_contract", i, "exists", c, "true", "1.0")) for i, c in
       enumerate(["grade", "state", "vintage_year", "borrowers", "total_EAD", "avg_PD", "total_EL"])]
    + [_named("a2", _exp_row("rollup_contract", 7, "between", "avg_PD", "coalesce(o7 >= 1.0, true)", "o7")),
       _named("a2", _exp_row("rollup_contract", 8, "not_null", "avg_PD", "coalesce(o8 >= 1.0, true)", "o8"))]
    + _rollup_rows("a2")
    + [_named("a3", _exp_row("fraud_merchants", 0, "between", "merchant_chargeback_rate", "coalesce(o0 >= 1.0, true)", "o0")),
       _named("a4", _exp_row("fraud_stream", 0, "between", "rolling_amount_last_1h", "coalesce(o0 >= 1.0, true)", "o0"))])

Q["el_total_by_name"] = SEG + "\nSELECT round(sum(total_EL), 2) AS el_total FROM seg"

# --- scans, sinks, coercions, and parts of roll-ups -----------------------------------------------
Q["any_table_roundtrip"] = with_(LOANS) + """
SELECT f AS format, count(*) AS n, round(sum(loan_amount), 2) AS loan_amount,
       round(sum(try_cast(replace(trim(revol_util), '%', '') AS DOUBLE)), 2) AS utilisation
FROM loans, (VALUES ('csv'), ('parquet')) v(f) GROUP BY f"""
Q["kpi_json_scan"] = with_(TXN) + """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS txns, round(sum(amount), 2) AS amount, CAST(NULL AS VARCHAR) AS model
FROM txn GROUP BY 1"""
Q["evolving_union"] = with_(TXN) + """
SELECT country, count(*) AS n, CAST(NULL AS DOUBLE) AS amount FROM txn WHERE transaction_id % 2 = 0 GROUP BY 1
UNION ALL SELECT country, count(*), round(sum(amount), 2) FROM txn WHERE transaction_id % 2 = 1 GROUP BY 1"""
Q["dated_sink_rerun"] = with_(TXN) + """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS n,
       round(sum(CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM txn) THEN 1.0 ELSE amount END), 2) AS amount
FROM txn GROUP BY 1"""
Q["flatten_log"] = LOG + """
SELECT transaction_id, round(amount, 2) AS tx_amount, country AS tx_who_country, device_id AS tx_who_device_id,
       CASE WHEN len(rules_hit) = 0 THEN '[]' ELSE '["' || array_to_string(rules_hit, '","') || '"]' END AS rules_hit
FROM score_log"""
Q["autoscan_labels"] = Q["default_labels"]
Q["chargeback_spellings"] = with_(TXN) + """,
s AS (SELECT CASE WHEN transaction_id % 9 < 8
             THEN (['Y', 'no', ' TRUE ', 'f', '1', '0', '2.0', 'maybe'])[CAST(transaction_id % 9 % 8 + 1 AS INTEGER)] END AS spelling FROM txn)
SELECT spelling, count(*) AS n, CAST(sum(CASE WHEN spelling IN ('Y', ' TRUE ', '1', '2.0') THEN 1 ELSE 0 END) AS BIGINT) AS chargebacks
FROM s GROUP BY 1"""
Q["last_30_days"] = with_(TXN) + """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS txns FROM txn GROUP BY 1 ORDER BY 1 DESC LIMIT 30"""
Q["freshness_of_systems"] = with_(LOANS, TXN) + """
SELECT strftime(greatest((SELECT max(CAST(ts AS DATE)) FROM txn), (SELECT max(origination_date) FROM loans)), '%Y-%m-%d') AS freshest_date"""
Q["pr_curve"] = LOG + """,
c AS (SELECT round(proba, 2) AS t, count_if(label = 1) AS p, count_if(label IS DISTINCT FROM 1) AS n FROM score_log
      WHERE proba IS NOT NULL GROUP BY 1),
r AS (SELECT t, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER () AS pp, sum(n) OVER () AS nn FROM c
      WINDOW w AS (ORDER BY t DESC))
SELECT t AS threshold, round(cp / (cp + cn), 6) AS precision, round(cp / nullif(pp, 0), 6) AS recall, round(cn / nullif(nn, 0), 6) AS fpr
FROM r"""
Q["arms_month_rollup"] = LOG + """
SELECT strftime(date, '%Y-%m') AS month, coalesce(arm, 'unknown') AS arm, count(*) AS n,
       count_if(decision IN ('block', 'review', 'manual_review') OR rules_count > 0) AS flagged,
       round(count_if(decision IN ('block', 'review', 'manual_review') OR rules_count > 0) / count(*), 6) AS flagged_pct
FROM score_log GROUP BY 1, 2"""
Q["label_source_fallback"] = with_(TXN) + """,
j AS (SELECT CASE WHEN e.event_type IN ('purchase', 'error') THEN 'feed' WHEN t.is_chargeback IS NOT NULL THEN 'log' ELSE 'none' END AS source,
             CASE WHEN e.event_type IN ('purchase', 'error') THEN CAST(e.event_type = 'error' AS INTEGER) ELSE t.is_chargeback END AS label
      FROM txn t JOIN events e ON e.event_id = t.transaction_id)
SELECT source, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives FROM j GROUP BY 1"""
Q["delinquency_trend"] = with_(LOANS) + """,
g AS (SELECT vintage_year, count(*) AS loans, avg(CASE WHEN coalesce(delinq_2yrs, 0) > 0 THEN 1.0 ELSE 0.0 END) AS r FROM loans GROUP BY 1)
SELECT vintage_year, loans, round(r, 6) AS delinquency_rate, round(r - lag(r) OVER (ORDER BY vintage_year), 6) AS change FROM g"""
Q["train_split_balance"] = with_(LOANS, TXN) + """,
d AS (SELECT borrower_id, max(""" + STATUS_FLAG + """) AS y FROM loans GROUP BY 1),
c AS (SELECT 'pd' AS model, y AS label, count(*) AS n FROM d GROUP BY 2
      UNION ALL SELECT 'fraud', is_chargeback, count(*) FROM txn GROUP BY 2)
SELECT model, CAST(label AS INTEGER) AS label, n, CAST(floor((n - 1) * 0.25) AS BIGINT) + 1 AS n_test FROM c"""
_top = Q["column_profile"]
Q["column_profile"] = _top.replace("SELECT * FROM (SELECT *,", "SELECT *, 'string' AS dtype, (SELECT count(*) FROM txn) AS row_count FROM (SELECT *,", 1)

# --- models in use, files that change, stored sketches ------------------------------------------
_DEF = """
lab AS (SELECT borrower_id, CAST(max(""" + STATUS_FLAG + """) AS INTEGER) AS label FROM loans GROUP BY 1)"""

Q["calibration_folds"] = with_(LOANS, _DEF) + """,
c AS (SELECT label, count(*) AS n FROM lab GROUP BY 1),
f AS (SELECT label, n, unnest(range(0, 3)) AS fold FROM c),
s AS (SELECT label, fold, n, CAST(floor((n - 1) * (fold + 1) / 3.0) AS BIGINT) + 1 AS hi,
             CASE WHEN fold = 0 THEN 0 ELSE CAST(floor((n - 1) * fold / 3.0) AS BIGINT) + 1 END AS lo FROM f)
SELECT label, CAST(fold AS INTEGER) AS fold, least(hi, n) - lo AS n, least(hi, n) - lo AS n_out_of_fold, true AS in_range FROM s"""

Q["split_shares"] = with_(LOANS, _DEF) + """,
m AS (SELECT count(*) AS n_positive FROM lab WHERE label = 1),
p AS (SELECT unnest([1, 2, 3, 4, 5, 6, 8, 12]) AS n_positive UNION ALL SELECT n_positive FROM m)
SELECT CAST(n_positive AS BIGINT) AS n_positive, CAST(coalesce(list_filter([25, 20, 15, 10], lambda s: n_positive - ((n_positive - 1) * s // 100 + 1) >= 1)[1], 10) AS INTEGER)
         AS test_share, CASE WHEN n_positive >= 3 THEN 3 WHEN n_positive = 2 THEN 2 ELSE 0 END AS folds
FROM p"""

Q["saved_model_parity"] = with_(LOANS) + """
SELECT count(DISTINCT borrower_id) AS n, count(DISTINCT borrower_id) AS n_same_b, count(DISTINCT borrower_id) AS n_same_s, true AS in_range FROM loans"""

Q["file_times"] = with_(LOANS) + """
SELECT 'written' AS step, false AS stale, count(DISTINCT borrower_id) AS borrowers FROM loans
UNION ALL SELECT 'input written again', true, count(DISTINCT borrower_id) FROM loans"""

Q["evolving_types"] = with_(TXN) + """,
g AS (SELECT country, transaction_id % 3 AS k, count(*) AS n, sum(amount) AS amount FROM txn GROUP BY 1, 2)
SELECT country, CASE WHEN k = 2 THEN concat(n, 'x') ELSE CAST(n AS VARCHAR) END AS n,
       CASE k WHEN 1 THEN round(amount, 2) WHEN 2 THEN round(amount) END AS amount, CASE WHEN k < 2 THEN n END AS s_a, CASE WHEN k = 1 THEN country END AS s_b
FROM g"""

Q["latency_sketches"] = LOG + """,
m AS (SELECT strftime(date, '%Y-%m') AS month, count(*) AS n FROM score_log GROUP BY 1)
SELECT month, n, q AS quantile, true AS within FROM m, (SELECT unnest(['p50', 'p95']) AS q)"""

Q["fractional_latency_kpis"] = LOG + """
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS requests,
       round(quantile_cont(latency_ms + (transaction_id % 10) / 10.0, 0.95), 6) AS p95_latency_ms
FROM (SELECT * REPLACE (CAST(latency_ms AS DOUBLE) AS latency_ms) FROM score_log) GROUP BY date"""

Q["shadow_log_scan"] = LOG + """,
s AS (SELECT proba AS prod_proba, decision AS prod_decision, 1.0 / (1.0 + exp(-(amount - 5000.0) / 1500.0)) AS cand_proba,
             CAST(latency_ms AS DOUBLE) + 0.25 AS lp, CAST(3.5 AS DOUBLE) + (transaction_id * 31) % 20 AS lc FROM score_log)
SELECT count(*) AS n, round(avg(CASE WHEN prod_decision = CASE WHEN cand_proba >= 0.5 THEN 'flag' ELSE 'allow' END THEN 1.0 ELSE 0.0 END), 6) AS agreement_rate,
       round(avg(cand_proba - prod_proba), 6) AS mean_score_delta, round(avg(abs(cand_proba - prod_proba)), 6) AS mean_abs_score_delta,
       round(quantile_cont(lp, 0.95), 6) AS p95_latency_prod, round(quantile_cont(lc, 0.95), 6) AS p95_latency_cand
FROM s"""

Q["alerts_that_fire"] = LOG + """,
d AS (SELECT merchant_id AS feature, count(*) * 10 / (SELECT count(*) FROM score_log) AS psi FROM score_log GROUP BY 1),
k AS (SELECT quantile_cont(CAST(latency_ms AS DOUBLE), 0.95) AS rp95, quantile_cont(CAST(latency_ms AS DOUBLE) * 20, 0.95) AS p95,
             avg(CASE WHEN decision = 'flag' THEN 1.0 ELSE 0.0 END) AS rfr, avg(CASE WHEN transaction_id % 10 <> 0 THEN 1.0 ELSE 0.0 END) AS fr FROM score_log)
SELECT 'psi' AS kind, 'warn' AS severity, feature AS subject, round(psi, 6) AS value, 0.25 AS "limit" FROM (
  SELECT *, row_number() OVER (ORDER BY psi DESC, feature) AS rn FROM d WHERE psi >= 0.25) WHERE rn <= 5
UNION ALL SELECT 'latency', 'warn', 'p95_latency_ms', round(p95, 6), round(greatest(250.0, 1.5 * rp95), 6) FROM k WHERE p95 > greatest(250.0, 1.5 * rp95)
UNION ALL SELECT 'flag_rate', 'warn', 'flag_rate', round(fr, 6), round(rfr, 6) FROM k WHERE rfr > 0 AND (fr < 0.5 * rfr OR fr > 1.5 * rfr)"""

Q["severity_thresholds"] = LOG + """,
g AS (SELECT CASE WHEN amount > 9000 THEN 30 WHEN amount > 6000 THEN 20 WHEN amount > 1000 THEN 10 ELSE 0 END AS rank FROM score_log)
SELECT m AS minimum, count_if(rank >= r) AS kept FROM g, (VALUES ('info', 10), ('warn', 20), ('error', 30)) v(m, r) GROUP BY 1"""

Q["upsert_last_in_batch"] = with_(TXN) + """,
l AS (SELECT user_id, arg_max(transaction_id, (epoch_us(ts), transaction_id)) AS transaction_id, arg_max(amount, (epoch_us(ts), transaction_id)) AS amount
      FROM txn GROUP BY 1)
SELECT user_id, CASE WHEN user_id % 3 <> 0 THEN transaction_id ELSE -1 END AS transaction_id,
       CASE WHEN user_id % 3 <> 0 THEN round(amount, 2) ELSE 0.0 END AS amount FROM l"""

Q["contracts_while_writing"] = "SELECT *, success AS success_later FROM (" + Q["contract_pd_scores"] + ")"
