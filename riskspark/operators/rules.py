"""Fraud rule evaluation (O-64..O-67) compiled to Spark ``Column`` expressions.

Two rule dialects share one evaluator:

* flat   ``[{name, condition, action}]``: ``condition`` is a boolean expression over
  the frame's columns (``amount > 5000 and account_age < 30``). A rule whose columns do
  not resolve evaluates to 0, as does a NULL comparison and a row on which it fails.
* structured ``{defaults, rules: [{id, enabled, params, when: {all|any: [...]}, effect}]}``:
  each condition is ``<operand> <op> <operand>`` with operands ``tx.<col>``,
  ``ctx.<col>``, ``params.<name>`` or a literal, and ops ``>= > <= < == != in``. The
  substitution to SQL text is positional (no parsing beyond splitting on the operator);
  ``tx.*`` and ``ctx.*`` are both columns of the frame (context comes from the
  feature operators).

YAML is parsed on the driver only; the rules become a handful of column expressions
evaluated inside whole-stage codegen, never Python per row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.conditions import condition

# ---- fixed values --------------------------------------------------------------------
SEVERITY_RANK = {"low": 1, "medium": 2, "high": 3}
FLAGGED_DECISIONS = ["block", "review", "manual_review"]
DEFAULT_FRAUD_THRESHOLD = 0.5
# Baseline structured rule set (v1.0.0): the four rules of the original baseline rule file.
BASELINE_RULES: dict[str, Any] = {
    "defaults": {"action": "review", "score_delta": 0.20, "severity": "medium"},
    "rules": [
        {"id": "R001_HIGH_AMOUNT_NEW_ACCOUNT", "enabled": True,
         "when": {"all": ["tx.amount >= 10000", "tx.account_age_days < 30"]},
         "effect": {"action": "review", "score_delta": 0.35, "severity": "high",
                    "reasons": ["high_amount_new_account"]}},
        {"id": "R002_VELOCITY_SPIKE", "enabled": True,
         "params": {"window_minutes": 30, "baseline_days": 14, "multiplier": 3.5},
         "when": {"any": ["ctx.velocity_spike == true"]},
         "effect": {"action": "review", "score_delta": 0.25, "severity": "medium", "reasons": ["velocity_spike"]}},
        {"id": "R003_CROSS_BORDER_ODD_HOURS", "enabled": True,
         "params": {"odd_hours": [0, 1, 2, 3, 4, 5, 23]},
         "when": {"all": ["tx.country != ctx.home_country", "tx.hour_of_day in params.odd_hours"]},
         "effect": {"action": "review", "score_delta": 0.20, "severity": "medium",
                    "reasons": ["cross_border_odd_hours"]}},
        {"id": "R004_HIGH_AMOUNT_NEW_DEVICE", "enabled": True,
         "params": {"threshold_amount": 7500},
         "when": {"all": ["tx.amount >= params.threshold_amount", "ctx.device_is_new == true",
                          "tx.account_age_days < 365"]},
         "effect": {"action": "review", "score_delta": 0.30, "severity": "high",
                    "reasons": ["high_amount_new_device"]}},
    ],
}
# --------------------------------------------------------------------------------------

_OPS = [">=", "<=", "==", "!=", ">", "<", " in "]


def load_rules(path: str) -> Any:
    """Read a YAML (or JSON) rule file on the driver."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or []


def _sql_literal(v: Any, in_list: bool = False) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, (list, tuple)):
        inner = ", ".join(_sql_literal(x) for x in v)
        return f"({inner})" if in_list else f"array({inner})"
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def _operand(tok: str, params: Mapping[str, Any], in_list: bool = False) -> str:
    tok = tok.strip()
    m = re.fullmatch(r"(tx|ctx)\.([A-Za-z_][A-Za-z0-9_]*)", tok)
    if m:
        return f"`{m.group(2)}`"
    m = re.fullmatch(r"params\.([A-Za-z_][A-Za-z0-9_]*)", tok)
    if m:
        if m.group(1) not in params:
            raise KeyError(f"unknown rule parameter {tok}")
        return _sql_literal(params[m.group(1)], in_list)
    return tok  # literal number / true / false / quoted text


def condition_sql(cond: str, params: Mapping[str, Any] | None = None) -> str:
    """Structured-dialect condition -> Spark SQL boolean text."""
    params = params or {}
    for op in _OPS:
        if op in cond:
            left, right = cond.split(op, 1)
            if op == " in ":
                return f"({_operand(left, params)} IN {_operand(right, params, in_list=True)})"
            sql_op = "=" if op == "==" else op
            return f"({_operand(left, params)} {sql_op} {_operand(right, params)})"
    return f"({_operand(cond, params)})"


def compile_structured(rules: Mapping[str, Any], df: DataFrame | None = None) -> list[dict[str, Any]]:
    """Enabled structured rules -> [{id, cond: Column, action, score_delta, severity, reasons}].

    A condition on a ``tx.*`` / ``ctx.*`` field that the frame lacks is false (names compare
    as Spark compares them, without case); the other conditions of an ``any`` still count."""
    defaults = dict(rules.get("defaults") or {})
    cols = {c.lower() for c in df.columns} if df is not None else None

    def compiled(c: Any, params: Mapping[str, Any]) -> Column:
        text = condition_sql(c, params)
        if cols is not None and any(n.lower() not in cols for n in re.findall(r"`([^`]+)`", text)):
            return F.lit(False)
        if df is None:
            return F.expr(text)
        found = condition(df, text)
        return F.lit(False) if found is None else found

    out = []
    for r in rules.get("rules") or []:
        if not r.get("enabled", True):
            continue
        params = r.get("params") or {}
        when = r.get("when") or {}
        parts_all = [compiled(c, params) for c in when.get("all") or []]
        parts_any = [compiled(c, params) for c in when.get("any") or []]
        cond = F.lit(True)
        for p in parts_all:
            cond = cond & p
        if parts_any:
            anyc = F.lit(False)
            for p in parts_any:
                anyc = anyc | p
            cond = cond & anyc
        if not parts_all and not parts_any:
            cond = F.lit(False)
        eff = {**defaults, **(r.get("effect") or {})}
        out.append({"id": str(r["id"]), "cond": F.coalesce(cond, F.lit(False)),
                    "action": eff.get("action", "review"), "score_delta": float(eff.get("score_delta", 0.0)),
                    "severity": str(eff.get("severity", "medium")), "reasons": list(eff.get("reasons") or [])})
    return out


def evaluate_structured(df: DataFrame, rules: Mapping[str, Any] = BASELINE_RULES) -> DataFrame:
    """O-65 / O-66: adds rules_hit (ids, rule order), rule_actions, score_delta (sum),
    severity (max), reasons (concatenated)."""
    comp = compile_structured(rules, df)
    if not comp:
        return df.withColumns({"rules_hit": F.array().cast("array<string>"),
                               "rule_actions": F.array().cast("array<string>"),
                               "score_delta": F.lit(0.0), "severity": F.lit(None).cast("string"),
                               "reasons": F.array().cast("array<string>")})
    hits = F.filter(F.array(*[F.when(r["cond"], F.lit(r["id"])) for r in comp]), lambda x: x.isNotNull())
    actions = F.array_distinct(F.filter(F.array(*[F.when(r["cond"], F.lit(r["action"])) for r in comp]),
                                        lambda x: x.isNotNull()))
    delta = sum((F.when(r["cond"], F.lit(r["score_delta"])).otherwise(F.lit(0.0)) for r in comp), F.lit(0.0))
    ranks = [F.when(r["cond"], F.lit(SEVERITY_RANK.get(r["severity"], 0))) for r in comp]
    rank = ranks[0] if len(ranks) == 1 else F.greatest(*ranks)
    sev = F.element_at(F.create_map(*[x for k, v in SEVERITY_RANK.items() for x in (F.lit(v), F.lit(k))]), rank)
    reasons = F.flatten(F.array(*[F.when(r["cond"], F.array(*[F.lit(x) for x in r["reasons"]]).cast("array<string>"))
                                  .otherwise(F.array().cast("array<string>")) for r in comp]))
    return df.withColumns({"rules_hit": hits, "rule_actions": actions, "score_delta": delta,
                           "severity": F.when(rank.isNotNull(), sev), "reasons": reasons})


def evaluate_flat(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    """O-64: one 0/1 column ``rule__<name>`` per rule, plus rule_flag / rule_review (OR of
    the rules with that action). A condition that cannot be read or analysed gives 0 everywhere; one
    that is unknown, or fails, on a row gives 0 there (:mod:`riskspark.functions.conditions`)."""
    cols: dict[str, Column] = {}
    flag, review = F.lit(0), F.lit(0)
    for i, r in enumerate(rules):
        name = str(r.get("name", f"rule_{i}"))
        cond = condition(df, str(r["condition"]))
        hit = F.lit(0) if cond is None else cond.cast("int")
        cols[f"rule__{name}"] = hit
        if r.get("action") == "flag":
            flag = F.greatest(flag, hit)
        if r.get("action") == "review":
            review = F.greatest(review, hit)
    cols["rule_flag"] = flag
    cols["rule_review"] = review
    return df.withColumns(cols)


def final_decision(df: DataFrame, proba: str = "proba", threshold: float = DEFAULT_FRAUD_THRESHOLD,
                   rules_hit: str = "rules_hit", out: str = "decision") -> DataFrame:
    """O-67: 'flag' if proba >= threshold or any rule hit, else 'allow'."""
    hit = F.coalesce(F.size(F.col(rules_hit)) > 0, F.lit(False))
    return df.withColumn(out, F.when((F.col(proba) >= F.lit(float(threshold))) | hit, F.lit("flag"))
                         .otherwise(F.lit("allow")))


def report_flagged(decision: Column, rules_count: Column) -> Column:
    """D3, report definition: decision in (block, review, manual_review) or any rule hit."""
    return decision.cast("string").isin(FLAGGED_DECISIONS) | (F.coalesce(rules_count, F.lit(0)) > 0)
