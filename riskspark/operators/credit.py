"""Credit operators: labels, borrower features, PD scoring, expected loss, roll-ups.

O-12, O-13, O-21, O-32, O-35, O-36, O-68..O-70, O-73, O-74, O-79, O-98..O-100, O-105.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskspark.functions import coerce as C

# ---- fixed values --------------------------------------------------------------------
DEFAULT_LGD = 0.45            # loss given default when no LGD column is present
DEFAULT_PD_THRESHOLD = 0.20   # credit decision cut-off
SEGMENT_KEYS = ["grade", "state", "vintage_year"]
# --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Scorecard:
    """Linear PD scorecard: z = intercept + sum(weight * (x * scale - shift)), PD = logistic(z).

    Missing features are imputed with ``fill`` before scoring (same on every side, D9).
    """
    terms: tuple[tuple[str, float, float, float], ...]  # (feature, weight, scale, shift)
    intercept: float = 0.0
    clip: float | None = 30.0
    fill: dict = field(default_factory=dict)

    def logit(self) -> Column:
        z = F.lit(float(self.intercept))
        for feat, w, scale, shift in self.terms:
            x = F.col(feat).cast("double")
            if feat in self.fill:
                x = F.coalesce(x, F.lit(float(self.fill[feat])))
            z = z + F.lit(float(w)) * (x * F.lit(float(scale)) - F.lit(float(shift)))
        return z


# Test scorecard: the synthetic logit of the original model publisher.
# z = -1.2(ratio - 1.5) + 0.9 delinq + 2.0(util/100 - 0.4) - 0.02(n - 12); missing -> 0.
DEFAULT_SCORECARD = Scorecard(
    terms=(("income_to_loan_ratio", -1.2, 1.0, 1.5),
           ("num_past_delinquencies", 0.9, 1.0, 0.0),
           ("credit_utilization_pct", 2.0, 0.01, 0.4),
           ("n_records", -0.02, 1.0, 12.0)),
    fill={"income_to_loan_ratio": 0.0, "num_past_delinquencies": 0.0,
          "credit_utilization_pct": 0.0, "n_records": 0.0},
)


def borrower_features(loans: DataFrame, id_col: str | None = None,
                      carry: Sequence[str] = (), carry_order: str | None = None) -> DataFrame:
    """O-32: one row per borrower: mean income/loan ratio, max delinquencies, mean
    utilisation (text percent, or 100*balance/limit), record count.

    ``carry`` columns of the borrower's first row (lowest ``carry_order``) ride along in the
    same aggregate; this is O-74's keep-first join fused into one shuffle when the
    features and the loan attributes come from the same table.
    """
    id_col = id_col or C.pick_col(loans, C.BORROWER_ID_ALIASES)
    if id_col is None:  # reference falls back to the row index
        loans = loans.withColumn("entity_id", F.monotonically_increasing_id())
        id_col = "entity_id"
    amt = C.pick_col(loans, C.LOAN_AMOUNT_ALIASES, required=True)
    inc = C.pick_col(loans, C.INCOME_ALIASES, required=True)
    dlq = C.pick_col(loans, C.DELINQ_ALIASES)
    ratio = C.safe_ratio(C.numeric(loans, inc), C.numeric(loans, amt))
    delinq = C.numeric(loans, dlq) if dlq else F.lit(None).cast("double")
    if "revol_util" in loans.columns:
        util = C.coerce_percent("revol_util")
    else:
        bal, lim = C.pick_col(loans, C.BALANCE_ALIASES), C.pick_col(loans, C.LIMIT_ALIASES)
        util = C.finite(C.safe_ratio(C.numeric(loans, bal), C.numeric(loans, lim)) * 100.0) if bal and lim \
            else F.lit(None).cast("double")
    aggs = [F.avg(ratio).alias("income_to_loan_ratio"),
            F.max(delinq).alias("num_past_delinquencies"),
            F.avg(util).alias("credit_utilization_pct"),
            F.count(F.lit(1)).alias("n_records")]
    if carry:
        order = F.col(carry_order) if carry_order else F.monotonically_increasing_id()
        aggs.append(F.min_by(F.struct(*[F.col(c) for c in carry]), order).alias("_first"))
    out = loans.groupBy(id_col).agg(*aggs)
    if carry:
        out = out.select(id_col, "income_to_loan_ratio", "num_past_delinquencies", "credit_utilization_pct",
                         "n_records", *[F.col(f"_first.{c}").alias(c) for c in carry])
    return out


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """O-79: one row per key, the first by ``order`` (a pre-aggregated min_by, no sort
    of the whole group)."""
    other = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in other]), ordering).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in other])


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """O-79: keep the last row per key by ``order``."""
    other = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in other]), ordering).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in other])


def left_join_keep_first(left: DataFrame, right: DataFrame, key: str, order: Sequence[str],
                         validate: bool = False) -> DataFrame:
    """O-74: left join onto a right side deduplicated keep-first (so m:1 holds by
    construction). ``validate`` additionally asserts the right side was unique."""
    r = dedupe_keep_first(right, [key], order)
    if validate:  # counted in the plan itself: a repeated key ends the query that uses it
        many = right.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_many"))
        once = F.when(F.col("_many") > 1, F.raise_error(F.concat(F.lit(f"duplicate {key}: "), F.col("_key").cast("string")))).otherwise(F.lit(True))
        r = r.join(many, r[key].eqNullSafe(many["_key"])).where(once.cast("boolean")).drop("_key", "_many")
    return left.join(r, key, "left")


def default_labels(loans: DataFrame, id_col: str = "borrower_id", label_column: str | None = None,
                   label_kind: str | None = None, bad_words: Iterable[str] | None = None) -> DataFrame:
    """O-12: borrower default flag = max over the borrower's rows.

    Resolution order: configured column/kind -> binary alias -> status alias -> autoscan.
    """
    if label_column and label_kind:
        col = C.pick_col(loans, [label_column], case_insensitive=True, required=True)
        flag = _binary_flag(loans, col) if label_kind.lower() == "binary" else C.status_default_flag(col, bad_words)
    else:
        col = C.pick_col(loans, C.BINARY_LABEL_ALIASES, case_insensitive=True)
        if col is not None:
            flag = _binary_flag(loans, col)
        else:
            col = C.pick_col(loans, C.STATUS_LABEL_ALIASES, case_insensitive=True) or autoscan_status_column(loans)
            if col is None:
                raise KeyError("Could not infer a default label column")
            flag = C.status_default_flag(col, bad_words)
    return loans.groupBy(id_col).agg(F.max(flag).cast("int").alias("default_flag"))


def _binary_flag(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, StringType):
        return C.bool01(col)
    return (F.coalesce(F.col(col).cast("double"), F.lit(0.0)) != 0).cast("int")


# Name hints for the autoscan, in priority order (fixed values).
STATUS_NAME_HINTS = ["status", "state", "result", "outcome"]


def autoscan_status_column(df: DataFrame) -> str | None:
    """O-13: the string column whose values contain a default word; name-hinted first.

    One aggregate over all string columns (``max(contains...)``), one row to the driver.
    """
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not strings:
        return None
    row = df.agg(*[F.max(C.status_default_flag(c)).alias(c) for c in strings]).first()
    hits = [c for c in strings if row[c] == 1]
    hinted = [c for c in hits if any(h in c.lower() for h in STATUS_NAME_HINTS)]
    return (hinted or hits or [None])[0]


def score_pd(features: DataFrame, scorecard: Scorecard = DEFAULT_SCORECARD, out: str = "PD") -> DataFrame:
    """O-70 + O-21 + O-22: PD from a linear scorecard (imputation explicit)."""
    return features.withColumn(out, C.logistic(scorecard.logit(), scorecard.clip))


def reason_codes(features: DataFrame, scorecard: Scorecard = DEFAULT_SCORECARD, k: int = 5,
                 means: dict | None = None, out: str = "top_features") -> DataFrame:
    """O-73 (re-aimed): top-k features by |weight * (x - mean)| of the linear scorecard."""
    means = means or {}
    contribs = []
    for feat, w, scale, _shift in scorecard.terms:
        x = F.col(feat).cast("double")
        if feat in scorecard.fill:
            x = F.coalesce(x, F.lit(float(scorecard.fill[feat])))
        c = F.lit(float(w)) * F.lit(float(scale)) * (x - F.lit(float(means.get(feat, 0.0))))
        contribs.append(F.struct(F.abs(c).alias("abs_contrib"), F.lit(feat).alias("feature"), c.alias("contrib")))
    arr = F.array_sort(F.array(*contribs), lambda a, b: F.when(a["abs_contrib"] > b["abs_contrib"], -1)
                       .when(a["abs_contrib"] < b["abs_contrib"], 1)
                       .otherwise(F.when(a["feature"] < b["feature"], -1).otherwise(1)))
    return features.withColumn(out, F.slice(F.transform(arr, lambda s: s["feature"]), 1, k))


def expected_loss(scored: DataFrame, pd_col: str = "PD", ead_col: str = "loan_amount",
                  lgd: float = DEFAULT_LGD, lgd_col: str | None = "LGD") -> DataFrame:
    """O-69: EAD = ead (NULL -> 0); LGD = column if present else default; EL = PD*LGD*EAD."""
    ead = F.coalesce(F.col(ead_col).cast("double"), F.lit(0.0))
    lgd_c = F.col(lgd_col).cast("double") if lgd_col and lgd_col in scored.columns else F.lit(float(lgd))
    return (scored.withColumn("EAD", ead).withColumn("LGD", lgd_c)
                  .withColumn("EL", F.col(pd_col) * F.col("LGD") * F.col("EAD")))


def segment_rollup(scores: DataFrame, keys: Sequence[str] = SEGMENT_KEYS, id_col: str = "borrower_id",
                   pd_col: str = "PD") -> DataFrame:
    """O-35: by segment: distinct borrowers, sum EAD, mean PD, sum EL (NULL keys kept)."""
    return scores.groupBy(*keys).agg(
        F.count_distinct(F.col(id_col)).alias("borrowers"),
        F.sum("EAD").alias("total_EAD"),
        F.avg(pd_col).alias("avg_PD"),
        F.sum("EL").alias("total_EL"))


def segment_rollup_levels(scores: DataFrame, keys: Sequence[str] = ("grade", "state"), id_col: str = "borrower_id",
                          pd_col: str = "PD") -> DataFrame:
    """O-35 with sub-totals: ``rollup`` over the segment keys (grade x state, grade, all)
    in one aggregate; ``level`` = grouping_id (0 = finest)."""
    return scores.rollup(*keys).agg(
        F.grouping_id().alias("level"),
        F.count_distinct(F.col(id_col)).alias("borrowers"),
        F.sum("EAD").alias("total_EAD"),
        F.avg(pd_col).alias("avg_PD"),
        F.sum("EL").alias("total_EL"))


def portfolio_summary(scores: DataFrame, pd_col: str = "PD") -> DataFrame:
    """O-36: N, mean PD, total EL (0 when empty)."""
    return scores.agg(F.count(F.lit(1)).alias("n"), F.avg(pd_col).alias("avg_PD"),
                      F.coalesce(F.sum("EL"), F.lit(0.0)).alias("total_EL"))


def credit_decision(scores: DataFrame, threshold: float = DEFAULT_PD_THRESHOLD, pd_col: str = "PD") -> DataFrame:
    """O-68: decision 1 when PD >= threshold."""
    return scores.withColumn("decision", (F.col(pd_col) >= F.lit(float(threshold))).cast("int"))


def stress_el(scores: DataFrame, scenarios: DataFrame, pd_col: str = "PD") -> DataFrame:
    """O-99: EL under scenario multipliers: scenarios(scenario, pd_mult, lgd_mult), PD and LGD
    capped at 1; one row per borrower and scenario. Scenarios are parameters: they become an
    array of constants that each score row is exploded over, so nothing is joined."""
    rows = scenarios.collect()
    if not rows:
        return scores.limit(0).withColumns({"scenario": F.lit(None).cast("string"), "pd_mult": F.lit(0.0), "lgd_mult": F.lit(0.0),
                                            "EL_stressed": F.lit(0.0)})
    each = F.array(*[F.struct(*[F.lit(r[c]).cast(t).alias(c) for c, t in scenarios.dtypes]) for r in rows])
    return scores.withColumn("_s", F.explode(each)).select(*scores.columns, "_s.*").withColumn(
        "EL_stressed", F.least(F.col(pd_col) * F.col("pd_mult"), F.lit(1.0))
        * F.least(F.col("LGD") * F.col("lgd_mult"), F.lit(1.0)) * F.col("EAD"))


def pd_histogram(scores: DataFrame, bins: int = 10, pd_col: str = "PD", by: Sequence[str] = ()) -> DataFrame:
    """O-98: PD histogram on equal-width [0,1] bins (bin 1..bins, PD=1 in the last bin)."""
    b = F.least(F.floor(F.col(pd_col) * bins).cast("int") + 1, F.lit(bins))
    return scores.groupBy(*by, b.alias("pd_bin")).agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum("EAD").alias("exposure"))


def woe_iv(df: DataFrame, feature: str, label: str, bins: int = 10, eps: float = 0.5) -> DataFrame:
    """O-100: weight of evidence and information value per quantile bin of ``feature``.

    Edges are exact deciles (``percentile``) of the non-null feature; bin = 1 + number
    of interior edges below the value (right-closed, as O-47). WOE = ln(%good/%bad)
    with ``eps`` added to empty cells.
    """
    fr = [i / bins for i in range(bins + 1)]
    from riskspark.functions.quantiles import exact_quantiles

    edges = exact_quantiles(df, feature, fr, out="e").select(F.array_distinct(F.col("e")).alias("e"))
    d = df.where(F.col(feature).isNotNull() & F.col(label).isNotNull()).crossJoin(F.broadcast(edges))
    inner = F.slice(F.col("e"), 2, F.greatest(F.size("e") - 2, F.lit(0)))
    binc = (F.lit(1) + F.size(F.filter(inner, lambda x: x < F.col(feature).cast("double")))).alias("bin")
    g = d.groupBy(binc).agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("bad"),
                            F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("good"))
    w = Window.partitionBy()
    g = g.withColumn("pct_bad", (F.col("bad") + eps) / F.sum(F.col("bad") + eps).over(w)) \
         .withColumn("pct_good", (F.col("good") + eps) / F.sum(F.col("good") + eps).over(w))
    g = g.withColumn("woe", F.log(F.col("pct_good") / F.col("pct_bad"))) \
         .withColumn("iv_part", (F.col("pct_good") - F.col("pct_bad")) * F.col("woe"))
    return g.withColumn("iv", F.sum("iv_part").over(w))
