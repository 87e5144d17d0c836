"""Tolerant coercions and schema-only helpers (O-11, O-14..O-20, O-22).

Spark 4 runs with ANSI on: a bad cast or a division by zero raises. Everything here uses
the ``try_*`` forms so junk becomes NULL, matching the "errors -> missing" behaviour the
operators need. NaN and +-inf are normalised to NULL so aggregates skip them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values (must match the original system's vocabulary) -------------------------
# Status words that mark a defaulted loan (case-insensitive substring match).
DEFAULT_BAD_STATUS_WORDS = ["default", "charged off", "charge off", "write off", "written off", "bad debt"]
# Text spellings read as 1 by the binary label coercion.
TRUE_TOKENS = ["1", "true", "yes", "y", "t"]
# Column aliases, in priority order.
BINARY_LABEL_ALIASES = ["default_flag", "is_default", "defaulted", "loan_default", "bad_flag",
                        "target", "y", "label", "class", "Class"]
STATUS_LABEL_ALIASES = ["loan_status", "status", "loanstatus", "current_status", "final_status",
                        "state", "result", "outcome"]
BORROWER_ID_ALIASES = ["borrower_id", "member_id", "customer_id", "client_id", "uid", "applicant_id", "loan_id"]
LOAN_AMOUNT_ALIASES = ["loan_amount", "loan_amnt", "funded_amnt", "principal", "amount"]
INCOME_ALIASES = ["annual_income", "annual_inc", "income", "applicant_income"]
DELINQ_ALIASES = ["num_past_delinquencies", "delinq_2yrs", "total_late_payments", "late_payments",
                  "past_delinquencies"]
BALANCE_ALIASES = ["revol_bal", "current_credit_balance", "total_balance"]
LIMIT_ALIASES = ["total_rev_hi_lim", "total_credit_limit", "credit_limit"]
# Names of an expected-loss column, compared without case: whole names, parts of a name, a beginning.
EL_NAMES = ["el", "expected_loss"]
EL_PARTS = ["el_total", "total_el", "expectedloss", "expected_loss", "loss"]
EL_PREFIX = "el"
# Chargeback flag spellings (upper-cased, trimmed) read as 1 / 0.
CHARGEBACK_TRUE = ["1", "Y", "YES", "TRUE", "T"]
CHARGEBACK_FALSE = ["0", "N", "NO", "FALSE", "F"]
# --------------------------------------------------------------------------------------


def pick_col(df_or_cols, candidates: Sequence[str], required: bool = False,
             case_insensitive: bool = False) -> str | None:
    """O-11: the alias of highest priority that is present, an exact spelling before any other.
    Schema-only, runs no job."""
    cols = list(df_or_cols.columns if isinstance(df_or_cols, DataFrame) else df_or_cols)
    found = next((name for name in candidates if name in cols), None)
    if found is None and case_insensitive:
        folded = {c.casefold(): c for c in reversed(cols)}
        found = next((folded[name.casefold()] for name in candidates if name.casefold() in folded), None)
    if found is None and required:
        raise KeyError(f"none of the columns {', '.join(candidates)} is present")
    return found


def rename_aliases(df: DataFrame, mapping: dict[str, Sequence[str]], case_insensitive: bool = False) -> DataFrame:
    """O-11: rename the first present alias of each canonical name to that name."""
    renames = {}
    for canonical, aliases in mapping.items():
        found = pick_col(df, [canonical, *aliases], case_insensitive=case_insensitive)
        if found and found != canonical:
            renames[found] = canonical
    return df.withColumnsRenamed(renames) if renames else df


def finite(c: Column) -> Column:
    """NaN / +-inf -> NULL for a double column."""
    c = c.cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def to_double(c) -> Column:
    """O-17: numeric coercion, junk -> NULL (strings are trimmed first)."""
    c = F.col(c) if isinstance(c, str) else c
    return finite(F.trim(c.cast("string")).try_cast("double"))


def numeric(df: DataFrame, name: str) -> Column:
    """O-17 for a named column: numeric types cast straight to double, text coerced."""
    from pyspark.sql.types import NumericType
    if isinstance(df.schema[name].dataType, NumericType):
        return finite(F.col(name).cast("double"))
    return to_double(name)


def to_ts(c, fmt: str | None = None) -> Column:
    """O-17: timestamp coercion, junk -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    if fmt:
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt))
    return F.try_to_timestamp(c.cast("string"))


def coerce_percent(c) -> Column:
    """O-14: '12.5%' -> 12.5, junk -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return finite(F.replace(F.trim(c.cast("string")), F.lit("%"), F.lit("")).try_cast("double"))


def locale_number(c) -> Column:
    """O-20: '1,234 ' -> 1234.0 (thousands separators and blanks removed), junk -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return finite(F.regexp_replace(F.trim(c.cast("string")), r"[,\s]", "").try_cast("double"))


def safe_ratio(num, den) -> Column:
    """O-16: num / den with zero or non-finite results -> NULL."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return finite(F.try_divide(num.cast("double"), den.cast("double")))


def bool01(c) -> Column:
    """Binary label coercion: numeric -> (x != 0); text -> token in TRUE_TOKENS."""
    c = F.col(c) if isinstance(c, str) else c
    txt = F.lower(F.trim(c.cast("string")))
    num = txt.try_cast("double")
    return F.when(num.isNotNull(), (num != 0).cast("int")).otherwise(txt.isin(TRUE_TOKENS).cast("int"))


def chargeback_flag(c) -> Column:
    """O-15: 1/0, Y/N, TRUE/FALSE -> 1/0; anything else -> 0."""
    c = F.col(c) if isinstance(c, str) else c
    u = F.upper(F.trim(c.cast("string")))
    num = u.try_cast("double")
    return (F.when(u.isin(CHARGEBACK_TRUE), 1)
            .when(u.isin(CHARGEBACK_FALSE), 0)
            .when(num.isNotNull() & (num != 0), 1)
            .otherwise(0)).cast("int")


def status_default_flag(c, bad_words: Iterable[str] | None = None) -> Column:
    """O-12: 1 if the status holds any bad word (any case, as a part of the text); NULL is 0.
    One regular expression over the escaped words, so the text is scanned once."""
    c = F.col(c) if isinstance(c, str) else c
    words = [re.escape(str(w).strip().lower()) for w in (bad_words or DEFAULT_BAD_STATUS_WORDS) if str(w).strip()]
    if not words:
        return F.lit(0)
    return F.coalesce(F.rlike(F.lower(c.cast("string")), F.lit("|".join(words))), F.lit(False)).cast("int")


def logistic(z: Column, clip: float | None = None) -> Column:
    """O-22: 1 / (1 + e^-z), z optionally clipped to +-clip first."""
    if clip is not None:
        z = F.least(F.greatest(z, F.lit(-clip)), F.lit(clip))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def flatten_struct(df: DataFrame, sep: str = ".", arrays_as_json: bool = True) -> DataFrame:
    """O-10: nested struct columns -> flat dotted columns; arrays -> JSON text.

    Schema-driven ``select``; the job itself is a projection.
    """
    from pyspark.sql.types import ArrayType, MapType, StructType

    cols: list[Column] = []

    def walk(path: list[str], dtype) -> None:
        ref = F.col(".".join(f"`{p}`" for p in path))
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                walk(path + [f.name], f.dataType)
        elif arrays_as_json and isinstance(dtype, (ArrayType, MapType)):
            cols.append(F.to_json(ref).alias(sep.join(path)))
        else:
            cols.append(ref.alias(sep.join(path)))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    return df.select(*cols)


def pick_col_fuzzy(df_or_cols, target: str) -> str | None:
    """O-20: tolerant column choice: the name itself, then in any case, then as part of a name."""
    cols = list(df_or_cols.columns if isinstance(df_or_cols, DataFrame) else df_or_cols)
    t = target.casefold()
    how = [(c != target, c.casefold() != t, k) for k, c in enumerate(cols) if t in c.casefold()]
    return cols[min(how)[-1]] if how else None


def pick_el_column(df_or_cols) -> str | None:
    """O-20: the expected-loss column of a roll-up: by whole name, else by part of the name,
    else by its beginning; earlier patterns, then earlier columns, win. None if none fits."""
    cols = list(df_or_cols.columns if isinstance(df_or_cols, DataFrame) else df_or_cols)
    patterns = [re.compile(re.escape(n) + r"\Z") for n in EL_NAMES] + [re.compile(".*" + re.escape(n), re.S) for n in EL_PARTS] \
        + [re.compile(re.escape(EL_PREFIX))]
    found = [(k, i) for k, p in enumerate(patterns) for i, c in enumerate(cols) if p.match(c.lower())]
    return cols[min(found)[1]] if found else None


def el_total(df: DataFrame, out: str = "el_total") -> DataFrame:
    """O-20: one row with the sum of the frame's expected-loss column read as locale numbers (NULL without one)."""
    c = pick_el_column(df)
    return df.agg((F.sum(locale_number(F.col(f"`{c}`"))) if c else F.first(F.lit(None).cast("double"))).alias(out))


def days_between(ts, created, default: int = 9999) -> Column:
    """O-18: whole days from ``created`` to ``ts`` (floor of the time difference, like a
    timedelta's ``days``); missing ``created`` -> default."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    created = F.col(created) if isinstance(created, str) else created
    d = F.floor((F.unix_micros(ts.cast("timestamp")) - F.unix_micros(created.cast("timestamp"))) / F.lit(86_400_000_000))
    return F.coalesce(d.cast("int"), F.lit(default))


# ---- fixed values: request-schema defaults and ranges of the scoring API -----------------
REQUEST_DEFAULTS = {"country": "US", "device_id": "unknown", "hour_of_day": 12}
GATEWAY_DEFAULT_ACCOUNT_AGE_DAYS = 365
# ------------------------------------------------------------------------------------------


def validate_requests(df: DataFrame, amount: str = "amount", age: str = "account_age_days",
                      country: str = "country", device: str = "device_id", hour: str = "hour_of_day") -> DataFrame:
    """O-19: fill request defaults (country US upper-cased, device 'unknown', hour 12,
    account age 365), then range checks -> ``errors`` array; ``valid`` = no errors.
    Split with ``where('valid')`` / ``where('not valid')`` (quarantine)."""
    d = df.withColumns({
        country: F.upper(F.coalesce(F.col(country).cast("string"), F.lit(REQUEST_DEFAULTS["country"]))),
        device: F.coalesce(F.col(device).cast("string"), F.lit(REQUEST_DEFAULTS["device_id"])),
        hour: F.coalesce(F.col(hour).cast("int"), F.lit(REQUEST_DEFAULTS["hour_of_day"])),
        age: F.coalesce(F.col(age).cast("int"), F.lit(GATEWAY_DEFAULT_ACCOUNT_AGE_DAYS)),
    })
    errs = F.array(
        F.when(F.col(amount).isNull() | (F.col(amount) < 0), F.lit("amount")),
        F.when(F.col(age) < 0, F.lit("account_age_days")),
        F.when(F.length(F.col(country)) != 2, F.lit("country")),
        F.when((F.col(hour) < 0) | (F.col(hour) > 23), F.lit("hour_of_day")))
    d = d.withColumn("errors", F.filter(errs, lambda x: x.isNotNull()))
    return d.withColumn("valid", F.size("errors") == 0)


def align_features(df: DataFrame, features: list[str], fill: str = "zero", keep: list[str] | None = None) -> DataFrame:
    """O-21: the model's feature columns in order; absent columns -> 0.0; non-finite ->
    NULL; NULL -> 0 (``fill='zero'``) or the column median (``fill='median'``: one
    aggregate, its single row cross-joined back)."""
    keep = keep or []
    cols = [finite(F.col(f).cast("double")).alias(f) if f in df.columns else F.lit(0.0).alias(f) for f in features]
    d = df.select(*keep, *cols)
    if fill == "median":
        from riskspark.functions.quantiles import exact_quantiles

        # all medians in one distributed quantile plan over the unpivoted features
        long = d.select(F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v"))
                                            for f in features])).alias("_p")).select("_p.f", "_p.v")
        q = exact_quantiles(long, "v", [0.5], by=["f"], out="_q")
        meds = q.agg(F.map_from_entries(F.collect_list(F.struct("f", F.col("_q")[0]))).alias("_meds"))
        d = d.crossJoin(F.broadcast(meds))  # one row: a map with one entry per feature
        return d.select(*keep, *[F.coalesce(F.col(f), F.col("_meds")[f], F.lit(0.0)).alias(f) for f in features])
    return d.fillna(0.0, subset=features)
