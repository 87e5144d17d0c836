"""Rule conditions: precedence, failing parts, what cannot be read."""

import pytest

from riskspark.functions.conditions import condition

ROWS = [(1, 6000.0, "7", 0, "2024-01-01", True), (2, 100.0, "US", 2, "x", False), (3, None, None, None, None, None)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id int, amount double, code string, days int, day string, ok boolean")


def hits(df, text):
    c = condition(df, text)
    return None if c is None else [r.id for r in df.where(c).orderBy("id").collect()]


@pytest.mark.parametrize("text, want", [
    ("amount > 50 and days < 1 or code = 'US'", [1, 2]), ("amount > 50 and (days < 1 or code = 'US')", [1, 2]), ("not amount > 500", [2]),
    ("amount > 50 & ~(days == 0)", [2]), ("1 < amount < 500", [2]), ("2 + 3 * 2 = 8 and id = 1", [1]), ("-days + 2 = 0", [2]), ("10 - 4 - 3 = 3 and id = 2", [2]),
    ("code in ('US', 'GB')", [2]), ("code not in ('US', 'GB')", [1]), ("id in [1, 3]", [1, 3]), ("code like 'U%'", [2]), ("code is null", [3]),
    ("code is not null", [1, 2]), ("ok", [1]), ("ok is not true", [2, 3]), ("ok = 1", [1]), ("ok == true", [1]), ("amount not between 50 and 500", [1]), ("code || days = 'US2'", [2]),
    ("amount / days > 5", [2]), ("100 % days = 0", [2]), ("100 div days = 50", [2]), ("5 < code", [1]), ("code between 1 and 9", [1]), ("code in (1, 2, 7)", [1]),
    ("code + 1 > 3", [1]), ("int(code) = 7", [1]), ("cast(code as int) = 7", [1]), ("element_at(array(1, 2), days) = 2", [2]),
    ("days * 2000000000 > 5", []), ("(days + 1) * 2000000000 > 5", [1]), ("to_date(day) is null", [3]), ("to_date(day) = date '2024-01-01'", [1]), ("day < date '2025-01-01'", [1]),
    ("amount > 50 or amount / days > 1", [1, 2]), ("amount / days > 1 or amount > 50", [2]), ("days > 0 and amount / days is null", []),
    ("case when days = 0 then true else amount / days > 1000 end", [1]), ("if(days = 0, id, id / days) = 1", [1, 2]), ("abs(code) = 7", [1]), ("year(day) = 2024", [1]),
    ("coalesce(amount, 0) = 0", [3]), ("length(code) = 2", [2]), ("code = 'it''s'", []), ('code = "US"', [2]), ("`amount` >= 1e2", [1, 2]), ("AMOUNT > 5000", [1]),
    ("code", []), ("days", [2])])
def test_conditions(df, text, want):
    assert hits(df, text) == want


@pytest.mark.parametrize("text", ["", "amount >", "amount > and", "missing > 1", "nosuchfn(amount) > 1", "(amount > 1", "amount > 1)", "amount > 1 extra", "to_date(day)",
                                  "code in 5", "amount ; 1", "case end", "cast(code as nothing) = 1", "between 1 and 2"])
def test_what_cannot_be_read(df, text):
    assert condition(df, text) is None


def test_structured_rules_do_not_fail_on_a_row(df):
    from riskspark.operators import rules as RU

    rules = {"rules": [{"id": "R1", "when": {"any": ["tx.code > 5", "tx.nothing == 1"]}}, {"id": "R2", "when": {"all": ["tx.amount >= params.least"]}, "params": {"least": 50}},
                       {"id": "R3", "when": {"all": ["tx.code in params.codes"]}, "params": {"codes": [7, 8]}}]}
    got = {r.id: r.rules_hit for r in RU.evaluate_structured(df, rules).collect()}
    assert got == {1: ["R1", "R2", "R3"], 2: ["R2"], 3: []}
