import datetime as dt
from decimal import Decimal

import pytest

from helpers import rows
from shelfline.operators import quality, refunds

T0 = dt.datetime(2025, 3, 1, 10)


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a", 5), (1, "b", 0), (2, None, None), (None, "z", 3), (None, "z", 3)],
                                 "k INT, v STRING, n INT")


def test_row_checks(spark, df):
    assert rows(quality.check_unique(df, "k")) == [(1, 2)]                      # nulls do not count
    assert rows(quality.check_unique_combination(df, ["k", "v"])) == [(None, "z", 2)]
    assert rows(quality.check_not_null(df, "k"), "v") == [("z",), ("z",)]
    assert rows(quality.check_not_null(df, "v", "k = 1")) == []
    assert rows(quality.check_accepted_values(df, "v", ["a", "b"])) == [("z", 2)]   # null passes
    assert rows(quality.check_expression(df, "n > 0"), "k", "n") == [(1, 0), (2, None)]
    parent = spark.createDataFrame([("a",), ("a",), ("z",)], "p STRING")
    assert rows(quality.check_relationships(df, "v", parent, "p"), "v") == [("b",)]
    assert rows(quality.check_relationships(df, "v", parent, "p", "n > 0"), "v") == []


def test_suite_counts_every_check_and_gates_on_errors(spark, df):
    checks = [
        quality.unique("k unique", df, "k", "warn"), quality.not_null("k set", df, "k", "warn"),
        quality.accepted("v known", df, "v", ["a", "b", "z"]), quality.expression("n positive", df, "n > 0", "warn", "n is not null"),
        quality.relationships("v in self", df, "v", df, "v"),
    ]
    result = quality.run_suite(checks)
    assert rows(result) == [("k set", "warn", 2), ("k unique", "warn", 1), ("n positive", "warn", 1),
                            ("v in self", "error", 0), ("v known", "error", 0)]
    assert sorted(r["check"] for r in quality.gate(result)) == ["k set", "k unique", "n positive"]
    with pytest.raises(quality.QualityError, match="k must be set: 2"):
        quality.gate(quality.run_suite([quality.not_null("k must be set", df, "k")]))


def test_row_checks_counted_in_the_write(spark, df, folder):
    checks = [quality.not_null("k set", df, "k", "warn"), quality.expression("n positive", df, "n > 0", "warn", "n is not null"),
              quality.unique("k unique", df, "k")]
    observed = quality.Observed(checks)
    observed.watch(df).write.parquet(folder)
    assert observed.result() == [("k set", "warn", 2), ("n positive", "warn", 1)]
    assert [r["check"] for r in quality.gate(None, observed.result())] == ["k set", "n positive"]
    with pytest.raises(quality.QualityError, match="k set: 2"):
        quality.gate(None, [("k set", "error", 2)])


def test_foreign_keys_take_one_pass(spark, df):
    """Nulls pass, hidden rows are not counted, a value counts as often as it occurs."""
    parents = spark.createDataFrame([("a", 1)], "p STRING, q INT")
    result = quality.run_suite([quality.relationships("v", df, "v", parents, "p"), quality.relationships("k", df, "k", parents, "q"),
                                quality.relationships("v where", df, "v", parents, "p", where="n > 3")])
    assert {r["check"]: r.failures for r in result.collect()} == {"k": 1, "v": 3, "v where": 0}
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(array(struct(of") == 1


def test_freshness(spark):
    hours = lambda h: dt.timedelta(hours=h)
    loads = spark.createDataFrame([(T0,), (T0 - hours(9),)], "_loaded_at TIMESTAMP")
    status = lambda d, now: quality.check_freshness(d, "t", now, hours(2), hours(12)).first()
    assert tuple(status(loads, T0 + hours(1))) == ("t", 3600, "pass")
    assert status(loads, T0 + hours(2)).status == "pass"
    assert status(loads, T0 + hours(3)).status == "warn"
    assert status(loads, T0 + hours(13)).status == "error"
    assert status(loads.where("false"), T0).status == "error"


PAY = "payment_id STRING, transaction_id STRING, method STRING, amount DECIMAL(12,2), created_at TIMESTAMP_NTZ"


def test_reconciliation_finds_planted_gaps(spark):
    data = [  # transaction, status, total, amount, deleted
        ("ok", "completed", "10.00", "4.00", False), ("ok", "completed", "10.00", "6.00", False),
        ("off", "completed", "10.00", "10.01", False), ("void", "voided", "5.00", "5.00", False),
        ("void", "voided", "5.00", "-5.00", False), ("norefund", "returned", "5.00", "5.00", False),
        ("gone", "completed", "5.00", "1.00", True),
    ]
    df = spark.createDataFrame([(t, s, Decimal(a), Decimal(b), d) for t, s, a, b, d in data],
                               "transaction_id STRING, status STRING, transaction_total DECIMAL(12,2), "
                               "amount DECIMAL(12,2), is_deleted BOOLEAN")
    assert rows(quality.check_payment_reconciliation(df), "transaction_id") == [("norefund",), ("off",)]


def test_refunds_are_complete_and_idempotent(spark):
    pays = spark.createDataFrame([
        ("p1", "v", "card", Decimal("4.00"), T0), ("p2", "v", "cash", Decimal("6.00"), T0),
        ("p3", "done", "card", Decimal("1.00"), T0), ("r3", "done", "card", Decimal("-1.00"), T0),
        ("p4", "sale", "card", Decimal("1.00"), T0),
    ], PAY)
    sales = spark.createDataFrame([("v", "voided", T0 + dt.timedelta(1)), ("done", "returned", T0), ("sale", "completed", T0)],
                                  "transaction_id STRING, status STRING, updated_at TIMESTAMP_NTZ")
    added = refunds.backfill_refunds(pays, sales)
    assert rows(added, "transaction_id", "method", "amount", "created_at") == [
        ("v", "card", Decimal("-4.00"), T0 + dt.timedelta(1)), ("v", "cash", Decimal("-6.00"), T0 + dt.timedelta(1))]
    assert refunds.backfill_refunds(pays.unionByName(added), sales).count() == 0
    assert rows(added, "payment_id") == rows(refunds.backfill_refunds(pays, sales), "payment_id")


def test_sale_total_is_exact(spark):
    lines = spark.createDataFrame([("a", 3, Decimal("0.335").quantize(Decimal("0.01")), Decimal("0.01"))] * 2,
                                  "transaction_id STRING, quantity INT, unit_price DECIMAL(10,2), discount_amount DECIMAL(10,2)")
    expected = 2 * (3 * Decimal("0.335").quantize(Decimal("0.01")) - Decimal("0.01"))
    assert rows(refunds.sale_total(lines)) == [("a", expected)]
