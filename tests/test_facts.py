import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import rows
from shelfline.operators import facts, marts
from shelfline.operators.calendar import date_key_join, dim_date

T0 = dt.datetime(2025, 3, 1, 10)
LINE = "transaction_id STRING, line_no INT, sku STRING, quantity INT, unit_price DECIMAL(10,2), " \
       "discount_amount DECIMAL(10,2), promo_code STRING, cdc_operation STRING, _dms_commit_ts TIMESTAMP_NTZ, " \
       "_file STRING, _loaded_at TIMESTAMP"
HEADER = "transaction_id STRING, store_id BIGINT, customer_id BIGINT, channel STRING, txn_ts TIMESTAMP_NTZ, " \
         "status STRING, total_amount DECIMAL(12,2), currency STRING, updated_at TIMESTAMP_NTZ, " \
         "cdc_operation STRING, _dms_commit_ts TIMESTAMP_NTZ, _file STRING, _loaded_at TIMESTAMP"
EVENT = "session_id STRING, event_id STRING, event_type STRING, event_ts TIMESTAMP_NTZ, anonymous_id STRING, " \
        "customer_id BIGINT, order_id STRING, device STRING, utm_source STRING, utm_medium STRING, " \
        "utm_campaign STRING, _loaded_at TIMESTAMP"


def line(t, n, qty=2, price="5.00", off="1.00", op="INSERT", loaded=T0):
    return (t, n, "S1", qty, Decimal(price), Decimal(off), None, op, T0, "f", loaded)


def header(t, status="completed", store=1, op="INSERT", loaded=T0, channel="store"):
    if op == "DELETE":
        return (t, None, None, None, None, None, None, None, None, op, T0, "f", loaded)
    return (t, store, 7, channel, T0, status, Decimal("9.00"), "USD", T0, op, T0, "f", loaded)


def frames(spark, lines, headers):
    return spark.createDataFrame(lines, LINE), spark.createDataFrame(headers, HEADER)


def test_lines_without_header_and_deletes(spark):
    later = T0 + dt.timedelta(hours=2)
    lines, headers = frames(
        spark, [line("a", 1), line("b", 1), line("c", 1), line("d", 1, op="DELETE")],
        [header("a", loaded=later), header("c", op="DELETE"), header("d")])
    got = {r.transaction_id: r for r in facts.sales_lines_join(lines, headers).collect()}
    assert (got["a"].gross_amount, got["a"].net_amount, got["a"].is_deleted) == (Decimal("10.00"), Decimal("9.00"), False)
    assert got["a"]._loaded_at == later                      # the header's load counts
    assert (got["b"].txn_ts, got["b"].is_deleted) == (None, False)   # kept, not deleted
    assert (got["c"].is_deleted, got["d"].is_deleted) == (True, True)


def test_a_changed_header_brings_back_all_its_lines(spark):
    later = T0 + dt.timedelta(hours=5)
    lines, headers = frames(spark, [line("a", 1), line("a", 2), line("b", 1)],
                            [header("a", "voided", loaded=later), header("b")])
    since = T0 + dt.timedelta(hours=1)
    assert rows(facts.changed_transactions(headers, lines, since)) == [("a",)]
    dims = {
        "date": dim_date(spark, dt.date(2025, 1, 1), dt.date(2026, 1, 1)),
        "product": spark.createDataFrame([(1, "S1", dt.date(1900, 1, 1), None)],
                                         "product_sk BIGINT, sku STRING, valid_from DATE, valid_to DATE"),
    }
    for d, key in (("customer", "customer_id"), ("store", "store_id")):
        dims[d] = spark.createDataFrame([(5, 1, dt.datetime(1900, 1, 1), None)],
                                        f"{d}_sk BIGINT, {key} BIGINT, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ")
    got = facts.fct_sales_lines(headers, lines, dims, since)
    assert rows(got, "transaction_id", "line_no", "status", "txn_date_sk", "product_sk", "customer_sk", "store_sk") == [
        ("a", 1, "voided", 20250301, 1, -1, 5), ("a", 2, "voided", 20250301, 1, -1, 5)]


def test_payments(spark):
    pays = spark.createDataFrame([
        ("p1", "a", "card", Decimal("9.00"), T0, "INSERT", T0, "f", T0),
        ("p2", "a", "card", Decimal("-9.00"), T0, "INSERT", T0, "f", T0),
        ("p3", None, None, None, None, "DELETE", T0, "f", T0 + dt.timedelta(hours=9)),
        ("p4", "z", "cash", Decimal("1.00"), T0, "INSERT", T0, "f", T0),
    ], "payment_id STRING, transaction_id STRING, method STRING, amount DECIMAL(12,2), created_at TIMESTAMP_NTZ, "
       "cdc_operation STRING, _dms_commit_ts TIMESTAMP_NTZ, _file STRING, _loaded_at TIMESTAMP")
    _, headers = frames(spark, [line("a", 1)], [header("a", "voided", loaded=T0 + dt.timedelta(hours=5))])
    got = facts.fct_payments(pays, headers)
    assert rows(got, "payment_id", "is_refund", "transaction_total", "is_deleted") == [
        ("p1", False, Decimal("9.00"), False), ("p2", True, Decimal("9.00"), False),
        ("p3", None, None, True), ("p4", False, None, False)]
    late = facts.fct_payments(pays, headers, T0 + dt.timedelta(hours=1))
    assert rows(late, "payment_id") == [("p1",), ("p2",), ("p3",)]


def event(s, e, kind, at, device="web", utm=None, order=None, customer=None):
    return (s, e, kind, at, "anon", customer, order, device, utm, utm, utm, T0)


def test_session_takes_its_first_event_nulls_included(spark):
    second = dt.timedelta(seconds=1)
    events = spark.createDataFrame([
        event("s", "e2", "page_view", T0, "ios", None),                        # same time, lower id wins
        event("s", "e3", "product_view", T0, "web", "mail"),
        event("s", "e4", "purchase", T0 + 10 * second, order="T1", customer=4),
        event("s", "e5", "purchase", T0 + 20 * second, order="T9"),
        event("u", "e6", "page_view", None),
    ], EVENT)
    got = {r.session_id: r for r in facts.session_rollup(events).collect()}
    s = got["s"]
    assert (s.device, s.utm_source, s.events, s.duration_seconds) == ("ios", None, 4, 20)
    assert (s.order_id, s.customer_id) == ("T9", 4)                            # largest order id
    assert (s.viewed_product, s.added_to_cart, s.purchased) == (True, False, True)
    assert got["u"].session_start is None and got["u"].device is None


def test_duration_counts_second_boundaries_across_days(spark):
    one = dt.datetime(2025, 1, 1, 23, 59, 59, 900_000)
    two = dt.datetime(2025, 1, 2, 0, 0, 0, 100_000)
    events = spark.createDataFrame([event("s", "a", "page_view", one), event("s", "b", "page_view", two)], EVENT)
    assert facts.session_rollup(events).first().duration_seconds == 1


def test_only_live_online_sales_confirm_a_web_order(spark):
    events = spark.createDataFrame([event(s, s, "purchase", T0, order=o) for s, o in
                                    (("s1", "on"), ("s2", "shop"), ("s3", "gone"), ("s4", None), ("s5", "none"))], EVENT)
    _, headers = frames(spark, [line("a", 1)], [header("on", channel="online"), header("shop"), header("gone", op="DELETE")])
    got = facts.fct_sessions(events, headers)
    assert rows(got, "session_id", "pos_order_found") == [
        ("s1", True), ("s2", False), ("s3", False), ("s4", True), ("s5", False)]
    listed = marts.unmatched_web_orders(facts.session_rollup(events), headers, T0 + dt.timedelta(hours=2))
    assert rows(listed, "session_id") == [("s2",), ("s3",), ("s5",)]
    assert marts.unmatched_web_orders(facts.session_rollup(events), headers, T0).count() == 0


def test_daily_sales_counts_each_sale_once(spark):
    lines, headers = frames(
        spark,
        [line("a", 1), line("a", 2), line("b", 1), line("c", 1), line("d", 1), line("x", 1, op="DELETE"), line("o", 1)],
        [header("a"), header("b", "voided"), header("c", "returned"), header("d", store=99), header("x")])
    stores = spark.createDataFrame([(1, "old", "north", False), (1, "new", "south", True)],
                                   "store_id BIGINT, store_name STRING, region STRING, is_current BOOLEAN")
    mart = marts.mart_daily_sales(facts.sales_lines_join(lines, headers), stores)
    got = {(r.store_id, r.channel): r for r in mart.collect()}
    one = got[(1, "store")]
    assert (one.store_name, one.completed_orders, one.units_sold, one.net_revenue, one.discounts) == (
        "new", 1, 4, Decimal("18.00"), Decimal("2.00"))
    assert (one.voided_orders, one.returned_orders, one.returned_amount) == (1, 1, Decimal("9.00"))
    assert got[(99, "store")].store_name is None and got[(99, "store")].completed_orders == 1
    assert got[(None, None)].completed_orders == 0           # a line without header
    assert "Expand" not in mart._jdf.queryExecution().executedPlan().toString()


def test_funnel_rate_is_zero_safe_and_exact(spark):
    sessions = spark.createDataFrame(
        [(T0, True, True, False, i == 0) for i in range(3)],
        "session_start TIMESTAMP_NTZ, viewed_product BOOLEAN, added_to_cart BOOLEAN, started_checkout BOOLEAN, purchased BOOLEAN")
    assert rows(marts.mart_web_funnel(sessions)) == [(T0.date(), 3, 3, 3, 0, 1, Decimal("0.333333"))]


def test_calendar(spark):
    days = dim_date(spark, dt.date(2026, 12, 31), dt.date(2027, 1, 3))
    assert rows(days, "date_sk", "month_name", "week_of_year", "day_of_week", "day_name", "is_weekend") == [
        (20261231, "Dec", 53, 4, "Thu", False), (20270101, "Jan", 53, 5, "Fri", False), (20270102, "Jan", 53, 6, "Sat", True)]
    fact = spark.createDataFrame([(dt.date(2027, 1, 1),), (dt.date(2020, 1, 1),), (None,)], "d DATE")
    assert sorted(r[1] or 0 for r in date_key_join(fact, days, "d", "sk").collect()) == [0, 0, 20270101]
    assert days.withColumn("x", F.lit(1)).count() == 3
