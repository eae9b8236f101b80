"""Whole runs: many deliveries give the same warehouse as one."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shelfline.operators import marts, tables
from shelfline.operators.quality import QualityError
from shelfline.plans import feeds, warehouse
from shelfline.plans.queries import _settings

DIR = "/root/testdata/sf0.001"
MODELS = ["stg_transactions", "stg_transaction_lines", "stg_payments", "stg_events", "stg_products",
          "dim_store", "dim_customer", "dim_product", "fct_sales_lines", "fct_payments", "fct_sessions"]
# Facts are not keyed again when a dimension version arrives after them, and a web order is looked
# up when its session is merged; both only hold for deliveries in time order.
LATER = {"_file", "_loaded_at", "product_sk", "customer_sk", "store_sk", "pos_order_found"}


def content(out):
    return {m: rows(out[m], *sorted(set(out[m].columns) - LATER)) for m in MODELS}


def settings(spark, checks=False):
    s = _settings(spark, DIR)
    s.checks, s.buckets = checks, 3
    return s


def files_below(spark, path):
    return {d: tables.list_names(spark, f"{path}/rows/_day={d}") for d in tables.stored_days(spark, path)}


@pytest.fixture(scope="module")
def whole(spark):
    from shelfline.session import run_dir
    base = run_dir(spark, "whole")
    feeds.write_landing(spark, DIR, f"{base}/in", "1")
    s = settings(spark, checks=True)
    out = warehouse.run_full(spark, f"{base}/in", f"{base}/wh", s)
    return base, content(out), s


def test_full_run_reports_the_planted_defects(whole):
    fired = dict(whole[2].warnings)
    assert fired["stg_transaction_lines.quantity positive"] > 0
    assert fired["fct_sales_lines.sku in dim_product"] > 0
    assert fired["fct_payments reconcile"] > 0
    assert fired["fct_sessions.pos_order_found true"] > 0


def test_scrambled_deliveries_equal_one(spark, whole, folder):
    """Changes arrive in any order, old ones after new ones."""
    for part in range(3):
        split = f"pmod(hash(_dms_commit_ts, 5), 3) = {part}"
        events = f"pmod(hash(event_id, event_ts), 3) = {part}"
        feeds.write_landing(spark, DIR, f"{folder}/in", str(part), split, events=events,
                            catalog_days=f"pmod(hash(_file), 3) = {part}")
        out = warehouse.run_incremental(spark, f"{folder}/in", f"{folder}/wh", settings(spark))
    got = content(out)
    for model in MODELS:
        assert got[model] == whole[1][model], model
    lines = out["fct_sales_lines"]
    for dim in ("product", "customer", "store"):  # no fact points at a version that is gone
        assert lines.join(out[f"dim_{dim}"], f"{dim}_sk", "left_anti").count() == 0
        keys = [r[0] for r in out[f"dim_{dim}"].select(f"{dim}_sk").collect()]
        assert len(keys) == len(set(keys))


def test_a_run_without_news_changes_nothing(spark, whole):
    base, before, _ = whole
    loaded = warehouse.load_raw(spark, f"{base}/in", f"{base}/wh")
    assert set(loaded.values()) == {0}
    stored = ("core/fct_sales_lines", "core/fct_payments", "core/fct_sessions", "core/dim_customer", "state/payments", "marts/mart_daily_sales")
    files = {t: files_below(spark, f"{base}/wh/{t}") for t in stored}
    first = rows(tables.read_table(spark, f"{base}/wh/core/fct_sales_lines"))
    out = warehouse.run_incremental(spark, f"{base}/in", f"{base}/wh", settings(spark))
    assert content(out) == before
    assert rows(out["fct_sales_lines"]) == first
    assert {t: files_below(spark, f"{base}/wh/{t}") for t in stored} == files   # not one partition was written again


def test_freshness_of_raw_tables(spark, whole):
    now = spark.range(1).select(F.current_timestamp()).first()[0]
    fresh = warehouse.freshness(spark, f"{whole[0]}/wh", now + dt.timedelta(hours=3))
    status = {r.table_name: r.status for r in fresh.collect()}
    assert len(status) == 7 and status["pos_stores"] == "warn" and status["catalog_products"] == "pass"


def test_an_out_of_date_source_stops_the_run(spark, whole):
    now = spark.range(1).select(F.current_timestamp()).first()[0]
    s = settings(spark, checks=True)
    s.now = now + dt.timedelta(hours=13)
    with pytest.raises(QualityError, match="out of date: .*pos_transactions"):
        warehouse.run_incremental(spark, f"{whole[0]}/in", f"{whole[0]}/wh", s)


def test_dimensions_are_never_rebuilt_alone():
    for dim in ("dim_store", "dim_customer", "dim_product"):
        with pytest.raises(ValueError, match="needs .*fct_sales_lines"):
            warehouse.assert_full_refresh_together({dim})
        warehouse.assert_full_refresh_together(warehouse.with_readers({dim}))
    warehouse.assert_full_refresh_together({"dim_date"})
    warehouse.assert_full_refresh_together({"mart_daily_sales"})
    warehouse.assert_full_refresh_together(warehouse.DIMS | warehouse.FACTS)
    assert warehouse.with_readers({"dim_store"}) == {"dim_store", "fct_sales_lines", "mart_daily_sales"}


def test_rows_of_given_days(spark):
    day = lambda n: dt.date(2025, 1, n)
    fact = spark.createDataFrame([(day(1), 1), (day(2), 2), (None, 3), (day(9), 4)], "at DATE, n INT")
    found = lambda days: rows(warehouse.of_days(fact, "at", days), "n")
    assert found([day(1), day(9)]) == [(1,), (4,)] and found([None]) == [(3,)] and found([None, day(2)]) == [(2,), (3,)] and found([]) == []


def test_marts_follow_the_days_that_change(spark, whole, folder):
    """A sale is added to a warehouse of years: one partition of the mart is written, and it equals a rebuild."""
    base, _, _ = whole
    wh = f"{folder}/wh"
    feeds.write_landing(spark, DIR, f"{folder}/in", "1", "_dms_commit_ts < '1998-01-01 00:00:00'")
    warehouse.run_full(spark, f"{folder}/in", wh, settings(spark))
    before = files_below(spark, f"{wh}/marts/mart_daily_sales")
    one = spark.createDataFrame([("T-new", 1, None, "store", dt.datetime(1995, 3, 4, 5), "completed", Decimal("7.00"), "USD",
                                  dt.datetime(1995, 3, 4, 5), "I", dt.datetime(1995, 3, 4, 5))],
                                "transaction_id STRING, store_id BIGINT, customer_id BIGINT, channel STRING, txn_ts TIMESTAMP_NTZ, status STRING, "
                                "total_amount DECIMAL(12,2), currency STRING, updated_at TIMESTAMP_NTZ, Op STRING, _dms_commit_ts TIMESTAMP_NTZ")
    one.coalesce(1).write.parquet(f"{folder}/in/pos/pos/transactions/2")
    line = spark.createDataFrame([("T-new", 1, "SKU-1", 7, Decimal("1.00"), Decimal("0.00"), None, "I", dt.datetime(1995, 3, 4, 5))],
                                 "transaction_id STRING, line_no INT, sku STRING, quantity INT, unit_price DECIMAL(10,2), "
                                 "discount_amount DECIMAL(10,2), promo_code STRING, Op STRING, _dms_commit_ts TIMESTAMP_NTZ")
    line.coalesce(1).write.parquet(f"{folder}/in/pos/pos/transaction_lines/2")
    out = warehouse.run_incremental(spark, f"{folder}/in", wh, settings(spark))
    after = files_below(spark, f"{wh}/marts/mart_daily_sales")
    assert [d for d in after if after[d] != before.get(d)] == [dt.date(1995, 1, 1)]
    rebuilt = marts.mart_daily_sales(out["fct_sales_lines"], out["dim_store"])
    assert rows(out["mart_daily_sales"]) == rows(rebuilt)
    assert out["mart_daily_sales"].where("txn_date = '1995-03-04' and store_id = 1 and channel = 'store'").count() == 1
    touched = files_below(spark, f"{wh}/core/fct_sales_lines")
    assert len(touched) > 3
