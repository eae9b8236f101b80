"""What a run may cost: how often something is computed, and over which rows."""

import gzip
import os
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shelfline.operators import facts, quality, tables
from shelfline.operators.pit import pit_join
from shelfline.plans import feeds, warehouse
from shelfline.session import SHUFFLE_CLEANUP, shuffles_dropped
from shelfline.sources import landing

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_a_merge_changed_is_taken_once(spark, folder):
    """checks and marts ask for the changed rows again; that must not join and compare the tables again."""
    one = spark.range(100).selectExpr("id AS k", "id % 7 AS v")
    tables.merge_rows(spark, folder, one, ["k"])
    merged = tables.merge_rows(spark, folder, one.withColumn("v", F.when(F.col("k") < 3, -1).otherwise(F.col("v"))), ["k"])
    assert "Join" not in plan(merged.changed) and "Exchange" not in plan(merged.changed)
    assert rows(merged.changed) == sorted([(k, -1) for k in range(3)] + [(k, k % 7) for k in range(3)], key=repr)


def test_difference_is_of_sets_and_null_equals_null(spark):
    new = spark.createDataFrame([(1, None), (1, None), (2, "b"), (3, "c")], "k INT, v STRING")
    old = spark.createDataFrame([(1, None), (2, "B"), (2, "B"), (4, None)], "k INT, v STRING")
    found = tables._difference(new, old)
    assert rows(found) == [(2, "B", False), (2, "b", True), (3, "c", True), (4, None, False)]
    assert plan(found).count("Join") == 0


def test_null_keys_still_match_in_a_merge(spark, folder):
    """Keys are compared plainly only where the source has no null among them."""
    tables.merge_rows(spark, folder, spark.createDataFrame([(1, "a"), (None, "n")], "k INT, v STRING"), ["k"])
    got = tables.merge_rows(spark, folder, spark.createDataFrame([(None, "N"), (2, "b")], "k INT, v STRING"), ["k"])
    assert rows(got.table) == [(1, "a"), (2, "b"), (None, "N")]
    got = tables.merge_rows(spark, folder, spark.createDataFrame([(1, "A")], "k INT, v STRING"), ["k"])
    assert rows(got.table) == [(1, "A"), (2, "b"), (None, "N")]


def test_marks_come_with_the_write(spark, folder):
    rows_ = spark.range(5).select("id", (F.lit(1_700_000_000) + F.col("id")).cast("timestamp").alias("_loaded_at"))
    tables.overwrite_table(spark, folder, rows_, number="id")
    top = rows_.agg(F.max("_loaded_at")).first()[0]
    assert tables.marks(spark, folder) == (top, 4)
    tables.merge_rows(spark, folder, rows_.where("id < 0"), ["id"])
    assert tables.marks(spark, folder) == (top, 4)


def test_hot_keys_of_a_short_table_need_no_sketch(spark, folder, monkeypatch):
    """a table with fewer rows than a hot key has none; the rows that a run picks are not joined for it."""
    tables.overwrite_table(spark, folder, spark.range(50).selectExpr("cast(id % 2 AS string) AS k"))
    table = tables.read_table(spark, folder)
    assert rows(warehouse.stored_hot_keys(table, "k", 20)) == [("0",), ("1",)]
    monkeypatch.setattr(warehouse, "hot_keys", lambda *a: pytest.fail("a sketch was made"))
    assert warehouse.stored_hot_keys(table, "k", 51) is None


@pytest.mark.parametrize("table", ["transactions", "payments"])
def test_sale_totals_are_restated_once(spark, folder, table):
    """F1 to F4: feeds over written totals have the same rows, and do not read the lines again."""
    held = feeds.sale_totals(spark, SF, f"{folder}/totals")
    before = tables.list_names(spark, held)
    assert feeds.sale_totals(spark, SF, f"{folder}/totals") == held and tables.list_names(spark, held) == before
    with_totals, plainly = feeds.cdc(spark, SF, table, held), feeds.cdc(spark, SF, table)
    assert not any("lineitem" in f for f in with_totals.inputFiles()) and any("lineitem" in f for f in plainly.inputFiles())
    assert with_totals.exceptAll(plainly).isEmpty() and plainly.exceptAll(with_totals).isEmpty()


def test_a_parent_is_not_broadcast_by_a_guess(spark):
    """twelve million catalog rows, made of a file of a few MB, were guessed to be small and sent through the driver."""
    child = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "sku STRING, n INT")
    parent = spark.createDataFrame([("a",)], "sku STRING")
    found = quality.check_relationships(child, "sku", parent, "sku")
    assert rows(found) == [("b", 2)]
    assert "Broadcast" not in plan(found)
    counted = quality.run_suite([quality.relationships("r", child, "sku", parent, "sku")])
    assert rows(counted) == [("r", "error", 1)]
    assert "BroadcastHashJoin" not in plan(counted)


def _sales(spark):
    headers = spark.createDataFrame(
        [("T1", "2024-01-01 10:00:00", 1, 7, "INSERT"), ("T2", "2024-01-02 10:00:00", None, None, "INSERT")],
        "transaction_id STRING, at STRING, store_id BIGINT, customer_id BIGINT, cdc_operation STRING")
    headers = headers.selectExpr("transaction_id", "cast(at AS timestamp_ntz) AS txn_ts", "store_id", "customer_id", "'store' AS channel",
                                 "'completed' AS status", "cdc_operation", "timestamp '2024-01-03 00:00:00' AS _loaded_at")
    lines = spark.createDataFrame([("T1", 1, "a"), ("T1", 2, "x"), ("T2", 1, "a"), ("T3", 1, "a"), (None, 1, "a")],
                                  "transaction_id STRING, line_no INT, sku STRING")
    lines = lines.selectExpr("*", "1 AS quantity", "cast(2 AS decimal(10,2)) AS unit_price", "cast(0 AS decimal(10,2)) AS discount_amount",
                             "cast(NULL AS string) AS promo_code", "'INSERT' AS cdc_operation", "timestamp '2024-01-03 00:00:00' AS _loaded_at")
    since = "cast('1900-01-01' AS timestamp_ntz) AS valid_from, cast(NULL AS timestamp_ntz) AS valid_to"
    dims = {"date": spark.sql("SELECT date '2024-01-01' AS date_day, 20240101 AS date_sk"),
            "store": spark.sql(f"SELECT cast(1 AS bigint) AS store_id, cast(11 AS bigint) AS store_sk, {since}"),
            "customer": spark.sql(f"SELECT cast(7 AS bigint) AS customer_id, cast(77 AS bigint) AS customer_sk, {since}"),
            "product": spark.sql("SELECT 'a' AS sku, cast(5 AS bigint) AS product_sk, date '1900-01-01' AS valid_from, cast(NULL AS date) AS valid_to")}
    return headers, lines, dims


@pytest.mark.parametrize("large", [False, True])
def test_customer_and_store_are_looked_up_once_a_sale(spark, monkeypatch, large):
    """they were looked up for every line, which shuffled all lines once more for each large dimension."""
    headers, lines, dims = _sales(spark)
    over, real = {}, facts.pit_join

    def seen(fact, dim, on, at, sk, **how):
        over[sk] = set(fact.columns)
        return real(fact, dim, on, at, sk, **how | ({"broadcast_rows": 0} if large else {}))

    monkeypatch.setattr(facts, "pit_join", seen)
    if large:
        monkeypatch.setattr(facts, "fits_broadcast", lambda df: False)
    found = facts.fct_sales_lines(headers, lines, dims)
    assert found.columns[-5:] == ["_loaded_at", "txn_date_sk", "product_sk", "customer_sk", "store_sk"]
    assert rows(found, "transaction_id", "line_no", "txn_date_sk", "product_sk", "customer_sk", "store_sk") == sorted([
        ("T1", 1, 20240101, 5, 77, 11), ("T1", 2, 20240101, -1, 77, 11), ("T2", 1, None, 5, -1, -1),
        ("T3", 1, None, -1, -1, -1), (None, 1, None, -1, -1, -1)], key=repr)
    assert "line_no" in over["product_sk"]
    assert "line_no" not in over["customer_sk"] and "line_no" not in over["store_sk"]


def test_a_large_dimension_is_not_broadcast_by_a_guess(spark):
    """a dimension that was counted as too large for it could still be broadcast, as its file is small."""
    fact = spark.createDataFrame([("a", 1)], "sku STRING, n INT").withColumn("day", F.lit("2024-01-01").cast("date"))
    dim = spark.createDataFrame([("a", 5), ("b", 6)], "sku STRING, product_sk BIGINT").selectExpr(
        "*", "date '1900-01-01' AS valid_from", "cast(NULL AS date) AS valid_to")
    found = pit_join(fact, dim, {"sku": "sku"}, "day", "product_sk", broadcast_rows=0)
    assert "Broadcast" not in plan(found) and rows(found, "n", "product_sk") == [(1, 5)]


def test_setting_holds_again_after_overlapping_writes(spark):
    """a write that began during another one took the other's setting for the one before, and left it behind."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    inside, leave = threading.Event(), threading.Event()

    def second():
        with shuffles_dropped(spark):
            inside.set()
            leave.wait(30)

    thread = threading.Thread(target=second)
    with shuffles_dropped(spark):
        thread.start()
        assert inside.wait(30)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    leave.set()
    thread.join()
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def _on_disk(path, ending):
    return [p for p in Path(path.removeprefix("file:")).rglob(f"*{ending}")]


def test_stored_rows_are_packed_tighter(spark, folder):
    """rows of tables, raw and landing stay on disk to the end of a run."""
    tables.overwrite_table(spark, f"{folder}/t", spark.range(10).selectExpr("id AS k"), ["k"])
    assert _on_disk(f"{folder}/t/rows", ".zstd.parquet") and not _on_disk(f"{folder}/t/rows", ".snappy.parquet")
    feeds.write_landing(spark, SF, f"{folder}/landing", "1", None, ("stores",), None)
    assert _on_disk(f"{folder}/landing/pos", ".zstd.parquet") and not _on_disk(f"{folder}/landing/pos", ".snappy.parquet")
    assert _on_disk(f"{folder}/landing/catalog", ".csv.gz") and not _on_disk(f"{folder}/landing/catalog", ".csv")


def test_packed_and_plain_catalog_files_are_loaded(spark, folder):
    base = folder.removeprefix("file:")
    os.makedirs(f"{base}/in/dt=2024-01-01")
    Path(f"{base}/in/dt=2024-01-01/a.csv").write_text("sku,product_name\nA,one\n")
    with gzip.open(f"{base}/in/dt=2024-01-01/b.csv.gz", "wt") as file:
        file.write("product_name,sku\ntwo,B\n")
    for expected in (2, 0):
        assert landing.ingest_new_files(spark, f"{base}/in", f"{base}/raw", "csv", f"{base}/ledger") == expected
    assert rows(landing.read_catalog(spark, f"{base}/raw"), "sku", "product_name") == [("A", "one"), ("B", "two")]


def test_keys_of_much_news_are_not_broadcast_by_a_guess(spark, folder, monkeypatch):
    """a run failed with too little memory on the driver, as a comparison of millions of rows was planned as a broadcast."""
    joined = []
    real = tables.freeze
    monkeypatch.setattr(tables, "freeze", lambda df, name: (joined.append((name, plan(df))), real(df, name))[1])
    one = spark.range(100).selectExpr("id AS k", "id % 7 AS v")
    tables.merge_rows(spark, folder, one, ["k"])
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 10)
    merged = tables.merge_rows(spark, folder, one.withColumn("v", F.lit(9)), ["k"])
    assert rows(merged.table) == sorted([(k, 9) for k in range(100)], key=repr)
    plans = dict(joined)
    assert "SortMergeJoin" in plans["known"] and "SortMergeJoin" in plans["changed"]
    assert "Broadcast" not in plans["known"] and "Broadcast" not in plans["changed"]
