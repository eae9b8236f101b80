"""Fact tables. Inputs are current-state staging frames; outputs are lazy, but for lines over a large product dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from shelfline.functions.columns import UNKNOWN_SK, is_soft_deleted, later_load, seconds_between
from shelfline.operators.calendar import date_key_join
from shelfline.operators.pit import pit_join
from shelfline.operators.skew import fits_broadcast, salted_left_join
from shelfline.operators.tables import loaded_after
from shelfline.session import freeze

LINE_KEYS = ["transaction_id", "line_no"]


# ---------------------------------------------------------------- sales lines
def sales_lines_join(
    lines: DataFrame, headers: DataFrame, hot: DataFrame | None = None, also: tuple[str, ...] = ()
) -> DataFrame:
    """Lines with their sale's header, amounts, soft-delete flag and load time; at the end the headers' columns `also`.

    A line without a header stays, with null header columns.
    """
    h = headers.select(
        "transaction_id", "txn_ts", "store_id", "customer_id", "channel", "status",
        F.col("cdc_operation").alias("_h_op"), F.col("_loaded_at").alias("_h_loaded"), *also,
    )
    gross = F.col("quantity") * F.col("unit_price")
    joined = salted_left_join(lines, h, "transaction_id", LINE_KEYS, hot)
    return joined.select(
        "transaction_id", "line_no", "txn_ts", F.to_date("txn_ts").alias("txn_date"),
        "store_id", "customer_id", "channel", "status",
        "sku", "quantity", "unit_price", "discount_amount", "promo_code",
        gross.alias("gross_amount"),
        (gross - F.col("discount_amount")).alias("net_amount"),
        is_soft_deleted(F.col("cdc_operation"), F.col("_h_op")).alias("is_deleted"),
        later_load(F.col("_loaded_at"), F.col("_h_loaded")).alias("_loaded_at"), *also,
    )


def changed_transactions(headers: DataFrame, lines: DataFrame, since: dt.datetime | None) -> DataFrame:
    """Sales whose header or any line was loaded after the watermark."""
    ids = loaded_after(headers, since).select("transaction_id")
    return ids.union(loaded_after(lines, since).select("transaction_id")).distinct()


def fct_sales_lines(
    headers: DataFrame, lines: DataFrame, dims: dict[str, DataFrame], since: dt.datetime | None = None,
    hot: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per line of a sale, with the dimension versions valid when it was sold.

    `dims`: date, product, customer, store. `hot`: optional `hot_keys` frames by column:
    transaction_id (of lines), customer_id and store_id (of the dimensions). Day, customer and store are the sale's, so
    they are looked up once for its header, and only the product for each line.
    """
    hot = hot or {}
    if since is not None:
        changed = changed_transactions(headers, lines, since)
        lines = lines.join(changed, "transaction_id", "left_semi")
        headers = headers.join(changed, "transaction_id", "left_semi")
    sales = headers.withColumn("_txn_day", F.to_date("txn_ts"))
    sales = date_key_join(sales, dims["date"], "_txn_day").drop("_txn_day")
    sales = pit_join(sales, dims["customer"], {"customer_id": "customer_id"}, "txn_ts", "customer_sk",
                     spread_by=["transaction_id"], hot=hot.get("customer_id"))
    sales = pit_join(sales, dims["store"], {"store_id": "store_id"}, "txn_ts", "store_sk",
                     spread_by=["transaction_id"], hot=hot.get("store_id"))
    of_sale = ("txn_date_sk", "customer_sk", "store_sk")
    fact = sales_lines_join(lines, sales, hot.get("transaction_id"), of_sale)
    if not fits_broadcast(dims["product"]):
        fact = freeze(fact, "sold")    # the lines are shuffled again, and till then the shuffles behind them are gone
    fact = pit_join(fact, dims["product"], {"sku": "sku"}, "txn_date", "product_sk", spread_by=LINE_KEYS)
    known = lambda sk: F.coalesce(F.col(sk), F.lit(UNKNOWN_SK).cast("bigint")).alias(sk)  # noqa: E731  a line without a header has none
    return fact.select(*[c for c in fact.columns if c not in (*of_sale, "product_sk")], "txn_date_sk", "product_sk",
                       known("customer_sk"), known("store_sk"))


# ---------------------------------------------------------------- payments
def fct_payments(
    payments: DataFrame, headers: DataFrame, since: dt.datetime | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """One row per tender or refund, with its sale's total and status."""
    if since is not None:
        changed = (
            loaded_after(payments, since).select("transaction_id")
            .union(loaded_after(headers, since).select("transaction_id")).distinct()
        )
        # A deleted tender lost its transaction_id, so it is kept by its own load time.
        late = F.col("_loaded_at") > F.lit(since)
        payments = (
            payments.join(changed, "transaction_id", "left_semi")
            .unionByName(payments.where(F.col("transaction_id").isNull() & late))
        )
        headers = headers.join(changed, "transaction_id", "left_semi")
    h = headers.select(
        "transaction_id", F.col("total_amount").alias("transaction_total"), "txn_ts", "store_id", "channel", "status",
        F.col("cdc_operation").alias("_h_op"), F.col("_loaded_at").alias("_h_loaded"),
    )
    joined = salted_left_join(payments, h, "transaction_id", ["payment_id"], hot)
    return joined.select(
        "payment_id", "transaction_id", "method", "amount", (F.col("amount") < 0).alias("is_refund"),
        "transaction_total", "txn_ts", F.to_date("txn_ts").alias("txn_date"), "store_id", "channel", "status",
        is_soft_deleted(F.col("cdc_operation"), F.col("_h_op")).alias("is_deleted"),
        later_load(F.col("_loaded_at"), F.col("_h_loaded")).alias("_loaded_at"),
    )


# ---------------------------------------------------------------- sessions
FUNNEL = {
    "viewed_product": "product_view",
    "added_to_cart": "add_to_cart",
    "started_checkout": "checkout_started",
    "purchased": "purchase",
}
FROM_FIRST_EVENT = ["device", "utm_source", "utm_medium", "utm_campaign"]


def session_rollup(events: DataFrame) -> DataFrame:
    """One row per session. Every aggregate merges on the map side, so a hot session is no problem.

    The first event decides device and campaign, nulls included; event_id breaks ties in time.
    """
    first = F.min(F.when(
        F.col("event_ts").isNotNull(), F.struct("event_ts", "event_id", *FROM_FIRST_EVENT)))
    rolled = events.groupBy("session_id").agg(
        F.min("anonymous_id").alias("anonymous_id"),
        F.max("customer_id").alias("customer_id"),
        F.min("event_ts").alias("session_start"),
        F.max("event_ts").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
        first.alias("_first"),
        *[F.bool_or(F.col("event_type") == kind).alias(flag) for flag, kind in FUNNEL.items()],
        F.max("order_id").alias("order_id"),
        F.max("_loaded_at").alias("_loaded_at"),
    )
    return rolled.select(
        "session_id", "anonymous_id", "customer_id", "session_start", "session_end",
        seconds_between(F.col("session_start"), F.col("session_end")).alias("duration_seconds"),
        "events",
        *[F.col(f"_first.{c}").alias(c) for c in FROM_FIRST_EVENT],
        *FUNNEL, "order_id", "_loaded_at",
    )


def online_orders(transactions: DataFrame) -> DataFrame:
    """Ids of the online sales; a deleted sale lost its channel and is not among them."""
    return transactions.where(F.col("channel") == "online").select("transaction_id")


def order_reconcile_flag(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Adds pos_order_found: no order, or the order exists as an online sale."""
    orders = online_orders(transactions).select(F.col("transaction_id").alias("order_id"), F.lit(True).alias("_found"))
    joined = salted_left_join(sessions, orders, "order_id", ["session_id"])
    found = F.col("order_id").isNull() | F.col("_found").isNotNull()
    return joined.select(*sessions.columns, found.alias("pos_order_found"))


def fct_sessions(events: DataFrame, transactions: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """Sessions with an event loaded after the watermark, rebuilt from all of their events."""
    if since is not None:
        touched = loaded_after(events, since).select("session_id").distinct()
        events = events.join(touched, "session_id", "left_semi")
    return order_reconcile_flag(session_rollup(events), transactions)
