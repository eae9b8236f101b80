"""The declared checks of every table, by table name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from shelfline.operators.quality import (
    Check, accepted, check_payment_reconciliation, expression, not_null, relationships, unique,
)

# What the sources may hold.
OPERATIONS = ["INSERT", "UPDATE", "DELETE"]
CHANNELS = ["store", "online"]
STATUSES = ["completed", "voided", "returned"]
METHODS = ["card", "cash", "wallet", "gift_card"]
TIERS = ["bronze", "silver", "gold", "unknown"]
EVENT_TYPES = ["page_view", "product_view", "add_to_cart", "checkout_started", "purchase"]
KEPT = "cdc_operation <> 'DELETE'"
LIVE = "not is_deleted"


def _key(table: str, df: DataFrame, column: str) -> list[Check]:
    return [unique(f"{table}.{column} unique", df, column), not_null(f"{table}.{column} not null", df, column)]


def _operations(table: str, df: DataFrame) -> list[Check]:
    return [accepted(f"{table}.cdc_operation accepted", df, "cdc_operation", OPERATIONS)]


def checks_for(table: str, t: dict[str, DataFrame], now: dt.datetime) -> list[Check]:
    """Checks of one table. A check over two tables belongs to the one that is built later."""
    df = t[table]
    if table.endswith("_cdc"):
        return _operations(table, df)
    if table == "stg_stores":
        return _key(table, df, "store_id")
    if table == "stg_customers":
        return _key(table, df, "customer_id") + [
            not_null("stg_customers.email not null", df, "email", "warn", KEPT)]
    if table == "stg_transactions":
        return _key(table, df, "transaction_id") + [
            not_null("stg_transactions.customer_id not null online", df, "customer_id", "warn",
                     f"channel = 'online' and {KEPT}"),
            accepted("stg_transactions.channel accepted", df, "channel", CHANNELS, where=KEPT),
            accepted("stg_transactions.status accepted", df, "status", STATUSES, where=KEPT),
        ]
    if table == "stg_transaction_lines":
        return [
            unique("stg_transaction_lines key unique", df, ["transaction_id", "line_no"]),
            expression("stg_transaction_lines.quantity positive", df, "quantity > 0", "warn", KEPT),
            expression("stg_transaction_lines.unit_price positive", df, "unit_price > 0", "warn", KEPT),
        ]
    if table == "stg_payments":
        return _key(table, df, "payment_id") + [
            accepted("stg_payments.method accepted", df, "method", METHODS, where=KEPT)]
    if table == "stg_events":
        return _key(table, df, "event_id") + [
            accepted("stg_events.event_type accepted", df, "event_type", EVENT_TYPES),
            not_null("stg_events.event_ts not null", df, "event_ts"),
        ]
    if table == "raw_products":
        return [expression("catalog_products nothing rescued", df, "_rescued is null", "warn")]
    if table == "stg_products":
        return [unique("stg_products key unique", df, ["sku", "snapshot_date"])]
    if table == "dim_date":
        return _key(table, df, "date_sk") + _key(table, df, "date_day")
    if table == "dim_store":
        return _key(table, df, "store_sk") + [unique("dim_store version unique", df, ["store_id", "version_ts"])]
    if table == "dim_customer":
        return _key(table, df, "customer_sk") + [
            unique("dim_customer version unique", df, ["customer_id", "version_ts"]),
            accepted("dim_customer.loyalty_tier accepted", df, "loyalty_tier", TIERS),
        ]
    if table == "dim_product":
        return _key(table, df, "product_sk") + [unique("dim_product version unique", df, ["sku", "version_date"])]
    if table == "fct_sales_lines":
        out = [
            unique("fct_sales_lines key unique", df, ["transaction_id", "line_no"]),
            not_null("fct_sales_lines.txn_ts not null", df, "txn_ts", where=LIVE),
            relationships("fct_sales_lines.sku in dim_product", df, "sku", t["dim_product"], "sku", "warn", LIVE),
            relationships("fct_sales_lines.txn_date_sk in dim_date", df, "txn_date_sk", t["dim_date"], "date_sk"),
        ]
        for dim in ("product", "customer", "store"):
            sk = f"{dim}_sk"
            out += [
                not_null(f"fct_sales_lines.{sk} not null", df, sk),
                relationships(f"fct_sales_lines.{sk} in dim_{dim}", df, sk, t[f"dim_{dim}"], sk),
            ]
        return out
    if table == "fct_payments":
        return _key(table, df, "payment_id") + [
            Check("fct_payments reconcile", failing=check_payment_reconciliation(df), severity="warn")]
    if table == "fct_sessions":
        hour_ago = now - dt.timedelta(hours=1)
        return _key(table, df, "session_id") + [
            accepted("fct_sessions.pos_order_found true", df, "pos_order_found", [True], "warn",
                     f"session_start < timestamp_ntz '{hour_ago}'")]
    if table == "mart_daily_sales":
        return [unique("mart_daily_sales key unique", df, ["txn_date", "store_id", "channel"])]
    if table == "mart_web_funnel":
        return _key(table, df, "session_date")
    return []


# Fixed values: (warn, error) age limits of the raw tables.
FRESHNESS = {"default": (dt.timedelta(hours=2), dt.timedelta(hours=12)),
             "catalog_products": (dt.timedelta(hours=26), dt.timedelta(hours=50))}
