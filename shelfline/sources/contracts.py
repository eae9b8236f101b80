"""Column contracts of the landing sources."""

from __future__ import annotations

# Column names and types as the sources deliver them.
POS_COLUMNS = {
    "stores": "store_id BIGINT, store_name STRING, region STRING, format STRING, open_date DATE, "
              "updated_at TIMESTAMP_NTZ",
    "customers": "customer_id BIGINT, email STRING, phone STRING, loyalty_tier STRING, home_store_id BIGINT, "
                 "signup_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    "transactions": "transaction_id STRING, store_id BIGINT, customer_id BIGINT, channel STRING, "
                    "txn_ts TIMESTAMP_NTZ, status STRING, total_amount DECIMAL(12,2), currency STRING, "
                    "updated_at TIMESTAMP_NTZ",
    "transaction_lines": "transaction_id STRING, line_no INT, sku STRING, quantity INT, "
                         "unit_price DECIMAL(10,2), discount_amount DECIMAL(10,2), promo_code STRING",
    "payments": "payment_id STRING, transaction_id STRING, method STRING, amount DECIMAL(12,2), "
                "created_at TIMESTAMP_NTZ",
}
CDC_SOURCE_COLUMNS = "Op STRING, _dms_commit_ts TIMESTAMP_NTZ"
POS_KEYS = {
    "stores": ["store_id"],
    "customers": ["customer_id"],
    "transactions": ["transaction_id"],
    "transaction_lines": ["transaction_id", "line_no"],
    "payments": ["payment_id"],
}
EVENT_COLUMNS = (
    "event_id STRING, event_type STRING, event_ts TIMESTAMP_NTZ, session_id STRING, anonymous_id STRING, "
    "customer_id BIGINT, page_url STRING, sku STRING, quantity INT, order_id STRING, device STRING, "
    "utm_source STRING, utm_medium STRING, utm_campaign STRING, schema_version INT"
)
CATALOG_COLUMNS = (
    "sku STRING, product_name STRING, brand STRING, category STRING, subcategory STRING, "
    "unit_cost DECIMAL(10,2), list_price DECIMAL(10,2), is_active BOOLEAN, "
    "supplier_updated_at TIMESTAMP_NTZ, pack_size STRING"
)


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a DDL column list; types keep their commas inside parentheses."""
    parts = ddl.replace("DECIMAL(12,2)", "DECIMAL(12;2)").replace("DECIMAL(10,2)", "DECIMAL(10;2)").split(",")
    return [tuple(p.strip().replace(";", ",").split(" ", 1)) for p in parts]
