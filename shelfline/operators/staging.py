"""Typed staging views over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.functions.columns import cdc_columns, to_ts, variant_field
from shelfline.operators.latest import daily_snapshots, dedupe_events, latest_cdc
from shelfline.sources.contracts import CATALOG_COLUMNS, EVENT_COLUMNS, POS_COLUMNS, POS_KEYS, fields


def _typed(ddl: str) -> list:
    out = []
    for name, kind in fields(ddl):
        if kind == "TIMESTAMP_NTZ":
            out.append(to_ts("record", name).alias(name))
        elif kind == "DATE":
            out.append(to_ts("record", name).cast("date").alias(name))
        else:
            out.append(variant_field("record", name, kind.lower()).alias(name))
    return out


def stg_cdc(raw: DataFrame, table: str) -> DataFrame:
    """Every change of one point-of-sale table, typed."""
    return raw.select(*_typed(POS_COLUMNS[table]), *cdc_columns())


def stg_latest(raw: DataFrame, table: str) -> DataFrame:
    return latest_cdc(stg_cdc(raw, table), POS_KEYS[table])


def stg_event_log(raw: DataFrame) -> DataFrame:
    """Every delivered event, typed, copies included."""
    return raw.select(*_typed(EVENT_COLUMNS), "_file", "_loaded_at")


def stg_events(raw: DataFrame) -> DataFrame:
    return dedupe_events(stg_event_log(raw))


def stg_products(raw: DataFrame) -> DataFrame:
    """Catalog rows, one per sku and snapshot day; columns that a file lacked are null."""
    names = [n for n, _ in fields(CATALOG_COLUMNS)]
    return daily_snapshots(raw.select(*names, F.col("_file"), F.col("_loaded_at")))
