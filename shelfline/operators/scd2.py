"""Slowly changing dimensions (type 2) from change logs and from daily snapshots.

A chain needs the previous and the next version of its key. A window over the key alone would put
the whole chain of a hot key into one task, so a chain is cut by time into pieces of about equal
size: neighbours inside a piece come from a window over (key, piece), neighbours across pieces
from one summary row per piece. Only the keys that a sketch finds hot are cut; the others have a
single piece, and the summary holds hot keys only. Without a hot key the plan is a plain window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.functions.columns import UNKNOWN_SK, second_index
from shelfline.operators.latest import cdc_order, latest_by
from shelfline.operators.skew import hot_keys
from shelfline.operators.tables import loaded_after

FIRST_TS = dt.datetime(1900, 1, 1)
FIRST_DATE = dt.date(1900, 1, 1)
PIECES = 256  # of the chain of a hot key

STORE_TRACKED = ["store_name", "region", "format", "open_date"]
CUSTOMER_TRACKED = ["email", "phone", "loyalty_tier", "home_store_id"]
CUSTOMER_CARRIED = ["signup_at"]
PRODUCT_TRACKED = ["product_name", "brand", "category", "subcategory", "unit_cost", "list_price", "is_active"]
PRODUCT_CARRIED = ["pack_size"]


def changed_keys(df: DataFrame, key: str, watermark: dt.datetime | None) -> DataFrame:
    """Keys with a row loaded after the watermark; all keys where there is no watermark."""
    return loaded_after(df, watermark).select(key).where(F.col(key).isNotNull()).distinct()


def _with_pieces(df: DataFrame, key: str, order: str, hot: DataFrame | None) -> DataFrame:
    """Adds _piece, which grows with the order within a key; 0 throughout for keys that are not hot."""
    if hot is None:
        return df.withColumn("_piece", F.lit(0))
    second = second_index(F.col(order))
    marks = F.array(*[F.lit(i / PIECES) for i in range(1, PIECES)])
    bounds = (
        df.join(F.broadcast(hot.select(key)), key, "left_semi")
        .groupBy(key).agg(F.percentile_approx(second, marks, 10 * PIECES).alias("_bounds"))
    )
    # The bounds are approximate, so they are taken once and kept: one short row per hot key.
    fixed = df.sparkSession.createDataFrame(bounds.collect(), bounds.schema)
    piece = F.size(F.filter("_bounds", lambda bound: bound <= second))
    cut = df.join(F.broadcast(fixed), key, "left")
    return cut.withColumn("_piece", F.when(F.col("_bounds").isNull(), 0).otherwise(piece)).drop("_bounds")


def _neighbour(
    df: DataFrame, key: str, order: str, value: Column, hot: DataFrame | None, ahead: bool, name: str
) -> DataFrame:
    """Adds column `name`: a struct holding `value` of the row before (or after) within the key, else null."""
    boxed = df.withColumn("_boxed", F.struct(value.alias("v")))
    step = F.lead if ahead else F.lag
    pick = F.min_by if ahead else F.max_by
    by_key = Window.partitionBy(key)
    inner = Window.partitionBy(key, "_piece").orderBy(order)
    out = boxed.withColumn(name, step("_boxed").over(inner))
    if hot is None:
        return out.drop("_boxed")
    edges = (
        boxed.join(F.broadcast(hot.select(key)), key, "left_semi")
        .groupBy(key, "_piece")
        .agg(pick("_boxed", order).alias("_edge"))
        .withColumn("_edge", step("_edge").over(by_key.orderBy("_piece")))
    )
    return (
        out.join(edges, [key, "_piece"], "left")
        .withColumn(name, F.coalesce(name, "_edge"))
        .drop("_boxed", "_edge")
    )


def detect_changes(
    df: DataFrame, key: str, order: str, tracked: list[str], hot: DataFrame | None = None
) -> DataFrame:
    """Rows whose tracked attributes differ from the row before; nulls compare as values.

    The input has one row per (key, order). Adds `_first`, true on the first row of a key.
    """
    pieces = df if "_piece" in df.columns else _with_pieces(df, key, order, hot)
    now = F.struct(*[F.col(c) for c in tracked])
    seen = _neighbour(pieces, key, order, now, hot, ahead=False, name="_before")
    changed = F.col("_before").isNull() | ~F.col("_before.v").eqNullSafe(now)
    return seen.where(changed).withColumn("_first", F.col("_before").isNull()).drop("_before")


def scd2(
    df: DataFrame,
    key: str,
    order: str,
    tracked: list[str],
    carried: list[str] = (),
    version: str = "version_ts",
    first_from: dt.datetime | dt.date = FIRST_TS,
    close_on_delete: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Version intervals per key: [valid_from, valid_to), open at the end of the newest version.

    Deletes open no version. With `close_on_delete` they end the running one, and a later row
    opens a new version even if no attribute changed.
    """
    is_log = "cdc_operation" in df.columns
    chain, watched = df, list(tracked)
    if is_log:
        deleted = F.col("cdc_operation") == "DELETE"
        if close_on_delete:
            chain = df.where(F.col("cdc_operation").isNotNull()).withColumn("_gone", deleted)
            watched = [*tracked, "_gone"]
        else:
            chain = df.where(~deleted)
        chain = latest_by(chain, [key, order], cdc_order(chain, [key]))
    changes = detect_changes(chain, key, order, watched, hot)
    linked = _neighbour(changes, key, order, F.col(order), hot, ahead=True, name="_after")
    if is_log and close_on_delete:
        linked = linked.where(~F.col("_gone"))
    kind = linked.schema[order].dataType.simpleString()
    start = F.when(F.col("_first"), F.lit(str(first_from)).cast(kind)).otherwise(F.col(order))
    return linked.select(
        key, *tracked, *carried,
        F.col(order).alias(version),
        start.alias("valid_from"),
        F.col("_after.v").alias("valid_to"),
        F.col("_after").isNull().alias("is_current"),
        "_loaded_at",
    )


def store_versions(cdc: DataFrame, close_on_delete: bool = False) -> DataFrame:
    return scd2(cdc, "store_id", "_dms_commit_ts", STORE_TRACKED,
                close_on_delete=close_on_delete, hot=hot_keys(cdc, "store_id"))


def customer_versions(cdc: DataFrame, close_on_delete: bool = False) -> DataFrame:
    return scd2(cdc, "customer_id", "_dms_commit_ts", CUSTOMER_TRACKED, CUSTOMER_CARRIED,
                close_on_delete=close_on_delete, hot=hot_keys(cdc, "customer_id"))


def product_versions(snapshots: DataFrame) -> DataFrame:
    """One row per sku and day at most, so a chain is no longer than the calendar and needs no cutting."""
    return scd2(snapshots, "sku", "snapshot_date", PRODUCT_TRACKED, PRODUCT_CARRIED,
                version="version_date", first_from=FIRST_DATE)


# The Unknown member of each dimension, for facts without a match.
UNKNOWN_STORE = {
    "store_sk": UNKNOWN_SK, "store_id": -1, "store_name": "Unknown", "region": "unknown", "format": "unknown",
    "version_ts": FIRST_TS, "valid_from": FIRST_TS, "is_current": True, "_loaded_at": FIRST_TS,
}
UNKNOWN_CUSTOMER = {
    "customer_sk": UNKNOWN_SK, "customer_id": -1, "loyalty_tier": "unknown", "home_store_id": -1,
    "version_ts": FIRST_TS, "valid_from": FIRST_TS, "is_current": True, "_loaded_at": FIRST_TS,
}
UNKNOWN_PRODUCT = {
    "product_sk": UNKNOWN_SK, "sku": "UNKNOWN", "product_name": "Unknown", "brand": "unknown",
    "category": "unknown", "subcategory": "unknown",
    "version_date": FIRST_DATE, "valid_from": FIRST_DATE, "is_current": True, "_loaded_at": FIRST_TS,
}


def _constant(value) -> Column:
    """Literal; dates and times as text, so that no time zone touches them."""
    return F.lit(str(value) if isinstance(value, dt.date) else value)


def with_unknown_member(df: DataFrame, values: dict) -> DataFrame:
    """Adds one row; columns without a value are null."""
    one = df.sparkSession.range(1).select(
        *[_constant(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(one)
