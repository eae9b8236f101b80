"""Latest state and duplicate removal.

`row_number() = 1` is planned with a group limit on both sides of the shuffle, so each map task
sends at most one row per key, however many versions a key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.functions.columns import operation_rank, partition_date


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def cdc_order(df: DataFrame, keys: list[str]) -> list[Column]:
    """Total order of the versions of a key, newest first.

    Commit time and file can tie when one commit holds several changes of a row, so the kind of
    change, the source's own change time and at last the values themselves decide.
    """
    first = [F.desc("_dms_commit_ts"), F.desc("_file"), operation_rank(F.col("cdc_operation")).desc()]
    named = {*keys, "_dms_commit_ts", "_file", "cdc_operation", "updated_at", "_loaded_at"}
    if "updated_at" in df.columns:
        first.append(F.desc("updated_at"))
    return first + [F.desc(c) for c in df.columns if c not in named]


def latest_cdc(cdc: DataFrame, keys: list[str]) -> DataFrame:
    """Current state per key from a change log; deleted keys stay, as their delete row."""
    return latest_by(cdc, keys, cdc_order(cdc, keys))


def dedupe_events(events: DataFrame) -> DataFrame:
    """One row per event_id: the copy that was loaded first."""
    rest = [c for c in events.columns if c not in ("event_id", "_loaded_at", "_file")]
    order = [F.asc("_loaded_at"), F.asc("_file"), *[F.asc(c) for c in rest]]
    return latest_by(events, ["event_id"], order)


def daily_snapshots(raw: DataFrame) -> DataFrame:
    """One row per sku and snapshot day, from the last file of that day."""
    dated = raw.withColumn("snapshot_date", partition_date(F.col("_file")))
    rest = [c for c in raw.columns if c not in ("sku", "_file", "_loaded_at")]
    kept = latest_by(dated, ["sku", "snapshot_date"], [F.desc("_file"), *[F.desc(c) for c in rest]])
    return kept.select("sku", *rest, "snapshot_date", "_file", "_loaded_at")
