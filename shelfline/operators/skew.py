"""Joins that stay even when one key, or the missing key, holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 64
MAX_HOT_KEYS = 1000


def hot_keys(df: DataFrame, key: str, min_rows: int = 1_000_000, k: int = MAX_HOT_KEYS) -> DataFrame | None:
    """The most frequent values of `key` as a frame of at most `k` rows; None if no value is hot.

    One pass over the key column: a frequent-items sketch merges on the map side, so no key is
    shuffled. It is approximate, which is harmless: callers give the same rows whether or not a key
    counts as hot. The look at the data comes first because most tables have no hot key, and then
    their plans need none of the handling.
    """
    sketch = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k({key}, {int(k)}, {10 * int(k)})").alias("top")
    )
    hot = (
        sketch.select(F.explode("top").alias("t"))
        .where(F.col("t.count") >= min_rows)
        .select(F.col("t.item").alias(key))
    )
    rows = hot.collect()  # at most k
    return df.sparkSession.createDataFrame(rows, hot.schema) if rows else None


BROADCAST_ROWS = 1_000_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most `rows` rows. A plain count adds up in each task; a limit would send
    that many rows of every partition to one task."""
    return df.count() <= rows


def spread_nulls(key: str, spread_by: list[str], kind: str) -> Column:
    """The key, with missing values replaced by many different ones, so that they do not all go to
    one task. A join on it must also ask that the key itself is not null."""
    filler = F.xxhash64(*spread_by)
    return F.coalesce(F.col(key), filler.cast(kind) if kind == "string" else filler)


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_by: list[str],
    hot: DataFrame | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left join on one text or bigint column, even under null and hot keys.

    Null keys match nothing, so they are spread over the tasks; the right side is not touched for
    that and keeps a partitioning by the key that it may already have. Hot keys, if `hot_keys`
    found any, are salted on the left and copied once per salt on the right. `spread_by` names
    left columns that tell the rows of one key apart.
    """
    kind = left.schema[on].dataType.simpleString()
    left = left.withColumn("_key", spread_nulls(on, spread_by, kind))
    right = right.withColumnRenamed(on, "_right_key")
    match = (F.col("_key") == F.col("_right_key")) & F.col(on).isNotNull()
    if hot is not None:
        flag = F.broadcast(hot.select(F.col(on).alias("_hot_key")))
        salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
        every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
        left = left.join(flag, F.col("_key") == F.col("_hot_key"), "left").withColumn(
            "_salt", F.when(F.col("_hot_key").isNotNull(), salt).otherwise(0)).drop("_hot_key")
        right = right.join(flag, F.col("_right_key") == F.col("_hot_key"), "left").withColumn(
            "_right_salt", F.explode(F.when(F.col("_hot_key").isNotNull(), every_salt).otherwise(F.array(F.lit(0)))),
        ).drop("_hot_key")
        match = match & (F.col("_salt") == F.col("_right_salt"))
    return left.join(right, match, "left").drop("_key", "_salt", "_right_key", "_right_salt")
