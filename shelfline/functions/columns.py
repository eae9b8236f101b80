"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNKNOWN_SK = -1


def variant_field(record: str, name: str, kind: str) -> Column:
    """Field of a variant row; fails on a value that does not fit, null where the field is missing."""
    return F.variant_get(F.col(record), f"$.{name}", kind)


def to_ts(record: str, name: str) -> Column:
    """Timestamp without zone from a variant field; null if it cannot be read as one."""
    return F.try_variant_get(F.col(record), f"$.{name}", "timestamp_ntz")


def cdc_operation(op: Column) -> Column:
    """Name of a one-letter change code: none means insert, an unknown code gives null."""
    return (
        F.when(op.isNull() | (op == "I"), "INSERT")
        .when(op == "U", "UPDATE")
        .when(op == "D", "DELETE")
    )


def cdc_columns(record: str = "record") -> list[Column]:
    return [
        cdc_operation(variant_field(record, "Op", "string")).alias("cdc_operation"),
        to_ts(record, "_dms_commit_ts").alias("_dms_commit_ts"),
        F.col("_file"),
        F.col("_loaded_at"),
    ]


def operation_rank(operation: Column) -> Column:
    """Order of the changes that share one commit: insert, then update, then delete."""
    return F.when(operation == "INSERT", 1).when(operation == "UPDATE", 2).when(operation == "DELETE", 3).otherwise(0)


def partition_date(file: Column) -> Column:
    """Date named by a dt=YYYY-MM-DD folder of a path; null where there is none."""
    day = F.regexp_extract(file, r"dt=(\d{4}-\d{2}-\d{2})", 1)
    return F.when(day != "", F.try_to_date(day, "yyyy-MM-dd"))


def is_soft_deleted(row_op: Column, header_op: Column) -> Column:
    return F.coalesce(header_op == "DELETE", F.lit(False)) | (row_op == "DELETE")


def later_load(row_loaded: Column, header_loaded: Column) -> Column:
    return F.greatest(row_loaded, F.coalesce(header_loaded, row_loaded))


def second_index(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a date or a timestamp, whatever the session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    clock = ts.cast("timestamp_ntz")
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return day * 86400 + F.hour(clock) * 3600 + F.minute(clock) * 60 + F.second(clock)


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries between two timestamps."""
    return second_index(end) - second_index(start)


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole with six decimals, 0 where whole is 0."""
    ratio = F.try_divide(part.cast("decimal(18,0)"), whole.cast("decimal(18,0)"))
    return F.coalesce(F.round(ratio, 6), F.lit(0)).cast("decimal(18,6)")


def valid_at(at: Column, valid_from: Column, valid_to: Column) -> Column:
    """Half-open interval test; an open end means still valid."""
    return (at >= valid_from) & (valid_to.isNull() | (at < valid_to))
