"""Streams that keep stored tables up to date. State lives in the tables, so nothing expires there; only
`drop_copies_within` keeps its state in Spark's state store, and lets go of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.operators import facts, merge, staging, tables
from shelfline.session import freeze
from shelfline.sources import landing as src
from shelfline.sources.contracts import POS_COLUMNS, POS_KEYS


def _start(raw: DataFrame, fold, checkpoint: str, every: str | None) -> StreamingQuery:
    """Runs until stopped with an interval such as '1 minute', else until nothing is left."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return raw.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_latest(
    spark: SparkSession, landing: str, warehouse: str, table: str, checkpoint: str,
    max_files: int | None = None, buckets: int = tables.DEFAULT_BUCKETS, every: str | None = None, grain: str = "DAY",
) -> StreamingQuery:
    """Change files of one point-of-sale table into its current-state table.

    A batch that is run again after a failure folds in the same changes and gives the same table.
    """
    folder = f"{landing}/pos/pos/{table}"
    schema = src.landed_schema(spark, folder, src.cdc_schema(table))   # columns beyond the contract stay
    reader = spark.readStream.option("recursiveFileLookup", "true").schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(folder)
    raw = src.to_raw(rows, src.as_record(rows), folder)

    def fold(batch: DataFrame, _: int) -> None:
        index = ["transaction_id"] if table == "transaction_lines" else None
        merge.merge_latest(batch.sparkSession, f"{warehouse}/state/{table}", staging.stg_cdc(batch, table),
                           POS_KEYS[table], index, buckets=buckets, grain=grain)

    return _start(raw, fold, checkpoint, every)


def stream_sessions(
    spark: SparkSession, landing: str, warehouse: str, checkpoint: str,
    max_files: int | None = None, buckets: int = tables.DEFAULT_BUCKETS, every: str | None = None, grain: str = "DAY",
) -> StreamingQuery:
    """Clickstream files into the event table and the session fact.

    Each batch rebuilds the sessions it touches from all of their events, however late they are.
    Orders are looked up in the current-state table of the sales.
    """
    folder = f"{landing}/clickstream/events"
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.format("json").option("singleVariantColumn", "record").load(folder)
    raw = src.to_raw(rows, rows["record"], folder)

    def fold(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        new = freeze(staging.stg_event_log(batch), "batch")   # the files are read and parsed once
        merge.merge_events(session, f"{warehouse}/state/events", new, buckets, grain)
        touched = new.select("session_id").dropna().distinct()
        events = freeze(tables.rows_of(session, f"{warehouse}/state/events", touched), "events")
        orders = events.select(F.col("order_id").alias("transaction_id")).dropna().distinct()
        stored = f"{warehouse}/state/transactions"
        if tables.table_schema(session, stored) is None:   # no sale has landed yet
            sales = session.createDataFrame([], POS_COLUMNS["transactions"])
        else:
            sales = tables.rows_of(session, stored, orders)
        merge.merge_fact(session, f"{warehouse}/core/fct_sessions", facts.fct_sessions(events, sales),
                         ["session_id"], day="session_start", buckets=buckets, grain=grain)

    return _start(raw, fold, checkpoint, every)


def dedupe_stream(
    events: DataFrame, table: str, checkpoint: str, buckets: int = tables.DEFAULT_BUCKETS, every: str | None = None,
) -> StreamingQuery:
    """Folds a stream of events into a stored event table, where the first copy of each stays.

    The table is the state: no event is too late, and copies are found however far apart they come.
    """
    def fold(batch: DataFrame, _: int) -> None:
        merge.merge_events(batch.sparkSession, table, batch, buckets)

    return _start(events, fold, checkpoint, every)


def drop_copies_within(
    events: DataFrame, path: str, checkpoint: str, within: str = "1 day", arrival: str = "_loaded_at",
    every: str | None = None,
) -> StreamingQuery:
    """Appends a stream of events to Parquet files, each event once, with bounded state.

    The state store remembers an event id until the stream has moved `within` (such as '1 day') past the arrival
    of its first copy: copies that arrive within that time are dropped, later ones are kept again, which
    `dedupe_stream` does not do. Time is the time of arrival, so an event is never too late for having
    happened long ago. Rows whose arrival lies further back than `within` behind the newest one of earlier batches
    are dropped as late; deliveries in order of arrival have none.
    """
    once = events.withWatermark(arrival, within).dropDuplicatesWithinWatermark(["event_id"])
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (once.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())
