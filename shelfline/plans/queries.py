"""One callable per operator over the driver's tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.functions import columns as fn
from shelfline.operators import calendar, facts, latest, marts, merge, quality, refunds, scd2, staging, surrogate, tables
from shelfline.operators.pit import pit_join
from shelfline.operators.skew import hot_keys
from shelfline.plans import feeds, warehouse
from shelfline.plans.checks import checks_for
from shelfline.session import freeze, run_dir
from shelfline.sources import landing as src
from shelfline.sources.contracts import POS_KEYS
from shelfline.streaming import live

Query = Callable[[SparkSession, str], DataFrame]

# The moments at which the feeds are cut into deliveries, and "now" of timed checks.
CUT = "1998-01-01 00:00:00"
CUSTOMER_SINCE = dt.datetime(1996, 6, 1)
EVENT_CUT = "2024-01-16 00:00:00"
NOW = dt.datetime(2024, 2, 1)
FRESH_NOW = dt.datetime(2024, 1, 31, 6)
GRAIN = "YEAR"   # of stored tables: the driver's sales are spread thinly over seven years


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the tables have them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields
    ])


def _without_load(df: DataFrame) -> DataFrame:
    return df.drop("_file", "_loaded_at")


# ---------------------------------------------------------------- building blocks
def _latest(spark, d, table) -> DataFrame:
    return latest.latest_cdc(feeds.cdc(spark, d, table), POS_KEYS[table])


def _headers(spark, d, totals: str | None = None) -> DataFrame:
    return latest.latest_cdc(feeds.cdc(spark, d, "transactions", totals), ["transaction_id"])


def _events(spark, d) -> DataFrame:
    return latest.dedupe_events(feeds.event_log(spark, d))


def _products(spark, d) -> DataFrame:
    return staging.stg_products(feeds.catalog(spark, d))


def _calendar(spark, d) -> DataFrame:
    lo, hi = spark.read.parquet(f"{d}/orders.parquet").agg(
        F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    return calendar.dim_date(spark, lo, hi + dt.timedelta(days=2))


def _dim_store(spark, d) -> DataFrame:
    versions = scd2.store_versions(feeds.cdc(spark, d, "stores"))
    keyed = surrogate.assign_surrogate_keys(versions, "store_id", "version_ts", "store_sk")
    return scd2.with_unknown_member(keyed, scd2.UNKNOWN_STORE)


def _dim_customer(spark, d) -> DataFrame:
    versions = scd2.customer_versions(feeds.cdc(spark, d, "customers"))
    keyed = surrogate.assign_surrogate_keys(versions, "customer_id", "version_ts", "customer_sk")
    return scd2.with_unknown_member(keyed, scd2.UNKNOWN_CUSTOMER)


def _dim_product(spark, d) -> DataFrame:
    versions = scd2.product_versions(_products(spark, d))
    keyed = surrogate.assign_surrogate_keys(versions, "sku", "version_date", "product_sk")
    return scd2.with_unknown_member(keyed, scd2.UNKNOWN_PRODUCT)


def _joined_lines(spark, d) -> DataFrame:
    log = feeds.cdc(spark, d, "transaction_lines")
    lines = latest.latest_cdc(log, POS_KEYS["transaction_lines"])
    return facts.sales_lines_join(lines, _headers(spark, d), hot_keys(log, "transaction_id"))


def _sales_lines(spark, d) -> DataFrame:
    log = feeds.cdc(spark, d, "transaction_lines")
    dims = {"date": _calendar(spark, d), "product": _dim_product(spark, d), "customer": _dim_customer(spark, d),
            "store": _dim_store(spark, d)}
    totals = feeds.sale_totals(spark, d, run_dir(spark, "totals"))   # its shuffles are gone before the fact's begin
    return facts.fct_sales_lines(
        _headers(spark, d, totals), latest.latest_cdc(log, POS_KEYS["transaction_lines"]), dims,
        hot={"transaction_id": hot_keys(log, "transaction_id"),
             "customer_id": hot_keys(dims["customer"], "customer_id", min_rows=10_000),
             "store_id": hot_keys(dims["store"], "store_id", min_rows=10_000)})


def _payments(spark, d) -> DataFrame:
    log = freeze(feeds.cdc(spark, d, "payments"), "log_payments")
    return facts.fct_payments(latest.latest_cdc(log, ["payment_id"]), _latest(spark, d, "transactions"),
                              hot=hot_keys(log, "transaction_id"))


def _sessions(spark, d) -> DataFrame:
    return facts.fct_sessions(_events(spark, d), _headers(spark, d))


# ---------------------------------------------------------------- A sources and sinks
def ingest_new_files(spark, d):
    base = run_dir(spark, "ingest")
    for part, where in (("1", f"_dms_commit_ts < '{CUT}'"), ("2", f"_dms_commit_ts >= '{CUT}'")):
        feeds.write_landing(spark, d, base, part, where, ("payments",), None, None)
        for _ in range(2):  # the second call finds nothing new
            src.ingest_new_files(spark, f"{base}/pos/pos/payments", f"{base}/raw", "parquet", f"{base}/ledger",
                                 src.cdc_schema("payments"))
    return _without_load(staging.stg_cdc(src.read_raw(spark, f"{base}/raw"), "payments"))


def read_cdc_parquet(spark, d):
    base = run_dir(spark, "cdc")
    feeds.write_landing(spark, d, base, "1", None, ("transactions",), None, None)
    raw = src.read_cdc_parquet(spark, f"{base}/pos/pos/transactions")
    return _without_load(staging.stg_cdc(raw, "transactions"))


def read_events_json(spark, d):
    base = run_dir(spark, "events")
    feeds.write_landing(spark, d, base, "1", None, (), "true", None)
    return _without_load(staging.stg_event_log(src.read_events_json(spark, f"{base}/clickstream/events")))


def read_csv_by_name(spark, d):
    base = run_dir(spark, "catalog")
    feeds.write_catalog(spark, d, base, "1")
    rows = src.read_csv_by_name(spark, tables.list_files(spark, base, src.CSV), base_dir=base).drop(src.RESCUED)
    return _without_load(rows.withColumn("snapshot_date", fn.partition_date(F.col("_file"))))


def with_load_metadata(spark, d):
    base = run_dir(spark, "meta")
    for part, where in (("1", f"_dms_commit_ts < '{CUT}'"), ("2", f"_dms_commit_ts >= '{CUT}'")):
        feeds.write_landing(spark, d, base, part, where, ("payments",), None, None)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/pos/pos")
    return (
        src.with_load_metadata(rows, f"{base}/pos/pos")
        .groupBy(F.substring_index("_file", "/", 2).alias("folder"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_loaded_at").alias("load_times"))
    )


def partition_date(spark, d):
    return feeds.catalog(spark, d).select("sku", "_file", fn.partition_date(F.col("_file")).alias("snapshot_date"))


def materialize(spark, d):
    path = run_dir(spark, "table")
    everything = feeds.cdc(spark, d, "customers")
    src.materialize(everything, path, "overwrite")
    src.materialize(freeze(latest.latest_cdc(tables.read_table(spark, path), ["customer_id"]), "latest"), path, "overwrite")
    return plain(tables.read_table(spark, path))


def materialize_view(spark, d):
    """A view by name; it is computed when it is read."""
    name = f"latest_customers_{run_dir(spark, 'view')[-12:]}"
    src.materialize(_latest(spark, d, "customers"), name)
    return plain(spark.table(name))


def upsert(spark, d):
    path = run_dir(spark, "upsert")
    log = feeds.cdc(spark, d, "transactions")
    for where in (f"_dms_commit_ts < '{CUT}'", f"_dms_commit_ts >= '{CUT}'"):
        tables.upsert(spark, path, latest.latest_cdc(log.where(where), ["transaction_id"]), ["transaction_id"], day="txn_ts",
                      grain=GRAIN)
    return plain(tables.read_table(spark, path))


# ---------------------------------------------------------------- B staging
def _stg_cdc(table: str) -> Query:
    return lambda spark, d: plain(staging.stg_cdc(feeds.raw_cdc(spark, d, table), table))


def cdc_columns(spark, d):
    raw = feeds.raw_cdc(spark, d, "transaction_lines")
    return plain(raw.select(fn.variant_field("record", "transaction_id", "string").alias("transaction_id"),
                            fn.variant_field("record", "line_no", "int").alias("line_no"), *fn.cdc_columns()))


def _latest_of(table: str) -> Query:
    return lambda spark, d: plain(_latest(spark, d, table))


# ---------------------------------------------------------------- C dimensions
def changed_keys(spark, d):
    return scd2.changed_keys(feeds.cdc(spark, d, "customers"), "customer_id", CUSTOMER_SINCE)


def detect_changes(spark, d):
    log = feeds.cdc(spark, d, "customers").where("cdc_operation <> 'DELETE'")
    one = latest.latest_by(log, ["customer_id", "_dms_commit_ts"], latest.cdc_order(log, ["customer_id"]))
    found = scd2.detect_changes(one, "customer_id", "_dms_commit_ts", scd2.CUSTOMER_TRACKED,
                                hot_keys(log, "customer_id"))
    return found.select("customer_id", "_dms_commit_ts", *scd2.CUSTOMER_TRACKED)


def assign_surrogate_keys(spark, d):
    versions = scd2.customer_versions(feeds.cdc(spark, d, "customers")).select("customer_id", "version_ts")
    old = surrogate.assign_surrogate_keys(
        versions.where(F.col("version_ts") < F.lit(str(CUSTOMER_SINCE)).cast("timestamp_ntz")),
        "customer_id", "version_ts", "customer_sk")
    return surrogate.assign_surrogate_keys(versions, "customer_id", "version_ts", "customer_sk", old)


def with_unknown_member(spark, d):
    return plain(scd2.with_unknown_member(scd2.store_versions(feeds.cdc(spark, d, "stores")), scd2.UNKNOWN_STORE))


def merge_dim(spark, d):
    path = run_dir(spark, "dim")
    log = feeds.cdc(spark, d, "customers")
    for rows in (log.where(F.col("_loaded_at") < F.lit(CUSTOMER_SINCE)), log):
        since = tables.table_watermark(spark, path)
        changed = rows.join(scd2.changed_keys(rows, "customer_id", since), "customer_id", "left_semi")
        merge.merge_dim(spark, path, scd2.customer_versions(changed), "customer_id", "version_ts", "customer_sk",
                        scd2.UNKNOWN_CUSTOMER, grain=GRAIN)
    return plain(tables.read_table(spark, path))


# ---------------------------------------------------------------- D facts
def changed_transactions(spark, d):
    since = dt.datetime.fromisoformat(CUT)
    return facts.changed_transactions(_headers(spark, d), _latest(spark, d, "transaction_lines"), since)


def _pit(dim, build, key, at, sk) -> Query:
    def query(spark, d):
        fact = _joined_lines(spark, d).select("transaction_id", "line_no", key, at)
        versions = build(spark, d)
        return pit_join(fact, versions, {key: key}, at, sk, spread_by=["transaction_id", "line_no"],
                        hot=hot_keys(versions, key, min_rows=10_000))
    return query


def date_key_join(spark, d):
    sales = _headers(spark, d).select("transaction_id", F.to_date("txn_ts").alias("txn_date"))
    return calendar.date_key_join(sales, _calendar(spark, d), "txn_date")


def soft_delete(spark, d):
    return _joined_lines(spark, d).select("transaction_id", "line_no", "is_deleted")


def session_rollup(spark, d):
    return plain(facts.session_rollup(_events(spark, d)))


def fct_sessions_incremental(spark, d):
    path = run_dir(spark, "sessions")
    log, sales = feeds.event_log(spark, d), _headers(spark, d)
    for rows in (log.where(F.col("_loaded_at") < F.lit(EVENT_CUT).cast("timestamp")), log):
        since = tables.table_watermark(spark, path, dt.timedelta(hours=1))
        merge.merge_fact(spark, path, facts.fct_sessions(latest.dedupe_events(rows), sales, since), ["session_id"],
                         day="session_start")
    return plain(tables.read_table(spark, path))


def order_reconcile_flag(spark, d):
    sessions = facts.session_rollup(_events(spark, d)).select("session_id", "order_id")
    return facts.order_reconcile_flag(sessions, _headers(spark, d))


def watermark_lookback(spark, d):
    log = feeds.event_log(spark, d)
    target = log.where(F.col("_loaded_at") < F.lit(EVENT_CUT).cast("timestamp"))
    since = tables.watermark(target, dt.timedelta(hours=1))
    return plain(tables.loaded_after(log, since).select("event_id", "_loaded_at"))


def merge_fact(spark, d):
    """Two runs; the second brings changed sales and one more column."""
    path = run_dir(spark, "fact")
    log = feeds.cdc(spark, d, "payments")
    early = latest.latest_cdc(log.where(f"_dms_commit_ts < '{CUT}'"), ["payment_id"])
    late = latest.latest_cdc(log.where(f"_dms_commit_ts >= '{CUT}'"), ["payment_id"])
    columns = ["payment_id", "transaction_id", "amount"]
    day = F.lit("1998-01-01")    # the fact has no date of its own
    merge.merge_fact(spark, path, early.select(*columns), ["payment_id"], day=day)
    merge.merge_fact(spark, path, late.select(*columns, "method"), ["payment_id"], day=day)
    return tables.read_table(spark, path)


# ---------------------------------------------------------------- E marts
def mart_daily_sales(spark, d):
    versions = scd2.store_versions(feeds.cdc(spark, d, "stores"))
    return marts.mart_daily_sales(_joined_lines(spark, d), versions)


def mart_web_funnel(spark, d):
    return marts.mart_web_funnel(facts.session_rollup(_events(spark, d)))


def unmatched_web_orders(spark, d):
    return marts.unmatched_web_orders(facts.session_rollup(_events(spark, d)), _headers(spark, d), NOW)


# ---------------------------------------------------------------- F quality
def check_unique(spark, d):
    return quality.check_unique(feeds.event_log(spark, d), "event_id")


def check_not_null(spark, d):
    return plain(quality.check_not_null(_latest(spark, d, "customers"), "email", "cdc_operation <> 'DELETE'"))


def check_accepted_values(spark, d):
    """The planted case: sessions whose order was not found."""
    return quality.check_accepted_values(_sessions(spark, d), "pos_order_found", [True])


def check_relationships(spark, d):
    lines = _latest(spark, d, "transaction_lines").where("cdc_operation <> 'DELETE'")
    return plain(quality.check_relationships(lines, "sku", _products(spark, d), "sku"))


def check_expression(spark, d):
    lines = _latest(spark, d, "transaction_lines")
    return plain(quality.check_expression(lines, "quantity > 0 and unit_price > 0", "cdc_operation <> 'DELETE'"))


def check_unique_combination(spark, d):
    return quality.check_unique_combination(feeds.cdc(spark, d, "transaction_lines"), ["transaction_id", "line_no"])


def check_payment_reconciliation(spark, d):
    found = quality.check_payment_reconciliation(_payments(spark, d))
    return found.withColumn("net_paid", F.col("net_paid").cast("decimal(38,2)"))


def _suite_frames(spark, d) -> dict[str, DataFrame]:
    """Tables to check, each written once, because a suite reads every one of them several times."""
    log = {t: freeze(feeds.cdc(spark, d, t), f"log_{t}") for t in ("transactions", "payments")}
    out = {"stg_transactions_cdc": log["transactions"]}
    for t in ("stores", "customers", "transactions", "transaction_lines", "payments"):
        out[f"stg_{t}"] = latest.latest_cdc(log.get(t) or feeds.cdc(spark, d, t), POS_KEYS[t])
    out["stg_events"], out["stg_products"] = _events(spark, d), _products(spark, d)
    out = {name: df if name.endswith("_cdc") else freeze(df, name) for name, df in out.items()}
    out["fct_payments"] = freeze(facts.fct_payments(out["stg_payments"], out["stg_transactions"]), "fct_payments")
    out["fct_sessions"] = freeze(facts.fct_sessions(out["stg_events"], out["stg_transactions"]), "fct_sessions")
    return out


def run_suite(spark, d):
    frames = _suite_frames(spark, d)
    return quality.run_suite([c for name in frames for c in checks_for(name, frames, NOW)])


def check_freshness(spark, d):
    """All seven sources, from the footers of files that hold their load times."""
    base = run_dir(spark, "fresh")
    raw = {f"pos_{t}": feeds.cdc(spark, d, t) for t in POS_KEYS}
    raw |= {"clickstream_events": feeds.event_log(spark, d), "catalog_products": feeds.catalog(spark, d)}
    parts = []
    for name, df in raw.items():
        times = df.select(F.unix_micros("_loaded_at").alias(src.LOADED_US), F.to_date("_loaded_at").alias("_load_date"))
        times.hint("rebalance").write.partitionBy("_load_date").parquet(f"{base}/{name}")
        parts.append(quality.check_freshness(src.newest_load(spark, f"{base}/{name}"), name, FRESH_NOW,
                                             *warehouse.FRESHNESS.get(name, warehouse.FRESHNESS["default"])))
    return reduce(DataFrame.unionByName, parts)


def rescued_values(spark, d):
    """Catalog files read with a number where they have text, and without a column that some of them have."""
    base = run_dir(spark, "rescued")
    feeds.write_catalog(spark, d, base, "1")
    target = "sku STRING, product_name STRING, brand STRING, category STRING, subcategory INT, unit_cost DECIMAL(10,2), " \
             "list_price DECIMAL(10,2), is_active BOOLEAN, supplier_updated_at TIMESTAMP_NTZ"
    rows = src.read_csv_by_name(spark, tables.list_files(spark, base, src.CSV), target, base)
    kept = [fn.variant_field(src.RESCUED, c, "string").alias(c) for c in ("subcategory", "pack_size")]
    return rows.select("sku", fn.partition_date(F.col("_file")).alias("snapshot_date"), F.col("list_price"), *kept)


def check_schema_drift(spark, d):
    """Folders whose catalog files lack a column or have one too many."""
    base = run_dir(spark, "drift")
    feeds.write_catalog(spark, d, base, "1")
    expected = "sku STRING, product_name STRING, brand STRING, category STRING, subcategory STRING, " \
               "unit_cost STRING, list_price STRING, is_active STRING, supplier_updated_at STRING"
    found = src.check_schema_drift(spark, tables.list_files(spark, base, src.CSV), expected, base)
    return found.select(fn.partition_date(F.col("file")).alias("snapshot_date"), "missing", "extra").distinct()


def gate_after_each(spark, d):
    """Gates the staging tables one by one; returns the warnings that fired."""
    frames, fired = _suite_frames(spark, d), []
    for name in frames:
        fired += quality.gate(quality.run_suite(checks_for(name, frames, NOW)))
    return spark.createDataFrame([(r["check"], r["failures"]) for r in fired], "check STRING, failures BIGINT")


# ---------------------------------------------------------------- G set-oriented changes
def backfill_refunds(spark, d):
    payments = freeze(_latest(spark, d, "payments"), "payments")  # read for tenders and for refunds
    return refunds.backfill_refunds(payments, _headers(spark, d))


def refunds_for(spark, d):
    ids = _headers(spark, d).where("status = 'returned'").select("transaction_id")
    at = F.lit(CUT).cast("timestamp_ntz")
    return refunds.refunds_for(_latest(spark, d, "payments"), ids, at)


def sale_total(spark, d):
    return refunds.sale_total(_latest(spark, d, "transaction_lines").where("cdc_operation <> 'DELETE'"))


# ---------------------------------------------------------------- H whole runs
def _settings(spark, d) -> warehouse.Settings:
    lo, hi = spark.read.parquet(f"{d}/orders.parquet").agg(
        F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    return warehouse.Settings(NOW, lo, hi + dt.timedelta(days=2), buckets=4, grain=GRAIN)


def run_full(spark, d):
    base = run_dir(spark, "full")
    feeds.write_landing(spark, d, f"{base}/landing", "1", totals=feeds.sale_totals(spark, d, f"{base}/totals"))
    return warehouse.run_full(spark, f"{base}/landing", f"{base}/warehouse", _settings(spark, d))["mart_daily_sales"]


def _deliver(spark, d, base: str, part: int) -> None:
    """One of two deliveries. Lines do not come before their sale, which the checks would reject."""
    totals = feeds.sale_totals(spark, d, f"{base}/totals")   # written with the first delivery
    early = feeds.cdc(spark, d, "transactions", totals).where(f"_dms_commit_ts < '{CUT}'").select("transaction_id").distinct()
    before, after = f"_dms_commit_ts < '{CUT}'", f"_dms_commit_ts >= '{CUT}'"
    if part == 1:
        feeds.write_landing(spark, d, f"{base}/landing", "1", before, events=f"_loaded_at < '{EVENT_CUT}'", totals=totals,
                            lines=lambda rows: rows.where(before).join(early, "transaction_id", "left_semi"))
    else:
        feeds.write_landing(
            spark, d, f"{base}/landing", "2", after, events=f"_loaded_at >= '{EVENT_CUT}'", catalog_days=None, totals=totals,
            lines=lambda rows: rows.where(after).unionByName(rows.where(before).join(early, "transaction_id", "left_anti")))


_runs: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _incremental(spark, d) -> dict[str, DataFrame]:
    """Two deliveries and a run without news; once for all queries of an application that look at the outcome."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _runs:
        base, settings = run_dir(spark, "incremental"), _settings(spark, d)
        for part in (1, 2):
            _deliver(spark, d, base, part)
            warehouse.run_incremental(spark, f"{base}/landing", f"{base}/warehouse", settings)
        _runs[key] = warehouse.run_incremental(spark, f"{base}/landing", f"{base}/warehouse", settings)
    return _runs[key]


def _with_versions(out: dict[str, DataFrame]) -> DataFrame:
    """Each line with the dimension versions it points at."""
    lines = out["fct_sales_lines"].drop("_loaded_at")
    for dim, version in (("product", "version_date"), ("customer", "version_ts"), ("store", "version_ts")):
        versions = out[f"dim_{dim}"].select(f"{dim}_sk", F.col(version).alias(f"{dim}_version"))
        lines = lines.join(versions, f"{dim}_sk", "left").drop(f"{dim}_sk")
    return lines


def refresh_dimension(spark, d):
    """With the second delivery one dimension is rebuilt with new keys, and the facts that hold them with it."""
    base, settings = run_dir(spark, "refresh"), _settings(spark, d)
    _deliver(spark, d, base, 1)
    warehouse.run_incremental(spark, f"{base}/landing", f"{base}/warehouse", settings)
    _deliver(spark, d, base, 2)
    return _with_versions(warehouse.run_refresh(spark, f"{base}/landing", f"{base}/warehouse", settings, {"dim_customer"}))


def run_incremental_marts(spark, d):
    """The daily mart after two deliveries, of which the second rewrote only its own days."""
    return _incremental(spark, d)["mart_daily_sales"]


def run_incremental(spark, d):
    return _with_versions(_incremental(spark, d))


# ---------------------------------------------------------------- I streams
def stream_sessions(spark, d):
    base = run_dir(spark, "live")
    tables.overwrite_table(spark, f"{base}/warehouse/state/transactions", _headers(spark, d),
                           ["transaction_id"], "txn_ts", 4, grain=GRAIN)
    for part, where in (("1", f"_loaded_at < '{EVENT_CUT}'"), ("2", f"_loaded_at >= '{EVENT_CUT}'")):
        feeds.write_landing(spark, d, base, part, None, (), where, None)
        live.stream_sessions(spark, base, f"{base}/warehouse", f"{base}/checkpoint", buckets=4).awaitTermination()
    return tables.read_table(spark, f"{base}/warehouse/core/fct_sessions").drop("_loaded_at")


def stream_latest(spark, d):
    """Newer changes are delivered first; the older ones that follow must not win."""
    base = run_dir(spark, "live")
    for part, where in (("1", f"_dms_commit_ts >= '{CUT}'"), ("2", f"_dms_commit_ts < '{CUT}'")):
        feeds.write_landing(spark, d, base, part, where, ("transactions",), None, None)
        live.stream_latest(spark, base, f"{base}/warehouse", "transactions", f"{base}/checkpoint",
                           buckets=4, grain=GRAIN).awaitTermination()
    return _without_load(tables.read_table(spark, f"{base}/warehouse/state/transactions"))


def dedupe_stream(spark, d):
    base = run_dir(spark, "dedupe")
    feeds.event_log(spark, d).write.parquet(f"{base}/in")
    files = len(spark.read.parquet(f"{base}/in").inputFiles())   # some three batches, whatever the size
    stream = (spark.readStream.schema(spark.read.parquet(f"{base}/in").schema)
              .option("maxFilesPerTrigger", max(1, files // 3)).parquet(f"{base}/in"))
    live.dedupe_stream(stream, f"{base}/events", f"{base}/checkpoint", buckets=4).awaitTermination()
    return tables.read_table(spark, f"{base}/events").select("event_id", "session_id")


def drop_copies_within(spark, d):
    """Three deliveries in order of arrival; copies arrive within the time that the state is kept for."""
    base = run_dir(spark, "bounded")
    log = feeds.event_log(spark, d)
    lo, hi = log.agg(F.min("_loaded_at"), F.max("_loaded_at")).first()
    at = lambda k: F.lit(lo + (hi - lo) * k / 3)
    for k in range(3):
        part = log.where((F.col("_loaded_at") >= at(k)) & ((F.col("_loaded_at") < at(k + 1)) | F.lit(k == 2)))
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(log.schema).parquet(f"{base}/in")
        live.drop_copies_within(stream, f"{base}/out", f"{base}/checkpoint", "1 day").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "session_id")


QUERIES: dict[str, Query] = {
    "ingest_new_files": ingest_new_files,
    "read_cdc_parquet": read_cdc_parquet,
    "read_events_json": read_events_json,
    "read_csv_by_name": read_csv_by_name,
    "with_load_metadata": with_load_metadata,
    "partition_date": partition_date,
    "materialize": materialize,
    "upsert": upsert,
    "stg_cdc_stores": _stg_cdc("stores"),
    "stg_cdc_customers": _stg_cdc("customers"),
    "stg_cdc_transactions": _stg_cdc("transactions"),
    "stg_cdc_lines": _stg_cdc("transaction_lines"),
    "stg_cdc_payments": _stg_cdc("payments"),
    "cdc_columns": cdc_columns,
    "latest_stores": _latest_of("stores"),
    "latest_customers": _latest_of("customers"),
    "latest_transactions": _latest_of("transactions"),
    "latest_lines": _latest_of("transaction_lines"),
    "latest_payments": _latest_of("payments"),
    "dedupe_events": lambda spark, d: plain(_events(spark, d)),
    "daily_snapshots": lambda spark, d: plain(_products(spark, d)),
    "dim_date": _calendar,
    "changed_keys": changed_keys,
    "detect_changes": detect_changes,
    "dim_store": lambda spark, d: plain(_dim_store(spark, d)),
    "dim_customer": lambda spark, d: plain(_dim_customer(spark, d)),
    "dim_product": lambda spark, d: plain(_dim_product(spark, d)),
    "assign_surrogate_keys": assign_surrogate_keys,
    "with_unknown_member": with_unknown_member,
    "merge_dim": merge_dim,
    "sales_lines_join": lambda spark, d: plain(_joined_lines(spark, d)),
    "changed_transactions": changed_transactions,
    "pit_join_product": _pit("product", _dim_product, "sku", "txn_date", "product_sk"),
    "pit_join_customer": _pit("customer", _dim_customer, "customer_id", "txn_ts", "customer_sk"),
    "pit_join_store": _pit("store", _dim_store, "store_id", "txn_ts", "store_sk"),
    "date_key_join": date_key_join,
    "fct_sales_lines": lambda spark, d: plain(_sales_lines(spark, d)),
    "soft_delete": soft_delete,
    "fct_payments": lambda spark, d: plain(_payments(spark, d)),
    "session_rollup": session_rollup,
    "fct_sessions": lambda spark, d: plain(_sessions(spark, d)),
    "fct_sessions_incremental": fct_sessions_incremental,
    "order_reconcile_flag": order_reconcile_flag,
    "watermark_lookback": watermark_lookback,
    "merge_fact": merge_fact,
    "mart_daily_sales": mart_daily_sales,
    "mart_web_funnel": mart_web_funnel,
    "unmatched_web_orders": unmatched_web_orders,
    "check_unique": check_unique,
    "check_not_null": check_not_null,
    "check_accepted_values": check_accepted_values,
    "check_relationships": check_relationships,
    "check_expression": check_expression,
    "check_unique_combination": check_unique_combination,
    "check_payment_reconciliation": check_payment_reconciliation,
    "run_suite": run_suite,
    "check_freshness": check_freshness,
    "check_schema_drift": check_schema_drift,
    "gate_after_each": gate_after_each,
    "backfill_refunds": backfill_refunds,
    "refunds_for": refunds_for,
    "sale_total": sale_total,
    "run_full": run_full,
    "run_incremental": run_incremental,
    "run_incremental_payments": lambda spark, d: _incremental(spark, d)["fct_payments"].drop("_loaded_at"),
    "stream_sessions": stream_sessions,
    "stream_latest": stream_latest,
    "dedupe_stream": dedupe_stream,
    "drop_copies_within": drop_copies_within,
    "refresh_dimension": refresh_dimension,
    "run_incremental_marts": run_incremental_marts,
    "rescued_values": rescued_values,
    "materialize_view": materialize_view,
}
