"""Landing files to marts, in one call: rebuilt in full or brought up to date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.operators import facts, marts, merge, scd2, staging, tables
from shelfline.operators.calendar import dim_date
from shelfline.operators.latest import dedupe_events, latest_cdc
from shelfline.operators.quality import Observed, QualityError, check_freshness, gate, run_suite
from shelfline.operators.skew import MAX_HOT_KEYS, hot_keys
from shelfline.operators.surrogate import assign_surrogate_keys
from shelfline.plans.checks import FRESHNESS, checks_for
from shelfline.session import freeze
from shelfline.sources import landing as src
from shelfline.sources.contracts import POS_COLUMNS, POS_KEYS

DIMS = {"dim_date", "dim_store", "dim_customer", "dim_product"}
FACTS = {"fct_sales_lines", "fct_payments", "fct_sessions"}
MARTS = {"mart_daily_sales", "mart_web_funnel"}
STATES = {"state/transactions", "state/transaction_lines", "state/payments", "state/events"}
# The current-state tables: by what rows are looked up, and the day that a new key is filed under.
STATE_INDEX = {"transactions": ["transaction_id"], "transaction_lines": ["transaction_id"], "payments": ["payment_id"]}
STATE_DAY = {"transactions": "txn_ts", "transaction_lines": "_dms_commit_ts", "payments": "created_at"}
STATE_ALSO = {"payments": [["transaction_id"]]}


@dataclass
class Settings:
    now: dt.datetime
    calendar_start: dt.date = dt.date(2025, 1, 1)
    calendar_end: dt.date | None = None          # one year after `now` by default
    sales_lookback: dt.timedelta = dt.timedelta(hours=1)
    clickstream_lookback: dt.timedelta = dt.timedelta(hours=1)
    buckets: int = tables.DEFAULT_BUCKETS        # of the key tables; thousands for large ones
    grain: str = "DAY"                           # of the partitions; MONTH or YEAR for tables of few rows a day
    checks: bool = True
    warnings: list = field(default_factory=list)

    def calendar(self) -> tuple[dt.date, dt.date]:
        end = self.calendar_end or (self.now + dt.timedelta(days=365)).date()
        return self.calendar_start, end


# What is built from what: a table's readers. Facts of sales lines hold the keys of dimension versions.
READERS = {
    "dim_date": {"fct_sales_lines"}, "dim_store": {"fct_sales_lines", "mart_daily_sales"}, "dim_customer": {"fct_sales_lines"},
    "dim_product": {"fct_sales_lines"}, "fct_sales_lines": {"mart_daily_sales"}, "fct_payments": set(),
    "fct_sessions": {"mart_web_funnel"}, "mart_daily_sales": set(), "mart_web_funnel": set(),
}


def with_readers(selected: set[str]) -> set[str]:
    """The selected models and all that is built from them."""
    found = set(selected)
    while more := set().union(*(READERS[m] for m in found)) - found:
        found |= more
    return found


def assert_full_refresh_together(selected: set[str]) -> None:
    """A dimension may only be rebuilt from scratch, with new keys, together with everything that holds its keys."""
    lacking = with_readers(selected & (DIMS - {"dim_date"})) - set(selected) - MARTS
    if lacking:
        raise ValueError(f"full refresh of dimensions needs {sorted(lacking)} as well")


# ---------------------------------------------------------------- raw
def landing_paths(landing: str) -> dict[str, tuple[str, str, str | None]]:
    """raw table -> (folder, format, schema)"""
    pos = {f"pos_{t}": (f"{landing}/pos/pos/{t}", "parquet", src.cdc_schema(t)) for t in POS_COLUMNS}
    return {
        **pos,
        "clickstream_events": (f"{landing}/clickstream/events", "json", None),
        "catalog_products": (f"{landing}/catalog/products", "csv", None),
    }


def load_raw(spark: SparkSession, landing: str, warehouse: str) -> dict[str, int]:
    """New landing files per raw table; the tables load side by side."""

    def load(name: str, folder: str, fmt: str, schema: str | None) -> int:
        return src.ingest_new_files(spark, folder, f"{warehouse}/raw/{name}", fmt, f"{warehouse}/ledger/{name}", schema)

    with ThreadPoolExecutor(max_workers=7) as pool:
        jobs = {name: pool.submit(load, name, *source) for name, source in landing_paths(landing).items()}
        return {name: job.result() for name, job in jobs.items()}


def raw(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    path = f"{warehouse}/raw/{name}"
    return src.read_catalog(spark, path) if name == "catalog_products" else src.read_raw(spark, path)


def freshness(spark: SparkSession, warehouse: str, now: dt.datetime) -> DataFrame:
    """The age of each raw table's newest load, from file footers."""
    parts = []
    for name in landing_paths(""):
        warn, error = FRESHNESS.get(name, FRESHNESS["default"])
        parts.append(check_freshness(src.newest_load(spark, f"{warehouse}/raw/{name}"), name, now, warn, error))
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- run
class _Run:
    """One run; the models in `full` are rebuilt from scratch, the others merge the news."""

    def __init__(self, spark: SparkSession, warehouse: str, settings: Settings, full: set[str]):
        self.spark, self.warehouse, self.s, self.full = spark, warehouse, settings, full
        self.out: dict[str, DataFrame] = {}
        self.retired: dict[str, DataFrame] = {}  # surrogate keys of versions that a late change removed
        self.changed: dict[str, DataFrame | None] = {}  # rows of the facts that came or went

    def path(self, name: str) -> str:
        return f"{self.warehouse}/{name}"

    def raw(self, name: str) -> DataFrame:
        return raw(self.spark, self.warehouse, name)

    def is_full(self, path: str) -> bool:
        return path in self.full or path.split("/")[-1] in self.full

    def since(self, name: str, lookback=dt.timedelta(0)) -> dt.datetime | None:
        return None if self.is_full(name) else tables.table_watermark(self.spark, self.path(name), lookback)

    def done(self, name: str, df: DataFrame, merged: tables.Merge | None = None, path: str = "", by: list[str] = (),
             observed: Observed | None = None) -> None:
        """Registers a model and runs its checks before anything that reads it.

        After a merge the rows of the keys in which something changed are checked, read once from their days; the
        others were when they came. Row checks that were `observed` in the write are not counted again.
        """
        self.out[name] = df
        if not self.s.checks:
            return
        if merged is not None and merged.changed is not None:
            keys = merged.changed.select(*by).dropna()
            df = None if keys.isEmpty() else freeze(tables.rows_of(self.spark, path, keys), "touched")
        checks = [] if df is None else checks_for(name, {**self.out, name: df}, self.s.now)
        if observed is not None:
            checks = [c for c in checks if c.bad is None]
        fired = gate(run_suite(checks) if checks else None, observed.result() if observed is not None else ())
        self.s.warnings += [(r["check"], r["failures"]) for r in fired]

    def observe(self, name: str, rows: DataFrame) -> tuple[DataFrame, Observed | None]:
        if not self.s.checks:
            return rows, None
        observed = Observed(checks_for(name, {**self.out, name: rows}, self.s.now))
        return observed.watch(rows), observed

    # ---- staging
    def state(self, table: str) -> None:
        """Current state of a change log, kept as a table so that no run reads the whole history."""
        path, keys = self.path(f"state/{table}"), POS_KEYS[table]
        index, day, also = STATE_INDEX[table], STATE_DAY[table], STATE_ALSO.get(table, ())
        log = staging.stg_cdc(self.fresh(f"pos_{table}", self.since(f"state/{table}")), table)
        self.done(f"stg_{table}_cdc", log)
        merged = None
        if self.is_full(f"state/{table}"):
            df = tables.overwrite_table(self.spark, path, latest_cdc(log, keys), index, day, self.s.buckets, also, grain=self.s.grain)
        else:
            merged = merge.merge_latest(self.spark, path, log, keys, index, day, self.s.buckets, also, self.s.grain)
            df = merged.table
        self.done(f"stg_{table}", df, merged, path, index)

    def fresh(self, name: str, since) -> DataFrame:
        return tables.loaded_after(self.raw(name), since)

    def events(self) -> None:
        path = self.path("state/events")
        log = staging.stg_event_log(self.fresh("clickstream_events", self.since("state/events")))
        merged = None
        if self.is_full("state/events"):
            df = tables.overwrite_table(self.spark, path, dedupe_events(log), merge.EVENT_KEYS, "event_ts", self.s.buckets,
                                        merge.EVENT_INDEXES, grain=self.s.grain)
        else:
            merged = merge.merge_events(self.spark, path, log, self.s.buckets, self.s.grain)
            df = merged.table
        self.done("stg_events", df, merged, path, merge.EVENT_KEYS)

    def views(self) -> None:
        """The small dimensions' sources stay views over raw."""
        for t in ("stores", "customers"):
            log = staging.stg_cdc(self.raw(f"pos_{t}"), t)
            self.done(f"stg_{t}_cdc", log)
            self.done(f"stg_{t}", latest_cdc(log, POS_KEYS[t]))
        self.done("raw_products", self.raw("catalog_products"))
        self.done("stg_products", staging.stg_products(self.raw("catalog_products")))

    # ---- dimensions
    def dimension(self, name: str, source: str, key: str, version: str, versions, unknown: dict) -> None:
        path, sk = self.path(f"core/{name}"), f"{name[4:]}_sk"
        rows, since = self.out[source], self.since(f"core/{name}")
        if since is not None:
            rows = rows.join(scd2.changed_keys(rows, key, since), key, "left_semi")
        rebuilt = versions(rows)
        if self.is_full(name):
            keyed = scd2.with_unknown_member(assign_surrogate_keys(rebuilt, key, version, sk), unknown)
            df = tables.overwrite_table(self.spark, path, keyed, [key], version, self.s.buckets, number=sk, grain=self.s.grain)
        else:
            merged = merge.merge_dim(self.spark, path, rebuilt, key, version, sk, unknown, self.s.buckets, self.s.grain)
            df, self.changed[name] = merged.table, merged.changed
            if merged.changed is not None:   # of the rows that came or went, those that are there no more
                gone = merged.changed.select(sk).distinct().join(df, sk, "left_anti")
                if not gone.isEmpty():
                    self.retired[sk] = gone
        self.done(name, df)

    def dimensions(self) -> None:
        start, end = self.s.calendar()
        self.done("dim_date", tables.overwrite_table(
            self.spark, self.path("core/dim_date"), dim_date(self.spark, start, end)))
        together(
            partial(self.dimension, "dim_store", "stg_stores_cdc", "store_id", "version_ts", scd2.store_versions, scd2.UNKNOWN_STORE),
            partial(self.dimension, "dim_customer", "stg_customers_cdc", "customer_id", "version_ts", scd2.customer_versions,
                    scd2.UNKNOWN_CUSTOMER),
            partial(self.dimension, "dim_product", "stg_products", "sku", "version_date", scd2.product_versions,
                    scd2.UNKNOWN_PRODUCT))

    # ---- facts
    def store_fact(self, name: str, rows: DataFrame, keys: list[str], index: list[str], day: str,
                   also: list[list[str]] = (), check_by: list[str] | None = None) -> None:
        """`check_by` names the key table by which rows are read for the checks, if that is not the index."""
        path, merged = self.path(f"core/{name}"), None
        rows, observed = self.observe(name, rows)
        if self.is_full(name):
            df = tables.overwrite_table(self.spark, path, rows, index, day, self.s.buckets, also, grain=self.s.grain)
        else:
            merged = merge.merge_fact(self.spark, path, rows, keys, index, day, self.s.buckets, self.s.grain, also)
            df, self.changed[name] = merged.table, merged.changed
        self.done(name, df, merged, path, check_by or index, observed)

    def sales_lines(self) -> None:
        headers, lines = self.out["stg_transactions"], self.out["stg_transaction_lines"]
        since = self.since("core/fct_sales_lines", self.s.sales_lookback)
        if since is not None:
            # Raw is stored by load day, so the changed sales come from its newest folders, and
            # the current-state tables are read only in the days that hold those sales.
            changed = facts.changed_transactions(
                staging.stg_cdc(self.fresh("pos_transactions", since), "transactions"),
                staging.stg_cdc(self.fresh("pos_transaction_lines", since), "transaction_lines"), None,
            )
            stored = tables.read_table(self.spark, self.path("core/fct_sales_lines"))
            for sk, gone in self.retired.items():
                # No fact may keep the number of a version that is gone.
                changed = changed.union(stored.join(gone, sk, "left_semi").select("transaction_id"))
            changed = freeze(changed.dropna().distinct(), "changed")
            headers = self.restrict("state/transactions", changed)
            lines = self.restrict("state/transaction_lines", changed)
        dims = {d: self.out[f"dim_{d}"] for d in ("date", "product", "customer", "store")}
        hot = {
            "transaction_id": stored_hot_keys(self.out["stg_transaction_lines"], "transaction_id"),
            "customer_id": stored_hot_keys(dims["customer"], "customer_id", min_rows=10_000),
            "store_id": stored_hot_keys(dims["store"], "store_id", min_rows=10_000),
        }
        rows = facts.fct_sales_lines(headers, lines, dims, hot=hot)
        self.store_fact("fct_sales_lines", rows, facts.LINE_KEYS, ["transaction_id"], "txn_date")

    def restrict(self, table: str, keys: DataFrame) -> DataFrame:
        return tables.rows_of(self.spark, self.path(table), keys)

    def payments(self) -> None:
        since = self.since("core/fct_payments", self.s.sales_lookback)
        payments, headers = self.out["stg_payments"], self.out["stg_transactions"]
        if since is not None:
            # As for the lines: the news is in raw's newest folders, and payments and headers come from their days.
            news = staging.stg_cdc(self.fresh("pos_payments", since), "payments").select("payment_id", "transaction_id")
            changed = facts.changed_transactions(
                staging.stg_cdc(self.fresh("pos_transactions", since), "transactions"), news, None)
            changed = freeze(changed.dropna(), "changed")
            headers = self.restrict("state/transactions", changed)
            of_sales = self.restrict("state/payments", changed)
            # A deleted tender lost its transaction_id, so it is found by its own.
            lost = self.restrict("state/payments", freeze(news.select("payment_id").dropna().distinct(), "tenders"))
            payments = of_sales.unionByName(lost.where("transaction_id is null"))
        rows = facts.fct_payments(payments, headers, hot=stored_hot_keys(self.out["stg_payments"], "transaction_id"))
        self.store_fact("fct_payments", rows, ["payment_id"], ["payment_id"], "txn_date",
                        also=[["transaction_id"]], check_by=["transaction_id"])

    def sessions(self) -> None:
        since = self.since("core/fct_sessions", self.s.clickstream_lookback)
        events, sales = self.out["stg_events"], self.out["stg_transactions"]
        if since is not None:
            touched = staging.stg_event_log(self.fresh("clickstream_events", since)).select("session_id").dropna().distinct()
            events = freeze(self.restrict("state/events", freeze(touched, "touched")), "events")
            orders = events.select(F.col("order_id").alias("transaction_id")).dropna().distinct()
            sales = self.restrict("state/transactions", freeze(orders, "orders"))
        rows = facts.fct_sessions(events, sales)
        self.store_fact("fct_sessions", rows, ["session_id"], ["session_id"], "session_start")

    def mart(self, name: str, fact: str, at: str, day: str, build: Callable[[DataFrame], DataFrame]) -> None:
        """Rebuilds the days of rows that came or went, or the whole mart where that is not known.

        `at` is the fact's column whose date is the mart's `day`.
        """
        path, changed = self.path(f"marts/{name}"), self.changed.get(fact)
        if changed is None or tables.table_schema(self.spark, path) is None:
            df = tables.overwrite_table(self.spark, path, build(self.out[fact]), day=day, grain=self.s.grain)
        else:
            days = [r[0] for r in changed.select(F.to_date(at)).distinct().collect()]   # at most one row per day
            df = tables.read_table(self.spark, path)
            if days:
                df = tables.replace_values(self.spark, path, build(of_days(self.out[fact], at, days)), day, days, self.s.grain)
        self.out[name] = df

    def marts(self) -> None:
        renamed = self.changed.get("dim_store")
        daily = self.path("marts/mart_daily_sales")
        if renamed is not None and tables.table_schema(self.spark, daily) is not None and not renamed.isEmpty():
            # Stores have other names or regions: the mart, small beside the fact, takes them over.
            named = marts.with_current_stores(tables.read_table(self.spark, daily), self.out["dim_store"])
            tables.overwrite_table(self.spark, daily, freeze(named, "named"), day="txn_date", grain=self.s.grain)
        self.mart("mart_daily_sales", "fct_sales_lines", "txn_date", "txn_date",
                  lambda rows: marts.mart_daily_sales(rows, self.out["dim_store"]))
        self.mart("mart_web_funnel", "fct_sessions", "session_start", "session_date", marts.mart_web_funnel)
        for name in sorted(MARTS):
            self.done(name, self.out[name])

    def sources(self) -> None:
        """Stops a run whose raw tables are out of date, before any model is built."""
        if not self.s.checks:
            return
        rows = freshness(self.spark, self.warehouse, self.s.now).where("status <> 'pass'").collect()   # one row per source
        late = [f"{r.table_name}: {r.age_seconds} s" for r in rows if r.status == "error"]
        if late:
            raise QualityError("out of date: " + "; ".join(late))
        self.s.warnings += [(f"{r.table_name} fresh", 1) for r in rows]

    def all(self) -> dict[str, DataFrame]:
        self.sources()
        self.views()
        together(*[partial(self.state, t) for t in STATE_INDEX], self.events)
        self.dimensions()
        together(self.sales_lines, self.payments, self.sessions)
        self.marts()
        return self.out


def stored_hot_keys(table: DataFrame, key: str, min_rows: int = 1_000_000) -> DataFrame | None:
    """`hot_keys` of a stored table: its footers tell how many keys can have so many rows at all, and no join is computed
    for it. Rows that a run leaves out may make a key hot, which changes no result."""
    most = table.count() // min_rows
    return hot_keys(table, key, min_rows, min(10 * most, MAX_HOT_KEYS)) if most else None


def together(*steps: Callable[[], None]) -> None:
    """Runs models that do not need each other side by side; their jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for job in [pool.submit(s) for s in steps]:
            job.result()


def of_days(fact: DataFrame, at: str, days: list[dt.date]) -> DataFrame:
    """The rows of the given dates; their range is a filter that reaches the scan."""
    known = [d for d in days if d is not None]
    first, after = (min(known), max(known) + dt.timedelta(days=1)) if known else (None, None)
    near = (F.col(at) >= F.lit(str(first)).cast("timestamp_ntz")) & (F.col(at) < F.lit(str(after)).cast("timestamp_ntz"))
    if fact.schema[at].dataType.typeName() == "date":
        near = (F.col(at) >= F.lit(first)) & (F.col(at) < F.lit(after))
    hit = near & F.to_date(at).isin(known) if known else F.lit(False)
    return fact.where(hit | F.col(at).isNull() if None in days else hit)


def run_full(spark: SparkSession, landing: str, warehouse: str, settings: Settings) -> dict[str, DataFrame]:
    """Loads new files and rebuilds every table from raw, dimensions and facts together."""
    return run_refresh(spark, landing, warehouse, settings, STATES | DIMS | FACTS | MARTS)


def run_incremental(spark: SparkSession, landing: str, warehouse: str, settings: Settings) -> dict[str, DataFrame]:
    """Loads new files and merges what they change. A second run without new files changes nothing."""
    return run_refresh(spark, landing, warehouse, settings, set())


def run_refresh(spark: SparkSession, landing: str, warehouse: str, settings: Settings, models: set[str]) -> dict[str, DataFrame]:
    """Loads new files, rebuilds the selected models and all that is built from them, and merges the news into the others.

    A dimension that is rebuilt gets new keys, and so the facts that hold them are keyed again with it.
    """
    full = {m for m in models if m in STATES} | with_readers({m for m in models if m not in STATES})
    assert_full_refresh_together(full & set(READERS))
    load_raw(spark, landing, warehouse)
    return _Run(spark, warehouse, settings, full).all()
