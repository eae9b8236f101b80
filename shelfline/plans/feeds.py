"""Landing feeds derived from the driver's order tables.

The given tables are a plain order schema. These adapters restate them as the change logs, events
and snapshots the operators take, with known defects planted by integer arithmetic. The text is
plain SQL with a few dialect helpers, because the checks run the same adapters in DuckDB.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.functions.columns import cdc_operation
from shelfline.operators.tables import list_names
from shelfline.session import STORED, freeze, shuffles_dropped
from shelfline.sources.contracts import POS_COLUMNS, POS_KEYS, fields

SOURCE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


class SparkDialect:
    @staticmethod
    def plus(ts: str, n: str, unit: str) -> str:
        return f"timestampadd({unit}, {n}, {ts})"

    @staticmethod
    def ts(text: str) -> str:
        return f"timestamp_ntz '{text}'"

    @staticmethod
    def year_start(ts: str) -> str:
        return f"cast(date_trunc('YEAR', {ts}) AS timestamp_ntz)"

    @staticmethod
    def path_day(ts: str) -> str:
        return f"date_format({ts}, 'yyyy/MM/dd')"

    @staticmethod
    def iso_day(ts: str) -> str:
        return f"date_format({ts}, 'yyyy-MM-dd')"

    @staticmethod
    def counted(table: str, last: str) -> str:
        """Each row of `table` once per v = 0..last."""
        return f"(SELECT t.*, x.v FROM {table} t LATERAL VIEW explode(sequence(0, cast({last} AS int))) x AS v)"


class DuckDialect:
    @staticmethod
    def plus(ts: str, n: str, unit: str) -> str:
        return f"({ts} + to_{unit.lower()}s(cast({n} AS int)))"

    @staticmethod
    def ts(text: str) -> str:
        return f"timestamp '{text}'"

    @staticmethod
    def year_start(ts: str) -> str:
        return f"cast(date_trunc('year', {ts}) AS timestamp)"

    @staticmethod
    def path_day(ts: str) -> str:
        return f"strftime({ts}, '%Y/%m/%d')"

    @staticmethod
    def iso_day(ts: str) -> str:
        return f"strftime({ts}, '%Y-%m-%d')"

    @staticmethod
    def counted(table: str, last: str) -> str:
        return f"(SELECT t.*, unnest(range(0, cast({last} AS int) + 1)) AS v FROM {table} t)"


def transaction_id(key: str) -> str:
    return f"('T' || lpad(cast({key} AS string), 10, '0'))"


def sku_of(key: str) -> str:
    return f"('SKU-' || lpad(cast({key} AS string), 9, '0'))"


def _status(key: str) -> str:
    return f"CASE WHEN {key} % 100 = 1 THEN 'voided' WHEN {key} % 100 IN (2, 3) THEN 'returned' ELSE 'completed' END"


def _net(alias: str = "") -> str:
    a = alias + "." if alias else ""
    return f"{a}quantity * {a}unit_price - {a}discount_amount"


def stores_feed(d) -> str:
    commit = d.plus(d.plus(d.ts("1995-01-01 00:00:00"), "v * 400", "DAY"), "s_suppkey % 1440", "MINUTE")
    shape = "(s_suppkey + CASE WHEN v = 0 THEN 0 ELSE 1 END) % 3"
    opened = d.plus(d.ts("1985-01-01 00:00:00"), "s_suppkey % 3650", "DAY")
    return f"""
    SELECT s_suppkey + 1 AS store_id, s_name AS store_name,
           CASE r_regionkey WHEN 0 THEN 'north' WHEN 1 THEN 'south' WHEN 2 THEN 'east' ELSE 'west' END AS region,
           CASE {shape} WHEN 0 THEN 'hyper' WHEN 1 THEN 'express' ELSE 'outlet' END AS format,
           cast({opened} AS date) AS open_date, {commit} AS updated_at,
           CASE WHEN v = 0 THEN 'I' ELSE 'U' END AS op, {commit} AS _dms_commit_ts,
           'pos/pos/stores/' || {d.path_day(commit)} || '/cdc.parquet' AS _file,
           {d.plus(commit, "5", "MINUTE")} AS _loaded_at
    FROM {d.counted("supplier", "t.s_suppkey % 3")} s
    JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
    UNION ALL
    SELECT cast(0 AS bigint), 'Online', 'online', 'online', date '1985-01-01', {d.ts("1995-01-01 00:00:00")}, 'I',
           {d.ts("1995-01-01 00:00:00")}, 'pos/pos/stores/1995/01/01/cdc.parquet', {d.ts("1995-01-01 00:05:00")}"""


def customers_feed(d) -> str:
    commit = d.plus(d.plus(d.ts("1995-01-01 00:00:00"), "v * 300", "DAY"), "c_custkey % 1440", "MINUTE")
    signup = d.plus(d.ts("1994-01-01 00:00:00"), "c_custkey % 8000", "HOUR")
    meta = f"""'pos/pos/customers/' || {d.path_day(commit)} || '/cdc.parquet' AS _file,
           {d.plus(commit, "5", "MINUTE")} AS _loaded_at"""

    def version(tier: str, op: str, changed: str) -> str:
        return f"""SELECT c_custkey AS customer_id,
           CASE WHEN c_custkey % 200 = 0 THEN NULL ELSE c_name END AS email,
           CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '+1-' || lpad(cast(c_custkey AS string), 9, '0') END AS phone,
           CASE ({tier}) % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS loyalty_tier,
           1 + c_custkey % (SELECT count(*) FROM supplier) AS home_store_id,
           {signup} AS signup_at, {changed} AS updated_at, {op} AS op, {commit} AS _dms_commit_ts, {meta}"""

    steps = "c_custkey + cast(floor(v / 2) AS int)"
    gone = "cast(NULL AS string)"
    return f"""
    {version(steps, "CASE WHEN v = 0 THEN 'I' ELSE 'U' END", commit)}
    FROM {d.counted("customer", "t.c_custkey % 4")} c
    UNION ALL
    {version("c_custkey + 2", "'U'", d.plus(commit, "1", "SECOND"))}
    FROM (SELECT *, 0 AS v FROM customer) c WHERE c_custkey % 50 = 5
    UNION ALL
    SELECT c_custkey, {gone}, {gone}, {gone}, cast(NULL AS bigint), cast(NULL AS timestamp_ntz),
           cast(NULL AS timestamp_ntz), 'D', {commit}, {meta}
    FROM (SELECT *, c_custkey % 4 + 1 AS v FROM customer) c WHERE c_custkey % 97 = 0"""


def lines_feed(d) -> str:
    commit = d.year_start("l_shipdate")
    price = "cast(p_retailprice AS decimal(10,2))"
    removed = d.ts("2002-01-01 00:00:00")
    return f"""
    SELECT {transaction_id("l_orderkey")} AS transaction_id, l_linenumber AS line_no,
           CASE WHEN l_orderkey % 300 = 7 THEN 'SKU-X' || lpad(cast(l_partkey % 10000 AS string), 9, '0')
                ELSE {sku_of("l_partkey")} END AS sku,
           CASE WHEN l_orderkey % 200 = 11 THEN -1 ELSE cast(l_quantity AS int) END AS quantity,
           CASE WHEN l_orderkey % 200 = 13 THEN cast(0 AS decimal(10,2)) ELSE {price} END AS unit_price,
           cast(cast(l_quantity AS int) * {price} * cast(l_discount AS decimal(4,2)) AS decimal(10,2)) AS discount_amount,
           CASE WHEN l_linenumber % 3 = 0 THEN 'PROMO' || cast(l_linenumber AS string) END AS promo_code,
           CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'U' END AS op, {commit} AS _dms_commit_ts,
           'pos/pos/transaction_lines/' || {d.path_day("l_shipdate")} || '/cdc.parquet' AS _file,
           {d.plus(commit, "5", "MINUTE")} AS _loaded_at
    FROM lineitem JOIN part ON p_partkey = l_partkey
    UNION ALL
    SELECT DISTINCT {transaction_id("l_orderkey")}, l_linenumber, cast(NULL AS string), cast(NULL AS int),
           cast(NULL AS decimal(10,2)), cast(NULL AS decimal(10,2)), cast(NULL AS string), 'D', {removed},
           'pos/pos/transaction_lines/2002/01/01/cdc.parquet', {d.plus(removed, "5", "MINUTE")}
    FROM lineitem WHERE l_orderkey % 2000 = 0"""


def lines_sold(d) -> str:
    """Lines as they were sold, newest version each; needs the CTE lines_cdc."""
    return """
    SELECT transaction_id, quantity, unit_price, discount_amount FROM (
        SELECT *, row_number() OVER (PARTITION BY transaction_id, line_no
            ORDER BY _dms_commit_ts DESC, _file DESC, CASE WHEN op = 'U' THEN 2 ELSE 1 END DESC,
                     sku DESC, quantity DESC, unit_price DESC, discount_amount DESC, promo_code DESC) AS nth
        FROM lines_cdc WHERE op IS NULL OR op <> 'D') ranked WHERE nth = 1"""


def totals(d) -> str:
    """Sale totals over the lines as sold; needs the CTE lines_sold."""
    return f"""
    SELECT transaction_id, cast(sum({_net()}) AS decimal(12,2)) AS total_amount
    FROM lines_sold GROUP BY transaction_id"""


def _sale(d) -> str:
    return f"""SELECT o_orderkey AS k, {transaction_id("o_orderkey")} AS transaction_id,
           CASE WHEN o_orderkey % 10 < 3 THEN 0 ELSE 1 + o_custkey % (SELECT count(*) FROM supplier) END AS store_id,
           CASE WHEN o_orderkey % 10 >= 3 AND o_orderkey % 5 < 2 THEN NULL
                WHEN o_orderkey % 10 < 3 AND o_orderkey % 200 = 0 THEN NULL ELSE o_custkey END AS customer_id,
           CASE WHEN o_orderkey % 10 < 3 THEN 'online' ELSE 'store' END AS channel,
           {d.plus("o_orderdate", "o_orderkey % 86400", "SECOND")} AS sold_at,
           {_status("o_orderkey")} AS last_status
    FROM orders"""


def _changed_at(d) -> str:
    """When a sale was voided or returned; some voids share the commit of the sale itself."""
    wait = "CASE WHEN s.k % 200 = 1 THEN 0 WHEN s.k % 100 = 1 THEN 10 ELSE 4320 END"
    return d.plus("s.sold_at", wait, "MINUTE")


def transactions_feed(d) -> str:
    """Needs the CTEs sales and totals."""

    def row(status: str, changed: str, commit: str, op: str) -> str:
        return f"""SELECT s.transaction_id, s.store_id, s.customer_id, s.channel, s.sold_at AS txn_ts,
           {status} AS status, coalesce(t.total_amount, cast(0 AS decimal(12,2))) AS total_amount, 'USD' AS currency,
           {changed} AS updated_at, {op} AS op, {commit} AS _dms_commit_ts,
           'pos/pos/transactions/' || {d.path_day(commit)} || '/cdc.parquet' AS _file,
           {d.plus(commit, "5", "MINUTE")} AS _loaded_at
    FROM sales s LEFT JOIN totals t ON t.transaction_id = s.transaction_id"""

    removed = d.plus("s.sold_at", "30", "DAY")
    nothing = "cast(NULL AS string)"
    return f"""
    {row("'completed'", "s.sold_at", "s.sold_at", "'I'")}
    UNION ALL
    {row("s.last_status", d.plus(_changed_at(d), "1", "SECOND"), _changed_at(d), "'U'")}
    WHERE s.last_status <> 'completed'
    UNION ALL
    SELECT s.transaction_id, cast(NULL AS bigint), cast(NULL AS bigint), {nothing}, cast(NULL AS timestamp_ntz),
           {nothing}, cast(NULL AS decimal(12,2)), {nothing}, cast(NULL AS timestamp_ntz), 'D', {removed},
           'pos/pos/transactions/' || {d.path_day(removed)} || '/cdc.parquet', {d.plus(removed, "5", "MINUTE")}
    FROM sales s WHERE s.k % 2000 = 0"""


def payments_feed(d) -> str:
    """Needs the CTEs sales and totals. Some tenders are off by 0.50, some refunds are missing."""
    part = "cast(t.total_amount * 0.4 AS decimal(12,2))"
    tender = f"""
        SELECT s.*, CASE WHEN s.k % 20 <> 0 THEN t.total_amount
                         WHEN s.v = 0 THEN {part}
                         ELSE cast(t.total_amount - {part} AS decimal(12,2)) END
                    + CASE WHEN s.k % 500 = 24 THEN 0.50 ELSE 0.00 END AS paid
        FROM {d.counted("sales", "CASE WHEN t.k % 20 = 0 THEN 1 ELSE 0 END")} s
        JOIN totals t ON t.transaction_id = s.transaction_id"""
    method = "CASE s.k % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'cash' WHEN 2 THEN 'wallet' ELSE 'gift_card' END"

    def row(prefix: str, amount: str, at: str, op: str = "'I'") -> str:
        return f"""SELECT {prefix} || s.transaction_id || '-' || cast(s.v AS string) AS payment_id, s.transaction_id,
           {method} AS method, cast({amount} AS decimal(12,2)) AS amount, {at} AS created_at,
           {op} AS op, {at} AS _dms_commit_ts,
           'pos/pos/payments/' || {d.path_day(at)} || '/cdc.parquet' AS _file,
           {d.plus(at, "5", "MINUTE")} AS _loaded_at
    FROM ({tender}) s"""

    removed = d.plus("s.sold_at", "30", "DAY")
    return f"""
    {row("'P'", "s.paid", "s.sold_at")}
    UNION ALL
    {row("'R'", "-s.paid", d.plus(_changed_at(d), "1", "SECOND"))}
    WHERE s.last_status <> 'completed' AND s.paid > 0 AND s.k % 1000 <> 2
    UNION ALL
    SELECT 'P' || s.transaction_id || '-' || cast(s.v AS string), cast(NULL AS string), cast(NULL AS string),
           cast(NULL AS decimal(12,2)), cast(NULL AS timestamp_ntz), 'D', {removed},
           'pos/pos/payments/' || {d.path_day(removed)} || '/cdc.parquet', {d.plus(removed, "5", "MINUTE")}
    FROM ({tender}) s WHERE s.k % 2000 = 0"""


CATALOG_DAYS = 10


def catalog_feed(d) -> str:
    """Ten full snapshots, 90 days apart; one day was delivered twice for some products."""
    day = d.plus(d.ts("1996-01-01 00:00:00"), "p.v * 90", "DAY")

    def row(extra: str, hour: str) -> str:
        return f"""SELECT {sku_of("p_partkey")} AS sku, p_name AS product_name, p_brand AS brand, p_type AS category,
           'size-' || cast(p_size AS string) AS subcategory,
           CASE WHEN p_partkey % 100 = 7 THEN NULL
                ELSE cast(cast(p_retailprice AS decimal(10,2)) * cast(0.5 AS decimal(4,2)) AS decimal(10,2)) END AS unit_cost,
           cast(cast(p_retailprice AS decimal(10,2)) + cast({extra} AS decimal(4,2))
                + cast(0.10 AS decimal(4,2)) * cast(floor((p.v + p_partkey % 4) / 4) AS int) AS decimal(10,2)) AS list_price,
           NOT (p.v >= 7 AND p_partkey % 50 = 0) AS is_active, {day} AS supplier_updated_at,
           CASE WHEN p.v >= 5 THEN cast(1 + p_partkey % 6 AS string) END AS pack_size,
           'catalog/products/dt=' || {d.iso_day(day)} || '/products_{hour}.csv' AS _file,
           {d.plus(day, hour, "HOUR")} AS _loaded_at"""

    return f"""
    {row("0.00", "1")} FROM {d.counted("part", str(CATALOG_DAYS - 1))} p
    UNION ALL
    {row("0.05", "2")} FROM (SELECT *, 3 AS v FROM part) p WHERE p_partkey % 10 = 0"""


def events_feed(d) -> str:
    """Delivered events: late ones, and a second copy of every tenth."""
    n_orders = "(SELECT count(*) FROM orders)"
    order = transaction_id(
        f"((event_id * 10) % {n_orders} + CASE WHEN event_id % 50 = 0 THEN 5 ELSE event_id % 3 END)")
    late = "CASE WHEN event_id % 5 = 0 THEN (1 + event_id % 6) * 60 ELSE 1 END"

    def row(copy: str, wait: str) -> str:
        loaded = d.plus("ts", wait, "MINUTE")
        return f"""SELECT 'E' || lpad(cast(event_id AS string), 12, '0') AS event_id,
           CASE event_type WHEN 'click' THEN 'page_view' WHEN 'view' THEN 'product_view' WHEN 'error' THEN 'add_to_cart'
                WHEN 'signup' THEN 'checkout_started' ELSE 'purchase' END AS event_type,
           ts AS event_ts, cast(user_id AS string) || '-' || {d.iso_day("ts")} AS session_id,
           'A' || cast(user_id AS string) AS anonymous_id,
           CASE WHEN event_type IN ('signup', 'purchase') THEN user_id END AS customer_id,
           '/page/' || cast(event_id % 100 AS string) AS page_url,
           CASE WHEN event_type IN ('view', 'error') THEN {sku_of("event_id % (SELECT count(*) FROM part)")} END AS sku,
           CASE WHEN event_type = 'error' THEN cast(1 + event_id % 3 AS int) END AS quantity,
           CASE WHEN event_type = 'purchase' THEN {order} END AS order_id,
           CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'ios' ELSE 'android' END AS device,
           CASE WHEN event_id % 7 = 0 THEN 'mail' END AS utm_source,
           CASE WHEN event_id % 7 = 0 THEN 'newsletter' END AS utm_medium,
           CASE WHEN event_id % 7 = 0 THEN 'c' || cast(event_id % 5 AS string) END AS utm_campaign,
           1 AS schema_version,
           'dt=' || {d.iso_day(loaded)} || '/batch-{copy}.json.gz' AS _file, {loaded} AS _loaded_at
    FROM events"""

    return f"""
    {row("1", late)}
    UNION ALL
    {row("2", f"({late}) + 3")} WHERE event_id % 10 = 0"""


# name -> (SQL text builder, names it needs)
_CTES = {
    "stores_cdc": (stores_feed, []),
    "customers_cdc": (customers_feed, []),
    "lines_cdc": (lines_feed, []),
    "lines_sold": (lines_sold, ["lines_cdc"]),
    "totals": (totals, ["lines_sold"]),
    "sales": (_sale, []),
    "transactions_cdc": (transactions_feed, ["sales", "totals"]),
    "payments_cdc": (payments_feed, ["sales", "totals"]),
    "catalog": (catalog_feed, []),
    "events_log": (events_feed, []),
}


def with_ctes(names: list[str], d, given: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """(name, text) pairs for the named feeds and all they need, in order. `given` has texts for some of them."""
    out: dict[str, str] = dict(given or {})

    def visit(name: str) -> None:
        if name in out:
            return
        build, needs = _CTES[name]
        for n in needs:
            visit(n)
        out.setdefault(name, build(d))

    for n in names:
        visit(n)
    return list(out.items())


def duck_with(names: list[str]) -> list[tuple[str, str]]:
    return [(n, t.replace("timestamp_ntz", "timestamp")) for n, t in with_ctes(names, DuckDialect)]


# ---------------------------------------------------------------- Spark side
FEED_OF = {
    "stores": "stores_cdc", "customers": "customers_cdc", "transactions": "transactions_cdc",
    "transaction_lines": "lines_cdc", "payments": "payments_cdc",
}


_written: dict[tuple[str, str], str] = {}


def write_feeds(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Writes all feeds of a folder of tables, so that queries of this process read them instead of restating the tables."""
    for name in [*FEED_OF.values(), "catalog", "events_log"]:
        _feed(spark, sf_dir, name).write.mode("overwrite").parquet(f"{folder}/{name}")
        _written[sf_dir, name] = f"{folder}/{name}"


def sale_totals(spark: SparkSession, sf_dir: str, folder: str) -> str | None:
    """Writes the sale totals once, for the feeds of headers and of payments: each of them needs the newest version of
    every line for these two narrow columns. Returns the folder; None if both feeds are written already."""
    if {(sf_dir, FEED_OF["transactions"]), (sf_dir, FEED_OF["payments"])} <= set(_written):
        return None
    if not list_names(spark, folder):
        freeze(_statement(spark, sf_dir, "totals"), "totals", folder)
    return folder


def _statement(spark: SparkSession, sf_dir: str, name: str, given: dict[str, str] | None = None) -> DataFrame:
    feeds = with_ctes([name], SparkDialect, given)
    used = [t for t in SOURCE_TABLES if any(re.search(rf"\b{t}\b", text) for _, text in feeds)]
    files = [(t, f"SELECT * FROM parquet.`{sf_dir.rstrip('/')}/{t}.parquet`") for t in used]
    return spark.sql("WITH " + ", ".join(f"{n} AS ({t})" for n, t in [*files, *feeds]) + f" SELECT * FROM {name}")


def _feed(spark: SparkSession, sf_dir: str, name: str, totals: str | None = None) -> DataFrame:
    """A feed as one statement over the files: no view is left behind and no session state is needed."""
    if (sf_dir, name) in _written:
        return spark.read.parquet(_written[sf_dir, name])
    given = {"totals": f"SELECT * FROM parquet.`{totals}`"} if totals and "totals" in _CTES[name][1] else None
    return _statement(spark, sf_dir, name, given).withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp"))


def cdc_source(spark: SparkSession, sf_dir: str, table: str, totals: str | None = None) -> DataFrame:
    """Source rows of a change log: columns as delivered, with Op and commit time."""
    return _feed(spark, sf_dir, FEED_OF[table], totals).withColumnRenamed("op", "Op")


def raw_cdc(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The same as raw table rows (record, _file, _loaded_at)."""
    rows = cdc_source(spark, sf_dir, table)
    body = [c for c in rows.columns if c not in ("_file", "_loaded_at")]
    return rows.select(F.to_variant_object(F.struct(*body)).alias("record"), "_file", "_loaded_at")


def cdc(spark: SparkSession, sf_dir: str, table: str, totals: str | None = None) -> DataFrame:
    """Typed change log, as the staging view gives it, without the detour over variants. `totals`: see `sale_totals`."""
    rows = _feed(spark, sf_dir, FEED_OF[table], totals)
    return rows.select(
        *[F.col(n).cast(k) for n, k in fields(POS_COLUMNS[table])],
        cdc_operation(F.col("op")).alias("cdc_operation"), "_dms_commit_ts", "_file", "_loaded_at")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, "catalog")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed delivered events, copies included."""
    return _feed(spark, sf_dir, "events_log")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the producer sends them: text timestamps, one JSON object each."""
    rows = event_log(spark, sf_dir)
    iso = F.date_format(F.col("event_ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return rows.withColumn("event_ts", iso)


# ---------------------------------------------------------------- landing files
def write_landing(spark: SparkSession, sf_dir: str, landing: str, part: str, where: str | None = None,
                  tables: tuple = ("stores", "customers", "transactions", "transaction_lines", "payments"),
                  events: str | None = "true", catalog_days: str | None = "true", lines: Callable | None = None,
                  totals: str | None = None) -> None:
    """Writes one delivery: change files, event files and catalog files, filtered by SQL conditions.

    `lines`, if given, picks the rows of the sales lines instead of `where`. The changes that one commit makes to a key go to one file, so their order does not depend on
    file names.
    """
    for t in tables:
        rows = cdc_source(spark, sf_dir, t, totals)
        if t == "transaction_lines" and lines:
            rows = lines(rows)
        else:
            rows = rows.where(where) if where else rows
        body = rows.drop("_file", "_loaded_at").repartition(POS_KEYS[t][0], "_dms_commit_ts")
        with shuffles_dropped(spark):
            body.write.mode("overwrite").parquet(f"{landing}/pos/pos/{t}/{part}", compression=STORED)
    if events:
        rows = event_records(spark, sf_dir).where(events).drop("_file", "_loaded_at")
        rows.write.mode("overwrite").option("compression", "gzip").json(f"{landing}/clickstream/events/{part}")
    if catalog_days:
        write_catalog(spark, sf_dir, f"{landing}/catalog/products", part, catalog_days)


def write_catalog(spark: SparkSession, sf_dir: str, folder: str, part: str, where: str = "true") -> None:
    """CSV files per delivery and day; from the sixth day on with pack_size, and in another column order."""
    rows = catalog(spark, sf_dir).where(where).drop("_loaded_at")
    rows = (
        rows.withColumn("dt", F.regexp_extract("_file", r"dt=([0-9-]+)", 1))
        .withColumn("hour", F.regexp_extract("_file", r"products_(\d+)", 1))
        .withColumn("list_price", F.col("list_price").cast("string"))
        .withColumn("supplier_updated_at", F.date_format(F.col("supplier_updated_at").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"))
        .drop("_file")
        .hint("rebalance", "dt", "hour")
    )
    late = F.col("pack_size").isNotNull()
    early_columns = [c for c in rows.columns if c not in ("pack_size", "dt", "hour")]
    late_columns = ["pack_size", *reversed(early_columns)]
    for name, df, columns in (("early", rows.where(~late), early_columns), ("late", rows.where(late), late_columns)):
        with shuffles_dropped(spark):
            (df.select(*columns, "dt", "hour").write.mode("overwrite").partitionBy("dt", "hour")
             .option("header", "true").csv(f"{folder}/{part}-{name}", compression="gzip"))
