import datetime as dt
import gzip
import json
import os
import shutil
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from helpers import rows
from shelfline.operators import quality, tables
from shelfline.operators.staging import stg_cdc, stg_event_log
from shelfline.sources import landing

TARGET = "sku STRING, product_name STRING, list_price DECIMAL(10,2), is_active BOOLEAN, pack_size STRING"


def put(path, text):
    path = Path(str(path).removeprefix("file:"))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_is_matched_by_name(spark, folder):
    files = [
        put(f"{folder}/dt=2025-01-01/a.csv", 'sku,product_name,list_price,is_active\n0042,"Milk, whole",1.50,true\n'),
        put(f"{folder}/dt=2025-01-02/a.csv", 'Is_Active,PACK_SIZE,sku,surprise,list_price,product_name\nfalse,6,0043,x,2.00,Egg\n'),
        put(f"{folder}/dt=2025-01-03/a.csv", 'sku,product_name,list_price,is_active\n0044,"say ""hi"""\n0045,Tea,cheap,true\n'),
        put(f"{folder}/dt=2025-01-04/a.csv", ''),
    ]
    got = landing.read_csv_by_name(spark, files, TARGET, folder)
    assert rows(got, "sku", "product_name", "list_price", "is_active", "pack_size") == [
        ("0042", "Milk, whole", Decimal("1.50"), True, None), ("0043", "Egg", Decimal("2.00"), False, "6"),
        ("0044", 'say "hi"', None, None, None), ("0045", "Tea", None, True, None)]
    assert {r._file for r in got.collect()} == {f"dt=2025-01-0{i}/a.csv" for i in (1, 2, 3)}
    drift = landing.check_schema_drift(spark, files[:3], TARGET, folder)
    assert rows(drift) == [("dt=2025-01-01/a.csv", "pack_size", ""), ("dt=2025-01-02/a.csv", "", "surprise"),
                           ("dt=2025-01-03/a.csv", "pack_size", "")]
    assert landing.read_csv_by_name(spark, [], TARGET).count() == 0


def test_csv_files_load_once(spark, folder):
    args = (spark, f"{folder}/in", f"{folder}/raw", "csv", f"{folder}/ledger", TARGET)
    assert landing.ingest_new_files(*args) == 0                       # nothing has landed yet
    put(f"{folder}/in/dt=2025-01-01/a.csv", "sku,list_price\nS1,1\n")
    assert landing.ingest_new_files(*args) == 1
    put(f"{folder}/in/dt=2025-01-02/a.csv", "list_price,sku,pack_size\n2,S2,9\n")
    assert landing.ingest_new_files(*args) == 1
    assert landing.ingest_new_files(*args) == 0
    got = landing.read_catalog(spark, f"{folder}/raw", TARGET)
    assert rows(got, "sku", "list_price", "pack_size") == [("S1", Decimal("1.00"), None), ("S2", Decimal("2.00"), "9")]


def event_file(path, *events):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress("\n".join(json.dumps(e) for e in events).encode()))


def test_json_files_load_once_and_keep_unknown_fields(spark, folder):
    args = (spark, f"{folder}/in", f"{folder}/raw", "json", f"{folder}/ledger")
    event = {"event_id": "e1", "event_ts": "2025-01-01T10:00:00.123Z", "customer_id": 5, "new_field": {"a": 1}}
    event_file(f"{folder}/in/dt=2025-01-01/hh=10/a.json.gz", event, {**event, "event_id": "e2", "event_ts": "?"})
    assert landing.ingest_new_files(*args) == 1
    assert landing.ingest_new_files(*args) == 0
    event_file(f"{folder}/in/dt=2025-01-01/hh=11/b.json.gz", {"event_id": "e3"})
    assert landing.ingest_new_files(*args) == 1
    raw = landing.read_raw(spark, f"{folder}/raw")
    assert rows(stg_event_log(raw), "event_id", "event_ts", "customer_id") == [
        ("e1", dt.datetime(2025, 1, 1, 10, 0, 0, 123000), 5), ("e2", None, 5), ("e3", None, None)]
    assert rows(raw.selectExpr("_file").distinct()) == [("dt=2025-01-01/hh=10/a.json.gz",), ("dt=2025-01-01/hh=11/b.json.gz",)]
    assert raw.selectExpr("variant_get(record, '$.new_field.a', 'int') a").where("a = 1").count() == 2


def test_parquet_files_load_once(spark, folder):
    args = (spark, f"{folder}/in", f"{folder}/raw", "parquet", f"{folder}/ledger", landing.cdc_schema("payments"))
    for day, op in (("01", "I"), ("02", "D")):
        spark.createDataFrame([(f"p{day}", Decimal("1.25"), op, dt.datetime(2025, 1, 1))],
                              "payment_id STRING, amount DECIMAL(12,2), Op STRING, _dms_commit_ts TIMESTAMP_NTZ"
                              ).coalesce(1).write.parquet(f"{folder}/in/2025/01/{day}")
        assert landing.ingest_new_files(*args) == 1
    assert landing.ingest_new_files(*args) == 0
    assert landing.newest_load(spark, f"{folder}/raw").first()[0] == landing.read_raw(spark, f"{folder}/raw").first()._loaded_at
    got = stg_cdc(landing.read_raw(spark, f"{folder}/raw"), "payments")
    assert rows(got, "payment_id", "transaction_id", "amount", "cdc_operation") == [
        ("p01", None, Decimal("1.25"), "INSERT"), ("p02", None, Decimal("1.25"), "DELETE")]


def test_csv_with_blank_first_lines_and_without_rows(spark, folder):
    args = (spark, f"{folder}/in", f"{folder}/raw", "csv", f"{folder}/ledger", TARGET)
    put(f"{folder}/in/dt=2025-01-01/a.csv", "\n  \nsku,list_price\nS1,1\n")
    put(f"{folder}/in/dt=2025-01-02/a.csv", "sku,list_price\n")
    put(f"{folder}/in/dt=2025-01-03/a.csv", "\n")
    assert landing.ingest_new_files(*args) == 3
    assert landing.ingest_new_files(*args) == 0
    assert rows(landing.read_catalog(spark, f"{folder}/raw", TARGET), "sku", "list_price") == [("S1", Decimal("1.00"))]


def test_headers_of_many_files_take_one_job(spark, folder):
    for k in range(200):
        put(f"{folder}/in/{k:03d} é.csv", f"sku,c{k % 3}\nS{k},x\n")
    files = tables.list_files(spark, f"{folder}/in", ".csv")
    spark.sparkContext.setJobGroup("headers", "headers")
    found = landing.csv_headers(spark, files)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setJobGroup("rest", "rest")
    assert len(found) == 200 and all(h[0] == "sku" and len(h) == 2 for h in found.values()) and len(jobs) <= 3


def test_columns_beyond_the_contract_stay(spark, folder):
    args = (spark, f"{folder}/in", f"{folder}/raw", "parquet", f"{folder}/ledger", landing.cdc_schema("payments"))
    for day, extra in (("01", ""), ("02", ", new_col STRING")):
        row = (f"p{day}", Decimal("1.25"), "I", dt.datetime(2025, 1, 1), *(["EUR"] if extra else []))
        spark.createDataFrame([row], f"payment_id STRING, amount DECIMAL(12,2), Op STRING, _dms_commit_ts TIMESTAMP_NTZ{extra}"
                              ).coalesce(1).write.parquet(f"{folder}/in/2025/01/{day}")
        assert landing.ingest_new_files(*args) == 1
    raw = landing.read_raw(spark, f"{folder}/raw")
    kept = raw.selectExpr("variant_get(record, '$.payment_id', 'string') p", "variant_get(record, '$.new_col', 'string') c")
    assert rows(kept) == [("p01", None), ("p02", "EUR")]


def test_an_old_file_that_comes_late_keeps_its_columns(spark, folder):
    """A delivery copied with its times: the file is older than all that have been loaded."""
    args = (spark, f"{folder}/in", f"{folder}/raw", "parquet", f"{folder}/ledger", landing.cdc_schema("payments"))
    ddl = "payment_id STRING, amount DECIMAL(12,2), Op STRING, _dms_commit_ts TIMESTAMP_NTZ"
    row = ("p1", Decimal("1.25"), "I", dt.datetime(2025, 1, 1))
    spark.createDataFrame([row], ddl).coalesce(1).write.parquet(f"{folder}/in/1")
    assert landing.ingest_new_files(*args) == 1
    spark.createDataFrame([(*row, "EUR")], ddl + ", currency STRING").coalesce(1).write.parquet(f"{folder}/late/2 {{x}}")
    for file in Path(f"{folder}/late".removeprefix("file:")).rglob("*.parquet"):
        os.utime(file, (1_600_000_000, 1_600_000_000))
    Path(f"{folder}/late/2 {{x}}".removeprefix("file:")).rename(f"{folder}/in/2 {{x}}".removeprefix("file:"))
    assert landing.ingest_new_files(*args) == 1 and landing.ingest_new_files(*args) == 0
    kept = landing.read_raw(spark, f"{folder}/raw").selectExpr("variant_get(record, '$.currency', 'string') c", "_file")
    assert {r.c for r in kept.collect()} == {None, "EUR"} and any("/2 {x}/" in f"/{r._file}" or "2%20" in r._file for r in kept.collect())


def test_a_batch_that_is_run_again_replaces_its_rows(spark, folder):
    args = (spark, f"{folder}/in", f"{folder}/raw", "json", f"{folder}/ledger")
    event_file(f"{folder}/in/a.json.gz", {"event_id": "e1"})
    assert landing.ingest_new_files(*args) == 1
    shutil.rmtree(Path(f"{folder}/ledger/commits".removeprefix("file:")))   # as if it had died before its commit
    assert landing.ingest_new_files(*args) == 1
    assert landing.read_raw(spark, f"{folder}/raw").count() == 1


def test_sessions_stream_before_any_sale(spark, folder):
    from shelfline.streaming import live
    event_file(f"{folder}/clickstream/events/a.json.gz",
               {"event_id": "e1", "event_ts": "2025-01-01T10:00:00Z", "session_id": "s1", "event_type": "purchase", "order_id": "T9"})
    live.stream_sessions(spark, folder, f"{folder}/warehouse", f"{folder}/checkpoint", buckets=2).awaitTermination()
    got = tables.read_table(spark, f"{folder}/warehouse/core/fct_sessions")
    assert rows(got, "session_id", "pos_order_found") == [("s1", False)]


def test_dedupe_stream_loses_nothing_late(spark, folder):
    """One file a batch: a copy ten hours after the first, and an event far behind the newest."""
    from shelfline.streaming import live
    schema = "event_id STRING, session_id STRING, event_ts TIMESTAMP, _loaded_at TIMESTAMP, _file STRING"
    start = dt.datetime(2025, 1, 1)
    for k, (event, hour) in enumerate([("A", 0), ("B", 20), ("A", 10), ("LATE", 1), ("C", 21)]):
        at = start + dt.timedelta(hours=hour)
        spark.createDataFrame([(event, "s", start, at, f"f{k}")], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    live.dedupe_stream(stream, f"{folder}/events", f"{folder}/checkpoint", buckets=2).awaitTermination()
    assert rows(tables.read_table(spark, f"{folder}/events"), "event_id") == [("A",), ("B",), ("C",), ("LATE",)]


def test_values_without_a_place_are_rescued(spark, folder):
    put(f"{folder}/in/a.csv", "sku,List_Price,colour,colour\nS1,abc,red,\nS2,1.5, ,\nS3,,,blue\n")
    args = (spark, f"{folder}/in", f"{folder}/raw", "csv", f"{folder}/ledger", TARGET)
    assert landing.ingest_new_files(*args) == 1
    got = landing.read_catalog(spark, f"{folder}/raw", TARGET)
    texts = got.select("sku", F.to_json(landing.RESCUED).alias("r"))
    assert rows(texts) == sorted([("S1", '{"List_Price":"abc","colour":"red"}'), ("S2", None), ("S3", '{"colour 2":"blue"}')], key=repr)
    assert landing.newest_load(spark, f"{folder}/raw").first()[0] == got.first()._loaded_at   # beside nested columns
    check = quality.expression("nothing rescued", got, "_rescued is null", "warn")
    assert [r.failures for r in quality.run_suite([check]).collect()] == [2]


def test_newest_load_comes_from_footers(spark, folder):
    assert landing.newest_load(spark, f"{folder}/none").first()[0] is None
    for day in (1, 3, 2):
        at = dt.datetime(2025, 1, day, 7)
        row = spark.createDataFrame([(at,), (at - dt.timedelta(hours=1),)], "_loaded_at TIMESTAMP")
        row.select(F.unix_micros("_loaded_at").alias(landing.LOADED_US), F.to_date("_loaded_at").alias("_load_date")
                   ).coalesce(1).write.mode("append").partitionBy("_load_date").parquet(f"{folder}/raw")
    newest = landing.newest_load(spark, f"{folder}/raw")
    assert newest.first()[0] == dt.datetime(2025, 1, 3, 7)
    plan = newest._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(_loaded_us)]" in plan and "_load_date=2025-01-03" not in plan.split("PartitionFilters: []")[-1]
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_copies_are_dropped_with_bounded_state(spark, folder):
    """A copy within the time is dropped; long after it the state has let go of the event."""
    from shelfline.streaming import live
    schema = "event_id STRING, _loaded_at TIMESTAMP"
    start, kept_rows = dt.datetime(2025, 1, 1), []
    for hour, events in [(0, "AB"), (1, "AC"), (30, "D"), (60, "E"), (90, "A")]:
        at = start + dt.timedelta(hours=hour)
        spark.createDataFrame([(e, at) for e in events], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        query = live.drop_copies_within(spark.readStream.schema(schema).parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/ck", "12 hours")
        query.awaitTermination()
        kept_rows.append([o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]][-1])
    assert rows(spark.read.parquet(f"{folder}/out"), "event_id") == [(e,) for e in "AABCDE"]
    assert max(kept_rows[1:2]) == 3 and kept_rows[-1] <= 2
