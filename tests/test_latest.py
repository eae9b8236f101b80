import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from shelfline.operators.latest import daily_snapshots, dedupe_events, latest_cdc
from shelfline.operators.staging import stg_cdc, stg_event_log
from shelfline.sources.contracts import CATALOG_COLUMNS

T0 = dt.datetime(2025, 3, 1, 10)
SCHEMA = "transaction_id STRING, status STRING, updated_at TIMESTAMP_NTZ, cdc_operation STRING, " \
         "_dms_commit_ts TIMESTAMP_NTZ, _file STRING, _loaded_at TIMESTAMP"


def log(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_ties_within_one_commit_are_decided(spark):
    second = dt.timedelta(seconds=1)
    df = log(spark, [
        ("a", "completed", T0, "INSERT", T0, "f", T0),
        ("a", "voided", T0, "UPDATE", T0, "f", T0),                 # update beats insert
        ("b", "x", T0, "UPDATE", T0, "f", T0),
        ("b", "y", T0 + second, "UPDATE", T0, "f", T0),             # later change time wins
        ("c", "completed", T0, "UPDATE", T0, "f", T0),
        ("c", None, None, "DELETE", T0, "f", T0),                   # delete beats all and is kept
        ("d", "old", T0, "UPDATE", T0, "f1", T0),
        ("d", "new", T0, "INSERT", T0, "f2", T0),                   # later file before kind of change
    ])
    expected = [("a", "voided"), ("b", "y"), ("c", None), ("d", "new")]
    assert rows(latest_cdc(df, ["transaction_id"]), "transaction_id", "status") == expected
    shuffled = df.orderBy(F.rand(seed=3)).repartition(5)
    assert rows(latest_cdc(shuffled, ["transaction_id"]), "transaction_id", "status") == expected


def test_versions_of_a_hot_key_are_dropped_before_the_shuffle(spark):
    df = log(spark, [("a", "s", T0, "INSERT", T0, "f", T0)])
    plan = latest_cdc(df, ["transaction_id"])._jdf.queryExecution().executedPlan().toString()
    limit = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert len(limit) == 2 and "Final" in limit[0] and "Partial" in limit[1]


def test_first_loaded_copy_of_an_event_stays(spark):
    df = spark.createDataFrame(
        [("e1", "late", T0 + dt.timedelta(hours=1), "f1"), ("e1", "early", T0, "f2"), ("e2", "only", T0, "f1")],
        "event_id STRING, device STRING, _loaded_at TIMESTAMP, _file STRING")
    assert rows(dedupe_events(df), "event_id", "device") == [("e1", "early"), ("e2", "only")]


def test_last_file_of_a_day_wins(spark):
    raw = spark.createDataFrame([
        ("S1", "p/dt=2025-01-01/a.csv", "first"), ("S1", "p/dt=2025-01-01/b.csv", "second"),
        ("S1", "p/dt=2025-01-02/a.csv", "next"), ("S1", "p/none/a.csv", "no day"),
    ], "sku STRING, _file STRING, product_name STRING")
    for column in CATALOG_COLUMNS.replace("DECIMAL(10,2)", "DOUBLE").split(", "):
        name, kind = column.split(" ")
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast(kind))
    raw = raw.withColumn("_loaded_at", F.current_timestamp())
    assert rows(daily_snapshots(raw), "snapshot_date", "product_name") == [
        (None, "no day"), (dt.date(2025, 1, 1), "second"), (dt.date(2025, 1, 2), "next")]


def test_schema_on_read(spark):
    """Missing fields are null, an unreadable time is null, unknown change codes are null."""
    raw = spark.createDataFrame([
        ('{"payment_id":"p1","amount":12.5,"created_at":"2025-01-01T00:00:01.5Z","Op":"I","extra":1}',),
        ('{"payment_id":"p2","created_at":"soon","Op":"X"}',), ('{"payment_id":"p3"}',),
    ], "j STRING").select(F.parse_json("j").alias("record"), F.lit("f").alias("_file"),
                          F.current_timestamp().alias("_loaded_at"))
    got = {r.payment_id: r for r in stg_cdc(raw, "payments").collect()}
    assert got["p1"].created_at == dt.datetime(2025, 1, 1, 0, 0, 1, 500000) and str(got["p1"].amount) == "12.50"
    assert got["p2"].created_at is None and got["p2"].cdc_operation is None and got["p2"].method is None
    assert got["p3"].cdc_operation == "INSERT"
    assert stg_event_log(raw).columns[:2] == ["event_id", "event_type"]
