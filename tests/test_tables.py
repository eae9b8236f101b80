import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shelfline.operators import latest, merge, scd2, surrogate, tables

T0 = dt.datetime(2025, 1, 1)


def frame(spark, data, ddl="k INT, v STRING"):
    return spark.createDataFrame(data, ddl)


def test_upsert_replaces_inserts_and_keeps(spark, folder):
    assert tables.read_table(spark, folder) is None
    tables.upsert(spark, folder, frame(spark, [(1, "a"), (2, "b"), (3, "c")]), ["k"])
    got = tables.upsert(spark, folder, frame(spark, [(2, "B"), (4, "d")]), ["k"])
    assert rows(got) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")] == rows(tables.read_table(spark, folder))


def test_new_columns_are_appended(spark, folder):
    tables.upsert(spark, folder, frame(spark, [(1, "a"), (2, "b")]), ["k"])
    got = tables.upsert(spark, folder, frame(spark, [(2, 5)], "k INT, n INT"), ["k"])
    assert got.columns == ["k", "v", "n"]
    assert rows(got) == [(1, "a", None), (2, None, 5)]


def test_double_source_keys_are_refused_and_change_nothing(spark, folder):
    tables.upsert(spark, folder, frame(spark, [(1, "a")]), ["k"])
    with pytest.raises(ValueError, match="more than one row"):
        tables.upsert(spark, folder, frame(spark, [(1, "x"), (1, "y")]), ["k"], check=True)
    assert rows(tables.read_table(spark, folder)) == [(1, "a")]


def day(n):
    return dt.date(2025, 1, 1) + dt.timedelta(days=n)


def files_by_day(spark, path):
    return {d: tables.list_names(spark, f"{path}/rows/_day={d}") for d in tables.stored_days(spark, path)}


def test_only_days_with_news_get_new_files(spark, folder):
    """Thirty days are loaded; an hour of the last day changes two old sales and adds some."""
    ddl = "k INT, n INT, d DATE"
    tables.upsert(spark, folder, frame(spark, [(i, 0, day(i % 30)) for i in range(900)], ddl), ["k"], day="d", buckets=4)
    before = files_by_day(spark, folder)
    news = [(3, 1, day(3)), (7, 1, day(7)), *[(k, 0, day(29)) for k in range(1000, 1005)], *[(k, 0, day(11)) for k in (11, 41)]]
    merged = tables.merge_rows(spark, folder, frame(spark, news, ddl), ["k"], day="d")
    after = files_by_day(spark, folder)
    assert {d for d in after if after[d] != before.get(d)} == {day(3), day(7), day(29)}   # day 11 has the same rows as before
    assert merged.table.count() == 905 and merged.table.where("n = 1").count() == 2
    assert rows(merged.changed, "k", "n") == sorted([(3, 0), (3, 1), (7, 0), (7, 1), *[(k, 0) for k in range(1000, 1005)]], key=repr)
    tables.merge_rows(spark, folder, frame(spark, news, ddl), ["k"], day="d")
    assert files_by_day(spark, folder) == after   # nothing changes twice


def test_a_key_stays_where_it_was_filed(spark, folder):
    ddl = "k INT, l INT, v STRING, d DATE"
    tables.upsert(spark, folder, frame(spark, [(1, 1, "a", day(0)), (2, 1, "b", day(1))], ddl), ["k", "l"], index=["k"], day="d")
    got = tables.upsert(spark, folder, frame(spark, [(1, 1, "A", day(5)), (1, 2, "c", day(6)), (2, 1, "b", None)], ddl), ["k", "l"],
                        index=["k"], day="d")
    assert rows(got, "k", "l", "v") == [(1, 1, "A"), (1, 2, "c"), (2, 1, "b")]
    assert tables.stored_days(spark, folder) == [day(0), day(1)]


def test_replaced_chains_leave_no_rows_and_no_empty_day(spark, folder):
    ddl = "k INT, v INT, d DATE"
    tables.overwrite_table(spark, folder, frame(spark, [(1, 1, day(0)), (1, 2, day(1)), (2, 1, day(2))], ddl), ["k"], "d")
    got = tables.upsert(spark, folder, frame(spark, [(1, 3, day(4))], ddl), ["k", "v"], replace_by=["k"], day="d")
    assert rows(got, "k", "v") == [(1, 3), (2, 1)]
    assert tables.stored_days(spark, folder) == [day(0), day(2)]


def test_null_keys_are_replaced_too(spark, folder):
    for value in "ab":
        got = tables.upsert(spark, folder, frame(spark, [(None, value), (1, value)]), ["k"])
    assert rows(got) == sorted([(None, "b"), (1, "b")], key=repr)


def test_rows_are_read_from_the_days_of_their_keys(spark, folder):
    data = [(i, i // 10, day(i % 30)) for i in range(300)]
    tables.overwrite_table(spark, folder, frame(spark, data, "k INT, g INT, d DATE"), ["k"], "d", buckets=4, also=[["g"]])
    one = tables.rows_of(spark, folder, spark.createDataFrame([(31,), (5000,)], "k INT"))
    assert rows(one, "k") == [(31,)] and all("_day=2025-01-02" in f for f in one.inputFiles())
    assert rows(tables.rows_of(spark, folder, spark.createDataFrame([(3,)], "g INT")), "k") == [(k,) for k in range(30, 40)]


def test_key_tables_are_not_shuffled_and_outlive_the_session(spark, folder):
    tables.upsert(spark, folder, spark.range(500).select(F.col("id").alias("k")), ["k"], buckets=8)
    other = spark.newSession()
    name, _ = tables._key_table(spark, folder, ["k"])
    spark.sql(f"DROP TABLE {name}")   # as in another application: the files alone are left
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = tables._known(other, folder, other.range(5).select(F.col("id").alias("k")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1 and found.count() == 5


def test_key_tables_are_written_anew(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "MOST_FILES", 1)
    for k in range(4):
        tables.upsert(spark, folder, frame(spark, [(k, "a"), (k + 10, "b")]), ["k"], buckets=2)
    assert rows(tables.upsert(spark, folder, frame(spark, [(0, "z")]), ["k"])) == sorted(
        [(0, "z"), *[(k, "a") for k in (1, 2, 3)], *[(k, "b") for k in range(10, 14)]], key=repr)
    assert len(tables.list_names(spark, f"{folder}/keys/k")) == 1


def test_a_run_that_died_is_repaired_by_the_next(spark, folder, monkeypatch):
    """Keys are entered before rows, marks after them: whichever is lacking, the same news gives the same table."""
    ddl = "k INT, v STRING, d DATE, _loaded_at TIMESTAMP"
    tables.upsert(spark, folder, frame(spark, [(1, "a", day(0), T0)], ddl), ["k"], day="d")
    news = frame(spark, [(1, "b", day(0), T0 + dt.timedelta(hours=1)), (2, "c", day(3), T0 + dt.timedelta(hours=1))], ddl)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "_replace_days", die)
        with pytest.raises(RuntimeError):
            tables.upsert(spark, folder, news, ["k"], day="d")
    assert tables.table_watermark(spark, folder) == T0
    assert rows(tables.upsert(spark, folder, news, ["k"], day="d"), "k", "v") == [(1, "b"), (2, "c")]
    assert tables.table_watermark(spark, folder) == T0 + dt.timedelta(hours=1)


def test_marks_only_grow_and_do_not_pile_up(spark, folder):
    for hour in (1, 5, 3, *range(20)):
        tables._mark(spark, folder, T0 + dt.timedelta(hours=hour), hour if hour % 2 else None)
    assert tables.marks(spark, folder) == (T0 + dt.timedelta(hours=19), 19)
    assert len(tables.list_files(spark, f"{folder}/marks", ".parquet")) <= tables.KEPT_MARKS + 1


def test_append_and_overwrite(spark, folder):
    tables.append_table(spark, folder, frame(spark, [(1, "a")]))
    got = tables.append_table(spark, folder, frame(spark, [(1, "a"), (2, "b")]))
    assert rows(got) == [(1, "a"), (1, "a"), (2, "b")]
    kept = spark.createDataFrame(got.where("k = 2").collect(), got.schema)
    assert rows(tables.overwrite_table(spark, folder, kept)) == [(2, "b")]


def test_watermarks(spark, folder):
    log = frame(spark, [(1, T0), (2, T0 + dt.timedelta(hours=3))], "k INT, _loaded_at TIMESTAMP")
    hour = dt.timedelta(hours=1)
    assert tables.watermark(None) is None and tables.watermark(log.where("false")) is None  # load all, not nothing
    assert tables.watermark(log, hour) == T0 + dt.timedelta(hours=2)
    assert tables.table_watermark(spark, folder) is None
    tables.upsert(spark, folder, log, ["k"])
    assert rows(tables.loaded_after(log, tables.table_watermark(spark, folder, hour)), "k") == [(2,)]
    assert rows(tables.loaded_after(log, tables.table_watermark(spark, folder)), "k") == []
    assert tables.loaded_after(log, None).count() == 2


def test_older_changes_never_win(spark, folder):
    ddl = "k INT, v STRING, cdc_operation STRING, _dms_commit_ts TIMESTAMP_NTZ, _file STRING, _loaded_at TIMESTAMP"

    def change(k, v, hour):
        at = T0 + dt.timedelta(hours=hour)
        return (k, v, "UPDATE", at, "f", at)

    merge.merge_latest(spark, folder, frame(spark, [change(1, "new", 5), change(2, "x", 1)], ddl), ["k"])
    got = merge.merge_latest(spark, folder, frame(spark, [change(1, "late", 3), change(2, "y", 2)], ddl), ["k"]).table
    assert rows(got, "k", "v") == [(1, "new"), (2, "y")]


def test_numbers_are_dense_and_in_order(spark):
    data = list(range(5000))
    random.Random(1).shuffle(data)
    df = spark.createDataFrame([(i // 3, i % 3) for i in data], "k INT, v INT").repartition(7)
    got = rows(surrogate.number_rows(df, ["k", "v"], "sk", 100), "k", "v", "sk")
    assert sorted(got) == [(i // 3, i % 3, 101 + i) for i in range(5000)]


def test_a_hot_key_is_numbered_over_several_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    got = surrogate.number_rows(df, ["k", "v"], "sk")
    assert got.where(F.col("sk") != F.col("v") + 1).count() == 0


def test_keys_are_never_given_again(spark, folder):
    """A late change removes a version; its number stays unused and the other numbers stay put."""
    ddl = "k INT, a STRING, updated_at TIMESTAMP_NTZ, cdc_operation STRING, _dms_commit_ts TIMESTAMP_NTZ, " \
          "_file STRING, _loaded_at TIMESTAMP"

    def change(a, day, k=1):
        at = T0 + dt.timedelta(days=day)
        return (k, a, at, "UPDATE", at, "f", at)

    def run(data):
        versions = scd2.scd2(frame(spark, data, ddl), "k", "_dms_commit_ts", ["a"])
        return merge.merge_dim(spark, folder, versions, "k", "version_ts", "sk").table

    first = [change("x", 0), change("y", 10)]
    assert rows(run(first), "sk", "a") == [(1, "x"), (2, "y")]
    late = [*first, change("y", 5)]  # y now starts on day 5, the version of day 10 is gone
    assert rows(run(late), "sk", "a") == [(1, "x"), (3, "y")]
    assert rows(run([*late, change("z", 20)]), "sk", "a") == [(1, "x"), (3, "y"), (4, "z")]
    got = run([change("q", 1, k=2)])
    assert rows(got, "k", "sk", "is_current") == [(1, 1, False), (1, 3, False), (1, 4, True), (2, 5, True)]


def event(event_id, session, hour):
    at = T0 + dt.timedelta(hours=hour)
    return (event_id, session, at.replace(tzinfo=None), f"f{hour}", at)


def test_copies_of_an_event_under_other_sessions_are_dropped(spark, folder):
    """Event ids alone decide, also when the copy comes in a later load and names another session or time."""
    ddl = "event_id STRING, session_id STRING, event_ts TIMESTAMP_NTZ, _file STRING, _loaded_at TIMESTAMP"
    loads = [[event("A", "s1", 0), event("B", "s1", 0)], [event("A", "s2", 30), event("C", "s2", 30)], [event("B", "s3", 99), event("C", None, 99)]]
    for load in loads:
        got = merge.merge_events(spark, folder, frame(spark, load, ddl), buckets=4).table
    assert rows(got, "event_id", "session_id") == [("A", "s1"), ("B", "s1"), ("C", "s2")]
    assert rows(got) == rows(latest.dedupe_events(frame(spark, [e for load in loads for e in load], ddl)))


def test_append_adds_new_columns(spark, folder):
    tables.append_table(spark, folder, spark.createDataFrame([(1, "a")], "k INT, v STRING"))
    tables.append_table(spark, folder, spark.createDataFrame([(2, "b", 5)], "k INT, v STRING, w INT"))
    assert rows(tables.read_table(spark, folder)) == [(1, "a", None), (2, "b", 5)]


def test_a_frozen_write_leaves_no_shuffle_files(spark):
    from shelfline.session import SHUFFLE_CLEANUP, freeze

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    written = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before, set_before = written(), spark.conf.get(SHUFFLE_CLEANUP, None)
    frozen = freeze(spark.range(20_000).groupBy((F.col("id") % 7_000).alias("k")).count(), "test")
    for _ in range(50):
        if not written() - before:
            break
        time.sleep(0.1)
    assert not written() - before
    assert frozen.count() == 7_000 and spark.conf.get(SHUFFLE_CLEANUP, None) == set_before
