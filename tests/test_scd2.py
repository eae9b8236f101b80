import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shelfline.operators import scd2
from shelfline.operators.skew import hot_keys

T0 = dt.datetime(2025, 1, 1)
LOG = "k INT, a STRING, b INT, c STRING, updated_at TIMESTAMP_NTZ, cdc_operation STRING, " \
      "_dms_commit_ts TIMESTAMP_NTZ, _file STRING, _loaded_at TIMESTAMP"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def row(k, a, hour, op="UPDATE", b=1, c="c"):
    return (k, a, b, c, at(hour), op, at(hour), "f", at(hour))


def chain(spark, data, **options):
    log = spark.createDataFrame(data, LOG)
    return scd2.scd2(log, "k", "_dms_commit_ts", ["a", "b"], ["c"], **options)


def spans(df):
    return rows(df, "k", "a", "valid_from", "valid_to", "is_current")


def test_versions_open_only_on_a_change(spark):
    got = chain(spark, [row(1, "x", 0, "INSERT"), row(1, "x", 1), row(1, "y", 2), row(1, "x", 3)])
    assert spans(got) == [
        (1, "x", scd2.FIRST_TS, at(2), False), (1, "x", at(3), None, True), (1, "y", at(2), at(3), False)]


def test_nulls_are_values_and_do_not_hide_changes(spark):
    got = chain(spark, [row(1, None, 0, b=None), row(1, None, 1, b=1), row(1, "1", 2, b=None)])
    assert sorted((r[2], r[1]) for r in spans(got)) == [(scd2.FIRST_TS, None), (at(1), None), (at(2), "1")]
    assert chain(spark, [row(1, None, 0, b=None)]).count() == 1


def test_two_changes_in_one_commit_make_one_version(spark):
    got = chain(spark, [row(1, "x", 0, "INSERT"), row(1, "y", 0, "UPDATE")])
    assert spans(got) == [(1, "y", scd2.FIRST_TS, None, True)]


def test_carried_columns_open_no_version(spark):
    assert chain(spark, [row(1, "x", 0, c="old"), row(1, "x", 1, c="new")]).count() == 1


def test_deletes(spark):
    data = [row(1, "x", 0, "INSERT"), (1, None, None, None, None, "DELETE", at(2), "f", at(2)), row(1, "x", 5, "INSERT")]
    assert spans(chain(spark, data)) == [(1, "x", scd2.FIRST_TS, None, True)]
    assert spans(chain(spark, data, close_on_delete=True)) == [
        (1, "x", scd2.FIRST_TS, at(2), False), (1, "x", at(5), None, True)]


@pytest.mark.parametrize("close", [False, True])
def test_cutting_hot_chains_changes_nothing(spark, close):
    rng = random.Random(7)
    data = [row(rng.choice([1, 1, 1, 2, 3]), rng.choice("xyz"), rng.randrange(200) + rng.random(),
                rng.choice(["UPDATE"] * 6 + ["DELETE", "INSERT"])) for _ in range(600)]
    log = spark.createDataFrame(data, LOG)
    hot = hot_keys(log, "k", min_rows=100)
    assert {r.k for r in hot.collect()} >= {1}
    plain = spans(chain(spark, data, close_on_delete=close))
    assert spans(chain(spark, data, close_on_delete=close, hot=hot)) == plain
    every = log.select("k").distinct()
    assert spans(chain(spark, data, close_on_delete=close, hot=every)) == plain
    for k in {r[0] for r in plain}:
        mine = sorted((r for r in plain if r[0] == k), key=lambda r: r[2])
        assert mine[0][2] == scd2.FIRST_TS or close
        if not close:  # contiguous and not overlapping
            assert all(one[3] == two[2] for one, two in zip(mine, mine[1:]))
            assert [r[4] for r in mine] == [False] * (len(mine) - 1) + [True]


def test_pieces_are_even_and_ordered_even_in_a_burst(spark):
    """Half of the versions fall into one hour; no piece holds more than a few of them."""
    moments = [T0 + dt.timedelta(seconds=i) for i in range(3000)] + [at(2 + i) for i in range(3000)]
    log = spark.createDataFrame([(1, m) for m in moments] + [(2, T0)], "k INT, t TIMESTAMP_NTZ")
    cut = scd2._with_pieces(log, "k", "t", log.where("k = 1").select("k").distinct())
    sizes = [r["count"] for r in cut.where("k = 1").groupBy("_piece").count().collect()]
    assert len(sizes) > 200 and max(sizes) < 100
    ordered = [r._piece for r in cut.where("k = 1").orderBy("t").collect()]
    assert ordered == sorted(ordered)
    assert [r._piece for r in cut.where("k = 2").collect()] == [0]


def test_hot_chain_windows_are_cut(spark):
    """With a hot key no window runs over that key's detail rows alone."""
    log = spark.createDataFrame([row(1, "x", h) for h in range(5)], LOG)
    hot = log.select("k").distinct()
    plan = scd2.scd2(log, "k", "_dms_commit_ts", ["a"], ["c"], hot=hot)._jdf.queryExecution().optimizedPlan().toString()
    whole_key = [w for w in plan.splitlines() if "Window" in w and "[k#" in w and "_piece" not in w
                 and "WindowGroupLimit" not in w and "row_number" not in w]
    assert whole_key == []


def test_changed_keys_without_watermark_means_all(spark):
    log = spark.createDataFrame([row(1, "x", 0), row(2, "y", 5)], LOG)
    assert rows(scd2.changed_keys(log, "k", None)) == [(1,), (2,)]
    assert rows(scd2.changed_keys(log, "k", at(0))) == [(2,)]  # strictly later


def test_unknown_member(spark):
    dim = chain(spark, [row(1, "x", 0)])
    got = scd2.with_unknown_member(dim, {"k": -1, "a": "unknown", "valid_from": scd2.FIRST_TS, "is_current": True})
    assert (-1, "unknown", scd2.FIRST_TS, None, True) in spans(got)
    assert got.where(F.col("k") == -1).first().b is None
