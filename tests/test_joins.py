import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shelfline.operators.pit import pit_join
from shelfline.operators.skew import MAX_HOT_KEYS, fits_broadcast, hot_keys, salted_left_join

T0 = dt.datetime(2025, 1, 1)


def hours(n):
    return T0 + dt.timedelta(hours=n)


def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("k"))
    assert rows(hot_keys(df, "k", min_rows=1000)) == [(7,)]
    assert hot_keys(df, "k", min_rows=100_000) is None
    assert hot_keys(df, "k", min_rows=1).count() <= MAX_HOT_KEYS


@pytest.mark.parametrize("with_hot", [False, True])
def test_salted_join_equals_plain_left_join(spark, with_hot):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = hot_keys(left, "k", min_rows=500) if with_hot else None
    got = salted_left_join(left, right, "k", ["id"], hot)
    assert rows(got, "id", "k", "v") == rows(left.join(right, "k", "left"), "id", "k", "v")


def test_null_and_hot_keys_are_spread_over_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 1).cast("bigint").alias("k"))
        right = spark.range(3).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        got = salted_left_join(left, right, "k", ["id"], hot_keys(left, "k", min_rows=1000))
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id(), F.col("k").isNull()).count().collect()]
        assert max(sizes) < 1500  # 2000 rows have the hot key and 2000 have none
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def pit_case(seed):
    rng = random.Random(seed)
    dims, sk = [], 0
    for key in (1, 2, 3):
        cuts = sorted(rng.sample(range(1, 500), {1: 60, 2: 3, 3: 0}[key]))
        bounds = [dt.datetime(1900, 1, 1), *[hours(c / 3) for c in cuts], None]
        for lo, hi in zip(bounds, bounds[1:]):
            sk += 1
            dims.append((sk, key, lo, hi))
    facts = [(i, rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([None, *[hours(rng.randrange(-100, 900) / 3)] * 20]))
             for i in range(800)]
    return dims, facts


def brute(dims, facts):
    out = []
    for i, key, at in facts:
        hit = [sk for sk, k, lo, hi in dims if k == key and at is not None and at >= lo and (hi is None or at < hi)]
        assert len(hit) <= 1
        out.append((i, hit[0] if hit else -1))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["broadcast", "shuffle", "hot", "hot broadcast"])
def test_point_in_time_join(spark, how):
    dims, facts = pit_case(11)
    dim = spark.createDataFrame(dims, "sk BIGINT, key INT, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ")
    fact = spark.createDataFrame(facts, "id INT, key INT, t TIMESTAMP_NTZ")
    hot = hot_keys(dim, "key", min_rows=10) if "hot" in how else None
    got = pit_join(fact, dim, {"key": "key"}, "t", "sk", spread_by=["id"], hot=hot,
                   broadcast_rows=1000 if "broadcast" in how else 0)
    assert got.columns == ["id", "key", "t", "sk"]
    assert rows(got, "id", "sk") == brute(dims, facts)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (how != "shuffle")


def test_date_interval_is_half_open(spark):
    dim = spark.createDataFrame([(1, "s", dt.date(1900, 1, 1), dt.date(2025, 1, 5)), (2, "s", dt.date(2025, 1, 5), None)],
                                "sk BIGINT, sku STRING, valid_from DATE, valid_to DATE")
    fact = spark.createDataFrame([("s", dt.date(2025, 1, 4)), ("s", dt.date(2025, 1, 5)), ("z", dt.date(2025, 1, 5))],
                                 "sku STRING, d DATE")
    assert [r[2] for r in rows(pit_join(fact, dim, {"sku": "sku"}, "d", "sk"))] == [1, 2, -1]


def test_size_check(spark):
    assert fits_broadcast(spark.range(10), 10) and not fits_broadcast(spark.range(11), 10)


def test_a_cut_chain_grows_at_most_twofold_and_its_slots_are_short(spark):
    from shelfline.operators import pit

    cuts = [hours(i * 7 % 5000 / 11) for i in range(2000)]
    bounds = [dt.datetime(1900, 1, 1), *sorted(set(cuts)), None]
    v = spark.createDataFrame([(i, 1, lo, hi) for i, (lo, hi) in enumerate(zip(bounds, bounds[1:]))],
                              "_sk BIGINT, _dim_key INT, _from TIMESTAMP_NTZ, _to TIMESTAMP_NTZ")
    fact = spark.range(10).select(F.lit(1).alias("_key"), F.lit(hours(3)).alias("t"))
    _, cut = pit._cut(fact, v, pit._spans(v), "t")
    assert cut.count() <= 2 * len(bounds)
    assert cut.groupBy("_dim_slot").count().agg(F.max("count")).first()[0] < 30
