"""Helpers against brute force, with one key holding a third of the rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillworks.functions import skew
from tillworks.operators.dispatch import distance_stats, rider_code_list
from tillworks.sources.tables import scan_by_keys

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark.range(0, 60000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.col("id") % 500).alias("k"),
        F.col("id").alias("v"), (F.col("id") * 7919 % 1000).alias("o"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_is_split_and_null_keys_match(skewed):
    out = skew.with_group(skewed, ["k"], F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    assert out.count() == skewed.count()
    plain = skewed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k"))).withColumn("s", F.sum("v").over(Window.partitionBy("k")))
    assert out.exceptAll(plain).isEmpty()
    check = out.agg(F.sum("n"), F.max("pad"))
    check.collect()
    plan = check._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_semi_and_anti_joins_split_too(skewed, how):
    keys = skewed.filter("k < 250 or k is null").select("k").distinct()
    out = skew.join_per_key(skewed, keys, ["k"], how)
    expected = skewed.filter("k < 250 or k is null" if how == "left_semi" else "k >= 250")
    assert out.count() == expected.count()
    check = out.agg(F.max("pad"))
    check.collect()
    assert how == "left_anti" or "skew=true" in check._jdf.queryExecution().executedPlan().toString()


def test_a_key_scan_splits_a_hot_key_and_takes_no_null(skewed):
    keys = skewed.filter("k < 250 or k is null").select("k")
    out = scan_by_keys(skewed, keys, "k")
    assert out.count() == skewed.filter("k < 250").count()
    check = out.agg(F.max("pad"))
    check.collect()
    assert "skew=true" in check._jdf.queryExecution().executedPlan().toString()


def test_running_sum_and_lead_equal_plain_windows(skewed):
    df = skewed.withColumn("b", F.floor(F.col("o") / 100)).drop("pad")
    out = skew.running_sum(df, ["k"], "b", ["o", "v"], F.col("v"), "r").drop("_slot")
    w = Window.partitionBy("k").orderBy("o", "v")
    plain = df.withColumn("r", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert out.exceptAll(plain).isEmpty() and out.count() == plain.count()
    lead = skew.bucketed_lead(df, ["k"], "b", "o", "n")
    assert lead.exceptAll(df.withColumn("n", F.lead("o").over(Window.partitionBy("k").orderBy("o")))).isEmpty()


def test_first_per_key_and_copies(skewed):
    df = skewed.drop("pad")
    first = skew.first_per_key(df, ["k"], ["o", "v"])
    w = Window.partitionBy("k").orderBy("o", "v")
    assert first.exceptAll(df.withColumn("n", F.row_number().over(w)).filter("n = 1").drop("n")).isEmpty()
    twice = df.select("k").unionAll(df.select("k"))
    assert skew.repeat_rows(skew.count_copies(twice), "_copies").exceptAll(twice).isEmpty()


def test_median_and_code_list_of_a_hot_order(spark):
    rows = [(1, float(i * 37 % 1001) * 10, f"c{i}") for i in range(2000)] + [(2, 5.0, "a"), (2, None, "b"), (2, 8.01, "c")] + [(3, None, "x")]
    df = spark.createDataFrame(rows, "pending_order_id int, route_distance_m double, rider_code string")
    import statistics

    out = {r.pending_order_id: r for r in distance_stats(df).collect()}
    for key in (1, 2):
        values = [v for k, v, _ in rows if k == key and v is not None]
        r = out[key]
        assert r.median_blasted_rider_distance_m == pytest.approx(round(statistics.median(values), 2), abs=0.011)
        assert r.nearest_blasted_rider_distance_m == min(values) and r.max_blasted_rider_distance_m == max(values)
    assert out[3].median_blasted_rider_distance_m is None
    pings = df.select("pending_order_id", F.col("route_distance_m").alias("distance_in_meter"), "rider_code",
                      F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("created_at"))
    codes = {r.pending_order_id: r.blasted_rider_codes for r in rider_code_list(pings).collect()}
    assert codes[2] == "a, c, b" and codes[3] == "x"
    expected = [c for _, _, c in sorted(rows[:2000], key=lambda r: (r[1], r[2]))]
    assert codes[1].split(", ") == expected


def test_codes_without_a_distance_are_listed_by_time(spark):
    t0 = dt.datetime(2024, 1, 1, 8)
    rows = [(1, None, t0 + dt.timedelta(minutes=i * 7919 % 3000), f"c{i}") for i in range(500)] + [(1, None, None, "early"), (1, 4.0, t0, "near")]
    df = spark.createDataFrame(rows, "pending_order_id int, distance_in_meter double, created_at timestamp_ntz, rider_code string")
    unknown = sorted(rows[:500], key=lambda r: (r[2], r[3]))
    assert rider_code_list(df).first()["blasted_rider_codes"].split(", ") == ["near", "early", *[r[3] for r in unknown]]
