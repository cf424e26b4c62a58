"""Skew-proof operators against plain ones, on data where one key owns a third of the rows."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from courierlake.operators import sequences, skew
from courierlake.operators.dedup import first_per_key, keep_earliest, keep_latest


@pytest.fixture
def skewed(spark):
    """3000 rows: a third on one key, a tenth on NULL, the rest spread; some exact copies."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{rng.randrange(400)}"
        data.append((i if i % 50 else 0, key, rng.randrange(100), rng.randrange(5)))
    return spark.createDataFrame(data, "id int, key string, v int, attempt int").repartition(5)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(key, a.select(columns).collect())) == sorted(map(key, b.select(columns).collect()))


def test_group_stats_equal_windows(skewed):
    stats = {"n": ("key", F.count("id")), "most": ("key", F.max("attempt")), "per_v": ("v", F.count("id"))}
    plain = skewed.withColumns({name: agg.over(Window.partitionBy(k)) for name, (k, agg) in stats.items()})
    same(skew.attach_group_stats(skewed, stats), plain)


def test_group_stats_meet_no_group_in_one_task(skewed):
    """Only sums per key and task are shuffled to form the statistics; no window is left."""
    stats = {"n": ("key", F.count("id")), "most": ("key", F.max("attempt"))}
    text = skew.attach_group_stats(skewed, stats)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "partial_count" in text


def test_lookup_join_splits_a_hot_key(spark):
    """A key with a third of the rows: adaptive execution splits its partition."""
    dim = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(300)]], "key string, a int")
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 400))
    fact = spark.range(60_000).select("id", key.alias("key"), F.repeat(F.lit("x"), 40).alias("pad"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = skew.lookup_join(fact, dim, "key")
        rows = joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 60_000
    assert all(r.a == (1 if r.key == "hot" else int(r.key[1:]) if int(r.key[1:]) < 300 else None) for r in rows)


@pytest.fixture
def series(spark):
    """Groups of very different length, one of them a third of all; NULL group and dates."""
    rng = random.Random(11)
    data = []
    for i in range(2400):
        group = "hot" if i % 3 == 0 else None if i % 17 == 0 else f"g{rng.randrange(40)}"
        day = None if i % 29 == 0 else f"2001-0{1 + rng.randrange(3)}-{10 + rng.randrange(15)}"
        data.append((group, day, i, rng.randrange(1000)))
    df = spark.createDataFrame(data, "g string, d string, tie int, v int").repartition(6)
    return df.withColumn("d", F.col("d").cast("date"))




def total_order():
    return [F.col("d").asc_nulls_last(), F.col("tie").asc()]


@pytest.mark.parametrize("slice_rows", [5, 40, 300, 1_000_000])
def test_lag_rows_equals_plain_lag(series, slice_rows):
    """Slices shorter than the reach, groups over many slices, many groups in a slice."""
    lags = {"v7": ("v", 7), "v30": ("v", 30), "t1": ("tie", 1)}
    got = sequences.lag_rows(series, ["g"], total_order(), lags, slice_rows=slice_rows)
    window = Window.partitionBy("g").orderBy(*total_order())
    want = series.select("*", *[F.lag(c, n).over(window).alias(k) for k, (c, n) in lags.items()])
    same(got, want)


def test_lag_rows_of_null_values(spark):
    df = spark.createDataFrame([("a", k, None if k % 3 else k) for k in range(60)], "g string, k int, v int")
    got = sequences.lag_rows(df, ["g"], [F.col("k").asc()], {"p": ("v", 4)}, slice_rows=7)
    assert {r.k: r.p for r in got.collect()} == {
        k: None if k < 4 or (k - 4) % 3 else k - 4 for k in range(60)
    }


@pytest.mark.parametrize("slice_rows", [100, 1_000_000])
def test_running_sum_equals_plain_window(series, slice_rows):
    order = [F.col("v").desc(), F.col("tie").asc()]
    want = series.withColumn(
        "run", F.sum("v").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    )
    same(sequences.running_sum(series, "v", order, "run", slice_rows=slice_rows), want)


def test_lag_days_looks_at_the_calendar(spark):
    df = spark.createDataFrame(
        [("a", "2001-01-01", 1), ("a", "2001-01-08", 2), ("a", "2001-01-09", 3), ("b", "2001-01-08", 4),
         ("a", None, 9)],
        "g string, d string, v int",
    ).withColumn("d", F.col("d").cast("date"))
    rows = sequences.lag_days(df, ["g"], "d", {"w": ("v", 7)}).collect()
    assert {(r.g, str(r.d)): r.w for r in rows} == {
        ("a", "2001-01-01"): None, ("a", "2001-01-08"): 1, ("a", "2001-01-09"): None,
        ("b", "2001-01-08"): None, ("a", "None"): None,
    }


def test_keep_latest_and_earliest_by_brute_force(skewed):
    rows = [r.asDict() for r in skewed.select("key", "id", "v").distinct().collect()]
    groups = defaultdict(list)
    for r in rows:
        groups[r["key"]].append(r)
    latest = {r.key: r.v for r in keep_latest(skewed.select("key", "id", "v"), "key", "v").collect()}
    earliest = {r.key: r.v for r in keep_earliest(skewed.select("key", "id", "v"), "key", "v").collect()}
    assert latest == {k: max(x["v"] for x in g) for k, g in groups.items()}
    assert earliest == {k: min(x["v"] for x in g) for k, g in groups.items()}


def test_null_timestamp_is_the_latest(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "2001-01-01", 2)], "k string, t string, v int")
    assert keep_latest(df, "k", "t").first().v == 1
    assert keep_earliest(df, "k", "t").first().v == 2


def test_ties_do_not_depend_on_row_order(spark):
    data = [("a", 1, i) for i in range(200)]
    picks = set()
    for seed in range(4):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, t int, v int").repartition(1 + seed)
        picks.add(first_per_key(df, ["k"], [F.col("t").desc()]).first().v)
    assert len(picks) == 1
