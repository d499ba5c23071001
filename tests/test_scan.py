import random

import pytest
from pyspark.sql import functions as F

from lotflow.operators.scan import CHUNK, chunk_groups, count_by, hot_keys


@pytest.fixture
def skewed(spark):
    rnd = random.Random(7)
    data = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(40)}", rnd.randrange(300), i, rnd.randrange(5)) for i in range(3000)]
    return data, spark.createDataFrame(data, "k string, o int, id int, v bigint")


def test_only_oversized_keys_are_found(skewed):
    _, df = skewed
    hot = hot_keys(count_by(df, ["k"]), ["k"], 200)
    assert [r["k"] for r in hot.table.collect()] == ["hot"]
    assert hot_keys(count_by(df, ["k"]), ["k"]).table is None


def test_the_number_of_hot_keys_is_bounded_by_the_partitions(spark):
    counts = spark.range(100_000).select(F.col("id").alias("k"), F.lit(10).alias("n"))
    # every key is above the minimum, none above rows / (4 * partitions)
    assert hot_keys(counts, ["k"], 1).table is None


def test_chunks_follow_the_order_and_split_the_hot_key(skewed):
    _, df = skewed
    step = chunk_groups(df, ["k"], ["o", "id"], hot_keys(count_by(df, ["k"]), ["k"], 100))
    parts = step.df.groupBy("k", CHUNK).agg(F.min(F.struct("o", "id")).alias("a"), F.max(F.struct("o", "id")).alias("b"))
    hot = sorted((r[CHUNK], tuple(r["a"]), tuple(r["b"])) for r in parts.where("k = 'hot'").collect())
    assert len(hot) > 4
    assert all(x[2] < y[1] for x, y in zip(hot, hot[1:]))
    assert step.df.count() == df.count()


@pytest.mark.parametrize("min_rows", [None, 100])
def test_intervals_match_a_running_sum(skewed, min_rows):
    data, df = skewed
    step = chunk_groups(df, ["k"], ["o", "id"], hot_keys(count_by(df, ["k"]), ["k"], min_rows))
    got = {r["id"]: (r["s"], r["e"]) for r in step.intervals("v", "s", "e").collect()}
    at, expected = {}, {}
    for k, o, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        expected[i] = (at.get(k, 0), at.get(k, 0) + v)
        at[k] = at.get(k, 0) + v
    assert got == expected


@pytest.mark.parametrize("min_rows", [None, 100])
def test_last_seen_carries_over_chunks(skewed, min_rows):
    data, df = skewed
    rare = df.withColumn("x", F.when(F.col("id") % 97 == 0, F.col("id")))
    step = chunk_groups(rare, ["k"], ["o", "id"], hot_keys(count_by(df, ["k"]), ["k"], min_rows))
    got = {r["id"]: r["x"] for r in step.last_seen(["x"]).collect()}
    last, expected = {}, {}
    for k, o, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        if i % 97 == 0:
            last[k] = i
        expected[i] = last.get(k)
    assert got == expected


def test_spread_repeats_a_small_row_once_per_chunk(skewed, spark):
    _, df = skewed
    step = chunk_groups(df, ["k"], ["o", "id"], hot_keys(count_by(df, ["k"]), ["k"], 100))
    small = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, w int")
    joined = step.df.join(step.spread(small), step.parts)
    assert joined.count() == df.where("k in ('hot', 'k1')").count()
