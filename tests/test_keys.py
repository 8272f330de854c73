import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pulselake.operators import keys


def test_survivor_does_not_depend_on_row_order(spark):
    data = [("U1", "t", v) for v in (3, None, 1, 2)] + [("U2", "t", 5), ("U2", "u", 4)]
    results = set()
    for seed in range(5):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "user_id string, timestamp string, v int").repartition(4)
        results.add(tuple(rows(keys.deduplicate(df))))
    assert results == {(("t", "U1", None), ("t", "U2", 5), ("u", "U2", 4))}


def test_table_without_key_columns_passes(spark):
    df = spark.createDataFrame([(1,), (1,)], "x int")
    assert keys.deduplicate(df).count() == 2


def test_copies_are_reduced_before_the_exchange(spark):
    df = spark.range(0, 100_000, numPartitions=8).select(
        F.lit("U1").alias("user_id"), F.lit("t").alias("timestamp"), F.lit(1).alias("v"))
    unique = keys.deduplicate(df)
    assert unique.count() == 1
    plan = keys.deduplicate(spark.createDataFrame([("a", "b", 1)], "user_id string, timestamp string, v int"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in text and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_latest_takes_newest_then_smallest(spark):
    df = spark.createDataFrame(
        [("U1", 1, "a"), ("U1", 2, "c"), ("U1", 2, "b"), ("U2", None, "z"), ("U2", 0, "y")],
        "user_id string, timestamp int, v string")
    assert rows(keys.latest_per_key(df)) == [(0, "U2", "y"), (2, "U1", "b")]


def test_surrogate_keys_are_unique_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("U"), F.col("id")).alias("user_id"), "id")
    one = keys.with_surrogate_key(df, ["user_id"], "sk")
    two = keys.with_surrogate_key(df.repartition(7), ["user_id"], "sk")
    assert one.columns[0] == "sk"
    assert one.select("sk").distinct().count() == 5000
    assert rows(one) == rows(two)
    assert one.filter("sk < 0").isEmpty()


def test_colliding_digests_still_get_different_keys(spark, monkeypatch):
    monkeypatch.setattr(keys, "_DIGEST_HEX", 1)
    df = spark.range(300).select(F.col("id").cast("string").alias("user_id"))
    assert keys.with_surrogate_key(df, ["user_id"], "sk").select("sk").distinct().count() == 300


def test_a_second_row_of_a_natural_key_fails(spark):
    df = spark.range(2).select(F.lit("U1").alias("user_id"))
    with pytest.raises(Exception, match="not unique"):
        keys.with_surrogate_key(df, ["user_id"], "sk").collect()
