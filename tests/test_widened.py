"""Digest comparison, publication in the catalog, own lookups, files by pattern, rules in streams."""

import random

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from conftest import rows
from pulselake import schemas
from pulselake.operators import audit, digests, enrich
from pulselake.operators.quality import Rule
from pulselake.plans import runs, star
from pulselake.sources import tables
from pulselake.streaming import ingest
from pulselake.streaming.silver import silver_stream
from test_quality import record


def two_sides(spark, changes):
    rng = random.Random(9)
    left = [(f"k{i}" if i % 50 else None, i, rng.choice(["x", None, "y"])) for i in range(500)]
    right = [r for r in left if r[1] not in changes] + [(r[0], r[1], "changed") for r in left if r[1] in changes and r[1] % 2]
    layout = "key string, n int, value string"
    return spark.createDataFrame(left, layout).repartition(3), spark.createDataFrame(right, layout).withColumn("n", F.col("n").cast("long"))


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_digests_find_what_a_full_comparison_finds(spark, buckets):
    left, right = two_sides(spark, {3, 4, 77, 100, 499})
    keys = {"key": "key", "n": "n"}
    ours = digests.reconcile_by_digest(left, right, keys, ["value"], buckets)
    assert rows(ours) == rows(audit.reconcile(left, right, keys, ["value"])) and ours.count() == 5
    open_buckets = digests.differing_buckets(left, right, keys, ["value"], buckets).count()
    assert open_buckets <= min(buckets, 5)
    same, _ = two_sides(spark, set())
    assert digests.differing_buckets(left, same, keys, ["value"], buckets).count() == 0


def test_copies_of_a_row_count_in_digests(spark):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert digests.differing_buckets(one, one.union(one.limit(1)).union(one.limit(1)), {"k": "k"}, ["v"], 1).count() == 1


def test_readers_find_a_whole_table_through_publications(spark, folder):
    database = "pub_" + folder[-8:]
    for n in (3, 5):
        names = star.publish({"mart": spark.range(n), "stg": spark.range(n + 1)}, folder, database)
        assert spark.table(names["mart"]).count() == n and spark.table(names["stg"]).count() == n + 1
    reader = spark.table(names["mart"])
    star.publish({"mart": spark.range(9), "stg": spark.range(1)}, folder, database)
    assert reader.count() == 5 and spark.table(names["mart"]).count() == 9
    assert spark.catalog.tableExists(names["stg"])


def test_columns_of_an_added_lookup_are_written(spark, folder, monkeypatch):
    extra = enrich.Lookup("workout_catalog", "workout_type", "workout_type", {"benefit": "primary_benefit"})
    other = enrich.Lookup("shoes", "workout_type", "kind", {"shoe": "model"})
    monkeypatch.setitem(enrich.LOOKUPS, "workout_log", (*enrich.LOOKUPS["workout_log"], extra, other))
    refs = {"workout_catalog": spark.createDataFrame([("Yoga", 2.5, "mobility", 0)], "workout_type string, met_value double, primary_benefit string, recovery_days_needed int"),
            "shoes": spark.createDataFrame([("Yoga", "none")], "kind string, model string")}
    batch = record(spark, "workout_log", [{"workout_type": "Yoga"}])
    tables.write_judged(runs.judge(batch, "workout_log", refs), folder, "workout_log")
    row = tables.read_silver(spark, folder, "workout_log").first()
    assert (row["benefit"], row["shoe"], row["met_value"]) == ("mobility", "none", 2.5)


def test_streams_take_rules(spark, folder):
    record(spark, "workout_log", [{"rpe": 9, "user_id": "U1"}, {"rpe": 2, "user_id": "U2"}]).write.parquet(f"{folder}/landing")
    source = ingest.file_stream(spark, f"{folder}/landing", schemas.BRONZE["workout_log"])
    silver_stream(source, f"{folder}/silver", "workout_log", {}, f"{folder}/memory", {"workout_log": [Rule("too_hard", "rpe > 8")]})
    assert [r["user_id"] for r in tables.read_silver(spark, f"{folder}/silver", "workout_log").collect()] == ["U2"]
    assert tables.read_quarantine(spark, f"{folder}/silver", "workout_log").first()["failure_reason"] == "too_hard"


def test_files_are_stacked_by_name(spark, folder):
    spark.range(2).withColumn("a", F.lit(1)).write.parquet(f"{folder}/x-1")
    spark.range(3).withColumn("b", F.lit("t")).write.parquet(f"{folder}/x-2")
    for paths in (f"{folder}/x-*", [f"{folder}/x-1", f"{folder}/x-2"]):
        assert sorted(tables.read_files(spark, paths).columns) == ["a", "b", "id"] and tables.read_files(spark, paths).count() == 5


def test_widened_queries_cover_every_type(spark, sf_dir):
    for name in ("q_scan_bronze", "q_scan_silver", "q_cast_schema", "q_dedup_events"):
        assert {r[0] for r in QUERIES[name](spark, sf_dir).select("record_type").distinct().collect()} == set(schemas.RECORD_TYPES)
