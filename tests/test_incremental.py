"""Updates that touch only what changed: appends, bucketed merges, Bronze folds, incremental Gold."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from conftest import rows
from pulselake import schemas
from pulselake.functions.texts import date_parts
from pulselake.operators import buckets, upsert
from pulselake.plans import incremental, runs
from pulselake.sources import files, tables
from pulselake.streaming import ingest


def parts_of(folder):
    """Path and time of change of all data files."""
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(folder) for n in names if n.startswith("part-")}


def test_append_opens_no_file_of_other_dates(spark, folder):
    days = spark.range(40).select(
        F.col("id").cast("string").alias("user_id"),
        F.when(F.col("id") > 0, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))).alias("date"))
    tables.append_new_rows(days, folder, ["user_id"])
    for path in parts_of(folder):
        if not any(f"date={d}/" in path for d in ("2024-01-04", "__HIVE_DEFAULT_PARTITION__")):
            with open(path, "w") as broken:
                broken.write("not parquet")
    again = days.filter("id in (0, 3)").union(spark.createDataFrame([("new", dt.date(2024, 1, 4)), ("new", dt.date(2025, 1, 1))], days.schema))
    assert tables.append_new_rows(again, folder, ["user_id", "date"]) == 2


def people(spark, data, extra=""):
    return spark.createDataFrame(data, "user_id string, timestamp int, job string" + extra)


def test_bucketed_merge_equals_the_plain_one(spark, folder):
    rng = random.Random(4)
    load = lambda k: people(spark, [(f"u{rng.randrange(200)}", rng.randrange(99), rng.choice("xyz")) for _ in range(k)])
    first, second = load(150), load(30)
    assert buckets.upsert_buckets(first, folder, by="timestamp", buckets=7)["inserted"] == first.select("user_id").distinct().count()
    counts = buckets.upsert_buckets(second.withColumn("kg", F.lit(5)), folder, by="timestamp")
    target = upsert.one_per_key(first, ["user_id"], "timestamp")
    wanted = upsert.merge_upsert(target, upsert.one_per_key(second.withColumn("kg", F.lit(5)), ["user_id"], "timestamp"))
    assert rows(buckets.read_buckets(spark, folder)) == rows(wanted.drop(upsert.ACTION))
    assert counts == {a: wanted.filter(F.col(upsert.ACTION) == a).count() for a in upsert.ACTIONS}
    assert buckets.upsert_buckets(second.limit(0), folder)["kept"] == wanted.count()


def test_untouched_buckets_are_not_rewritten(spark, folder):
    buckets.upsert_buckets(people(spark, [(f"u{k}", 1, "x") for k in range(300)]), folder, buckets=16)
    before = files.latest_manifest(spark, folder)[1]["live"]
    written = parts_of(folder)
    buckets.upsert_buckets(people(spark, [("u7", 2, "y")]), folder)
    after = files.latest_manifest(spark, folder)[1]["live"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(after) == 16
    assert {p: t for p, t in parts_of(folder).items() if p in written} == written
    assert buckets.read_buckets(spark, folder).filter("job = 'y'").collect()[0]["user_id"] == "u7"


def test_a_failed_merge_changes_nothing_and_a_lost_race_starts_over(spark, folder, monkeypatch):
    buckets.upsert_buckets(people(spark, [("a", 1, "x"), ("b", 1, "x")]), folder, buckets=4)
    bad = people(spark, [("a", 2, "y")]).withColumn("job", F.when(F.col("job") == "y", F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        buckets.upsert_buckets(bad, folder)
    assert rows(buckets.read_buckets(spark, folder)) == [("x", 1, "a"), ("x", 1, "b")]
    real, state = buckets.commit_manifest, []

    def late(spark, root, version, content):
        if not state:
            state.append(version)
            monkeypatch.setattr(buckets, "commit_manifest", real)
            buckets.upsert_buckets(people(spark, [("a", 5, "other")]), folder)
        real(spark, root, version, content)

    monkeypatch.setattr(buckets, "commit_manifest", late)
    buckets.upsert_buckets(people(spark, [("b", 6, "mine")]), folder)
    assert rows(buckets.read_buckets(spark, folder)) == [("mine", 6, "b"), ("other", 5, "a")]
    with pytest.raises(files.Conflict):
        files.commit_manifest(spark, folder, 1, {})


def bronze_rows(spark, sf_dir, condition="true"):
    return fx.records(spark, sf_dir).filter(condition).drop("id", "day").withColumns(date_parts(F.col("timestamp").try_cast("timestamp")))


def test_folding_keeps_every_row_at_every_step(spark, sf_dir, folder, monkeypatch):
    for k in range(3):
        tables.write_bronze(bronze_rows(spark, sf_dir, f"id % 3 = {k} and record_type = 'sleep_log'"), folder, "w", str(k))
    wanted = rows(tables.read_bronze(spark, folder, "sleep_log"))
    real = tables.retire
    monkeypatch.setattr(tables, "retire", lambda s, r, name, *more: real(s, r, name, *more) if name == "none" else 1 / 0)
    with pytest.raises(ZeroDivisionError):  # the fold is written, its mark is not
        tables.fold_bronze(spark, folder, "sleep_log")
    assert rows(tables.read_bronze(spark, folder, "sleep_log")) == wanted
    monkeypatch.setattr(tables, "retire", real)
    days = len({v[1:4] for v in tables.bronze_partitions(spark, folder).values()})
    assert tables.fold_bronze(spark, folder, "sleep_log") > days
    assert rows(tables.read_bronze(spark, folder, "sleep_log")) == wanted
    assert len(tables.bronze_partitions(spark, folder)) == days and tables.fold_bronze(spark, folder, "sleep_log") == 0
    tables.clear_retired(spark, folder)
    assert rows(tables.read_bronze(spark, folder, "sleep_log")) == wanted
    assert len(files.listed(spark, f"{folder}/record_type=*/year=*/month=*/day=*/writer=*/batch=*")) == days


def test_a_replay_loses_and_doubles_nothing(spark, sf_dir, folder):
    landing, bronze = f"{folder}/landing", f"{folder}/bronze"
    fx.payloads(spark, sf_dir).select("value").repartition(3).write.text(landing)
    total = fx.payloads(spark, sf_dir).count()
    first = ingest.ingest_messages(ingest.text_stream(spark, landing, max_files=1), bronze, f"{folder}/memory")
    again = ingest.ingest_messages(ingest.text_stream(spark, landing), bronze, f"{folder}/memory")
    assert ingest.writer_of(first) == ingest.writer_of(again) == str(first.id)
    found = {r["writer"]: (r["n_batches"], r["rows_held"]) for r in ingest.totals(spark, bronze).collect()}
    assert found == {ingest.writer_of(first): (3, total)}  # of both runs, read after the first has ended
    replay = ingest.ingest_messages(ingest.text_stream(spark, landing), bronze, f"{folder}/fresh")
    assert ingest.writer_of(replay) != ingest.writer_of(first)
    before = spark.read.parquet(bronze).count()
    assert before == 2 * total  # a new query never overwrites
    tables.retire_writer(spark, bronze, ingest.writer_of(first))
    assert {r["writer"]: r["rows_held"] for r in ingest.totals(spark, bronze).collect()} == {ingest.writer_of(replay): total}
    known = {r["record_type"]: r["count"] for r in spark.read.parquet(f"{bronze}").groupBy("record_type").count().collect()}
    for t in schemas.RECORD_TYPES:
        assert 2 * tables.read_bronze(spark, bronze, t).count() == known[t]


def test_incremental_gold_equals_a_full_run(spark, sf_dir, folder):
    refs = fx.references(spark, sf_dir)
    late = "(day > date'2024-01-20' or (day = date'2024-01-10' and id % 3 = 0))"
    roots = [f"{folder}/{n}" for n in ("bronze", "silver", "gold")]
    tables.write_bronze(bronze_rows(spark, sf_dir, f"not {late}"), roots[0], "w", "1")
    assert set(incremental.refresh(spark, *roots, refs)) == set(schemas.RECORD_TYPES)
    assert incremental.refresh(spark, *roots, refs) == {}
    dated = lambda: {p: t for p, t in parts_of(folder).items() if "date=2024-01-05" in p or "date=2024-01-19" in p}
    before = dated()
    tables.write_bronze(bronze_rows(spark, sf_dir, late), roots[0], "w", "2")
    incremental.refresh(spark, *roots, refs)
    assert before and dated() == before
    runs.run_silver(spark, roots[0], f"{folder}/full_silver", refs)
    runs.run_gold(spark, f"{folder}/full_silver", f"{folder}/full_gold")
    for t in schemas.RECORD_TYPES:
        for read in (tables.read_silver, tables.read_quarantine):
            assert rows(read(spark, roots[1], t)) == rows(read(spark, f"{folder}/full_silver", t))
    for name in runs.GOLD_INPUTS:
        whole = spark.read.parquet(f"{folder}/full_gold/{name}")
        ours = spark.read.parquet(f"{roots[2]}/{name}").select(*whole.columns)
        cut = lambda df: rows(df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes]))
        assert cut(ours) == cut(whole), name


def test_a_quarantine_that_empties_leaves_nothing_stale(spark, folder):
    from test_quality import record
    roots = [f"{folder}/{n}" for n in ("bronze", "silver", "gold")]
    dated = lambda batch: batch.withColumns(date_parts(F.col("timestamp").try_cast("timestamp")))
    bad = record(spark, "workout_log", [{"rpe": 99, "duration_minutes": 50}])
    tables.write_bronze(dated(bad), roots[0], "w", "1")
    incremental.refresh(spark, *roots, {})
    assert tables.read_quarantine(spark, roots[1], "workout_log").count() == 1
    good = record(spark, "workout_log", [{"rpe": 5, "duration_minutes": 40}])  # same key, smaller row
    tables.write_bronze(dated(good), roots[0], "w", "2")
    incremental.refresh(spark, *roots, {})
    assert tables.read_quarantine(spark, roots[1], "workout_log").count() == 0
    assert tables.read_silver(spark, roots[1], "workout_log").first()["rpe"] == 5
