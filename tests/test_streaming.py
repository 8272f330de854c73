import base64
import json

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from conftest import rows
from pulselake import schemas
from pulselake.functions.codec import decode_records, unwrap_envelope
from pulselake.operators.quality import refine
from pulselake.sources import tables
from pulselake.streaming import ingest
from pulselake.streaming.silver import silver_stream


def encoded(spark, texts):
    data = [(base64.b64encode(t).decode() if isinstance(t, bytes) else t,) for t in texts]
    return spark.createDataFrame(data, "value string")


def test_every_message_is_kept_with_its_verdict(spark):
    good = json.dumps({"record_type": "workout_log", "user_id": "U1", "rpe": 5, "muscle_groups": ["back", "core"]})
    messages = encoded(spark, [
        good.encode(), b'{"user_id": "U2"}', b'{"record_type": "new_kind", "user_id": "U3"}',
        b'{"record_type": "wearable_event", "heart_rate": "high"}', b'{"record_type": ', b"\xff\xfe", "***", None])
    decoded = decode_records(messages)
    found = [(r.record_type, r.reject_reason) for r in decoded.collect()]
    assert found == [
        ("workout_log", None), ("unknown", None), ("new_kind", None), ("wearable_event", "schema_mismatch"),
        ("unknown", "invalid_json"), ("unknown", "undecodable"), ("unknown", "undecodable"), ("unknown", "undecodable")]
    first = decoded.first()
    assert (first.user_id, first.rpe, first.muscle_groups) == ("U1", 5, '["back","core"]')
    kept = {r.record_type: r.payload for r in ingest.bronze_rows(messages).collect() if r.payload}
    assert set(kept) == {"unknown", "new_kind", "rejected"}


def test_plain_envelope(spark):
    envelope = json.dumps({"data": {"record_type": "sleep_log", "user_id": "U1", "total_sleep_hours": 7.5},
                           "partition_key": "U1", "partition_id": 0, "offset": 3, "topic": "t"})
    df = spark.createDataFrame([(envelope,)], "raw string").select(unwrap_envelope(F.col("raw")).alias("value"))
    row = decode_records(df, encoding="text").first()
    assert (row.record_type, row.user_id, row.total_sleep_hours) == ("sleep_log", "U1", 7.5)
    with pytest.raises(ValueError):
        decode_records(df, encoding="zip")


def test_only_new_files_are_read_and_a_rerun_adds_nothing(spark, sf_dir, folder):
    bronze = fx.bronze(spark, sf_dir, "sleep_log")
    cold, warm = bronze.filter("awakenings < 4"), bronze.filter("awakenings >= 4")
    landing = f"{folder}/landing"
    read = []
    for delivery in (cold, warm, None):
        if delivery is not None:
            delivery.coalesce(1).write.mode("append").parquet(landing)
        finished = ingest.ingest_files(spark, "sleep_log", landing, f"{folder}/bronze", f"{folder}/memory")
        read.append(ingest.progress(finished)["rows_read"])
    assert read == [cold.count(), warm.count(), 0]
    stored = spark.read.parquet(f"{folder}/bronze")
    assert rows(stored.select(*bronze.columns)) == rows(bronze)
    assert stored.filter("_ingested_at is null or _source_file not like '%landing%'").isEmpty()


def test_bounded_batches_read_everything(spark, sf_dir, folder):
    fx.payloads(spark, sf_dir).select("value").repartition(6).write.text(f"{folder}/landing")
    stream = ingest.text_stream(spark, f"{folder}/landing", max_files=2)
    finished = ingest.ingest_messages(stream, f"{folder}/bronze", f"{folder}/memory")
    seen = ingest.progress(finished)
    assert seen["n_batches"] == 3 and seen["rows_read"] == fx.payloads(spark, sf_dir).count()
    assert spark.read.parquet(f"{folder}/bronze").count() == seen["rows_read"]


@pytest.mark.parametrize("record_type", schemas.RECORD_TYPES)
def test_stream_equals_batch(spark, sf_dir, folder, record_type):
    refs = fx.references(spark, sf_dir)
    bronze = fx.records(spark, sf_dir).filter(F.col("record_type") == record_type)
    names = schemas.BRONZE[record_type].names
    for condition in ("day <= date'2024-01-15'", "day > date'2024-01-15'", "day <= date'2024-01-03'"):
        bronze.filter(condition).select(*names).write.mode("append").parquet(f"{folder}/bronze")
        source = ingest.file_stream(spark, f"{folder}/bronze", schemas.BRONZE[record_type])
        silver_stream(source, f"{folder}/silver", record_type, refs, f"{folder}/memory")
    judged = refine(bronze.select(*names), record_type).withColumn("date", F.to_date("timestamp"))
    columns = [*names, "failure_reason", "date"]
    valid, bad = judged.filter("is_valid").select(columns), judged.filter("not is_valid").select(columns)
    assert rows(tables.read_silver(spark, f"{folder}/silver", record_type).select(columns)) == rows(valid)
    assert rows(tables.read_quarantine(spark, f"{folder}/silver", record_type).select(columns)) == rows(bad)


def test_streams_and_loads_share_a_root(spark, sf_dir, folder):
    records = fx.records(spark, sf_dir)
    parts = ingest.date_parts(F.col("timestamp").try_cast("timestamp"))
    expected = {}
    for t in schemas.RECORD_TYPES:
        one = records.filter(F.col("record_type") == t).select(*schemas.BRONZE[t].names)
        one.write.parquet(f"{folder}/landing/{t}")
        for checkpoint in ("first", "replay"):
            ingest.ingest_files(spark, t, f"{folder}/landing/{t}", f"{folder}/bronze", f"{folder}/{checkpoint}/{t}")
        tables.write_bronze(one.withColumns(parts), f"{folder}/bronze")
        expected[t] = 3 * one.count()
    assert {t: tables.read_bronze(spark, f"{folder}/bronze", t).count() for t in schemas.RECORD_TYPES} == expected


def test_progress_counts_every_batch(spark, sf_dir, folder):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        fx.payloads(spark, sf_dir).select("value").repartition(5).write.text(f"{folder}/landing")
        done = ingest.ingest_messages(ingest.text_stream(spark, f"{folder}/landing", max_files=1), f"{folder}/bronze", f"{folder}/memory")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert ingest.progress(done) == {"n_batches": 5, "rows_read": spark.read.parquet(f"{folder}/bronze").count()}


def test_unreadable_rows_are_told_apart(spark, folder):
    data = [("sleep_log", "u", "?", 1), ("sleep_log", "u", "?", 2), ("sleep_log", None, "2024-01-01", 1), ("sleep_log", "u", "?", 1), ("workout_log", "u", "?", 1)]
    layout = "record_type string, user_id string, timestamp string, n int"
    spark.createDataFrame(data, layout).write.parquet(f"{folder}/landing")
    for _ in range(2):
        stream = ingest.file_stream(spark, f"{folder}/landing", spark.createDataFrame([], layout).schema)
        ingest.append_unique(stream, f"{folder}/out", f"{folder}/memory")
    assert spark.read.parquet(f"{folder}/out").count() == 4


def test_redelivered_rows_meet_state_and_older_copies_the_table(spark, folder):
    layout = "record_type string, user_id string, timestamp string, n int, at timestamp"
    instant = "2024-01-01 00:00:00.00000"
    first = [("sleep_log", "u", "2024-01-01 00:00:00", 1, None), ("sleep_log", None, "?", 1, f"{instant}1"), ("sleep_log", None, "?", 1, f"{instant}2")]
    later = [*first, ("sleep_log", "u", "2024-01-01 00:00:00", 2, None), ("sleep_log", "v", "1999-01-01 00:00:00", 1, None)]

    def deliver(data):
        cast = spark.createDataFrame(data, layout.replace("at timestamp", "at string")).withColumn("at", F.col("at").cast("timestamp"))
        cast.coalesce(1).write.mode("append").parquet(f"{folder}/landing")

    def dropped(query):
        return sum(int(s["customMetrics"].get("numDroppedDuplicateRows", 0)) for p in query.recentProgress for s in p["stateOperators"])

    def run(checkpoint):
        stream = ingest.file_stream(spark, f"{folder}/landing", spark.createDataFrame([], layout).schema)
        return dropped(ingest.append_unique(stream, f"{folder}/out", f"{folder}/{checkpoint}", redelivered="1 hour"))

    deliver(first)
    seen = [run("memory")]
    deliver(later)
    seen += [run("memory"), run("replay")]  # a replay has no state of its own: the table drops all its rows
    assert seen == [0, 3, 3]
    found = spark.read.parquet(f"{folder}/out")
    assert sorted(found.select("n", "user_id").collect(), key=str) == sorted([(1, "u"), (1, None), (1, None), (1, "v")], key=str)
    assert found.filter("user_id is null").select("at").distinct().count() == 2
