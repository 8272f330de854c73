import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pulselake import schemas
from pulselake.operators import audit, expectations, upsert
from pulselake.operators.calendar import date_dimension
from pulselake.plans import runs
from pulselake.sources import tables
from test_quality import record


def test_missing_tables_read_as_empty_with_schema(spark, folder):
    assert tables.read_bronze(spark, folder, "sleep_log").count() == 0
    silver = tables.read_silver(spark, folder, "sleep_log")
    assert silver.count() == 0 and "failure_reason" in silver.columns
    assert set(tables.read_reference(spark, folder).values()) == {None}


def test_reference_csv_keeps_its_types(spark, folder):
    row = ("GYM1", "A, \"B\" gym", "X", None, "functional", 80, 1500, 2019, False, True)
    gyms = spark.createDataFrame([row], schemas.REFERENCE["gym_master"])
    tables.write_reference(gyms, folder, "gym_master")
    refs = tables.read_reference(spark, folder)
    assert tuple(refs["gym_master"].first()) == row
    assert refs["workout_catalog"] is None


def test_records_of_one_batch_go_to_their_own_days(spark, folder):
    late = record(spark, "sleep_log", [{"timestamp": "2024-01-31 23:59:59"}, {"timestamp": "2024-02-01 00:00:01"}])
    from pulselake.functions.texts import date_parts
    tables.write_bronze(late.withColumns(date_parts(F.col("timestamp").try_cast("timestamp"))), folder)
    stored = tables.read_bronze(spark, folder, "sleep_log")
    assert sorted((r.year, r.month, r.day) for r in stored.collect()) == [("2024", "01", "31"), ("2024", "02", "01")]
    assert tables.read_bronze(spark, folder, "user_profile").count() == 0


def test_rewriting_judged_rows_leaves_nothing_stale(spark, folder):
    mixed = record(spark, "workout_log", [{}, {"rpe": 99}])
    counts = tables.write_judged(runs.judge(mixed, "workout_log", {}), folder, "workout_log")
    assert counts == {"silver_rows": 1, "quarantine_rows": 1}
    clean = record(spark, "workout_log", [{}, {}])
    counts = tables.write_judged(runs.judge(clean, "workout_log", {}), folder, "workout_log")
    assert counts == {"silver_rows": 2, "quarantine_rows": 0}
    assert tables.read_quarantine(spark, folder, "workout_log").count() == 0
    nothing = runs.judge(clean.filter("rpe > 99"), "workout_log", {})
    assert tables.write_judged(nothing, f"{folder}/empty", "workout_log") == {"silver_rows": 0, "quarantine_rows": 0}
    assert tables.read_silver(spark, folder, "workout_log").first().date == dt.date(2024, 1, 1)


def test_enrichment_survives_missing_references(spark):
    profile = runs.judge(record(spark, "user_profile", [{"gym_id": "GYM1"}]), "user_profile", {})
    assert profile.first().medical_risk_modifier == 1.0 and "gym_type" not in profile.columns
    assert "job_type" not in runs.judge(record(spark, "sleep_log", [{}]), "sleep_log", {}).columns


def test_enrichment_adds_only_columns_the_profile_table_has(spark):
    users = spark.createDataFrame([("U1", "active")], "user_id string, job_type string")
    judged = runs.judge(record(spark, "sleep_log", [{}]), "sleep_log", {"user_profiles": users})
    assert judged.first().job_type == "active" and "gym_id" not in judged.columns


def test_quarantined_rows_are_not_enriched(spark):
    conditions = spark.createDataFrame([("none", 1.0)], "condition string, risk_modifier double")
    bad = record(spark, "user_profile", [{"age": 5, "medical_history": "none"}])
    row = runs.judge(bad, "user_profile", {"medical_conditions": conditions}).first()
    assert row.failure_reason == "age_out_of_range" and row.medical_risk_modifier is None


def test_gold_overwrite_may_change_columns(spark, folder):
    assert tables.write_gold(spark.range(3), folder, "g") == 3
    assert tables.write_gold(spark.range(2).withColumn("x", F.lit(1)), folder, "g") == 2
    assert spark.read.parquet(f"{folder}/g").columns == ["id", "x"]
    assert tables.write_gold(spark.range(0), folder, "g") == 0


def test_append_adds_each_key_once_also_null_keys(spark, folder):
    def load(keys):
        data = [(k, dt.date(2024, 1, d)) for k, d in keys]
        return spark.createDataFrame(data, "user_id string, date date")

    assert tables.append_new_rows(load([("a", 1), (None, 1)]), folder, ["user_id", "date"]) == 2
    assert tables.append_new_rows(load([("a", 1), (None, 1), ("a", 2)]), folder, ["user_id", "date"]) == 1
    assert tables.append_new_rows(load([("a", 2)]), folder, ["user_id", "date"]) == 0
    assert spark.read.parquet(folder).count() == 3


def test_append_reads_only_touched_partitions(spark, folder):
    days = spark.range(30).select(
        F.col("id").cast("string").alias("user_id"),
        F.when(F.col("id") > 0, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))).alias("date"))
    tables.append_new_rows(days, folder, ["user_id"])
    table = spark.read.parquet(folder)
    for two in (days.filter("id in (3, 4)"), days.filter("id in (0, 4)"), days):
        assert rows(tables.touched(table, two, "date")) == rows(two)
    assert tables.append_new_rows(days, folder, ["user_id"]) == 0


def test_audit_log_replaces_only_its_own_run(spark, folder):
    for run, n in (("r1", 3), ("r2", 2), ("r2", 1)):
        tables.append_audit(spark.range(n), folder, run)
    assert rows(spark.read.parquet(folder).groupBy("run_id").count()) == [(1, "r2"), (3, "r1")]
    tables.append_audit(spark.range(0), folder, "r1")
    assert rows(spark.read.parquet(folder).groupBy("run_id").count()) == [(1, "r2")]


def people(spark, data, extra=""):
    return spark.createDataFrame(data, "user_id string, timestamp int, job string" + extra)


def test_upsert_labels_and_evolves(spark):
    target = people(spark, [("a", 1, "x"), ("b", 1, "y"), ("c", 1, None)])
    source = people(spark, [("a", 1, "x", None), ("b", 2, "z", 5), ("c", 1, None, None), ("d", 1, "n", 6)], ", kg int")
    merged = {r.user_id: r.asDict() for r in upsert.merge_upsert(target, source).collect()}
    assert {k: v[upsert.ACTION] for k, v in merged.items()} == {
        "a": "unchanged", "b": "updated", "c": "unchanged", "d": "inserted"}
    assert (merged["b"]["job"], merged["b"]["kg"], merged["a"]["kg"]) == ("z", 5, None)
    narrow = source.filter("user_id = 'b'").select("user_id", "job")
    kept = {r.user_id: r for r in upsert.merge_upsert(target, narrow).collect()}
    assert kept["b"].timestamp == 1 and kept["b"].job == "z" and kept["a"][upsert.ACTION] == "kept"


def test_upsert_table_twice_changes_nothing(spark, folder):
    name = "people_" + folder[-12:]
    first = people(spark, [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")])
    assert upsert.upsert_table(first, name, folder, by="timestamp")["inserted"] == 2
    second = people(spark, [("b", 3, "w"), ("c", 1, "v")])
    assert upsert.upsert_table(second, name, folder, by="timestamp") == {
        "inserted": 1, "updated": 1, "unchanged": 0, "kept": 1}
    again = upsert.upsert_table(second, name, folder, by="timestamp")
    assert (again["inserted"], again["updated"], again["unchanged"]) == (0, 0, 2)
    assert rows(spark.table(name)) == [("v", 1, "c"), ("w", 3, "b"), ("y", 2, "a")]


def test_reconcile_names_every_kind_of_difference(spark):
    landing = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None), ("d", 4.0)], "user_id string, score double")
    final = spark.createDataFrame([("a", 1.0), ("b", 9.0), ("c", None), ("e", 5.0)], "user_id string, score double")
    found = audit.reconcile(landing, final, {"user_id": "user_id"}, ["score"])
    assert {r.user_id: r.difference for r in found.collect()} == {
        "b": "value_differs", "d": "missing_in_final", "e": "missing_in_landing"}
    assert audit.reconcile(landing, landing, {"user_id": "user_id"}, ["score"]).isEmpty()


def test_rates_guard_against_empty_groups(spark):
    empty = spark.createDataFrame([], "record_type string, failure_reason string")
    assert audit.quarantine_rate(empty, ()).first().pct_quarantined is None
    assert audit.quarantine_rate(empty).isEmpty()


def test_expectations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, -3)], "k string, v int")
    counts = {r.check_name: r.violations for r in expectations.null_counts(df, "t", ["k", "v"]).collect()}
    assert counts == {"not_null t.k": 1, "not_null t.v": 0}
    assert expectations.duplicate_count(df, "t", ["k"]).first().violations == 1
    assert rows(expectations.unaccepted_values(df, "k", ["b"])) == [("a", 1), ("a", 2)]
    parent = spark.createDataFrame([("b",), ("a",), ("a",)], "id string")
    assert expectations.orphans(df, "k", parent, "id").isEmpty()
    assert rows(expectations.outside_range(df, "v", 0, 1)) == [("a", 2), (None, -3)] or \
        len(rows(expectations.outside_range(df, "v", 0, 1))) == 2
    assert expectations.differing_counts(df, df, ("a", "b")).isEmpty()
    assert tuple(expectations.differing_counts(df, parent.limit(1), ("a", "b")).first()) == (3, 1)
    assert expectations.grain(df, df, ["k"], "t").first().passes is False


def test_date_dimension(spark):
    bounds = spark.createDataFrame([(dt.date(2026, 1, 1), dt.date(2026, 12, 31))], "first_date date, last_date date")
    days = {r.full_date: r for r in date_dimension(bounds).collect()}
    assert len(days) == 365
    for day, r in days.items():
        assert r.date_id == day.strftime("%Y%m%d") and r.week_of_year == day.isocalendar()[1]
        assert (r.month_name, r.day_name) == (day.strftime("%B"), day.strftime("%A"))
        assert (r.day_of_week, r.is_weekend) == (day.weekday(), day.weekday() >= 5)
        assert (r.quarter, r.day_of_year) == ((day.month + 2) // 3, day.timetuple().tm_yday)


def test_one_failing_type_does_not_stop_the_run(spark, folder, monkeypatch):
    from pulselake.functions.texts import date_parts
    for t in ("sleep_log", "workout_log"):
        batch = record(spark, t, [{}])
        tables.write_bronze(batch.withColumns(date_parts(F.col("timestamp").try_cast("timestamp"))), f"{folder}/bronze/{t}")
    real = runs.judge
    monkeypatch.setattr(runs, "judge", lambda b, t, r, *more: real(b, t, r, *more) if t != "sleep_log" else 1 / 0)
    found = {}
    for t in ("sleep_log", "workout_log", "user_profile"):
        found[t] = runs.run_silver(spark, f"{folder}/bronze/{t}", f"{folder}/silver", {}, [t])[0]["status"]
    assert found == {"sleep_log": "error", "workout_log": "success", "user_profile": "skipped_no_data"}
    summary = {s["table_name"]: s["status"] for s in runs.run_gold(spark, f"{folder}/silver", f"{folder}/gold")}
    assert summary["gold_workout_consistency"] == "success"
    assert summary["gold_fatigue_recovery"] == "skipped_missing_input"


def test_workspace_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from pulselake import session

    class Conf:
        @staticmethod
        def get(_key, _default):
            return None

    class Fake:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.workspace(Fake(), "x")
