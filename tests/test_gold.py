import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pulselake.functions import scoring, texts
from pulselake.functions.numbers import percent, round_half_up
from pulselake.plans import gold

DAY = dt.date(2024, 1, 1)
WEARABLE = "user_id string, date date, recovery_score double, stress_score bigint, hrv double"
SLEEP = "user_id string, date date, total_sleep_hours double"
WORKOUT = ("user_id string, date date, duration_minutes int, rpe int, muscle_groups string, "
           "completed boolean")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("x, digits, expected", [
    (1.005, 2, 1.01), (2.675, 2, 2.68), (-1.005, 2, -1.01), (0.125, 1, 0.1), (None, 2, None),
    (1e25, 2, 1e25),
])
def test_rounding_is_half_up_on_the_written_value(spark, x, digits, expected):
    assert value(spark, round_half_up(F.lit(x).cast("double"), digits)) == expected


def test_percent_of_nothing_is_null(spark):
    assert value(spark, percent(F.lit(0), F.lit(0))) is None
    assert value(spark, percent(F.lit(1), F.lit(3))) == 33.33


@pytest.mark.parametrize("text, quoted, bare, groups", [
    ("['back', 'core']", ["back", "core"], ["'back'", "'core'"], ["back", "core"]),
    ("[back, core]", None, ["back", "core"], ["back", "core"]),
    ('["back"]', ["back"], ['"back"'], ["back"]),
    ("[]", [], [""], []),
    (None, None, None, None),
])
def test_list_spellings(spark, text, quoted, bare, groups):
    t = F.lit(text).cast("string")
    assert value(spark, texts.parse_quoted_list(t)) == quoted
    assert value(spark, texts.parse_bare_list(t)) == bare
    assert value(spark, texts.parse_groups(t)) == groups


@pytest.mark.parametrize("debt, recovery, stress, expected", [
    (0.0, 100.0, 0.0, 0.0), (8.0, 0.0, 100.0, 100.0), (4.0, 50.0, 50.0, 50.0),
    (16.0, 0.0, 100.0, 100.0), (0.0, 200.0, 0.0, 0.0), (1.0, 50.0, None, None),
])
def test_fatigue_score(spark, debt, recovery, stress, expected):
    args = [F.lit(v).cast("double") for v in (debt, recovery, stress)]
    assert value(spark, scoring.fatigue_score(*args)) == expected


def test_labels_and_bmi(spark):
    label = lambda v: value(spark, scoring.readiness_label(F.lit(v).cast("double")))
    assert [label(v) for v in (70, 69.9, 40, 39.9, None)] == [
        "high_readiness", "moderate_readiness", "moderate_readiness", "low_readiness", "low_readiness"]
    assert value(spark, scoring.bmi(F.lit(70.0), F.lit(175))) == 22.9
    bands = [value(spark, scoring.bmi_category(F.lit(v))) for v in (18.4, 18.5, 25.0, 30.0)]
    assert bands == ["underweight", "normal", "overweight", "obese"]


def test_fatigue_table(spark):
    wearable = spark.createDataFrame([
        ("U1", DAY, 20.0, 90, 30.0), ("U1", DAY, 30.0, 100, 50.0),
        ("U2", DAY, 80.0, None, 60.0), ("U3", DAY, None, 10, None)], WEARABLE)
    sleep = spark.createDataFrame([("U1", DAY, 1.0), ("U1", DAY, 2.0), ("U9", DAY, 5.0)], SLEEP)
    workout = spark.createDataFrame([("U1", DAY, 30, 5, "[]", True), ("U1", DAY, 10, 2, "[]", False),
                                     ("U8", DAY, 1, 1, "[]", True)], WORKOUT)
    found = {r.user_id: r for r in gold.fatigue_recovery(wearable, sleep, workout).collect()}
    assert set(found) == {"U1", "U2", "U3"}
    one = found["U1"]
    assert (one.recovery_score, one.stress_score, one.hrv) == (25.0, 95.0, 40.0)
    assert (one.total_sleep_hours, one.sleep_debt_hours, one.training_load_today) == (1.5, 6.5, 170)
    assert one.fatigue_score == 82.5 and one.recovery_readiness == 17.5 and one.overtraining_flag is True
    two = found["U2"]
    assert (two.total_sleep_hours, two.sleep_debt_hours, two.training_load_today) == (8.0, 0.0, 0)
    assert two.fatigue_score is None and two.recovery_readiness is None
    assert two.overtraining_flag is False  # no load decides, whatever the score
    assert found["U3"].recovery_score is None


def test_fatigue_equals_three_groupings_and_two_joins(spark):
    ids = F.col("id")
    user = F.when(ids % 3 == 0, "U0").otherwise(F.concat(F.lit("U"), (ids % 7).cast("string")))
    date = F.when(ids % 11 == 0, None).otherwise(F.date_add(F.lit(DAY), (ids % 5).cast("int")))
    base = spark.range(600).withColumns({"user_id": user, "date": date})
    wearable = base.filter("id % 2 = 0").select("user_id", "date", (ids % 101).cast("double").alias("recovery_score"),
                                                (ids % 97).alias("stress_score"), (ids % 50).cast("double").alias("hrv"))
    sleep = base.filter("id % 5 < 2").select("user_id", "date", (ids % 12).cast("double").alias("total_sleep_hours"))
    workout = base.filter("id % 4 = 1").select("user_id", "date", (ids % 60).cast("int").alias("duration_minutes"),
                                               (ids % 10).cast("int").alias("rpe"))
    joined = (gold.wearable_daily(wearable).join(gold.sleep_daily(sleep), ["user_id", "date"], "left")
              .join(gold.training_load_daily(workout), ["user_id", "date"], "left")
              .fillna({"total_sleep_hours": 8.0, "training_load_today": 0}))
    columns = ["user_id", "date", "recovery_score", "stress_score", "hrv", "total_sleep_hours", "training_load_today"]
    assert rows(gold.fatigue_recovery(wearable, sleep, workout).select(columns)) == rows(joined.select(columns))


def test_consistency_table(spark):
    workout = spark.createDataFrame([
        ("U1", DAY, 30, 5, "['legs', 'core']", True), ("U1", DAY, 45, 6, "[core]", False),
        ("U1", DAY, 50, 6, "[]", None), ("U2", DAY, 10, 1, None, True)], WORKOUT)
    found = {r.user_id: r for r in gold.workout_consistency(workout).collect()}
    one = found["U1"]
    assert (one.total_sessions, one.completed_sessions, one.total_training_load) == (3, 1, 720)
    assert (one.avg_rpe, one.avg_duration_minutes, one.completion_rate_pct) == (5.67, 41.67, 33.33)
    assert [tuple(g) for g in one.muscle_group_breakdown] == [("core", 2), ("legs", 1)]
    assert found["U2"].muscle_group_breakdown is None


def cohort_inputs(spark):
    wearable = spark.createDataFrame([("U1", 50.0, 10, 20.0, "j", "g", 1), ("U1", 60.0, 20, 30.0, "j", "g", 2),
                                      ("U2", 90.0, 30, 40.0, None, None, 1)],
                                     "user_id string, recovery_score double, stress_score bigint, hrv double, "
                                     "job_type string, fitness_goal string, timestamp int")
    sleep = spark.createDataFrame([("U1", 7.0, "j", "g"), ("U2", 5.0, None, None), ("U3", 1.0, "j", "g")],
                                  "user_id string, total_sleep_hours double, job_type string, fitness_goal string")
    workout = spark.createDataFrame([("U1", 10, 5, True), ("U2", 20, 5, False)],
                                    "user_id string, duration_minutes int, rpe int, completed boolean")
    return wearable, sleep, workout


def test_community_by_profile_labels_users_without_one(spark):
    wearable, sleep, workout = cohort_inputs(spark)
    profiles = spark.createDataFrame([("U1", 1, "old", "g"), ("U1", 2, "j", "g"), ("U3", 1, "other", "g")],
                                     "user_id string, timestamp int, job_type string, fitness_goal string")
    found = {r.job_type: r for r in gold.community_analytics(wearable, sleep, workout, profiles).collect()}
    assert set(found) == {"j", "Unprofiled"}  # a cohort without readings does not appear
    assert found["j"].asDict() == {
        "job_type": "j", "fitness_goal": "g", "avg_recovery_score": 55.0, "avg_stress_score": 15.0,
        "avg_hrv": 25.0, "user_count_wearable": 1, "avg_sleep_hours": 7.0, "avg_training_load": 50.0,
        "avg_completion_rate_pct": 100.0}
    assert found["Unprofiled"].avg_sleep_hours == 5.0 and found["Unprofiled"].avg_completion_rate_pct == 0.0


def test_community_by_event_keeps_the_null_cohort_without_side_figures(spark):
    found = {r.job_type: r for r in gold.community_analytics_by_event(*cohort_inputs(spark)).collect()}
    assert set(found) == {"j", None}
    assert found["j"].avg_sleep_hours == 4.0 and found["j"].avg_training_load == 50.0
    lost = found[None]
    assert lost.user_count_wearable == 1 and lost.avg_recovery_score == 90.0
    assert (lost.avg_sleep_hours, lost.avg_training_load, lost.avg_completion_rate_pct) == (None, None, None)
