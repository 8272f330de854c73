"""Measures over days and the as-of join against plain loops."""

import datetime as dt
import random
import statistics

import pytest

from conftest import rows
from pulselake.operators import temporal
from pulselake.plans import rolling

START = dt.date(2024, 1, 1)


def workouts(seed):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", None]), START + dt.timedelta(days=rng.randrange(120)) if rng.random() < 0.95 else None,
             rng.choice([30, 60, None]), rng.randint(1, 10)) for _ in range(300)]


def test_workload_ratio_equals_plain_sums(spark):
    data = workouts(1)
    frame = spark.createDataFrame(data, "user_id string, date date, duration_minutes int, rpe int").repartition(4)
    loads = {}
    for user, day, minutes, rpe in data:
        if user and day:
            loads[user, day] = loads.get((user, day), 0) + (minutes or 0) * rpe
    found = {(r.user_id, r.date): r for r in rolling.workload_ratio(frame).collect()}
    assert found.keys() == loads.keys()
    for (user, day), r in found.items():
        week, month = (sum(v for (u, d), v in loads.items() if u == user and 0 <= (day - d).days < n) for n in (7, 28))
        assert (r.acute_load, r.chronic_load) == (week, month)
        assert r.workload_ratio is None if not month else r.workload_ratio == pytest.approx(week / (month / 4), abs=0.0051)


def test_hrv_baseline_equals_plain_statistics(spark):
    rng = random.Random(2)
    data = [(rng.choice("ab"), START + dt.timedelta(days=rng.randrange(90)), rng.choice([None, 20.0, 45.0, 80.0, 61.0])) for _ in range(400)]
    found = rolling.hrv_baseline(spark.createDataFrame(data, "user_id string, date date, hrv double").repartition(3)).collect()
    assert len(found) == len({(u, d) for u, d, _ in data})
    for r in found:
        past = [h for u, d, h in data if u == r.user_id and 1 <= (r.date - d).days <= 28 and h is not None]
        now = [h for u, d, h in data if (u, d) == (r.user_id, r.date) and h is not None]
        assert r.baseline_readings == len(past)
        if past:
            assert r.baseline_hrv == pytest.approx(statistics.mean(past), abs=0.0051)
        if len(past) > 1:
            deviation = statistics.stdev(past)
            assert r.baseline_deviation == pytest.approx(deviation, abs=0.0051)
            if now and deviation > 1e-6:
                assert r.hrv_z == pytest.approx((statistics.mean(now) - statistics.mean(past)) / deviation, abs=0.0051)


def test_no_user_is_sorted_as_a_whole(spark):
    frame = spark.range(10).selectExpr("concat('a', id) as user_id", "date_add(date'2024-01-01', cast(id as int)) as date", "id as load")
    plan = rolling.rolling(frame, {"week": ("load", -6, 0)})._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan and "_period" in plan.split("hashpartitioning(user_id", 1)[1].split(")")[0]


def test_calories_need_a_met_value_and_a_weight(spark):
    sessions = spark.createDataFrame([("a", 90, 8.0), ("a", 30, None), ("b", 60, 5.0)], "user_id string, duration_minutes int, met_value double")
    weights = spark.createDataFrame([("a", 70.0)], "user_id string, weight_kg double")
    assert rows(rolling.session_calories(sessions, weights).select("calories")) == rows(spark.createDataFrame([(840.0,), (None,), (None,)], "calories double"))


def test_alerts_compare_with_own_history(spark):
    past = spark.createDataFrame([(float(v),) for v in (10, 12, 11, 9, 10, 11, 12, 10)], "pct_unprofiled double")
    today = spark.createDataFrame([("d1", 11.0), ("d2", 40.0)], "d string, pct_unprofiled double")
    assert {r.d: r.alert for r in rolling.against_history(today, past).collect()} == {"d1": False, "d2": True}
    assert not any(r.alert for r in rolling.against_history(today, past.limit(3)).collect())
    assert not any(r.alert for r in rolling.against_history(today, past.limit(0)).collect())


@pytest.mark.parametrize("period", ["day", "month", "year"])
def test_as_of_join_equals_the_range_join(spark, period):
    rng = random.Random(7)
    versions, facts = [], []
    for user in ["u1", "u2", "u3"]:
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(20))
        for k in range(25):
            end = at + dt.timedelta(hours=rng.choice([1, 12, 24, 70, 400]))
            start = dt.datetime(1900, 1, 1) if k == 0 and user != "u2" else at
            versions.append((user, k, start, end if k < 24 else None, f"{user}-{k}"))
            at = end + dt.timedelta(hours=rng.choice([0, 0, 0, 30]))  # some gaps
    for k in range(300):
        facts.append((k, rng.choice(["u1", "u2", "u3", "nobody", None]), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(400))))
    v = spark.createDataFrame(versions, "user_id string, user_sk int, effective_date_for_join timestamp, end_date timestamp, job string").repartition(3)
    f = spark.createDataFrame(facts, "fact_id int, user_id string, event_date date").repartition(3)
    for keep in (False, True):
        ours = temporal.as_of_join(f, v, keep, period).select("fact_id", "user_id", "event_date", "user_sk", "job")
        plain = temporal.point_in_time_join(f, v, keep).select("fact_id", "user_id", "event_date", "user_sk", "job")
        assert rows(ours) == rows(plain)
    assert not temporal.as_of_join(f, v.limit(0)).collect()


def test_as_of_join_multiplies_no_rows(spark):
    v = spark.createDataFrame([], "user_id string, effective_date_for_join timestamp, end_date timestamp")
    f = spark.createDataFrame([], "fact_id int, user_id string, event_date date")
    plan = temporal.as_of_join(f, v).select("fact_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and ">=" not in plan.split("Join LeftOuter", 1)[1].splitlines()[0]
