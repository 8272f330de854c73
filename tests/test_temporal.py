import datetime as dt
import random

from pyspark.sql import functions as F

from pulselake import schemas
from pulselake.operators import temporal

START = dt.datetime(2024, 1, 1)


def profile_history(seed, users=6, events=120):
    rng = random.Random(seed)
    history, used = [], set()
    for _ in range(events):
        # one user holds about a third of all events
        user = "U0" if rng.random() < 0.35 else f"U{rng.randrange(1, users)}"
        ts = START + dt.timedelta(seconds=rng.choice([rng.randrange(300), rng.randrange(20 * 86400)]))
        if (user, ts) in used:
            continue
        used.add((user, ts))
        history.append((user, ts, rng.choice(["a", "b", None]), rng.choice(["x", "y"])))
    return history


def expected_versions(history):
    versions = []
    for user in sorted({h[0] for h in history}):
        mine = sorted((h for h in history if h[0] == user), key=lambda h: h[1])
        kept = [h for i, h in enumerate(mine) if i == 0 or mine[i - 1][2:] != h[2:]]
        for i, h in enumerate(kept):
            versions.append((user, h[1], kept[i + 1][1] if i + 1 < len(kept) else None, h[2], h[3]))
    return sorted(versions, key=repr)


def test_versions_match_brute_force_for_any_bucket(spark):
    for seed in range(3):
        history = profile_history(seed)
        df = spark.createDataFrame(history, "user_id string, timestamp timestamp, job string, goal string")
        for bucket in ("minute", "day", "year"):
            found = temporal.change_rows(df.repartition(5), ("job", "goal"), bucket=bucket)
            got = sorted(
                ((r.user_id, r.timestamp, r.end_date, r.job, r.goal) for r in found.collect()), key=repr)
            assert got == expected_versions(history), (seed, bucket)


def dimension(spark, versions):
    blank = {f.name: None for f in schemas.STAR["dim_user"]}
    data = [
        tuple({**blank, "user_sk": i, "user_id": u, "effective_date": s, "end_date": e,
               "is_current": e is None, "job_type": j}[f.name] for f in schemas.STAR["dim_user"])
        for i, (u, s, e, j, _) in enumerate(versions)
    ]
    return spark.createDataFrame(data, schemas.STAR["dim_user"])


def test_first_version_is_open_and_others_keep_their_start(spark):
    versions = expected_versions(profile_history(1))
    staged = temporal.stage_dim_user(dimension(spark, versions)).collect()
    firsts = {}
    for user, start, *_ in versions:
        firsts[user] = min(firsts.get(user, start), start)
    assert len(staged) == len(versions)
    for r in staged:
        opened = r.effective_date == firsts[r.user_id]
        assert r.effective_date_for_join == (dt.datetime(1900, 1, 1) if opened else r.effective_date)


def test_point_in_time_join_matches_brute_force(spark):
    for seed in range(3):
        versions = expected_versions(profile_history(seed))
        staged = temporal.stage_dim_user(dimension(spark, versions))
        spans = [(r.user_id, r.effective_date_for_join, r.end_date, r.user_sk) for r in staged.collect()]
        facts = [(f"U{u}", START.date() + dt.timedelta(days=d)) for u in range(8) for d in range(-2, 22)]
        df = spark.createDataFrame(facts, "user_id string, event_date date")
        expected = []
        for user, day in facts:
            at = dt.datetime.combine(day, dt.time())
            expected += [(user, day, sk) for u, s, e, sk in spans
                         if u == user and s <= at < (e or dt.datetime(9999, 12, 31))]
        joined = temporal.point_in_time_join(df, staged.select(
            "user_id", "user_sk", "effective_date_for_join", "end_date"))
        got = [(r.user_id, r.event_date, r.user_sk) for r in joined.collect()]
        assert sorted(got) == sorted(expected)
        kept = temporal.point_in_time_join(df, staged.select(
            "user_id", "user_sk", "effective_date_for_join", "end_date"), keep_unmatched=True)
        assert kept.count() == len(facts)


def test_overlapping_and_gapped_validity_is_respected(spark):
    spans = [("U1", "2024-01-01 00:00:00", "2024-01-03 00:00:00", 1), ("U1", "2024-01-02 00:00:00", None, 2),
             ("U1", "2024-01-02 00:00:01", "2024-01-02 23:59:59", 3)]
    versions = spark.createDataFrame(spans, "user_id string, s string, e string, user_sk int").select(
        "user_id", "user_sk", F.col("s").cast("timestamp").alias("effective_date_for_join"),
        F.col("e").cast("timestamp").alias("end_date"))
    facts = spark.createDataFrame([("U1", dt.date(2024, 1, d)) for d in (1, 2, 3)], "user_id string, event_date date")
    joined = temporal.point_in_time_join(facts, versions).collect()
    assert sorted((r.event_date.day, r.user_sk) for r in joined) == [(1, 1), (2, 1), (2, 2), (3, 2)]


def test_version_after_midnight_does_not_cover_its_own_day(spark):
    versions = spark.createDataFrame([("U1", dt.datetime(2024, 1, 2, 11), None, 1)],
                                     "user_id string, effective_date_for_join timestamp, end_date timestamp, user_sk int")
    facts = spark.createDataFrame([("U1", dt.date(2024, 1, 2)), ("U1", dt.date(2024, 1, 3))],
                                  "user_id string, event_date date")
    assert [r.event_date.day for r in temporal.point_in_time_join(facts, versions).collect()] == [3]
