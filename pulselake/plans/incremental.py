"""Silver and Gold brought up to date by the dates that new Bronze batches touch.

Bronze folders name the type, date, writer and batch of their rows, so what is new, and which dates it
touches, is read from names alone. Silver is judged again for these dates only: copies of a key share a
date, so a date's verdict needs no other. Gold that is kept per date is computed again for the touched
dates; Gold per user or cohort is folded from states per date, which hold sums, counts and latest rows
and are replaced date by date in the same way. Files of untouched dates stay as they are.

What was included is written down last, so a run that fails is repeated in full and ends the same.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake import schemas
from pulselake.operators.enrich import References
from pulselake.operators.keys import latest_per_key
from pulselake.operators.quality import RULES, Rule
from pulselake.plans import gold
from pulselake.plans.runs import judge
from pulselake.session import side_by_side
from pulselake.sources import tables

SEEN = "_included"
_SEEN = "record_type string, year string, month string, day string, writer string, batch string"
Day = tuple[str | None, str | None, str | None]

FATIGUE = "gold_fatigue_recovery"
DAILY = ("wearable_event", "sleep_log", "workout_log")


def _user_days(wearable: DataFrame, sleep: DataFrame, workout: DataFrame) -> DataFrame:
    return gold.cohort_sums(wearable, sleep, workout, "date")


def _sessions(workout: DataFrame) -> DataFrame:
    return gold.session_sums(workout, "date")


def _profiles(profile: DataFrame) -> DataFrame:
    """Each user's latest profile row of each date."""
    wanted = profile.select("date", "timestamp", *gold.PROFILE_OUTPUT)
    return latest_per_key(wanted, ("user_id", "date"))


#: Tables kept per date: how a date is computed, and from which types.
PER_DATE = {
    FATIGUE: (gold.fatigue_recovery, DAILY),
    "state_user_day": (_user_days, DAILY),
    "state_session_day": (_sessions, ("workout_log",)),
    "state_profile_day": (_profiles, ("user_profile",)),
}


def unseen(spark: SparkSession, bronze_root: str, silver_root: str) -> list[tuple]:
    """Partitions of Bronze that no finished run has included."""
    known = tables.read_parquet_or_empty(spark, f"{silver_root}/{SEEN}", schemas.layout(_SEEN))
    done = {tuple(r) for r in known.distinct().collect()}  # names of folders, not rows
    return [v for v in tables.bronze_partitions(spark, bronze_root).values() if v[0] in schemas.RECORD_TYPES and v not in done]


def _date(day: Day) -> dt.date | None:
    return None if day[0] is None else dt.date(*map(int, day))


def refresh_silver(
    spark: SparkSession, bronze_root: str, silver_root: str, refs: References, touched: Mapping[str, set[Day]],
    rules: Mapping[str, Sequence[Rule]] = RULES, parity: bool = False,
) -> None:
    """Judge the touched dates of each type again and replace them in both zones."""

    def run(record_type: str) -> None:
        days = touched[record_type]
        bronze = tables.read_bronze(spark, bronze_root, record_type, days).drop("year", "month", "day")
        judged = tables.zoned(judge(bronze, record_type, refs, rules, parity))
        rows = tables.conform(judged, tables.silver_layout(record_type))
        tables.write_dates(rows, f"{silver_root}/{record_type}", [_date(d) for d in days], ("zone", "date"))

    side_by_side(run, touched)


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def _latest_profiles(spark: SparkSession, root: str) -> DataFrame:
    return latest_per_key(_read(spark, root, "state_profile_day").drop("date"))


def _folded(name: str, spark: SparkSession, root: str) -> DataFrame:
    if name == "gold_user_profile_enriched":
        return _latest_profiles(spark, root).select(*gold.PROFILE_OUTPUT)
    if name == "gold_workout_consistency":
        states = _read(spark, root, "state_session_day")
        return gold.consistency_of(states.groupBy("user_id", "muscle_group").agg(*(F.sum(c).alias(c) for c in gold.SESSION_SUMS)))
    states = _read(spark, root, "state_user_day").drop("date")
    sums = states.groupBy("user_id").agg(*(F.sum(c).alias(c) for c in states.columns if c != "user_id"))
    return gold.cohorts_of(sums, _latest_profiles(spark, root).select("user_id", *gold.COHORT))


#: Tables folded from the states, and which they need.
FOLDED = {
    "gold_workout_consistency": ("state_session_day",),
    "gold_community_analytics": ("state_user_day", "state_profile_day"),
    "gold_user_profile_enriched": ("state_profile_day",),
}


def refresh_gold(spark: SparkSession, silver_root: str, gold_root: str, touched: Mapping[str, set[Day]]) -> None:
    """Compute the touched dates of Gold and states again, then fold the states that changed."""

    def run(name: str) -> None:
        build, types = PER_DATE[name]
        dates = sorted({d for t in types for day in touched.get(t, ()) if (d := _date(day)) is not None})
        if dates:
            own = [tables.read_silver(spark, silver_root, t).filter(tables.among("date", dates)) for t in types]
            tables.write_dates(build(*own), f"{gold_root}/{name}", dates)

    def fold(name: str) -> None:
        if all(tables.listed(spark, f"{gold_root}/{s}/date=*") for s in FOLDED[name]):
            tables.write_gold(_folded(name, spark, gold_root), gold_root, name)

    side_by_side(run, PER_DATE)
    changed = {name for name, (_, types) in PER_DATE.items() if any(touched.get(t) for t in types)}
    side_by_side(fold, [n for n, needed in FOLDED.items() if changed & set(needed)])


def refresh(
    spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str, refs: References,
    rules: Mapping[str, Sequence[Rule]] = RULES, parity: bool = False,
) -> dict[str, int]:
    """Include all batches that no finished run has included; returns the touched dates per type.

    A changed reference table or rule touches no date: it takes a full run.
    """
    new = unseen(spark, bronze_root, silver_root)
    touched: dict[str, set[Day]] = reduce(lambda out, v: out | {v[0]: out.get(v[0], set()) | {v[1:4]}}, new, {})
    if touched:
        refresh_silver(spark, bronze_root, silver_root, refs, touched, rules, parity)
        refresh_gold(spark, silver_root, gold_root, touched)
        spark.createDataFrame(new, _SEEN).coalesce(1).write.mode("append").parquet(f"{silver_root}/{SEEN}")
    return {t: len(days) for t, days in touched.items()}
