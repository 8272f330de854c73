"""Silver to Gold: four recomputed tables, each a pure function of Silver DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions import scoring
from pulselake.functions.numbers import percent, round_half_up
from pulselake.functions.texts import parse_groups
from pulselake.operators.keys import latest_per_key

UNPROFILED = "Unprofiled"
USER_DAY = ("user_id", "date")
COHORT = ("job_type", "fitness_goal")
PROFILE_OUTPUT = (
    "user_id", "age", "gender", "weight_kg", "medical_history", "medical_risk_modifier",
    "job_type", "fitness_goal", "gym_id", "gym_type",
)


def session_load() -> Column:
    return scoring.training_load(F.col("duration_minutes"), F.col("rpe"))


def wearable_daily(wearable: DataFrame) -> DataFrame:
    return wearable.groupBy(*USER_DAY).agg(
        F.avg("recovery_score").alias("recovery_score"),
        F.avg("stress_score").alias("stress_score"),
        F.avg("hrv").alias("hrv"),
    )


def sleep_daily(sleep: DataFrame) -> DataFrame:
    return sleep.groupBy(*USER_DAY).agg(F.avg("total_sleep_hours").alias("total_sleep_hours"))


def training_load_daily(workout: DataFrame) -> DataFrame:
    return workout.groupBy(*USER_DAY).agg(F.sum(session_load()).alias("training_load_today"))


def fatigue_recovery(wearable: DataFrame, sleep: DataFrame, workout: DataFrame) -> DataFrame:
    """One row per user-day with wearable readings.

    The three sources are stacked and grouped once instead of grouped three times and joined
    twice: one exchange of map-side partial sums, no sort, and a hot user-day costs one row per
    map task. Missing sleep counts as the baseline, a missing workout as no load.
    """
    null = F.lit(None)
    anchor = wearable.select(
        *USER_DAY, "recovery_score", "stress_score", "hrv",
        null.cast("double").alias("sleep"), null.cast("bigint").alias("load"),
        F.lit(1).alias("anchor"),
    )
    # a null user or day matches nothing, so such side rows are left out
    keyed = F.col("user_id").isNotNull() & F.col("date").isNotNull()
    nights = sleep.filter(keyed).select(*USER_DAY, F.col("total_sleep_hours").alias("sleep"))
    sessions = workout.filter(keyed).select(*USER_DAY, session_load().alias("load"))
    stacked = anchor.unionByName(nights, allowMissingColumns=True).unionByName(
        sessions, allowMissingColumns=True
    )
    daily = (
        stacked.groupBy(*USER_DAY)
        .agg(
            F.avg("recovery_score").alias("recovery_score"),
            F.avg("stress_score").alias("stress_score"),
            F.avg("hrv").alias("hrv"),
            F.coalesce(F.avg("sleep"), F.lit(scoring.SLEEP_BASELINE_HOURS)).alias(
                "total_sleep_hours"
            ),
            F.coalesce(F.sum("load"), F.lit(0)).cast("bigint").alias("training_load_today"),
            F.count("anchor").alias("readings"),
        )
        .filter("readings > 0")
    )
    debt, score = F.col("sleep_debt_hours"), F.col("fatigue_score")
    recovery = F.col("recovery_score")
    return (
        daily.withColumn("sleep_debt_hours", scoring.sleep_debt(F.col("total_sleep_hours")))
        .withColumn("fatigue_score", scoring.fatigue_score(debt, recovery, F.col("stress_score")))
        .select(
            *USER_DAY, "recovery_score", "stress_score", "hrv", "total_sleep_hours",
            "sleep_debt_hours", "training_load_today", "fatigue_score",
            scoring.readiness(score).alias("recovery_readiness"),
            scoring.overtraining(score, F.col("training_load_today"), recovery).alias(
                "overtraining_flag"
            ),
        )
    )


def muscle_counts(workout: DataFrame) -> DataFrame:
    """Sessions per user and muscle group."""
    return (
        workout.select("user_id", F.explode(parse_groups(F.col("muscle_groups"))).alias("muscle_group"))
        .groupBy("user_id", "muscle_group")
        .agg(F.count(F.lit(1)).alias("session_count"))
    )


SESSION_SUMS = ("n", "done", "rpe", "n_rpe", "minutes", "n_minutes", "load")


def session_sums(workout: DataFrame, *more: str) -> DataFrame:
    """Sums per user and muscle group, and per ``more`` columns, that can be added up further.

    Each session yields one row per muscle group plus one without a group that carries the
    session itself, so totals and the breakdown come out of a single pass over the sessions.
    """
    groups = F.coalesce(parse_groups(F.col("muscle_groups")), F.array().cast("array<string>"))
    sessions = workout.select(
        "user_id", *more,
        F.col("completed").cast("int").alias("done"),
        F.col("rpe").cast("bigint").alias("rpe"),
        F.col("duration_minutes").cast("bigint").alias("minutes"),
        session_load().alias("load"),
        F.explode(F.concat(F.array(F.lit(None).cast("string")), groups)).alias("muscle_group"),
    )
    return sessions.groupBy("user_id", "muscle_group", *more).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("done").alias("done"),
        F.sum("rpe").alias("rpe"), F.count("rpe").alias("n_rpe"),
        F.sum("minutes").alias("minutes"), F.count("minutes").alias("n_minutes"),
        F.sum("load").alias("load"),
    )


def consistency_of(per_group: DataFrame) -> DataFrame:
    """One row per user from the sums per user and muscle group."""
    whole = F.col("muscle_group").isNull()

    def total(name: str) -> Column:
        return F.max(F.when(whole, F.col(name)))

    entry = F.struct("muscle_group", F.col("n").alias("session_count"))
    breakdown = F.sort_array(F.collect_list(F.when(~whole, entry)))
    return (
        per_group.groupBy("user_id")
        .agg(
            total("n").alias("total_sessions"),
            total("done").alias("completed_sessions"),
            round_half_up(F.try_divide(total("rpe"), total("n_rpe"))).alias("avg_rpe"),
            round_half_up(F.try_divide(total("minutes"), total("n_minutes"))).alias(
                "avg_duration_minutes"
            ),
            total("load").alias("total_training_load"),
            breakdown.alias("groups"),
        )
        .select(
            "user_id", "total_sessions", "completed_sessions", "avg_rpe",
            "avg_duration_minutes", "total_training_load",
            percent(F.col("completed_sessions"), F.col("total_sessions")).alias(
                "completion_rate_pct"
            ),
            F.when(F.size("groups") > 0, F.col("groups")).alias("muscle_group_breakdown"),
        )
    )


def workout_consistency(workout: DataFrame) -> DataFrame:
    """One row per user: totals, averages and a nested count per muscle group.

    The sums are reduced map-side per (user, group) before the small per-user step.
    """
    return consistency_of(session_sums(workout))


# Measures that cohort averages are made of, and their types.
_MEASURES = {
    "recovery": "double", "stress": "double", "hrv": "double", "sleep": "double",
    "load": "bigint", "done": "int", "reading": "int",
}


def _measured(source: DataFrame, keys: tuple[str, ...], measures: dict[str, Column]) -> DataFrame:
    """Keys and all measures of one source, null where the source lacks a measure."""
    return source.select(
        *keys,
        *[measures.get(n, F.lit(None)).cast(t).alias(n) for n, t in _MEASURES.items()],
    )


def _wearable_measures() -> dict[str, Column]:
    return {
        "recovery": F.col("recovery_score"), "stress": F.col("stress_score"),
        "hrv": F.col("hrv"), "reading": F.lit(1),
    }


def _sleep_measures() -> dict[str, Column]:
    return {"sleep": F.col("total_sleep_hours")}


def _workout_measures() -> dict[str, Column]:
    return {"load": session_load(), "done": F.col("completed").cast("int")}


def _partial_sums(stacked: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    sums = [F.sum(n).alias(f"{n}_sum") for n in _MEASURES if n != "reading"]
    counts = [F.count(n).alias(f"{n}_n") for n in _MEASURES]
    return stacked.groupBy(*keys).agg(*sums, *counts)


def _cohort_averages(per_user: DataFrame) -> DataFrame:
    """Fold per-user sums into cohorts; a cohort exists only where a user has readings."""

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))

    return (
        per_user.groupBy(*COHORT)
        .agg(
            round_half_up(mean("recovery")).alias("avg_recovery_score"),
            round_half_up(mean("stress")).alias("avg_stress_score"),
            round_half_up(mean("hrv")).alias("avg_hrv"),
            F.count_if((F.col("reading_n") > 0) & F.col("user_id").isNotNull()).alias(
                "user_count_wearable"
            ),
            round_half_up(mean("sleep")).alias("avg_sleep_hours"),
            round_half_up(mean("load")).alias("avg_training_load"),
            round_half_up(mean("done") * 100).alias("avg_completion_rate_pct"),
            F.sum("reading_n").alias("readings"),
        )
        .filter("readings > 0")
        .drop("readings")
    )


def user_cohorts(profiles: DataFrame) -> DataFrame:
    """Cohort of each user by the latest row."""
    return latest_per_key(profiles.select("user_id", "timestamp", *COHORT)).drop("timestamp")


def cohort_sums(wearable: DataFrame, sleep: DataFrame, workout: DataFrame, *more: str) -> DataFrame:
    """Sums and counts of all measures per user, and per ``more`` columns, that can be added up further."""
    keys = ("user_id", *more)
    stacked = (
        _measured(wearable, keys, _wearable_measures())
        .union(_measured(sleep, keys, _sleep_measures()))
        .union(_measured(workout, keys, _workout_measures()))
    )
    return _partial_sums(stacked, keys)


def cohorts_of(per_user: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Cohort averages from the sums per user; users without a cohort form ``Unprofiled``."""
    return _cohort_averages(per_user.join(cohorts, "user_id", "left").fillna(UNPROFILED, list(COHORT)))


def community_analytics(
    wearable: DataFrame, sleep: DataFrame, workout: DataFrame, profiles: DataFrame
) -> DataFrame:
    """One row per (job_type, fitness_goal) cohort, users without a profile in ``Unprofiled``.

    Cohort is a function of the user, so all three sources are first reduced to one row per user
    (partial sums map-side, one exchange); the lookup joins those rows, not the events, and the
    distinct user count becomes a plain count.
    """
    return cohorts_of(cohort_sums(wearable, sleep, workout), user_cohorts(profiles))


def community_analytics_by_event(
    wearable: DataFrame, sleep: DataFrame, workout: DataFrame
) -> DataFrame:
    """Cohorts as stored on the enriched events; sessions take the cohort of the user's latest reading.

    A null cohort stays a row of its own and, as null keys match nothing, has no sleep or
    workout figures.
    """
    by_user = ("user_id",)
    by_cohort_user = (*COHORT, *by_user)
    events = _measured(wearable, by_cohort_user, _wearable_measures()).union(
        _measured(sleep, by_cohort_user, _sleep_measures())
    )
    sessions = _partial_sums(_measured(workout, by_user, _workout_measures()), by_user)
    per_user = _partial_sums(events, by_cohort_user).unionByName(
        sessions.join(user_cohorts(wearable), "user_id", "left")
    )
    known = F.col("job_type").isNotNull() & F.col("fitness_goal").isNotNull()
    side = [f"{n}_{k}" for n in ("sleep", "load", "done") for k in ("sum", "n")]
    return _cohort_averages(per_user.withColumns({c: F.when(known, F.col(c)) for c in side}))


def user_profile_enriched(profiles: DataFrame) -> DataFrame:
    """Current state: one row per user from the newest profile event."""
    wanted = profiles.select("timestamp", *PROFILE_OUTPUT)
    return latest_per_key(wanted).select(*PROFILE_OUTPUT)
