"""Training, fatigue and readiness formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulselake.functions.numbers import round_half_up

# Constants of the scoring model.
SLEEP_BASELINE_HOURS = 8.0
SLEEP_WEIGHT = 40.0
RECOVERY_WEIGHT = 35.0
STRESS_WEIGHT = 25.0
OVERTRAINING_MIN_FATIGUE = 70.0
OVERTRAINING_MAX_RECOVERY = 40.0
HIGH_READINESS_FROM = 70
MODERATE_READINESS_FROM = 40
UNDERWEIGHT_BELOW = 18.5
NORMAL_BELOW = 25
OVERWEIGHT_BELOW = 30


def training_load(duration_minutes: Column, rpe: Column) -> Column:
    return duration_minutes.cast("bigint") * rpe.cast("bigint")


def sleep_debt(total_sleep_hours: Column) -> Column:
    return F.greatest(F.lit(0.0), SLEEP_BASELINE_HOURS - total_sleep_hours)


def fatigue_score(debt: Column, recovery: Column, stress: Column) -> Column:
    """Weighted 0-100 composite; null if any input is null."""
    sleep_part = debt / SLEEP_BASELINE_HOURS * SLEEP_WEIGHT
    recovery_part = (100.0 - recovery) / 100.0 * RECOVERY_WEIGHT
    stress_part = stress / 100.0 * STRESS_WEIGHT
    score = round_half_up(sleep_part + recovery_part + stress_part)
    # least/greatest skip nulls, so a null score must be kept by hand
    return F.when(score.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))


def readiness(fatigue: Column) -> Column:
    return round_half_up(100.0 - fatigue)


def overtraining(fatigue: Column, load: Column, recovery: Column) -> Column:
    return (
        (fatigue > OVERTRAINING_MIN_FATIGUE)
        & (load > 0)
        & (recovery < OVERTRAINING_MAX_RECOVERY)
    )


def risk_adjusted(fatigue: Column, modifier: Column) -> Column:
    return fatigue * F.coalesce(modifier, F.lit(1.0))


def readiness_label(avg_recovery: Column) -> Column:
    return (
        F.when(avg_recovery >= HIGH_READINESS_FROM, "high_readiness")
        .when(avg_recovery >= MODERATE_READINESS_FROM, "moderate_readiness")
        .otherwise("low_readiness")
    )


def bmi(weight_kg: Column, height_cm: Column) -> Column:
    metres = height_cm / 100.0
    return round_half_up(F.try_divide(weight_kg, metres * metres), 1)


def bmi_category(value: Column) -> Column:
    return (
        F.when(value < UNDERWEIGHT_BELOW, "underweight")
        .when(value < NORMAL_BELOW, "normal")
        .when(value < OVERWEIGHT_BELOW, "overweight")
        .when(value.isNotNull(), "obese")
    )
