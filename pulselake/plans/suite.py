"""The data tests of the star schema and the marts as one table of checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from pulselake.operators import expectations as dq
from pulselake.sources.tables import read_many

# Required columns and unique keys per table, and the accepted labels.
NOT_NULL = {
    "stg_dim_user": ("user_sk", "user_id", "is_current", "effective_date_for_join"),
    "stg_fact_fatigue_recovery": ("fact_id", "user_id", "fatigue_score", "recovery_readiness"),
    "stg_fact_workout_consistency": ("fact_id", "user_id", "completion_rate_pct"),
    "stg_fact_community_analytics": ("fact_id",),
    "mart_user_health_score": (
        "fact_id", "user_id", "fatigue_score", "risk_adjusted_fatigue_score",
    ),
    "mart_coach_dashboard": ("fact_id", "user_id", "completion_rate_pct"),
    "mart_community_analytics": ("fact_id",),
}
UNIQUE = {
    "stg_dim_user": "user_sk",
    "stg_fact_fatigue_recovery": "fact_id",
    "stg_fact_workout_consistency": "fact_id",
    "stg_fact_community_analytics": "fact_id",
    "mart_user_health_score": "fact_id",
    "mart_coach_dashboard": "fact_id",
    "mart_community_analytics": "fact_id",
}
LABELS = ("high_readiness", "moderate_readiness", "low_readiness")
USER_FACTS = ("stg_fact_fatigue_recovery", "stg_fact_workout_consistency")


def not_null_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    return read_many([dq.null_counts(tables[n], n, cols) for n, cols in NOT_NULL.items()])


def unique_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    return read_many([dq.duplicate_count(tables[n], n, [key]) for n, key in UNIQUE.items()])


def relationship_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    users = tables["stg_dim_user"]
    return read_many([
        dq.count_of(dq.orphans(tables[n], "user_id", users, "user_id"), f"relationships {n}.user_id")
        for n in USER_FACTS
    ])


def negative_scores(health: DataFrame) -> DataFrame:
    return health.filter("fatigue_score < 0 or risk_adjusted_fatigue_score < 0")


def run_suite(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All 33 checks, one row each: ``check_name`` and the number of violations."""
    health, coach = tables["mart_user_health_score"], tables["mart_coach_dashboard"]
    community = tables["mart_community_analytics"]
    counts = dq.differing_counts(
        tables["stg_fact_fatigue_recovery"], health, ("raw_fact_rows", "mart_rows")
    )
    return read_many([
        not_null_checks(tables),
        unique_checks(tables),
        relationship_checks(tables),
        dq.count_of(
            dq.unaccepted_values(community, "cohort_readiness_label", LABELS),
            "accepted_values mart_community_analytics.cohort_readiness_label",
        ),
        dq.count_of(dq.outside_range(coach, "completion_rate_pct", 0, 100), "completion_rate_in_range"),
        dq.count_of(negative_scores(health), "fatigue_score_non_negative"),
        dq.count_of(counts, "health_score_no_dropped_rows"),
    ])
