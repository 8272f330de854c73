"""Gold to star schema, and the three serving marts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake import schemas
from pulselake.functions import scoring
from pulselake.operators.keys import with_surrogate_key
from pulselake.operators.temporal import as_of_join, build_dim_user, stage_dim_user
from pulselake.session import side_by_side
from pulselake.sources.tables import store

CURRENT_USER = ("gym_id", "gym_type", "fitness_goal", "job_type")


def _load(gold: DataFrame, table: str, natural_key: list[str]) -> DataFrame:
    layout = schemas.STAR[table]
    keyed = with_surrogate_key(gold, natural_key, "fact_id")
    return keyed.select(*[F.col(f.name).cast(f.dataType) for f in layout])


def load_fact_fatigue(gold: DataFrame) -> DataFrame:
    renamed = gold.withColumnRenamed("date", "event_date")
    return _load(renamed, "fact_fatigue_recovery", ["user_id", "event_date"])


def load_fact_consistency(gold: DataFrame) -> DataFrame:
    return _load(gold, "fact_workout_consistency", ["user_id"])


def load_fact_community(gold: DataFrame) -> DataFrame:
    return _load(gold, "fact_community_analytics", ["job_type", "fitness_goal"])


def stage(table: DataFrame, name: str) -> DataFrame:
    """One-to-one staging projection in the fixed column order, also published as a view."""
    staged = table.select(*schemas.STAR[name].names)
    staged.createOrReplaceTempView(f"stg_{name}")
    return staged


def mart_user_health_score(
    fatigue: DataFrame, staged_users: DataFrame, keep_unmatched: bool = False
) -> DataFrame:
    """User-days with the profile valid on that day and the risk-adjusted fatigue score.

    Days of users without any profile are left out unless ``keep_unmatched``, which keeps them
    with a neutral modifier.
    """
    joined = as_of_join(fatigue, staged_users, keep_unmatched)
    measures = [c for c in schemas.STAR["fact_fatigue_recovery"].names
                if c not in ("fact_id", "user_id", "event_date")]
    return joined.select(
        "fact_id", "user_id", "event_date", "user_sk", *schemas.PROFILE_COLUMNS, *measures,
        scoring.risk_adjusted(F.col("fatigue_score"), F.col("medical_risk_modifier")).alias(
            "risk_adjusted_fatigue_score"
        ),
    )


def mart_coach_dashboard(consistency: DataFrame, staged_users: DataFrame) -> DataFrame:
    """Per-user totals with the user's current profile."""
    current = staged_users.filter("is_current").select("user_id", *CURRENT_USER)
    totals = [c for c in schemas.STAR["fact_workout_consistency"].names
              if c not in ("fact_id", "user_id")]
    return consistency.join(current, "user_id", "left").select(
        "fact_id", "user_id", *CURRENT_USER, *totals
    )


def mart_community_analytics(community: DataFrame) -> DataFrame:
    """Cohorts with a readiness label."""
    return community.select(
        *schemas.STAR["fact_community_analytics"].names,
        scoring.readiness_label(F.col("avg_recovery_score")).alias("cohort_readiness_label"),
    )


def publish(made: dict[str, DataFrame], root: str, database: str) -> dict[str, str]:
    """Tables into the session's catalog: facts and marts as stored tables, staging as views over them.

    Every publication writes tables of a new name under ``root`` and then points the view of each
    plain name at its new table, so readers always find a whole one. Returns the names by table;
    superseded tables are left for the operator to drop.
    """
    spark = next(iter(made.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    version = uuid.uuid4().hex[:8]

    def save(name: str) -> str:
        made[name].write.option("path", f"{root}/{name}_{version}").saveAsTable(f"`{database}`.`{name}_{version}`")
        return f"`{database}`.`{name}`"

    names = dict(zip(made, side_by_side(save, made)))
    for name, shown in names.items():
        spark.sql(f"CREATE OR REPLACE VIEW {shown} AS SELECT * FROM `{database}`.`{name}_{version}`")
    return names


def _store_all(tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    stored = side_by_side(lambda name: store(tables[name], root, name), tables)
    return dict(zip(tables, stored))


def run_star(
    profiles: DataFrame, fatigue: DataFrame, consistency: DataFrame, community: DataFrame, root: str
) -> dict[str, DataFrame]:
    """Store the dimension, facts and marts under ``root``; staging stays a projection on top.

    Takes the enriched Silver profiles and three Gold tables, and returns the staged tables and
    the marts by name.
    """
    made = {
        "dim_user": build_dim_user(profiles),
        "fact_fatigue_recovery": load_fact_fatigue(fatigue),
        "fact_workout_consistency": load_fact_consistency(consistency),
        "fact_community_analytics": load_fact_community(community),
    }
    base = _store_all(made, root)
    users = stage_dim_user(base["dim_user"])
    facts = {n: stage(t, n) for n, t in base.items() if n != "dim_user"}
    marts = {
        "mart_user_health_score": mart_user_health_score(facts["fact_fatigue_recovery"], users),
        "mart_coach_dashboard": mart_coach_dashboard(facts["fact_workout_consistency"], users),
        "mart_community_analytics": mart_community_analytics(facts["fact_community_analytics"]),
    }
    return {
        "stg_dim_user": users,
        **{f"stg_{n}": t for n, t in facts.items()},
        **_store_all(marts, root),
    }
