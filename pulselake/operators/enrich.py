"""Left joins of judged rows to the reference tables.

Reference tables carry no broadcast hint: Spark broadcasts them when their size, known from the
files or measured at run time, is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to
a shuffle join with skew splitting beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

References = Mapping[str, "DataFrame | None"]


class Lookup(NamedTuple):
    """Columns to take from a reference table: row key, table key, and new name -> table column."""

    table: str
    key: str
    table_key: str
    take: Mapping[str, str]


# What each record type gains. A type not listed gains the user's cohort columns.
LOOKUPS: dict[str, tuple[Lookup, ...]] = {
    "user_profile": (
        Lookup("medical_conditions", "medical_history", "condition",
               {"medical_risk_modifier": "risk_modifier"}),
        Lookup("gym_master", "gym_id", "gym_id", {"gym_type": "gym_type"}),
    ),
    "workout_log": (
        Lookup("workout_catalog", "workout_type", "workout_type",
               {"met_value": "met_value", "recovery_days_needed": "recovery_days_needed"}),
    ),
}
DEFAULTS = {"medical_risk_modifier": 1.0}
COHORT_COLUMNS = ("job_type", "fitness_goal", "gym_id")


def look_up(rows: DataFrame, lookup: Lookup, refs: References) -> DataFrame:
    """Add the columns of one lookup; without the table or the key only defaults are added."""
    table = refs.get(lookup.table)
    if table is None or lookup.key not in rows.columns:
        known = {n: F.lit(DEFAULTS[n]) for n in lookup.take if n in DEFAULTS}
        return rows.withColumns(known) if known else rows
    wanted = table.select(
        F.col(lookup.table_key).alias(lookup.key), *[F.col(c).alias(n) for n, c in lookup.take.items()]
    )
    joined = rows.join(wanted, lookup.key, "left")
    filled = [
        F.coalesce(n, F.lit(DEFAULTS[n])).alias(n) if n in DEFAULTS else F.col(n) for n in lookup.take
    ]
    return joined.select(*rows.columns, *filled)


def add_cohort(events: DataFrame, refs: References) -> DataFrame:
    """Add each user's job, goal and gym, as far as the profile table has these columns.

    The profile table grows with the number of users. A user with a large share of the events, or
    no user at all, fills partitions on the event side only, which adaptive execution splits.
    """
    users = refs.get("user_profiles")
    if users is None or "user_id" not in events.columns:
        return events
    wanted = users.select("user_id", *[c for c in COHORT_COLUMNS if c in users.columns])
    added = [c for c in wanted.columns if c != "user_id"]
    return events.join(wanted, "user_id", "left").select(*events.columns, *added)


def enrich(rows: DataFrame, record_type: str, refs: References) -> DataFrame:
    """Enrich one record type. Rows with a ``failure_reason`` get null enrichment columns."""
    out = rows
    if record_type in LOOKUPS:
        for lookup in LOOKUPS[record_type]:
            out = look_up(out, lookup, refs)
    else:
        out = add_cohort(out, refs)
    if "failure_reason" not in rows.columns:
        return out
    valid = F.col("failure_reason").isNull()
    added = [c for c in out.columns if c not in rows.columns]
    return out.select(*rows.columns, *[F.when(valid, F.col(c)).alias(c) for c in added])
