"""Whole runs: every type to Silver, then every Gold table, failures isolated."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from pulselake import schemas
from pulselake.operators.enrich import References, enrich
from pulselake.operators.quality import RULES, Rule, refine
from pulselake.plans import gold
from pulselake.session import side_by_side
from pulselake.sources import tables

log = logging.getLogger(__name__)

GOLD_INPUTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "gold_fatigue_recovery": (
        gold.fatigue_recovery, ("wearable_event", "sleep_log", "workout_log"),
    ),
    "gold_workout_consistency": (gold.workout_consistency, ("workout_log",)),
    "gold_community_analytics": (
        gold.community_analytics, ("wearable_event", "sleep_log", "workout_log", "user_profile"),
    ),
    "gold_user_profile_enriched": (gold.user_profile_enriched, ("user_profile",)),
}


def judge(
    bronze: DataFrame,
    record_type: str,
    refs: References,
    rules: Mapping[str, Sequence[Rule]] = RULES,
    parity: bool = False,
) -> DataFrame:
    """Bronze rows of one type to labelled, enriched rows of both zones."""
    judged = refine(bronze, record_type, rules, parity)
    return enrich(judged, record_type, refs)


def run_type(
    spark: SparkSession, bronze_root: str, silver_root: str, record_type: str, refs: References,
    rules: Mapping[str, Sequence[Rule]] = RULES, parity: bool = False,
) -> dict:
    bronze = tables.read_bronze(spark, bronze_root, record_type).drop("year", "month", "day")
    if bronze.isEmpty():
        return {"record_type": record_type, "status": "skipped_no_data"}
    counts = tables.write_judged(judge(bronze, record_type, refs, rules, parity), silver_root, record_type)
    return {"record_type": record_type, "status": "success", **counts}


def run_silver(
    spark: SparkSession, bronze_root: str, silver_root: str, refs: References,
    record_types: Sequence[str] = schemas.RECORD_TYPES,
    rules: Mapping[str, Sequence[Rule]] = RULES, parity: bool = False,
) -> list[dict]:
    """Bronze to Silver for every type; a failing type is reported and does not stop the rest.

    ``rules`` replaces the built-in rules, ``parity`` keeps the source platform's habits.
    """

    def run(record_type: str) -> dict:
        try:
            return run_type(spark, bronze_root, silver_root, record_type, refs, rules, parity)
        except Exception as error:
            log.exception("record type %s failed", record_type)
            return {"record_type": record_type, "status": "error", "error": str(error)}

    return side_by_side(run, record_types)


def run_gold(spark: SparkSession, silver_root: str, gold_root: str) -> list[dict]:
    """All Gold tables from Silver; a table whose inputs are missing is skipped."""
    silver = {t: tables.read_silver(spark, silver_root, t) for t in schemas.RECORD_TYPES}
    empty = {t for t, df in silver.items() if df.isEmpty()}

    def run(name: str) -> dict:
        build, inputs = GOLD_INPUTS[name]
        if empty & set(inputs):
            return {"table_name": name, "status": "skipped_missing_input"}
        try:
            rows = tables.write_gold(build(*[silver[t] for t in inputs]), gold_root, name)
            return {"table_name": name, "status": "success", "n_rows": rows}
        except Exception as error:
            log.exception("gold table %s failed", name)
            return {"table_name": name, "status": "error", "error": str(error)}

    return side_by_side(run, GOLD_INPUTS)
