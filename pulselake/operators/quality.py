"""Casting, sentinel filling, ordered validation rules and the Silver / Quarantine split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake import schemas
from pulselake.operators.keys import deduplicate, deduplicate_events

BAD_KEY = "bad_key"
UNREADABLE_KEY = "user_id is null or timestamp is null"


class Rule(NamedTuple):
    """A reason code and the SQL condition under which a row violates the rule."""

    code: str
    violated_when: str


def outside(column: str, low: int, high: int, null_fails: bool = False) -> str:
    """Condition for a value outside ``[low, high]``; a null violates only on request."""
    text = f"{column} not between {low} and {high}"
    return f"{column} is null or {text}" if null_fails else text


# The ranges and reason codes. The first violated rule of a type names the reason.
RULES: dict[str, tuple[Rule, ...]] = {
    "wearable_event": (
        Rule("heart_rate_out_of_range", outside("heart_rate", 30, 220, null_fails=True)),
        Rule("hrv_negative_or_zero", "hrv is null or hrv <= 0"),
        Rule("steps_out_of_range", outside("steps", 0, 50000, null_fails=True)),
        Rule("recovery_score_out_of_range", outside("recovery_score", 0, 100)),
    ),
    "workout_log": (
        Rule("duration_out_of_range", outside("duration_minutes", 1, 300, null_fails=True)),
        Rule("rpe_out_of_range", outside("rpe", 1, 10, null_fails=True)),
    ),
    "sleep_log": (
        Rule("total_sleep_out_of_range", outside("total_sleep_hours", 0, 16, null_fails=True)),
        Rule("deep_sleep_exceeds_total", "deep_sleep_hours > total_sleep_hours"),
        Rule("rem_exceeds_total", "rem_hours > total_sleep_hours"),
    ),
    "nutrition_snapshot": (
        Rule("calories_out_of_range", outside("calories_in", 0, 10000, null_fails=True)),
        Rule("protein_out_of_range", outside("protein_g", 0, 500)),
        Rule("hydration_out_of_range", outside("hydration_ml", 0, 10000)),
    ),
    "user_profile": (
        Rule("age_out_of_range", outside("age", 13, 100, null_fails=True)),
        Rule("weight_out_of_range", outside("weight_kg", 30, 250)),
    ),
}


def cast_record(df: DataFrame, record_type: str) -> DataFrame:
    """Cast to the Silver types; an unreadable value becomes null, a missing column a null one."""
    casts = {**schemas.KEY_CASTS, **schemas.SILVER_CASTS.get(record_type, {})}
    present = [
        F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns
    ]
    missing = [F.lit(None).cast(t).alias(c) for c, t in casts.items() if c not in df.columns]
    return df.select(*present, *missing)


def fill_sentinels(df: DataFrame, record_type: str) -> DataFrame:
    columns = [c for c in schemas.SENTINEL_COLUMNS.get(record_type, ()) if c in df.columns]
    return df.fillna(schemas.SENTINEL, columns) if columns else df


def first_violation(rules: Sequence[Rule]) -> Column:
    """Reason code of the first violated rule, null for a valid row; null is no violation."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(F.expr(r.violated_when), F.lit(r.code)) for r in rules])


def validate(
    df: DataFrame,
    record_type: str,
    rules: Mapping[str, Sequence[Rule]] = RULES,
    require_key: bool = False,
) -> DataFrame:
    """Add ``is_valid`` and ``failure_reason``; a type without rules is all valid."""
    wanted = list(rules.get(record_type, ()))
    if require_key:
        wanted.insert(0, Rule(BAD_KEY, UNREADABLE_KEY))
    reason = first_violation(wanted)
    return df.withColumns({"is_valid": reason.isNull(), "failure_reason": reason})


def refine(
    bronze: DataFrame,
    record_type: str,
    rules: Mapping[str, Sequence[Rule]] = RULES,
    parity: bool = False,
) -> DataFrame:
    """Bronze rows to judged rows: deduplicated, cast and labelled, one shuffle in all.

    By default a row without a usable user or time is quarantined as ``bad_key`` and the rules see
    sentinels only while they run, so no ``-1`` is stored. ``parity=True`` keeps the source
    platform's habits: deduplication on the raw time text, sentinels stored, no key rule.
    """
    if parity:
        cast = cast_record(deduplicate(bronze), record_type)
        return validate(fill_sentinels(cast, record_type), record_type, rules)
    parsed = F.col("timestamp").try_cast("timestamp")
    cast = cast_record(deduplicate_events(bronze, parsed), record_type)
    nullable = [c for c in schemas.SENTINEL_COLUMNS.get(record_type, ()) if c in cast.columns]
    kept = cast.withColumns({f"_{c}": F.col(c) for c in nullable})
    judged = validate(fill_sentinels(kept, record_type), record_type, rules, require_key=True)
    return judged.withColumns({c: F.col(f"_{c}") for c in nullable}).drop(
        *[f"_{c}" for c in nullable]
    )


def split_silver_quarantine(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid rows with equal schemas; Silver keeps a null ``failure_reason``."""
    return (
        judged.filter("is_valid").drop("is_valid"),
        judged.filter("not is_valid").drop("is_valid"),
    )
