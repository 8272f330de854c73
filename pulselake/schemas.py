"""Table layouts: Bronze records, Silver casts, reference tables and the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "muscle_groups": T.ArrayType(T.StructType([
        T.StructField("muscle_group", T.StringType()),
        T.StructField("session_count", T.LongType()),
    ])),
}


def layout(text: str) -> T.StructType:
    """``"name type, name type"`` to a schema, usable before a session exists."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The record layouts of the event stream, one DDL string per type.
_HEAD = "record_type string, user_id string, timestamp string"
_BODY = {
    "wearable_event": "heart_rate bigint, steps bigint, hrv bigint, calories_burned bigint, "
    "recovery_score bigint, stress_score bigint, device_type string",
    "workout_log": "workout_type string, duration_minutes bigint, rpe bigint, "
    "muscle_groups string, completed boolean, gym_id string",
    "sleep_log": "total_sleep_hours double, deep_sleep_hours double, rem_hours double, "
    "awakenings bigint, sleep_quality_score bigint",
    "nutrition_snapshot": "calories_in bigint, protein_g bigint, carbs_g bigint, fat_g bigint, "
    "hydration_ml bigint",
    "user_profile": "age bigint, gender string, weight_kg double, height_cm bigint, "
    "medical_history string, job_type string, fitness_goal string, gym_id string",
}

RECORD_TYPES = tuple(_BODY)

BRONZE: dict[str, T.StructType] = {
    name: layout(f"{_HEAD}, {body}") for name, body in _BODY.items()
}

# Column types after the Silver cast. Columns not listed keep their Bronze type.
SILVER_CASTS: dict[str, dict[str, str]] = {
    "wearable_event": {
        "heart_rate": "int", "hrv": "double", "steps": "int", "recovery_score": "double",
    },
    "workout_log": {
        "workout_type": "string", "duration_minutes": "int", "rpe": "int",
        "muscle_groups": "string",
    },
    "sleep_log": {
        "total_sleep_hours": "double", "deep_sleep_hours": "double", "rem_hours": "double",
    },
    "nutrition_snapshot": {
        "calories_in": "int", "protein_g": "double", "carbs_g": "double",
        "hydration_ml": "double",
    },
    "user_profile": {
        "age": "int", "weight_kg": "double", "medical_history": "string",
        "job_type": "string", "fitness_goal": "string",
    },
}
KEY_CASTS = {"user_id": "string", "timestamp": "timestamp"}

# Columns whose nulls the rules see as -1.
SENTINEL = -1
SENTINEL_COLUMNS: dict[str, tuple[str, ...]] = {
    "wearable_event": ("heart_rate", "hrv", "steps", "recovery_score"),
    "workout_log": ("duration_minutes", "rpe"),
    "sleep_log": ("total_sleep_hours", "deep_sleep_hours", "rem_hours"),
    "nutrition_snapshot": ("calories_in", "protein_g", "carbs_g", "hydration_ml"),
    "user_profile": ("age", "weight_kg"),
}

REFERENCE: dict[str, T.StructType] = {
    "user_profiles": layout(
        "user_id string, name string, age int, gender string, weight_kg double, height_cm int, "
        "bmi double, bmi_category string, medical_history string, job_type string, "
        "fitness_goal string, gym_id string, member_since date, is_active boolean, city string"
    ),
    "gym_master": layout(
        "gym_id string, name string, city string, area string, gym_type string, capacity int, "
        "monthly_fee int, established int, has_pool boolean, has_sauna boolean"
    ),
    "workout_catalog": layout(
        "workout_type string, category string, met_value double, primary_benefit string, "
        "recovery_days_needed int"
    ),
    "medical_conditions": layout(
        "condition string, risk_modifier double, hr_max_factor double, notes string"
    ),
    "date_dimension": layout(
        "date_id string, full_date date, year int, quarter int, month int, month_name string, "
        "week_of_year int, day_of_week int, day_name string, is_weekend boolean, "
        "day_of_month int, day_of_year int"
    ),
}

# Columns the enrichment step adds to each record type.
ENRICHMENT: dict[str, dict[str, str]] = {
    "wearable_event": {"job_type": "string", "fitness_goal": "string", "gym_id": "string"},
    "workout_log": {"met_value": "double", "recovery_days_needed": "int"},
    "sleep_log": {"job_type": "string", "fitness_goal": "string", "gym_id": "string"},
    "nutrition_snapshot": {"job_type": "string", "fitness_goal": "string", "gym_id": "string"},
    "user_profile": {"medical_risk_modifier": "double", "gym_type": "string"},
}

PROFILE_COLUMNS = (
    "age", "gender", "weight_kg", "medical_history", "medical_risk_modifier",
    "job_type", "fitness_goal", "gym_id", "gym_type",
)

STAR: dict[str, T.StructType] = {
    "dim_user": layout(
        "user_sk bigint, user_id string, age int, gender string, weight_kg double, "
        "medical_history string, medical_risk_modifier double, job_type string, "
        "fitness_goal string, gym_id string, gym_type string, effective_date timestamp, "
        "end_date timestamp, is_current boolean"
    ),
    "fact_fatigue_recovery": layout(
        "fact_id bigint, user_id string, event_date date, recovery_score double, "
        "stress_score double, hrv double, total_sleep_hours double, sleep_debt_hours double, "
        "training_load_today bigint, fatigue_score double, recovery_readiness double, "
        "overtraining_flag boolean"
    ),
    "fact_workout_consistency": layout(
        "fact_id bigint, user_id string, total_sessions bigint, completed_sessions bigint, "
        "avg_rpe double, avg_duration_minutes double, total_training_load bigint, "
        "completion_rate_pct double, "
        "muscle_group_breakdown muscle_groups"
    ),
    "fact_community_analytics": layout(
        "fact_id bigint, job_type string, fitness_goal string, avg_recovery_score double, "
        "avg_stress_score double, avg_hrv double, user_count_wearable bigint, "
        "avg_sleep_hours double, avg_training_load double, avg_completion_rate_pct double"
    ),
}


def silver_schema(record_type: str) -> T.StructType:
    """Columns of a Silver (and Quarantine) table as written, in file order."""
    casts = {**KEY_CASTS, **SILVER_CASTS[record_type]}
    ddl = [f"{f.name} {casts.get(f.name, f.dataType.simpleString())}" for f in BRONZE[record_type]]
    ddl.append("failure_reason string")
    ddl += [f"{n} {t}" for n, t in ENRICHMENT[record_type].items()]
    ddl += ["zone string", "date date"]
    return layout(", ".join(ddl))


def stream_schema() -> T.StructType:
    """All record types side by side, for decoding one multiplexed stream in a single pass."""
    fields: dict[str, T.StructField] = {}
    for schema in BRONZE.values():
        for field in schema:
            fields.setdefault(field.name, field)
    return T.StructType(list(fields.values()))
