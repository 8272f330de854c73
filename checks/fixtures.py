"""Deterministic inputs derived from the ``events`` table, the same in Spark and in plain SQL.

Column expressions use only functions with equal meaning in both engines. ``id`` is the event id,
``k`` the number in the event's properties, ``uid`` and ``ts_text`` the record's user and time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake import schemas

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

# Exact copies of some events stand for delivery retries, changed copies with the same user and
# time (id + 10,000,000) force the tiebreak.
RETRY_EVERY, NEAR_EVERY, NEAR_SHIFT = 101, 103, 10_000_000
NO_TIME_EVERY = 211

RAW_COLUMNS = {
    "uid": "concat('U', cast(1001 + user_id as varchar(20)))",
    "ts_text": f"case when id % {NO_TIME_EVERY} = 0 then 'not-a-time' else cast(ts as varchar(40)) end",
}


def _gym(number: str) -> str:
    return f"concat('GYM', cast(1 + {number} as varchar(20)))"


_JOB = "case {0} % 3 when 0 then 'sedentary' when 1 then 'active' else 'mixed' end"

# record type -> (event type, row condition, column expressions)
TYPED: dict[str, tuple[str, str, dict[str, str]]] = {
    "wearable_event": ("view", "true", {
        "heart_rate": "case when id % 53 = 0 then null else 40 + (7 * id + k) % 200 end",
        "steps": "case when id % 67 = 0 then 60000 else (13 * id) % 900 end",
        "hrv": "case when id % 37 = 0 then -1 else 15 + k end",
        "calories_burned": "50 + (3 * id) % 600",
        "recovery_score": "case when id % 59 = 0 then null else (31 * id + k) % 101 end",
        "stress_score": "case when id % 61 = 0 then null else (17 * id) % 101 end",
        "device_type": "case id % 3 when 0 then 'band' when 1 then 'watch' else 'ring' end",
    }),
    "workout_log": ("click", "true", {
        "workout_type": "case when id % 29 = 0 then 'Pilates' when id % 4 = 0 then 'Strength' "
                        "when id % 4 = 1 then 'HIIT' when id % 4 = 2 then 'Yoga' else 'Running' end",
        "duration_minutes": "(11 * id) % 320",
        "rpe": "1 + id % 11",
        "muscle_groups": "case when id % 31 = 0 then '[]' when id % 5 = 0 then '[arms]' "
                         "when id % 5 = 1 then '[shoulders, core]' "
                         "when id % 5 = 2 then concat('[', chr(39), 'back', chr(39), ', ', chr(39), 'core', chr(39), ']') "
                         "else concat('[', chr(39), 'legs', chr(39), ']') end",
        "completed": "id % 4 <> 0",
        "gym_id": _gym("id % 6"),
    }),
    "sleep_log": ("error", "true", {
        "total_sleep_hours": "case when id % 43 = 0 then cast(25 as double) when id % 71 = 0 then null "
                             "else cast(k % 96 as double) / 10 end",
        "deep_sleep_hours": "case when id % 41 = 0 then cast(12 as double) when id % 73 = 0 then null "
                            "else cast(k % 96 as double) / 50 end",
        "rem_hours": "case when id % 47 = 0 then cast(12 as double) else cast(k % 96 as double) / 50 end",
        "awakenings": "id % 8",
        "sleep_quality_score": "35 + id % 66",
    }),
    "nutrition_snapshot": ("purchase", "true", {
        "calories_in": "case when id % 47 = 0 then 12000 when id % 53 = 0 then null "
                       "else 1200 + (7 * id) % 2600 end",
        "protein_g": "case when id % 59 = 0 then 600 when id % 61 = 0 then null else 50 + k end",
        "carbs_g": "case when id % 67 = 0 then null else 80 + k end",
        "fat_g": "30 + k",
        "hydration_ml": "case when id % 71 = 0 then 20000 else 800 + (5 * id) % 3700 end",
    }),
    "user_profile": ("signup", "user_id % 10 <> 7", {
        "age": "case when id % 19 = 0 then 7 when id % 83 = 0 then null else 18 + k % 48 end",
        "gender": "case id % 3 when 0 then 'male' when 1 then 'female' else 'other' end",
        "weight_kg": "case when id % 23 = 0 then cast(300 as double) else cast(450 + 7 * k as double) / 10 end",
        "height_cm": "150 + k % 51",
        "medical_history": "case when id % 79 = 0 then 'asthma' when id % 5 = 3 then 'hypertension' "
                           "when id % 5 = 4 then 'diabetes' else 'none' end",
        "job_type": _JOB.format("id"),
        "fitness_goal": "case when id % 12 < 3 then 'strength' when id % 12 < 6 then 'endurance' "
                        "when id % 12 < 9 then 'weight_loss' else 'longevity' end",
        "gym_id": _gym("id % 6"),
    }),
}

# Static profile table: one row per user, some users missing.
USER_PROFILE_FILTER = "user_id % 13 <> 0"
USER_PROFILE_COLUMNS = {
    "user_id": RAW_COLUMNS["uid"],
    "age": "18 + user_id % 48",
    "gender": "case user_id % 3 when 0 then 'male' when 1 then 'female' else 'other' end",
    "weight_kg": "cast(480 + 7 * (user_id % 90) as double) / 10",
    "height_cm": "152 + user_id % 47",
    "job_type": _JOB.format("user_id"),
    "fitness_goal": "case user_id % 4 when 0 then 'strength' when 1 then 'endurance' "
                    "when 2 then 'weight_loss' else 'longevity' end",
    "gym_id": _gym("user_id % 5"),
}

# The reference tables.
GYMS = (
    ("GYM1", "functional"), ("GYM2", "crossfit"), ("GYM3", "commercial"),
    ("GYM4", "yoga_studio"), ("GYM5", "performance"),
)
CATALOG = (
    ("Strength", "resistance", 5.0, "muscle_gain", 2),
    ("CrossFit", "mixed", 8.0, "conditioning", 2),
    ("HIIT", "cardio", 8.5, "fat_loss", 1),
    ("Yoga", "flexibility", 2.5, "mobility", 0),
    ("Running", "cardio", 8.0, "endurance", 1),
    ("Cycling", "cardio", 7.5, "endurance", 1),
    ("Swimming", "cardio", 7.0, "full_body", 1),
    ("Mobility", "flexibility", 2.0, "injury_prevention", 0),
    ("Rest", "recovery", 1.0, "recovery", 0),
)
CONDITIONS = (("none", 1.0, 1.0), ("hypertension", 1.3, 0.85), ("diabetes", 1.25, 0.9))

# Damage done to stream payloads.
NOT_BASE64_EVERY, NOT_JSON_EVERY, NO_TYPE_EVERY, WRONG_KIND_EVERY = 97, 89, 83, 79


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with retries and near copies, in one scan."""
    copies = F.expr(
        "filter(array("
        "event_id,"
        f" if(event_id % {RETRY_EVERY} = 0, event_id, null),"
        f" if(event_id % {NEAR_EVERY} = 0, event_id + {NEAR_SHIFT}, null)"
        "), c -> c is not null)"
    )
    return events(spark, sf_dir).select(
        F.explode(copies).alias("id"), "ts", "user_id", "event_type",
        F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("k"),
    )


def _spark_sql(expression: str) -> str:
    return expression.replace("varchar(20)", "string").replace("varchar(40)", "string")


def _record(record_type: str) -> list:
    """Bronze columns of one record type as Spark expressions over ``raw_events``."""
    body = TYPED[record_type][2]
    schema = schemas.BRONZE[record_type]
    head = {
        "record_type": f"'{record_type}'",
        "user_id": RAW_COLUMNS["uid"], "timestamp": RAW_COLUMNS["ts_text"],
    }
    return [
        F.expr(_spark_sql({**head, **body}[f.name])).cast(f.dataType).alias(f.name) for f in schema
    ]


def bronze(spark: SparkSession, sf_dir: str, record_type: str) -> DataFrame:
    event_type, condition, _ = TYPED[record_type]
    raw = raw_events(spark, sf_dir).filter(F.col("event_type") == event_type).filter(condition)
    return raw.select(*_record(record_type))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All record types side by side in one scan: ``id``, ``day`` and the stream columns."""
    raw = raw_events(spark, sf_dir)
    fields: dict[str, object] = {}
    record_type = F.lit(None).cast("string")
    for name, (event_type, condition, _) in TYPED.items():
        applies = (F.col("event_type") == event_type) & F.expr(condition)
        record_type = F.when(applies, name).otherwise(record_type)
        schema = schemas.BRONZE[name]
        for field, column in zip(schema, _record(name)):
            if field.name != "record_type":
                value = F.when(applies, column)
                known = fields.get(field.name)
                fields[field.name] = value if known is None else F.coalesce(known, value)
    return raw.select(
        "id", F.to_date("ts").alias("day"), record_type.alias("record_type"),
        *[c.alias(n) for n, c in fields.items()],
    ).filter("record_type is not null")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base64 JSON messages, some damaged: ``id``, ``day``, ``value``."""
    rows = records(spark, sf_dir)
    names = [c for c in rows.columns if c not in ("id", "day")]
    typed = rows.withColumn(
        "record_type", F.when(F.col("id") % NO_TYPE_EVERY != 0, F.col("record_type"))
    )
    text = F.to_json(F.struct(*names))
    wrong = F.regexp_replace(text, '"user_id":', '"heart_rate":"high","user_id":')
    text = F.when(F.col("id") % WRONG_KIND_EVERY == 0, wrong).otherwise(text)
    text = F.when(F.col("id") % NOT_JSON_EVERY == 0, F.lit('{"record_type": ')).otherwise(text)
    value = F.when(F.col("id") % NOT_BASE64_EVERY == 0, F.lit("%%not base64%%")).otherwise(
        F.regexp_replace(F.base64(text.cast("binary")), "[\\r\\n]", "")
    )
    return typed.select("id", "day", value.alias("value"))


def user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = events(spark, sf_dir).select("user_id").distinct().filter(USER_PROFILE_FILTER)
    schema = schemas.REFERENCE["user_profiles"]
    made = {n: F.expr(_spark_sql(e)) for n, e in USER_PROFILE_COLUMNS.items()}
    return users.select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def references(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame | None]:
    return {
        "user_profiles": user_profiles(spark, sf_dir),
        "gym_master": spark.createDataFrame(list(GYMS), "gym_id string, gym_type string"),
        "workout_catalog": spark.createDataFrame(
            list(CATALOG),
            "workout_type string, category string, met_value double, primary_benefit string, "
            "recovery_days_needed int",
        ),
        "medical_conditions": spark.createDataFrame(
            list(CONDITIONS), "condition string, risk_modifier double, hr_max_factor double"
        ),
    }


# --- the same inputs for the SQL oracle -------------------------------------------------------

def _rows(values) -> str:
    def literal(v):
        return f"'{v}'" if isinstance(v, str) else f"cast({v} as double)" if isinstance(v, float) else str(v)
    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in values)


def oracle_views() -> dict[str, str]:
    """SQL of the fixture views by name, in dependency order."""
    views = {
        "fx_raw": f"""
            select event_id as id, ts, user_id, event_type,
                   cast(regexp_extract(props, '[0-9]+') as bigint) as k from events
            union all
            select event_id, ts, user_id, event_type, cast(regexp_extract(props, '[0-9]+') as bigint)
            from events where event_id % {RETRY_EVERY} = 0
            union all
            select event_id + {NEAR_SHIFT}, ts, user_id, event_type,
                   cast(regexp_extract(props, '[0-9]+') as bigint)
            from events where event_id % {NEAR_EVERY} = 0"""
    }
    short = {"wearable_event": "fx_wearable", "workout_log": "fx_workout", "sleep_log": "fx_sleep",
             "nutrition_snapshot": "fx_nutrition", "user_profile": "fx_profile"}
    for name, (event_type, condition, body) in TYPED.items():
        columns = []
        for f in schemas.BRONZE[name]:
            if f.name in body:
                columns.append(f"cast({body[f.name]} as {f.dataType.simpleString().replace('string', 'varchar')}) as {f.name}")
        views[short[name]] = f"""
            select id, '{name}' as record_type, {RAW_COLUMNS['uid']} as user_id,
                   {RAW_COLUMNS['ts_text']} as "timestamp", {', '.join(columns)}
            from fx_raw where event_type = '{event_type}' and {condition}"""
    views["fx_user_profiles"] = (
        "select " + ", ".join(f"{e} as {n}" for n, e in USER_PROFILE_COLUMNS.items())
        + f" from (select distinct user_id from events) where {USER_PROFILE_FILTER}"
    )
    views["fx_gym"] = f"select * from (values {_rows(GYMS)}) as g(gym_id, gym_type)"
    views["fx_catalog"] = (
        f"select * from (values {_rows(CATALOG)}) as c(workout_type, category, met_value, "
        "primary_benefit, recovery_days_needed)"
    )
    views["fx_conditions"] = (
        f"select * from (values {_rows(CONDITIONS)}) as m(condition, risk_modifier, hr_max_factor)"
    )
    return views
