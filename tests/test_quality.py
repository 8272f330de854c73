import pytest
from pyspark.sql import functions as F

from pulselake import schemas
from pulselake.operators import quality
from pulselake.operators.quality import Rule

GOOD = {
    "wearable_event": {"heart_rate": 70, "hrv": 40, "steps": 10, "recovery_score": 50},
    "workout_log": {"duration_minutes": 30, "rpe": 5},
    "sleep_log": {"total_sleep_hours": 7.0, "deep_sleep_hours": 1.0, "rem_hours": 1.0},
    "nutrition_snapshot": {"calories_in": 2000, "protein_g": 90, "carbs_g": 200, "hydration_ml": 2000},
    "user_profile": {"age": 30, "weight_kg": 70.0},
}
# type, changed columns, expected reason: both sides of each boundary, and nulls
CASES = [
    ("wearable_event", {"heart_rate": 30}, None),
    ("wearable_event", {"heart_rate": 29}, "heart_rate_out_of_range"),
    ("wearable_event", {"heart_rate": 220}, None),
    ("wearable_event", {"heart_rate": 221}, "heart_rate_out_of_range"),
    ("wearable_event", {"heart_rate": None}, "heart_rate_out_of_range"),
    ("wearable_event", {"hrv": 0}, "hrv_negative_or_zero"),
    ("wearable_event", {"hrv": 1}, None),
    ("wearable_event", {"hrv": None}, "hrv_negative_or_zero"),
    ("wearable_event", {"steps": 0}, None),
    ("wearable_event", {"steps": 50000}, None),
    ("wearable_event", {"steps": 50001}, "steps_out_of_range"),
    ("wearable_event", {"steps": None}, "steps_out_of_range"),
    ("wearable_event", {"recovery_score": 0}, None),
    ("wearable_event", {"recovery_score": 100}, None),
    ("wearable_event", {"recovery_score": 101}, "recovery_score_out_of_range"),
    ("wearable_event", {"recovery_score": None}, "recovery_score_out_of_range"),
    ("wearable_event", {"heart_rate": 300, "hrv": -1}, "heart_rate_out_of_range"),
    ("workout_log", {"duration_minutes": 1}, None),
    ("workout_log", {"duration_minutes": 0}, "duration_out_of_range"),
    ("workout_log", {"duration_minutes": 300}, None),
    ("workout_log", {"duration_minutes": 301}, "duration_out_of_range"),
    ("workout_log", {"duration_minutes": None}, "duration_out_of_range"),
    ("workout_log", {"rpe": 1}, None),
    ("workout_log", {"rpe": 0}, "rpe_out_of_range"),
    ("workout_log", {"rpe": 10}, None),
    ("workout_log", {"rpe": 11}, "rpe_out_of_range"),
    ("workout_log", {"rpe": None, "duration_minutes": None}, "duration_out_of_range"),
    ("sleep_log", {"total_sleep_hours": 0.0, "deep_sleep_hours": 0.0, "rem_hours": 0.0}, None),
    ("sleep_log", {"total_sleep_hours": 16.0}, None),
    ("sleep_log", {"total_sleep_hours": 16.1}, "total_sleep_out_of_range"),
    ("sleep_log", {"total_sleep_hours": None}, "total_sleep_out_of_range"),
    ("sleep_log", {"deep_sleep_hours": 7.0}, None),
    ("sleep_log", {"deep_sleep_hours": 7.1}, "deep_sleep_exceeds_total"),
    ("sleep_log", {"rem_hours": 7.1}, "rem_exceeds_total"),
    ("sleep_log", {"deep_sleep_hours": None, "rem_hours": None}, None),
    ("nutrition_snapshot", {"calories_in": 10000}, None),
    ("nutrition_snapshot", {"calories_in": 10001}, "calories_out_of_range"),
    ("nutrition_snapshot", {"calories_in": None}, "calories_out_of_range"),
    ("nutrition_snapshot", {"protein_g": 501}, "protein_out_of_range"),
    ("nutrition_snapshot", {"protein_g": None}, "protein_out_of_range"),
    ("nutrition_snapshot", {"hydration_ml": 10001}, "hydration_out_of_range"),
    ("nutrition_snapshot", {"carbs_g": None}, None),
    ("user_profile", {"age": 13}, None),
    ("user_profile", {"age": 12}, "age_out_of_range"),
    ("user_profile", {"age": 101}, "age_out_of_range"),
    ("user_profile", {"weight_kg": 30.0}, None),
    ("user_profile", {"weight_kg": 250.1}, "weight_out_of_range"),
    ("user_profile", {"weight_kg": None}, "weight_out_of_range"),
]


def record(spark, record_type, values_list):
    schema = schemas.BRONZE[record_type]
    data = [
        tuple({"record_type": record_type, "user_id": "U1", "timestamp": f"2024-01-01 00:00:{i:02d}",
               **GOOD[record_type], **v}.get(f.name) for f in schema)
        for i, v in enumerate(values_list)
    ]
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("record_type", schemas.RECORD_TYPES)
def test_rules_at_their_boundaries(spark, record_type):
    cases = [(v, reason) for t, v, reason in CASES if t == record_type]
    judged = quality.refine(record(spark, record_type, [v for v, _ in cases]), record_type)
    found = [r.failure_reason for r in judged.orderBy("timestamp").collect()]
    assert found == [reason for _, reason in cases]


def test_null_rule_input_is_no_violation(spark):
    plain = spark.createDataFrame([(None, 5.0)], "recovery_score double, x double")
    rules = {"t": [Rule("r", quality.outside("recovery_score", 0, 100)), Rule("x_small", "x < 9")]}
    assert quality.validate(plain, "t", rules).first().failure_reason == "x_small"


def test_type_without_rules_is_valid(spark):
    row = quality.validate(spark.range(1), "unheard_of").first()
    assert row.is_valid and row.failure_reason is None


def test_sentinels_are_stored_in_parity_mode_only(spark):
    bronze = record(spark, "sleep_log", [{"deep_sleep_hours": None}])
    assert quality.refine(bronze, "sleep_log").first().deep_sleep_hours is None
    assert quality.refine(bronze, "sleep_log", parity=True).first().deep_sleep_hours == -1.0


def test_unusable_keys_are_quarantined_each_on_its_own(spark):
    bad = [{"timestamp": "never", "heart_rate": h} for h in (70, 71, 71)]
    bad += [{"user_id": None, "heart_rate": 70}, {"timestamp": None}]
    judged = quality.refine(record(spark, "wearable_event", bad), "wearable_event")
    assert [r.failure_reason for r in judged.collect()] == ["bad_key"] * 4
    parity = quality.refine(record(spark, "wearable_event", bad[:3]), "wearable_event", parity=True)
    assert parity.count() == 1 and parity.first().is_valid


def test_same_instant_in_two_spellings_is_one_event(spark):
    spelled = [{"timestamp": "2024-01-01T05:00:00"}, {"timestamp": "2024-01-01 05:00:00"}]
    bronze = record(spark, "wearable_event", spelled)
    assert quality.refine(bronze, "wearable_event").count() == 1
    assert quality.refine(bronze, "wearable_event", parity=True).count() == 2


def test_missing_column_becomes_null_and_unreadable_value_too(spark):
    df = spark.createDataFrame([("U1", "2024-01-01", "fast")], "user_id string, timestamp string, heart_rate string")
    cast = quality.cast_record(df, "wearable_event")
    row = cast.first()
    assert row.heart_rate is None and row.hrv is None
    assert dict(cast.dtypes)["hrv"] == "double" and dict(cast.dtypes)["heart_rate"] == "int"
    filled = quality.fill_sentinels(cast, "wearable_event").first()
    assert (filled.heart_rate, filled.hrv, filled.steps, filled.recovery_score) == (-1, -1.0, -1, -1.0)


def test_split_keeps_every_row_and_equal_schemas(spark):
    bronze = record(spark, "workout_log", [{}, {"rpe": 99}, {"duration_minutes": None}])
    judged = quality.refine(bronze, "workout_log")
    silver, quarantine = quality.split_silver_quarantine(judged)
    assert silver.schema == quarantine.schema and "is_valid" not in silver.columns
    assert (silver.count(), quarantine.count()) == (1, 2)
    assert silver.filter(F.col("failure_reason").isNotNull()).isEmpty()
