"""Registered queries: one per operator, each over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from pulselake import schemas
from pulselake.functions import scoring, texts
from pulselake.functions.codec import decode_records, opened
from pulselake.functions.numbers import round_half_up
from pulselake.operators import audit, buckets, digests, enrich, expectations, keys, quality, temporal, upsert
from pulselake.operators.calendar import date_dimension
from pulselake.plans import gold, incremental, rolling, runs, star, suite
from pulselake.session import configure, side_by_side, workspace
from pulselake.sources import tables
from pulselake.streaming import ingest
from pulselake.streaming.silver import silver_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SHORT = {
    "wearable_event": "wearable", "workout_log": "workout", "sleep_log": "sleep",
    "nutrition_snapshot": "nutrition", "user_profile": "profile",
}
FIRST_DROP_UNTIL = "2024-01-20"
SECOND_LOAD_FROM = "2024-01-16"


def portable(df: DataFrame) -> DataFrame:
    """Dates, times and nested values as text, so any engine can compare them."""
    columns = []
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind in ("date", "timestamp", "timestamp_ntz"):
            columns.append(F.col(f.name).cast("string").alias(f.name))
        elif kind in ("array", "struct", "map"):
            columns.append(F.to_json(f.name).alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(function(configure(spark), sf_dir))

    QUERIES[function.__name__] = run
    return function


# --- shared steps -----------------------------------------------------------------------------

def judged(spark, sf_dir, record_type, parity=False):
    return quality.refine(fx.bronze(spark, sf_dir, record_type), record_type, parity=parity)


def all_judged(spark, sf_dir, parity=False):
    """Type, key and verdict of every record."""
    return tables.read_many([
        judged(spark, sf_dir, t, parity).select(
            "record_type", "user_id", "timestamp", "is_valid", "failure_reason"
        )
        for t in schemas.RECORD_TYPES
    ])


def silver(spark, sf_dir, record_type):
    """Valid rows of a type with their date, not enriched."""
    valid, _ = quality.split_silver_quarantine(judged(spark, sf_dir, record_type))
    return tables.with_date(valid)


def silver_enriched(spark, sf_dir, record_type):
    refs = fx.references(spark, sf_dir)
    bronze = fx.bronze(spark, sf_dir, record_type)
    return enrich.enrich(silver(spark, sf_dir, record_type), record_type, refs)


def gold_fatigue(spark, sf_dir):
    return gold.fatigue_recovery(
        *[silver(spark, sf_dir, t) for t in ("wearable_event", "sleep_log", "workout_log")]
    )


def gold_community(spark, sf_dir):
    return gold.community_analytics(*[
        silver(spark, sf_dir, t)
        for t in ("wearable_event", "sleep_log", "workout_log", "user_profile")
    ])


def dim_user(spark, sf_dir):
    return temporal.build_dim_user(silver_enriched(spark, sf_dir, "user_profile"))


def staged_users(spark, sf_dir):
    return temporal.stage_dim_user(dim_user(spark, sf_dir))


def fact_fatigue(spark, sf_dir):
    return star.load_fact_fatigue(gold_fatigue(spark, sf_dir))


def fact_consistency(spark, sf_dir):
    return star.load_fact_consistency(gold.workout_consistency(silver(spark, sf_dir, "workout_log")))


def fact_community(spark, sf_dir):
    return star.load_fact_community(gold_community(spark, sf_dir))


def stored_star(spark, sf_dir):
    """Dimension, facts and marts as stored tables, for checks that read them many times."""
    return star.run_star(
        silver_enriched(spark, sf_dir, "user_profile"), gold_fatigue(spark, sf_dir),
        gold.workout_consistency(silver(spark, sf_dir, "workout_log")),
        gold_community(spark, sf_dir), workspace(spark, "star"),
    )


def rounded(df, *columns, digits=6):
    return df.withColumns({c: round_half_up(F.col(c), digits) for c in columns})


def record_drop(spark, sf_dir, record_type, condition):
    """Bronze rows of one type that arrive in one delivery."""
    rows = fx.records(spark, sf_dir).filter(F.col("record_type") == record_type).filter(condition)
    return rows.select(*schemas.BRONZE[record_type].names)


FIRST_DROP = f"day <= date'{FIRST_DROP_UNTIL}'"
SECOND_DROP = f"day > date'{FIRST_DROP_UNTIL}'"


def message_landing(spark, sf_dir, folder):
    fx.payloads(spark, sf_dir).select("value").write.mode("append").text(folder)


# --- scans, sources, sinks --------------------------------------------------------------------

@query
def q_scan_bronze(spark, sf_dir):
    root = workspace(spark, "bronze")
    records = fx.records(spark, sf_dir)
    parts = texts.date_parts(F.col("timestamp").try_cast("timestamp"))
    tables.write_bronze(records.drop("id", "day").withColumns(parts), root)
    return tables.read_many([tables.read_bronze(spark, root, t) for t in schemas.RECORD_TYPES])


@query
def q_scan_silver(spark, sf_dir):
    root = _written_zones(spark, sf_dir)
    return tables.read_many([tables.read_silver(spark, root, t) for t in schemas.RECORD_TYPES])


@query
def q_reference_csv(spark, sf_dir):
    folder = workspace(spark, "reference")
    tables.write_reference(fx.user_profiles(spark, sf_dir), folder, "user_profiles")
    return tables.read_reference(spark, folder)["user_profiles"].select(*fx.USER_PROFILE_COLUMNS)


@query
def q_reference_tables(spark, sf_dir):
    """All five reference tables through CSV files, three columns of each."""
    folder = workspace(spark, "reference")
    bounds = fx.events(spark, sf_dir).agg(F.min("ts").cast("date").alias("first_date"), F.max("ts").cast("date").alias("last_date"))
    made = fx.references(spark, sf_dir) | {"date_dimension": date_dimension(bounds)}
    for name, table in made.items():
        layout = schemas.REFERENCE[name]
        tables.write_reference(tables.conform(table, layout), folder, name)
    wanted = {"user_profiles": ("user_id", "job_type", "weight_kg"), "gym_master": ("gym_id", "gym_type", None),
              "workout_catalog": ("workout_type", "category", "met_value"),
              "medical_conditions": ("condition", None, "risk_modifier"), "date_dimension": ("date_id", "day_name", "day_of_year")}
    read = tables.read_reference(spark, folder)
    column = lambda c, kind: (F.lit(None) if c is None else F.col(c)).cast(kind)
    return tables.read_many([
        read[name].select(F.lit(name).alias("table_name"), column(a, "string").alias("key"), column(b, "string").alias("label"), column(c, "double").alias("number"))
        for name, (a, b, c) in wanted.items()])


@query
def q_read_files(spark, sf_dir):
    """Files of one logical table whose columns differ, read by a pattern."""
    folder = workspace(spark, "files")
    for name, t, columns in (("a", "workout_log", ("user_id", "timestamp", "gym_id", "rpe")), ("b", "user_profile", ("timestamp", "user_id", "age", "gym_id"))):
        fx.bronze(spark, sf_dir, t).select(*columns).write.parquet(f"{folder}/part-{name}")
    return tables.read_files(spark, f"{folder}/part-*")


@query
def q_catalog_marts(spark, sf_dir):
    """Marts and staging in the catalog, published twice; the second publication replaces the first."""
    made, database = stored_star(spark, sf_dir), "marts_" + workspace(spark, "x")[-12:]
    star.publish({n: t.limit(0) for n, t in made.items()}, workspace(spark, "catalog"), database)
    names = star.publish(made, workspace(spark, "catalog"), database)
    return tables.read_many([spark.table(shown).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, shown in names.items()])


@query
def q_stream_incremental(spark, sf_dir):
    base = workspace(spark, "incremental")

    def deliver(t):
        for drop in (FIRST_DROP, SECOND_DROP, None):
            if drop is not None:
                record_drop(spark, sf_dir, t, drop).write.mode("append").parquet(f"{base}/landing/{t}")
            ingest.ingest_files(spark, t, f"{base}/landing/{t}", f"{base}/bronze", f"{base}/checkpoint/{t}")

    side_by_side(deliver, schemas.RECORD_TYPES)
    audited = F.col("_ingested_at").isNotNull() & F.col("_source_file").contains("/landing/")
    rows = spark.read.parquet(f"{base}/bronze").select("record_type", "user_id", "timestamp", audited.alias("audited"))
    readable = tables.read_many([tables.read_bronze(spark, f"{base}/bronze", t).select("record_type") for t in schemas.RECORD_TYPES])
    return rows.join(readable.distinct(), "record_type", "left_semi")


@query
def q_stream_demux(spark, sf_dir):
    base = workspace(spark, "demux")
    message_landing(spark, sf_dir, f"{base}/landing")
    ingest.ingest_messages(
        ingest.text_stream(spark, f"{base}/landing"), f"{base}/bronze", f"{base}/checkpoint"
    )
    schema = spark.read.parquet(f"{base}/bronze").drop("payload")
    kept = [c for c in schema.columns if c not in ("year", "month", "day", "writer", "batch")]
    return schema.select(*kept)


@query
def q_bronze_write(spark, sf_dir):
    root = workspace(spark, "bronze")
    records = fx.records(spark, sf_dir)
    parts = texts.date_parts(F.col("timestamp").try_cast("timestamp"))
    tables.write_bronze(records.drop("id", "day").withColumns(parts), root)
    stored = tables.read_many([tables.read_bronze(spark, root, t).select(
        *tables.BRONZE_PARTITIONS) for t in schemas.RECORD_TYPES])
    return stored.groupBy(*tables.BRONZE_PARTITIONS).agg(F.count(F.lit(1)).alias("n_rows"))


def _written_zones(spark, sf_dir):
    root = workspace(spark, "silver")
    refs = fx.references(spark, sf_dir)
    side_by_side(lambda t: tables.write_judged(
        runs.judge(fx.bronze(spark, sf_dir, t), t, refs), root, t), schemas.RECORD_TYPES)
    return root


@query
def q_silver_write(spark, sf_dir):
    root = _written_zones(spark, sf_dir)
    stored = tables.read_many([
        tables.read_silver(spark, root, t).select("record_type", "date")
        for t in schemas.RECORD_TYPES
    ])
    return stored.groupBy("record_type", "date").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def q_quarantine_write(spark, sf_dir):
    root = _written_zones(spark, sf_dir)
    return tables.read_many([
        tables.read_quarantine(spark, root, t).select(
            "record_type", "user_id", "timestamp", "failure_reason", "date"
        )
        for t in schemas.RECORD_TYPES
    ])


@query
def q_gold_write(spark, sf_dir):
    root = workspace(spark, "gold")
    fatigue = gold_fatigue(spark, sf_dir)
    tables.write_gold(fatigue.select("user_id", "date", "hrv"), root, "fatigue")
    tables.write_gold(fatigue.drop("hrv"), root, "fatigue")
    stored = spark.read.parquet(f"{root}/fatigue")
    return rounded(stored, "recovery_score", "stress_score", "total_sleep_hours", "sleep_debt_hours")


@query
def q_append_idempotent(spark, sf_dir):
    root = workspace(spark, "append")
    natural = ("user_id", "timestamp")

    def load(t):
        rows, path = silver(spark, sf_dir, t).drop("failure_reason"), f"{root}/{t}"
        tables.append_new_rows(rows.filter(f"date <= date'{FIRST_DROP_UNTIL}'"), path, natural)
        for _ in range(2):
            tables.append_new_rows(rows.filter(f"date >= date'{SECOND_LOAD_FROM}'"), path, natural)
        return spark.read.schema(rows.schema).parquet(path)

    return tables.read_many(side_by_side(load, [t for t in schemas.RECORD_TYPES if t != "user_profile"]))


@query
def q_quarantine_audit_log(spark, sf_dir):
    path = workspace(spark, "audit")
    _, bad = quality.split_silver_quarantine(judged(spark, sf_dir, "user_profile"))
    bad = bad.select("user_id", "timestamp", "failure_reason")
    for run in ("run-1", "run-2", "run-2"):
        tables.append_audit(bad, path, run)
    return spark.read.parquet(path).groupBy("run_id", "failure_reason").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


PROFILE_STATE = ("user_id", "timestamp", "job_type", "fitness_goal", "weight_kg")


def _profile_loads(spark, sf_dir):
    """Two overlapping profile deliveries, the later one with more columns."""
    rows = silver(spark, sf_dir, "user_profile")
    first = rows.filter(f"date <= date'{FIRST_DROP_UNTIL}'").select(*PROFILE_STATE)
    second = rows.filter(f"date >= date'{SECOND_LOAD_FROM}'")
    return first, second


@query
def q_merge_upsert(spark, sf_dir):
    first, second = _profile_loads(spark, sf_dir)
    root = workspace(spark, "merge")
    name = "profile_state_" + root[-12:]
    upsert.upsert_table(first, name, root, by="timestamp")
    upsert.upsert_table(second.select(*PROFILE_STATE), name, root, by="timestamp")
    return spark.table(name)


@query
def q_merge_buckets(spark, sf_dir):
    """The same merge on a table of key buckets, of which only the touched ones are rewritten."""
    first, second = _profile_loads(spark, sf_dir)
    root = workspace(spark, "buckets")
    buckets.upsert_buckets(first, root, by="timestamp", buckets=16)
    buckets.upsert_buckets(second.select(*PROFILE_STATE), root, by="timestamp")
    return buckets.read_buckets(spark, root)


@query
def q_merge_schema_evolution(spark, sf_dir):
    first, second = _profile_loads(spark, sf_dir)
    target = upsert.one_per_key(first, ["user_id"], "timestamp")
    source = upsert.one_per_key(
        second.select("user_id", "timestamp", "job_type", "fitness_goal", "gym_id"),
        ["user_id"], "timestamp",
    )
    return upsert.merge_upsert(target, source)


@query
def q_merge_metrics(spark, sf_dir):
    first, second = _profile_loads(spark, sf_dir)
    target = upsert.one_per_key(first, ["user_id"], "timestamp")
    source = upsert.one_per_key(second.select(*PROFILE_STATE), ["user_id"], "timestamp")
    return upsert.merge_metrics(upsert.merge_upsert(target, source))


@query
def q_fact_load(spark, sf_dir):
    facts = fact_fatigue(spark, sf_dir)
    return rounded(facts, "recovery_score", "stress_score", "hrv", "total_sleep_hours", "sleep_debt_hours")


@query
def q_union_by_name(spark, sf_dir):
    workouts = fx.bronze(spark, sf_dir, "workout_log").select("user_id", "timestamp", "gym_id", "rpe")
    profiles = fx.bronze(spark, sf_dir, "user_profile").select("timestamp", "user_id", "age", "gym_id")
    return tables.read_many([workouts, profiles])


# --- ingest -----------------------------------------------------------------------------------

@query
def q_decode_payload(spark, sf_dir):
    decoded = decode_records(fx.payloads(spark, sf_dir))
    return decoded.filter("reject_reason is null").drop("payload", "reject_reason", "day")


@query
def q_envelope_decode(spark, sf_dir):
    """The same records from base64 payloads under ``kinesis.data``, beside their stream position."""
    wrapped = fx.payloads(spark, sf_dir).withColumns({
        "value": F.to_json(F.struct(F.struct(F.col("value").alias("data")).alias("kinesis"))), "offset": F.col("id")})
    decoded = decode_records(opened(wrapped, envelope="$.kinesis.data"))
    return decoded.filter("reject_reason is null and offset = id").drop("payload", "reject_reason", "day", "_message", "offset")


@query
def q_decode_errors(spark, sf_dir):
    decoded = decode_records(fx.payloads(spark, sf_dir))
    return decoded.filter("reject_reason is not null").groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def q_ingest_summary(spark, sf_dir):
    decoded = decode_records(fx.payloads(spark, sf_dir)).filter("reject_reason is null")
    by_type = audit.counts_by_type(decoded)
    total = by_type.agg(F.sum("n_rows").alias("n_rows")).select(F.lit("total").alias("record_type"), "n_rows")
    return by_type.unionByName(total)


@query
def q_schema_enforce(spark, sf_dir):
    decoded = decode_records(fx.payloads(spark, sf_dir))
    wrong = decoded.filter("reject_reason = 'schema_mismatch'")
    return wrong.select("id", "reject_reason", F.col("payload").contains('"heart_rate":"high"').alias("text_kept"))


@query
def q_parse_array_pylist(spark, sf_dir):
    rows = fx.bronze(spark, sf_dir, "workout_log")
    return rows.select("user_id", "timestamp", F.array_join(
        texts.parse_quoted_list(F.col("muscle_groups")), "|").alias("muscles"))


@query
def q_parse_array_bracket(spark, sf_dir):
    rows = fx.bronze(spark, sf_dir, "workout_log")
    parsed = texts.parse_bare_list(F.col("muscle_groups"))
    return rows.select("user_id", "timestamp", F.array_join(parsed, "|").alias("muscles"),
                       F.size(parsed).alias("n_muscles"))


@query
def q_parse_groups(spark, sf_dir):
    rows = fx.bronze(spark, sf_dir, "workout_log")
    parsed = texts.parse_groups(F.col("muscle_groups"))
    return rows.select("user_id", "timestamp", F.array_join(parsed, "|").alias("muscles"),
                       F.size(parsed).alias("n_muscles"))


@query
def q_type_coverage(spark, sf_dir):
    records = fx.records(spark, sf_dir).select("user_id", "record_type")
    every_type = F.array(*[F.lit(t) for t in schemas.RECORD_TYPES])
    expected = records.select("user_id").distinct().select(
        "user_id", F.explode(every_type).alias("record_type"))
    return expectations.missing_types(expected, records, ("user_id", "record_type"))


@query
def q_replay_equals_batch(spark, sf_dir):
    base = workspace(spark, "replay")
    landing = f"{base}/landing"
    payloads = fx.payloads(spark, sf_dir)
    for drop in (FIRST_DROP, SECOND_DROP):
        payloads.filter(drop).select("value").write.mode("append").text(landing)
        ingest.ingest_messages(ingest.text_stream(spark, landing), f"{base}/live", f"{base}/live_memory")
    ingest.ingest_messages(ingest.text_stream(spark, landing), f"{base}/replay", f"{base}/replay_memory")
    live, replay = (spark.read.parquet(f"{base}/{n}").drop("writer", "batch") for n in ("live", "replay"))
    live, replay = live.withColumn("n_live", F.lit(1)), replay.withColumn("n_live", F.lit(-1))
    balance = live.unionByName(replay).groupBy(*[c for c in live.columns if c != "n_live"]).agg(
        F.count_if(F.col("n_live") > 0).alias("live"), F.count_if(F.col("n_live") < 0).alias("replayed"))
    return balance.groupBy("record_type").agg(
        F.sum("live").alias("n_live"), F.sum("replayed").alias("n_replayed"),
        F.sum(F.abs(F.col("live") - F.col("replayed"))).alias("n_different"))


# --- projections and validation ---------------------------------------------------------------

@query
def q_cast_schema(spark, sf_dir):
    return tables.read_many([quality.cast_record(fx.bronze(spark, sf_dir, t), t) for t in schemas.RECORD_TYPES])


@query
def q_schema_drift(spark, sf_dir):
    drifted = fx.bronze(spark, sf_dir, "wearable_event").drop("hrv", "recovery_score")
    rows = quality.refine(drifted, "wearable_event")
    return rows.select("user_id", "timestamp", "heart_rate", "hrv", "recovery_score", "failure_reason")


@query
def q_sentinel_fill(spark, sf_dir):
    cast = quality.cast_record(fx.bronze(spark, sf_dir, "nutrition_snapshot"), "nutrition_snapshot")
    return quality.fill_sentinels(cast, "nutrition_snapshot")


def _validate_query(record_type):
    def run(spark, sf_dir):
        return judged(spark, sf_dir, record_type)

    run.__name__ = f"q_validate_{SHORT[record_type]}"
    return run


for _type in schemas.RECORD_TYPES:
    query(_validate_query(_type))


@query
def q_validate_parity(spark, sf_dir):
    return all_judged(spark, sf_dir, parity=True)


@query
def q_validate_unknown_type(spark, sf_dir):
    decoded = decode_records(fx.payloads(spark, sf_dir)).filter("reject_reason is null")
    unknown = decoded.filter("record_type = 'unknown'").select("id", "user_id", "timestamp")
    return quality.validate(unknown, "unknown")


@query
def q_split_silver(spark, sf_dir):
    return quality.split_silver_quarantine(all_judged(spark, sf_dir))[0]


@query
def q_split_quarantine(spark, sf_dir):
    return quality.split_silver_quarantine(all_judged(spark, sf_dir))[1]


@query
def q_enrich_events(spark, sf_dir):
    return tables.read_many([
        silver_enriched(spark, sf_dir, t).select(
            "record_type", "user_id", "timestamp", "job_type", "fitness_goal", "gym_id")
        for t in ("wearable_event", "sleep_log", "nutrition_snapshot")
    ])


@query
def q_enrich_profile(spark, sf_dir):
    return silver_enriched(spark, sf_dir, "user_profile").select(
        "user_id", "timestamp", "medical_history", "medical_risk_modifier", "gym_id", "gym_type")


@query
def q_enrich_workout(spark, sf_dir):
    return silver_enriched(spark, sf_dir, "workout_log").select(
        "user_id", "timestamp", "workout_type", "met_value", "recovery_days_needed")


@query
def q_stg_facts(spark, sf_dir):
    fatigue = star.stage(fact_fatigue(spark, sf_dir), "fact_fatigue_recovery")
    consistency = star.stage(fact_consistency(spark, sf_dir), "fact_workout_consistency")
    community = star.stage(fact_community(spark, sf_dir), "fact_community_analytics")
    return tables.read_many([
        fatigue.select(F.lit("fatigue").alias("fact"), "fact_id", "user_id", "event_date", "fatigue_score"),
        consistency.select(F.lit("consistency").alias("fact"), "fact_id", "user_id", "completion_rate_pct"),
        community.select(F.lit("community").alias("fact"), "fact_id", "job_type", "fitness_goal"),
    ])


# --- aggregates and Gold ----------------------------------------------------------------------

@query
def q_wearable_daily(spark, sf_dir):
    return rounded(gold.wearable_daily(silver(spark, sf_dir, "wearable_event")),
                   "recovery_score", "stress_score", "hrv")


@query
def q_sleep_daily(spark, sf_dir):
    return rounded(gold.sleep_daily(silver(spark, sf_dir, "sleep_log")), "total_sleep_hours")


@query
def q_training_load_daily(spark, sf_dir):
    return gold.training_load_daily(silver(spark, sf_dir, "workout_log"))


@query
def q_muscle_counts(spark, sf_dir):
    return gold.muscle_counts(silver(spark, sf_dir, "workout_log"))


@query
def q_gold_fatigue(spark, sf_dir):
    return rounded(gold_fatigue(spark, sf_dir), "recovery_score", "stress_score", "hrv",
                   "total_sleep_hours", "sleep_debt_hours")


@query
def q_gold_consistency(spark, sf_dir):
    return gold.workout_consistency(silver(spark, sf_dir, "workout_log"))


@query
def q_gold_community(spark, sf_dir):
    return gold_community(spark, sf_dir)


@query
def q_gold_community_by_event(spark, sf_dir):
    return gold.community_analytics_by_event(
        silver_enriched(spark, sf_dir, "wearable_event"), silver_enriched(spark, sf_dir, "sleep_log"),
        silver(spark, sf_dir, "workout_log"))


@query
def q_gold_profile(spark, sf_dir):
    return gold.user_profile_enriched(silver_enriched(spark, sf_dir, "user_profile"))


@query
def q_overtraining_flagged(spark, sf_dir):
    flagged = gold_fatigue(spark, sf_dir).filter("overtraining_flag")
    return rounded(flagged.drop("hrv"), "recovery_score", "stress_score", "total_sleep_hours", "sleep_debt_hours")


@query
def q_unprofiled_users(spark, sf_dir):
    users = gold.user_cohorts(silver(spark, sf_dir, "user_profile"))
    active = silver(spark, sf_dir, "wearable_event").select("user_id").distinct()
    lost = expectations.orphans(active, "user_id", users, "user_id")
    return lost.agg(F.count("user_id").alias("unprofiled_users"))


@query
def q_quarantine_rate(spark, sf_dir):
    return audit.quarantine_rate(all_judged(spark, sf_dir))


@query
def q_failure_reasons(spark, sf_dir):
    return audit.failure_reasons(all_judged(spark, sf_dir))


@query
def q_gold_fatigue_stats(spark, sf_dir):
    return audit.score_stats(gold_fatigue(spark, sf_dir))


@query
def q_table_counts(spark, sf_dir):
    named = {f"bronze_{SHORT[t]}": fx.bronze(spark, sf_dir, t) for t in schemas.RECORD_TYPES}
    named |= {f"silver_{SHORT[t]}": silver(spark, sf_dir, t) for t in schemas.RECORD_TYPES}
    return audit.table_counts(named)


@query
def q_dedup_removed(spark, sf_dir):
    return audit.dedup_removed(fx.records(spark, sf_dir))


# --- windows, ordering, sets ------------------------------------------------------------------

@query
def q_dedup_events(spark, sf_dir):
    return tables.read_many([keys.deduplicate(fx.bronze(spark, sf_dir, t)) for t in schemas.RECORD_TYPES])


@query
def q_latest_profile(spark, sf_dir):
    return keys.latest_per_key(silver(spark, sf_dir, "user_profile"))


@query
def q_stg_dim_user(spark, sf_dir):
    return staged_users(spark, sf_dir)


@query
def q_dim_user_scd2(spark, sf_dir):
    return dim_user(spark, sf_dir)


@query
def q_top_fatigue(spark, sf_dir):
    top = gold_fatigue(spark, sf_dir).orderBy(F.desc_nulls_last("fatigue_score"), "user_id", "date").limit(10)
    return top.select("user_id", "date", "fatigue_score", "recovery_readiness", "overtraining_flag")


@query
def q_sample_dim(spark, sf_dir):
    sample = dim_user(spark, sf_dir).orderBy("user_id", "effective_date").limit(5)
    return sample.select("user_id", "effective_date", "end_date", "is_current")


@query
def q_sample_fact(spark, sf_dir):
    sample = fact_fatigue(spark, sf_dir).orderBy("user_id", "event_date").limit(5)
    return sample.select("user_id", "event_date")


@query
def q_audit_union(spark, sf_dir):
    users, parts = fx.references(spark, sf_dir), []
    for t in ("wearable_event", "sleep_log", "nutrition_snapshot"):
        valid, bad = quality.split_silver_quarantine(judged(spark, sf_dir, t))
        parts += [enrich.add_cohort(valid, users), bad]
    return tables.read_many(parts).select(
        "record_type", "user_id", "timestamp", "total_sleep_hours", "failure_reason", "job_type", "fitness_goal", "gym_id")


# --- dimensions, marts ------------------------------------------------------------------------

@query
def q_user_bmi(spark, sf_dir):
    value = scoring.bmi(F.col("weight_kg"), F.col("height_cm"))
    return silver(spark, sf_dir, "user_profile").select(
        "user_id", "timestamp", "weight_kg", "height_cm", value.alias("bmi"),
        scoring.bmi_category(value).alias("bmi_category"))


@query
def q_date_dimension(spark, sf_dir):
    bounds = fx.events(spark, sf_dir).agg(
        F.trunc(F.min("ts").cast("date"), "year").alias("first_date"),
        F.last_day(F.add_months(F.trunc(F.max("ts").cast("date"), "year"), 11)).alias("last_date"))
    return date_dimension(bounds)


MART_ROUNDED = ("recovery_score", "stress_score", "hrv", "total_sleep_hours", "sleep_debt_hours")


@query
def q_mart_health_score(spark, sf_dir):
    marts = star.mart_user_health_score(fact_fatigue(spark, sf_dir), staged_users(spark, sf_dir))
    return rounded(marts, *MART_ROUNDED)


@query
def q_mart_health_score_unmatched(spark, sf_dir):
    marts = star.mart_user_health_score(
        fact_fatigue(spark, sf_dir), staged_users(spark, sf_dir), keep_unmatched=True)
    return marts.select("user_id", "event_date", "job_type", "fatigue_score", "risk_adjusted_fatigue_score")


@query
def q_mart_coach(spark, sf_dir):
    return star.mart_coach_dashboard(fact_consistency(spark, sf_dir), dim_user(spark, sf_dir))


@query
def q_mart_community(spark, sf_dir):
    return star.mart_community_analytics(fact_community(spark, sf_dir))


@query
def q_reconcile(spark, sf_dir):
    fatigue = gold_fatigue(spark, sf_dir)
    stale = fatigue.filter("date <> date'2024-01-10'").withColumn(
        "fatigue_score", F.when(F.dayofmonth("date") == 20, F.col("fatigue_score") + 1).otherwise(F.col("fatigue_score")))
    final = star.load_fact_fatigue(stale)
    return audit.reconcile(fatigue, final, {"user_id": "user_id", "date": "event_date"},
                           ["fatigue_score", "overtraining_flag"])


@query
def q_reconcile_profiles(spark, sf_dir):
    """Landing profiles against the versions of the dimension, by digests of key buckets."""
    landing = silver_enriched(spark, sf_dir, "user_profile")
    return digests.reconcile_by_digest(landing, dim_user(spark, sf_dir), {"user_id": "user_id", "timestamp": "effective_date"},
                                       ["job_type", "fitness_goal"], buckets=64)


@query
def q_profile_scd2_ranges(spark, sf_dir):
    return audit.scd2_ranges(dim_user(spark, sf_dir), fact_fatigue(spark, sf_dir))


# --- expectations -----------------------------------------------------------------------------

@query
def q_dq_not_null(spark, sf_dir):
    return suite.not_null_checks(stored_star(spark, sf_dir))


@query
def q_dq_unique(spark, sf_dir):
    return suite.unique_checks(stored_star(spark, sf_dir))


@query
def q_dq_accepted_values(spark, sf_dir):
    marts = star.mart_community_analytics(fact_community(spark, sf_dir))
    label = F.when(F.col("job_type") == "mixed", F.concat(F.lit("no_"), "cohort_readiness_label")).otherwise(F.col("cohort_readiness_label"))
    spoilt = marts.withColumn("cohort_readiness_label", label)
    return expectations.unaccepted_values(spoilt, "cohort_readiness_label", suite.LABELS).select(
        "job_type", "fitness_goal", "cohort_readiness_label")


@query
def q_dq_relationships(spark, sf_dir):
    users = dim_user(spark, sf_dir)
    facts = {"stg_fact_fatigue_recovery": fact_fatigue(spark, sf_dir),
             "stg_fact_workout_consistency": fact_consistency(spark, sf_dir)}
    return tables.read_many([
        expectations.orphans(fact, "user_id", users, "user_id").select(
            F.lit(name).alias("table_name"), "user_id", "fact_id")
        for name, fact in facts.items()])


@query
def q_dq_completion_range(spark, sf_dir):
    totals = gold.workout_consistency(silver(spark, sf_dir, "workout_log"))
    return expectations.count_of(
        expectations.outside_range(totals, "completion_rate_pct", 0, 100), "completion_rate_in_range")


@query
def q_dq_fatigue_nonneg(spark, sf_dir):
    health = star.mart_user_health_score(fact_fatigue(spark, sf_dir), staged_users(spark, sf_dir))
    return expectations.count_of(suite.negative_scores(health), "fatigue_score_non_negative")


@query
def q_dq_no_dropped_rows(spark, sf_dir):
    fatigue = fact_fatigue(spark, sf_dir)
    health = star.mart_user_health_score(fatigue, staged_users(spark, sf_dir))
    return expectations.differing_counts(fatigue, health, ("raw_fact_rows", "mart_rows"))


@query
def q_dq_conservation(spark, sf_dir):
    zones = audit.quarantine_rate(all_judged(spark, sf_dir, parity=True)).drop("pct_quarantined")
    deduped = audit.dedup_removed(fx.records(spark, sf_dir)).select("record_type", "rows_after")
    return zones.join(deduped, "record_type", "full_outer").withColumn(
        "conserved", F.col("silver_rows") + F.col("quarantine_rows") == F.col("rows_after"))


@query
def q_dq_conservation_written(spark, sf_dir):
    """Rows of both written zones against the judged rows, per type."""
    root = _written_zones(spark, sf_dir)
    zones = [read(spark, root, t).select("record_type", F.lit(n).alias("zone"))
             for t in schemas.RECORD_TYPES for n, read in (("silver", tables.read_silver), ("quarantine", tables.read_quarantine))]
    held = tables.read_many(zones).groupBy("record_type").agg(
        F.count_if(F.col("zone") == "silver").alias("silver_rows"), F.count_if(F.col("zone") == "quarantine").alias("quarantine_rows"))
    wanted = all_judged(spark, sf_dir).groupBy("record_type").agg(F.count(F.lit(1)).alias("rows_after"))
    return held.join(wanted, "record_type", "full_outer").withColumn(
        "conserved", F.col("silver_rows") + F.col("quarantine_rows") == F.col("rows_after"))


@query
def q_dq_grain(spark, sf_dir):
    wearable, workout = silver(spark, sf_dir, "wearable_event"), silver(spark, sf_dir, "workout_log")
    profile = silver_enriched(spark, sf_dir, "user_profile")
    cohorts = wearable.select("user_id").distinct().join(
        gold.user_cohorts(profile), "user_id", "left").fillna(gold.UNPROFILED)
    return tables.read_many([
        expectations.grain(gold_fatigue(spark, sf_dir), wearable, gold.USER_DAY, "gold_fatigue_recovery"),
        expectations.grain(gold.workout_consistency(workout), workout, ("user_id",), "gold_workout_consistency"),
        expectations.grain(gold_community(spark, sf_dir), cohorts, gold.COHORT, "gold_community_analytics"),
        expectations.grain(gold.user_profile_enriched(profile), profile, ("user_id",), "gold_user_profile_enriched"),
    ])


@query
def q_dq_suite(spark, sf_dir):
    return suite.run_suite(stored_star(spark, sf_dir))


# --- whole runs -------------------------------------------------------------------------------

def _bronze_root(spark, sf_dir):
    root = workspace(spark, "bronze")
    parts = texts.date_parts(F.col("timestamp").try_cast("timestamp"))
    tables.write_bronze(fx.records(spark, sf_dir).drop("id", "day").withColumns(parts), root)
    return root


@query
def q_silver_summary(spark, sf_dir):
    bronze, root = _bronze_root(spark, sf_dir), workspace(spark, "silver")
    summary = runs.run_silver(spark, bronze, root, fx.references(spark, sf_dir))
    return spark.createDataFrame(
        [(s["record_type"], s["status"], s.get("silver_rows"), s.get("quarantine_rows")) for s in summary],
        "record_type string, status string, silver_rows bigint, quarantine_rows bigint")


@query
def q_gold_summary(spark, sf_dir):
    bronze, root = _bronze_root(spark, sf_dir), workspace(spark, "silver")
    runs.run_silver(spark, bronze, root, fx.references(spark, sf_dir))
    summary = runs.run_gold(spark, root, workspace(spark, "gold"))
    return spark.createDataFrame(
        [(s["table_name"], s["status"], s.get("n_rows")) for s in summary],
        "table_name string, status string, n_rows bigint")


LATE = "(day > date'2024-01-20' or (day = date'2024-01-10' and id % 3 = 0))"


def _refreshed(spark, sf_dir):
    """Gold after two incremental runs, the second with new days and with late rows of an old one."""
    bronze, silver_root, root = (workspace(spark, n) for n in ("bronze", "silver", "gold"))
    records = fx.records(spark, sf_dir)
    parts = texts.date_parts(F.col("timestamp").try_cast("timestamp"))
    refs = fx.references(spark, sf_dir)
    for batch, condition in (("1", f"not {LATE}"), ("2", LATE)):
        tables.write_bronze(records.filter(condition).drop("id", "day").withColumns(parts), bronze, "source", batch)
        incremental.refresh(spark, bronze, silver_root, root, refs)
    return root


@query
def q_gold_incremental(spark, sf_dir):
    fatigue = spark.read.parquet(f"{_refreshed(spark, sf_dir)}/gold_fatigue_recovery")
    return rounded(fatigue, "recovery_score", "stress_score", "hrv", "total_sleep_hours", "sleep_debt_hours")


@query
def q_gold_incremental_consistency(spark, sf_dir):
    return spark.read.parquet(f"{_refreshed(spark, sf_dir)}/gold_workout_consistency")


@query
def q_gold_incremental_community(spark, sf_dir):
    return spark.read.parquet(f"{_refreshed(spark, sf_dir)}/gold_community_analytics")


@query
def q_bronze_fold(spark, sf_dir):
    """Bronze of all types in many batches, folded day by day, with a writer taken back."""
    root = workspace(spark, "fold")
    parts = texts.date_parts(F.col("timestamp").try_cast("timestamp"))
    rows = fx.records(spark, sf_dir)
    for writer, batch in (("a", 0), ("a", 1), ("a", 2), ("mistake", 0)):
        part = rows.filter(f"id % 3 = {batch}").drop("id", "day").withColumns(parts)
        tables.write_bronze(part, root, writer, str(batch))
    tables.retire_writer(spark, root, "mistake")
    side_by_side(lambda t: tables.fold_bronze(spark, root, t), schemas.RECORD_TYPES)
    kept = tables.read_many([tables.read_bronze(spark, root, t).select(*tables.BRONZE_PARTITIONS) for t in schemas.RECORD_TYPES])
    return kept.groupBy(*tables.BRONZE_PARTITIONS).agg(F.count(F.lit(1)).alias("n_rows"))


# --- measures over days -----------------------------------------------------------------------

@query
def q_workload_ratio(spark, sf_dir):
    return rolling.workload_ratio(silver(spark, sf_dir, "workout_log"))


@query
def q_hrv_baseline(spark, sf_dir):
    return rolling.hrv_baseline(silver(spark, sf_dir, "wearable_event"))


@query
def q_session_calories(spark, sf_dir):
    latest = keys.latest_per_key(silver(spark, sf_dir, "user_profile").select("user_id", "timestamp", "weight_kg"))
    sessions = silver_enriched(spark, sf_dir, "workout_log")
    return rolling.session_calories(sessions, latest).select(
        "user_id", "timestamp", "workout_type", "duration_minutes", "met_value", "calories")


@query
def q_unprofiled_rate(spark, sf_dir):
    daily = rolling.unprofiled_rate(silver(spark, sf_dir, "wearable_event"), silver(spark, sf_dir, "user_profile"))
    log = workspace(spark, "unprofiled")
    for run, condition in (("first", FIRST_DROP), ("second", SECOND_DROP)):
        days = daily.filter(condition.replace("day", "date", 1))
        if run == "second":
            days = rolling.against_history(days, spark.read.parquet(log))
        tables.append_audit(days, log, run)
    return spark.read.option("mergeSchema", True).parquet(log).filter("run_id = 'second'").drop("run_id")


# --- streaming --------------------------------------------------------------------------------

@query
def q_stream_two_consumers(spark, sf_dir):
    base = workspace(spark, "consumers")
    message_landing(spark, sf_dir, f"{base}/landing")
    counted = []
    for group in ("archive", "alerts"):
        ingest.ingest_messages(
            ingest.text_stream(spark, f"{base}/landing"), f"{base}/{group}", f"{base}/{group}_memory")
        counted.append(spark.read.parquet(f"{base}/{group}").groupBy("record_type").agg(
            F.count(F.lit(1)).alias(f"n_{group}")))
    return counted[0].join(counted[1], "record_type", "full_outer")


@query
def q_stream_dedup(spark, sf_dir):
    base = workspace(spark, "dedup")
    layout = schemas.stream_schema()
    records = fx.records(spark, sf_dir)
    for drop in (FIRST_DROP, SECOND_DROP, FIRST_DROP):  # the last delivery repeats the first
        records.filter(drop).select(*layout.names).write.mode("append").parquet(f"{base}/landing")
        ingest.append_unique(
            ingest.file_stream(spark, f"{base}/landing", layout), f"{base}/out",
            f"{base}/checkpoint", ("record_type", "user_id", "timestamp"))
    return spark.read.parquet(f"{base}/out").select("record_type", "user_id", "timestamp")


@query
def q_stream_redelivered(spark, sf_dir):
    base = workspace(spark, "redelivered")
    layout = schemas.stream_schema()
    records = fx.records(spark, sf_dir).select(*layout.names)
    for within in ("1 hour", "1 hour", None):  # the last run starts from a new checkpoint, without state
        records.write.mode("append").parquet(f"{base}/landing")
        ingest.append_unique(
            ingest.file_stream(spark, f"{base}/landing", layout), f"{base}/out",
            f"{base}/checkpoint-{within is None}", redelivered=within)
    return spark.read.parquet(f"{base}/out").select("record_type", "user_id", "timestamp")


@query
def q_stream_silver(spark, sf_dir):
    base = workspace(spark, "stream_silver")
    refs = fx.references(spark, sf_dir)
    types = schemas.RECORD_TYPES

    def deliver(t):
        for drop in (FIRST_DROP, SECOND_DROP):
            record_drop(spark, sf_dir, t, drop).write.mode("append").parquet(f"{base}/bronze/{t}")
            silver_stream(ingest.file_stream(spark, f"{base}/bronze/{t}", schemas.BRONZE[t]),
                          f"{base}/silver", t, refs, f"{base}/memory/{t}")

    side_by_side(deliver, types)
    wanted = ("record_type", "user_id", "timestamp", "failure_reason")
    return tables.read_many([
        read(spark, f"{base}/silver", t).select(*wanted)
        for t in types for read in (tables.read_silver, tables.read_quarantine)])


@query
def q_stream_progress(spark, sf_dir):
    base = workspace(spark, "progress")
    message_landing(spark, sf_dir, f"{base}/landing")
    finished = ingest.ingest_messages(
        ingest.text_stream(spark, f"{base}/landing"), f"{base}/bronze", f"{base}/checkpoint")
    seen = ingest.progress(finished)
    held = spark.read.parquet(f"{base}/bronze").agg(F.count(F.lit(1)).alias("rows_held"))
    return held.select(F.lit(seen["rows_read"]).cast("bigint").alias("rows_consumed"), "rows_held")
