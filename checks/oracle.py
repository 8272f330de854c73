"""Independent SQL for every registered query, written by hand against the fixture views."""

from __future__ import annotations

import re

from checks.fixtures import (
    NO_TYPE_EVERY, NOT_BASE64_EVERY, NOT_JSON_EVERY, WRONG_KIND_EVERY, oracle_views,
)

BODY = {
    "wearable": ["heart_rate", "steps", "hrv", "calories_burned", "recovery_score", "stress_score", "device_type"],
    "workout": ["workout_type", "duration_minutes", "rpe", "muscle_groups", "completed", "gym_id"],
    "sleep": ["total_sleep_hours", "deep_sleep_hours", "rem_hours", "awakenings", "sleep_quality_score"],
    "nutrition": ["calories_in", "protein_g", "carbs_g", "fat_g", "hydration_ml"],
    "profile": ["age", "gender", "weight_kg", "height_cm", "medical_history", "job_type", "fitness_goal", "gym_id"],
}
TYPE = {
    "wearable": "wearable_event", "workout": "workout_log", "sleep": "sleep_log",
    "nutrition": "nutrition_snapshot", "profile": "user_profile",
}
CAST = {
    "heart_rate": "int", "steps": "int", "hrv": "double", "recovery_score": "double",
    "duration_minutes": "int", "rpe": "int", "calories_in": "int", "protein_g": "double",
    "carbs_g": "double", "hydration_ml": "double", "age": "int",
}
REASON = {
    "wearable": """case when coalesce(heart_rate, -1) not between 30 and 220 then 'heart_rate_out_of_range'
        when coalesce(hrv, -1) <= 0 then 'hrv_negative_or_zero'
        when coalesce(steps, -1) not between 0 and 50000 then 'steps_out_of_range'
        when coalesce(recovery_score, -1) not between 0 and 100 then 'recovery_score_out_of_range' end""",
    "workout": """case when coalesce(duration_minutes, -1) not between 1 and 300 then 'duration_out_of_range'
        when coalesce(rpe, -1) not between 1 and 10 then 'rpe_out_of_range' end""",
    "sleep": """case when coalesce(total_sleep_hours, -1) not between 0 and 16 then 'total_sleep_out_of_range'
        when coalesce(deep_sleep_hours, -1) > coalesce(total_sleep_hours, -1) then 'deep_sleep_exceeds_total'
        when coalesce(rem_hours, -1) > coalesce(total_sleep_hours, -1) then 'rem_exceeds_total' end""",
    "nutrition": """case when coalesce(calories_in, -1) not between 0 and 10000 then 'calories_out_of_range'
        when coalesce(protein_g, -1) not between 0 and 500 then 'protein_out_of_range'
        when coalesce(hydration_ml, -1) not between 0 and 10000 then 'hydration_out_of_range' end""",
    "profile": """case when coalesce(age, -1) not between 13 and 100 then 'age_out_of_range'
        when coalesce(weight_kg, -1) not between 30 and 250 then 'weight_out_of_range' end""",
}


def rnd(x: str, digits: int = 2) -> str:
    return f"cast(round(cast({x} as decimal(28,10)), {digits}) as double)"


def nulls_first(columns) -> str:
    return ", ".join(f"{c} nulls first" for c in columns)


VIEWS = dict(oracle_views())

for s, body in BODY.items():
    cols = ", ".join(body)
    cast_cols = ", ".join(f"cast({c} as {CAST[c]}) as {c}" if c in CAST else c for c in body)
    # deduplicated: best row per (user, instant); rows without a time only lose exact copies
    VIEWS[f"dd_{s}"] = f"""
        select record_type, user_id, tsp as "timestamp", {cast_cols} from (
            select *, row_number() over (partition by user_id, tsp order by "timestamp" nulls first, {nulls_first(body)}) as rn
            from (select *, try_cast("timestamp" as timestamp) as tsp from fx_{s}) where tsp is not null
        ) where rn = 1
        union all
        select record_type, user_id, cast(null as timestamp), {cast_cols} from (
            select distinct record_type, user_id, "timestamp", {cols} from fx_{s}
            where try_cast("timestamp" as timestamp) is null)"""
    VIEWS[f"jd_{s}"] = f"""
        select *, case when user_id is null or "timestamp" is null then 'bad_key' else {REASON[s]} end as failure_reason
        from dd_{s}"""
    VIEWS[f"sv_{s}"] = f"""
        select *, cast("timestamp" as date) as "date" from jd_{s} where failure_reason is null"""
    # source platform's habits: one row per time text, no key rule
    VIEWS[f"pj_{s}"] = f"""
        select record_type, user_id, try_cast("timestamp" as timestamp) as "timestamp", {cast_cols},
               {REASON[s]} as failure_reason
        from (select *, row_number() over (partition by user_id, "timestamp" order by {nulls_first(body)}) as rn from fx_{s})
        where rn = 1"""

VIEWS["all_jd"] = " union all ".join(
    f'select record_type, user_id, "timestamp", failure_reason is null as is_valid, failure_reason from jd_{s}' for s in BODY)
VIEWS["all_pj"] = " union all ".join(
    f'select record_type, user_id, "timestamp", failure_reason is null as is_valid, failure_reason from pj_{s}' for s in BODY)

for s in ("wearable", "sleep", "nutrition"):
    VIEWS[f"en_{s}"] = f"""
        select e.*, p.job_type, p.fitness_goal, p.gym_id from sv_{s} e left join fx_user_profiles p on p.user_id = e.user_id"""
VIEWS["en_profile"] = """
    select e.*, coalesce(m.risk_modifier, 1.0) as medical_risk_modifier, g.gym_type
    from sv_profile e left join fx_conditions m on m.condition = e.medical_history
    left join fx_gym g on g.gym_id = e.gym_id"""
VIEWS["en_workout"] = """
    select e.*, c.met_value, c.recovery_days_needed from sv_workout e left join fx_catalog c on c.workout_type = e.workout_type"""

VIEWS["w_day"] = 'select user_id, "date", avg(recovery_score) as recovery_score, avg(stress_score) as stress_score, avg(hrv) as hrv from sv_wearable group by 1, 2'
VIEWS["s_day"] = 'select user_id, "date", avg(total_sleep_hours) as total_sleep_hours from sv_sleep group by 1, 2'
VIEWS["l_day"] = 'select user_id, "date", cast(sum(duration_minutes * rpe) as bigint) as training_load_today from sv_workout group by 1, 2'
VIEWS["joined_day"] = """
    select w.*, coalesce(s.total_sleep_hours, 8.0) as total_sleep_hours,
           coalesce(l.training_load_today, 0) as training_load_today
    from w_day w left join s_day s on s.user_id = w.user_id and s."date" = w."date"
    left join l_day l on l.user_id = w.user_id and l."date" = w."date\""""
VIEWS["debt_day"] = """
    select *, case when total_sleep_hours < 8.0 then 8.0 - total_sleep_hours else 0.0 end as sleep_debt_hours from joined_day"""
VIEWS["raw_score"] = f"""
    select *, {rnd('''cast(sleep_debt_hours as double) / 8 * 40 + (100 - recovery_score) / 100 * 35 + stress_score / 100 * 25''')} as score from debt_day"""
VIEWS["g_fatigue"] = f"""
    select user_id, "date", recovery_score, stress_score, hrv, total_sleep_hours, sleep_debt_hours, training_load_today,
           fatigue_score, {rnd("100 - fatigue_score")} as recovery_readiness,
           fatigue_score > 70 and training_load_today > 0 and recovery_score < 40 as overtraining_flag
    from (select *, case when score > 100 then cast(100 as double) when score < 0 then cast(0 as double) else score end as fatigue_score from raw_score)"""

MUSCLES = """list_filter(list_transform(string_split(translate(muscle_groups, '[]''"', ''), ','), lambda x: trim(x)), lambda x: x <> '')"""
VIEWS["muscle_n"] = f"""
    select user_id, muscle_group, count(*) as session_count
    from (select user_id, unnest({MUSCLES}) as muscle_group from sv_workout) group by 1, 2"""
VIEWS["muscle_user"] = """
    select user_id, to_json(list({'muscle_group': muscle_group, 'session_count': session_count} order by muscle_group)) as breakdown
    from muscle_n group by 1"""
VIEWS["g_consistency"] = f"""
    select b.*, m.breakdown as muscle_group_breakdown from (
        select user_id, count(*) as total_sessions, cast(sum(cast(completed as int)) as bigint) as completed_sessions,
               {rnd('avg(rpe)')} as avg_rpe, {rnd('avg(duration_minutes)')} as avg_duration_minutes,
               cast(sum(duration_minutes * rpe) as bigint) as total_training_load,
               {rnd('cast(sum(cast(completed as int)) as double) / count(*) * 100')} as completion_rate_pct
        from sv_workout group by 1) b left join muscle_user m on m.user_id = b.user_id"""

LATEST = nulls_first(["record_type"] + BODY["profile"])
VIEWS["last_profile"] = f"""
    select * exclude (rn) from (select *, row_number() over (partition by user_id order by "timestamp" desc, {LATEST}) as rn from en_profile)
    where rn = 1"""
for s in ("wearable", "sleep", "workout"):
    VIEWS[f"co_{s}"] = f"""
        select e.*, coalesce(p.job_type, 'Unprofiled') as jt, coalesce(p.fitness_goal, 'Unprofiled') as fg
        from sv_{s} e left join last_profile p on p.user_id = e.user_id"""


def cohorts(prefix: str) -> str:
    return f"""
    select w.*, s.avg_sleep_hours, k.avg_training_load, k.avg_completion_rate_pct from (
        select jt as job_type, fg as fitness_goal, {rnd('avg(recovery_score)')} as avg_recovery_score,
               {rnd('avg(stress_score)')} as avg_stress_score, {rnd('avg(hrv)')} as avg_hrv,
               count(distinct user_id) as user_count_wearable from {prefix}_wearable group by 1, 2) w
    left join (select jt as job_type, fg as fitness_goal, {rnd('avg(total_sleep_hours)')} as avg_sleep_hours
               from {prefix}_sleep group by 1, 2) s on s.job_type = w.job_type and s.fitness_goal = w.fitness_goal
    left join (select jt as job_type, fg as fitness_goal, {rnd('avg(duration_minutes * rpe)')} as avg_training_load,
                      {rnd('avg(cast(completed as int)) * 100')} as avg_completion_rate_pct
               from {prefix}_workout group by 1, 2) k on k.job_type = w.job_type and k.fitness_goal = w.fitness_goal"""


VIEWS["g_community"] = cohorts("co")
VIEWS["ce_wearable"] = "select *, job_type as jt, fitness_goal as fg from en_wearable"
VIEWS["ce_sleep"] = "select *, job_type as jt, fitness_goal as fg from en_sleep"
VIEWS["ce_lookup"] = "select distinct user_id, job_type as jt, fitness_goal as fg from en_wearable"
VIEWS["ce_workout"] = "select e.*, l.jt, l.fg from sv_workout e left join ce_lookup l on l.user_id = e.user_id"
VIEWS["g_community_by_event"] = cohorts("ce")


def surrogate(table: str, name: str, key: list[str]) -> str:
    text = ", ".join(f"coalesce(cast({k} as varchar), chr(30))" for k in key)
    digest = f"cast('0x' || substr(md5(concat_ws(chr(31), {text})), 1, 14) as bigint)"
    return f"""
        select digest * 128 + row_number() over (partition by digest order by {nulls_first(key)}) - 1 as {name}, * exclude (digest)
        from (select *, {digest} as digest from {table})"""


ATTRS = "age, gender, weight_kg, medical_history, medical_risk_modifier, job_type, fitness_goal, gym_id, gym_type"
VIEWS["versions"] = f"""
    select user_id, {ATTRS}, "timestamp" as effective_date, lead("timestamp") over (partition by user_id order by "timestamp") as end_date
    from (select *, lag("timestamp") over u as before, lag(job_type) over u as pj, lag(fitness_goal) over u as pf,
                 lag(medical_history) over u as pm from en_profile window u as (partition by user_id order by "timestamp"))
    where before is null or pj is distinct from job_type or pf is distinct from fitness_goal or pm is distinct from medical_history"""
VIEWS["dated_versions"] = "select *, end_date is null as is_current from versions"
VIEWS["dim_user"] = surrogate("dated_versions", "user_sk", ["user_id", "effective_date"])
VIEWS["stg_dim"] = """
    select *, case when row_number() over (partition by user_id order by effective_date) = 1
                   then timestamp '1900-01-01 00:00:00' else effective_date end as effective_date_for_join from dim_user"""
VIEWS["day_fact"] = 'select "date" as event_date, * exclude ("date") from g_fatigue'
VIEWS["f_fatigue"] = surrogate("day_fact", "fact_id", ["user_id", "event_date"])
VIEWS["f_consistency"] = surrogate("g_consistency", "fact_id", ["user_id"])
VIEWS["f_community"] = surrogate("g_community", "fact_id", ["job_type", "fitness_goal"])
VIEWS["m_health"] = f"""
    select f.fact_id, f.user_id, f.event_date, u.user_sk, {', '.join('u.' + a for a in ATTRS.split(', '))},
           f.recovery_score, f.stress_score, f.hrv, f.total_sleep_hours, f.sleep_debt_hours, f.training_load_today,
           f.fatigue_score, f.recovery_readiness, f.overtraining_flag,
           f.fatigue_score * coalesce(u.medical_risk_modifier, 1.0) as risk_adjusted_fatigue_score
    from f_fatigue f join stg_dim u on u.user_id = f.user_id and f.event_date >= u.effective_date_for_join
         and f.event_date < coalesce(u.end_date, date '9999-12-31')"""
VIEWS["m_coach"] = """
    select f.fact_id, f.user_id, u.gym_id, u.gym_type, u.fitness_goal, u.job_type, f.total_sessions, f.completed_sessions,
           f.avg_rpe, f.avg_duration_minutes, f.total_training_load, f.completion_rate_pct, f.muscle_group_breakdown
    from f_consistency f left join (select * from stg_dim where is_current) u on u.user_id = f.user_id"""
VIEWS["m_community"] = """
    select *, case when avg_recovery_score >= 70 then 'high_readiness' when avg_recovery_score >= 40 then 'moderate_readiness'
                   else 'low_readiness' end as cohort_readiness_label from f_community"""

# all records side by side, and what the stream makes of them
STREAM = list(dict.fromkeys(c for body in BODY.values() for c in body))
VIEWS["fx_all"] = " union all ".join(
    f"select id, '{TYPE[s]}' as record_type, user_id, \"timestamp\", "
    + ", ".join(c if c in body else f"null as {c}" for c in STREAM) + f" from fx_{s}"
    for s, body in BODY.items())
VIEWS["decoded"] = f"""
    select * replace (case when id % {NO_TYPE_EVERY} = 0 then 'unknown' else record_type end as record_type),
           case when id % {NOT_BASE64_EVERY} = 0 then 'undecodable' when id % {NOT_JSON_EVERY} = 0 then 'invalid_json'
                when id % {WRONG_KIND_EVERY} = 0 then 'schema_mismatch' end as reject_reason
    from fx_all"""
VIEWS["bronze_types"] = "select case when reject_reason is null then record_type else 'rejected' end as record_type from decoded"
TS = 'cast("timestamp" as varchar) as "timestamp"'
PARTS = """strftime(try_cast("timestamp" as timestamp), '%Y') as "year", strftime(try_cast("timestamp" as timestamp), '%m') as "month",
           strftime(try_cast("timestamp" as timestamp), '%d') as "day\""""

DAY6 = ", ".join(f"{rnd(c, 6)} as {c}" for c in
                 ("recovery_score", "stress_score", "hrv", "total_sleep_hours", "sleep_debt_hours"))
ROUND5 = f"* replace ({DAY6})"

# merges: state after the first delivery, and the newest rows of the second
STATE = ["timestamp", "job_type", "fitness_goal", "weight_kg"]


def newest(condition: str) -> str:
    return f"""
        select * exclude (rn) from (select user_id, "timestamp", job_type, fitness_goal, weight_kg, gym_id,
            row_number() over (partition by user_id order by "timestamp" desc) as rn from sv_profile where {condition}) where rn = 1"""


VIEWS["load_one"] = newest("\"date\" <= date '2024-01-20'")
VIEWS["load_two"] = newest("\"date\" >= date '2024-01-16'")
VIEWS["merged"] = """
    select coalesce(t.user_id, s.user_id) as user_id, s.user_id is not null as has_s, t.user_id is not null as has_t,
           t."timestamp" as t_ts, s."timestamp" as s_ts, t.job_type as t_job, s.job_type as s_job,
           t.fitness_goal as t_goal, s.fitness_goal as s_goal, t.weight_kg as t_kg, s.weight_kg as s_kg, s.gym_id as s_gym
    from load_one t full outer join load_two s on s.user_id = t.user_id"""
VIEWS["nn"] = " union all ".join(
    f"select 'not_null {label}.{c}' as check_name, count(*) filter (where {c} is null) as violations from {view}"
    for label, view, cols in (
        ("stg_dim_user", "stg_dim", ["user_sk", "user_id", "is_current", "effective_date_for_join"]),
        ("stg_fact_fatigue_recovery", "f_fatigue", ["fact_id", "user_id", "fatigue_score", "recovery_readiness"]),
        ("stg_fact_workout_consistency", "f_consistency", ["fact_id", "user_id", "completion_rate_pct"]),
        ("stg_fact_community_analytics", "f_community", ["fact_id"]),
        ("mart_user_health_score", "m_health", ["fact_id", "user_id", "fatigue_score", "risk_adjusted_fatigue_score"]),
        ("mart_coach_dashboard", "m_coach", ["fact_id", "user_id", "completion_rate_pct"]),
        ("mart_community_analytics", "m_community", ["fact_id"]),
    ) for c in cols)
VIEWS["uq"] = " union all ".join(
    f"select 'unique {label}.{c}' as check_name, (select count(*) from (select {c} from {view} group by 1 having count(*) > 1)) as violations"
    for label, view, c in (
        ("stg_dim_user", "stg_dim", "user_sk"), ("stg_fact_fatigue_recovery", "f_fatigue", "fact_id"),
        ("stg_fact_workout_consistency", "f_consistency", "fact_id"), ("stg_fact_community_analytics", "f_community", "fact_id"),
        ("mart_user_health_score", "m_health", "fact_id"), ("mart_coach_dashboard", "m_coach", "fact_id"),
        ("mart_community_analytics", "m_community", "fact_id")))
VIEWS["orphan"] = " union all ".join(
    f"select '{label}' as table_name, user_id, fact_id from {view} where user_id is not null and user_id not in (select user_id from stg_dim)"
    for label, view in (("stg_fact_fatigue_recovery", "f_fatigue"), ("stg_fact_workout_consistency", "f_consistency")))


def per_type(select: str) -> str:
    return " union all ".join(select.format(s=s, t=TYPE[s]) for s in BODY)


def shown(s: str, view: str, extra: str) -> str:
    return f'select record_type, user_id, {TS}, {", ".join(BODY[s])}, {extra} from {view}'


ORACLE: dict[str, str] = {
    "q_reference_csv": "select * from fx_user_profiles",
    "q_stream_incremental": 'select record_type, user_id, "timestamp", true as audited from fx_all',
    "q_stream_demux": "select case when reject_reason is null then record_type else 'rejected' end as record_type, reject_reason, "
        + ", ".join(f'case when reject_reason is null then {c} end as {c}' for c in ["user_id", '"timestamp"'] + STREAM) + " from decoded",
    "q_bronze_write": f"select record_type, \"year\", \"month\", \"day\", count(*) as n_rows from (select record_type, {PARTS} from fx_all) group by all",
    "q_silver_write": per_type('select record_type, cast("date" as varchar) as "date", count(*) as n_rows from sv_{s} group by 1, 2'),
    "q_quarantine_write": f'select record_type, user_id, {TS}, failure_reason, cast(cast("timestamp" as date) as varchar) as "date" from all_jd where not is_valid',
    "q_gold_write": f'select * exclude (hrv) replace (cast("date" as varchar) as "date", {", ".join(f"{rnd(c, 6)} as {c}" for c in ("recovery_score", "stress_score", "total_sleep_hours", "sleep_debt_hours"))}) from g_fatigue',
    "q_quarantine_audit_log": """select run_id, failure_reason, count(*) as n_rows from jd_profile, (values ('run-1'), ('run-2')) r(run_id)
        where failure_reason is not null group by 1, 2""",
    "q_merge_upsert": """select user_id, cast(case when has_s then s_ts else t_ts end as varchar) as "timestamp",
        case when has_s then s_job else t_job end as job_type, case when has_s then s_goal else t_goal end as fitness_goal,
        case when has_s then s_kg else t_kg end as weight_kg from merged""",
    "q_merge_schema_evolution": """select user_id, cast(case when has_s then s_ts else t_ts end as varchar) as "timestamp",
        case when has_s then s_job else t_job end as job_type, case when has_s then s_goal else t_goal end as fitness_goal,
        t_kg as weight_kg, s_gym as gym_id,
        case when not has_t then 'inserted' when not has_s then 'kept'
             when t_ts = s_ts and t_job = s_job and t_goal = s_goal and s_gym is null then 'unchanged' else 'updated' end as merge_action
        from merged""",
    "q_merge_metrics": """select count(*) filter (where not has_t) as rows_inserted,
        count(*) filter (where has_s and has_t and not (t_ts = s_ts and t_job = s_job and t_goal = s_goal and t_kg = s_kg)) as rows_updated,
        count(*) filter (where has_s and has_t and t_ts = s_ts and t_job = s_job and t_goal = s_goal and t_kg = s_kg) as rows_unchanged,
        count(*) filter (where not has_s) as rows_kept from merged""",
    "q_fact_load": f"select {ROUND5[:-1]}, cast(event_date as varchar) as event_date) from f_fatigue",
    "q_union_by_name": """select user_id, "timestamp", gym_id, rpe, cast(null as bigint) as age from fx_workout
        union all select user_id, "timestamp", gym_id, null, age from fx_profile""",
    "q_decode_payload": f'select id, record_type, user_id, "timestamp", {", ".join(STREAM)} from decoded where reject_reason is null',
    "q_envelope_decode": f'select id, record_type, user_id, "timestamp", {", ".join(STREAM)} from decoded where reject_reason is null',
    "q_decode_errors": "select reject_reason, count(*) as n_rows from decoded where reject_reason is not null group by 1",
    "q_ingest_summary": """select record_type, count(*) as n_rows from decoded where reject_reason is null group by 1
        union all select 'total', count(*) from decoded where reject_reason is null""",
    "q_schema_enforce": "select id, reject_reason, true as text_kept from decoded where reject_reason = 'schema_mismatch'",
    "q_parse_array_pylist": """select user_id, "timestamp",
        case when json_valid(replace(muscle_groups, '''', '"'))
             then array_to_string(from_json(replace(muscle_groups, '''', '"'), '["varchar"]'), '|') end as muscles from fx_workout""",
    "q_parse_array_bracket": """select user_id, "timestamp", array_to_string(m, '|') as muscles, len(m) as n_muscles
        from (select *, string_split(translate(muscle_groups, '[]', ''), ', ') as m from fx_workout)""",
    "q_parse_groups": f"""select user_id, "timestamp", array_to_string(m, '|') as muscles, len(m) as n_muscles
        from (select *, {MUSCLES} as m from fx_workout)""",
    "q_type_coverage": f"""select user_id, record_type from (select distinct user_id from fx_all),
        (values {', '.join(f"('{t}')" for t in TYPE.values())}) t(record_type) except select user_id, record_type from fx_all""",
    "q_replay_equals_batch": "select record_type, count(*) as n_live, count(*) as n_replayed, cast(0 as bigint) as n_different from bronze_types group by 1",
    "q_schema_drift": """select user_id, cast(tsp as varchar) as "timestamp", cast(heart_rate as int) as heart_rate, cast(null as double) as hrv,
        cast(null as double) as recovery_score,
        case when tsp is null then 'bad_key' when coalesce(heart_rate, -1) not between 30 and 220 then 'heart_rate_out_of_range'
             else 'hrv_negative_or_zero' end as failure_reason
        from (select *, row_number() over (partition by user_id, tsp, case when tsp is null then own end
                     order by heart_rate nulls first, steps nulls first, calories_burned, stress_score nulls first, device_type) as rn
              from (select *, try_cast("timestamp" as timestamp) as tsp,
                           concat_ws('|', coalesce(cast(heart_rate as varchar), '-'), steps, calories_burned,
                                     coalesce(cast(stress_score as varchar), '-'), device_type) as own from fx_wearable)) where rn = 1""",
    "q_sentinel_fill": """select record_type, user_id, cast(try_cast("timestamp" as timestamp) as varchar) as "timestamp",
        cast(coalesce(calories_in, -1) as int) as calories_in, cast(coalesce(protein_g, -1) as double) as protein_g,
        cast(coalesce(carbs_g, -1) as double) as carbs_g, fat_g, cast(coalesce(hydration_ml, -1) as double) as hydration_ml from fx_nutrition""",
    **{f"q_validate_{s}": shown(s, f"jd_{s}", "failure_reason is null as is_valid, failure_reason") for s in BODY},
    "q_validate_parity": f"select record_type, user_id, {TS}, is_valid, failure_reason from all_pj",
    "q_validate_unknown_type": """select id, user_id, "timestamp", true as is_valid, cast(null as varchar) as failure_reason
        from decoded where reject_reason is null and record_type = 'unknown'""",
    "q_split_silver": f"select record_type, user_id, {TS}, failure_reason from all_jd where is_valid",
    "q_split_quarantine": f"select record_type, user_id, {TS}, failure_reason from all_jd where not is_valid",
    "q_enrich_events": " union all ".join(
        f"select record_type, user_id, {TS}, job_type, fitness_goal, gym_id from en_{s}" for s in ("wearable", "sleep", "nutrition")),
    "q_enrich_profile": f"select user_id, {TS}, medical_history, medical_risk_modifier, gym_id, gym_type from en_profile",
    "q_enrich_workout": f"select user_id, {TS}, workout_type, met_value, recovery_days_needed from en_workout",
    "q_stg_facts": """select 'fatigue' as fact, fact_id, user_id, cast(event_date as varchar) as event_date, fatigue_score,
               cast(null as double) as completion_rate_pct, cast(null as varchar) as job_type, cast(null as varchar) as fitness_goal from f_fatigue
        union all select 'consistency', fact_id, user_id, null, null, completion_rate_pct, null, null from f_consistency
        union all select 'community', fact_id, null, null, null, null, job_type, fitness_goal from f_community""",
    "q_wearable_daily": f"""select user_id, cast("date" as varchar) as "date", {rnd('recovery_score', 6)} as recovery_score,
        {rnd('stress_score', 6)} as stress_score, {rnd('hrv', 6)} as hrv from w_day""",
    "q_sleep_daily": f'select user_id, cast("date" as varchar) as "date", {rnd("total_sleep_hours", 6)} as total_sleep_hours from s_day',
    "q_training_load_daily": 'select user_id, cast("date" as varchar) as "date", training_load_today from l_day',
    "q_muscle_counts": "select * from muscle_n",
    "q_gold_fatigue": f'select {ROUND5[:-1]}, cast("date" as varchar) as "date") from g_fatigue',
    "q_gold_consistency": "select * replace (cast(muscle_group_breakdown as varchar) as muscle_group_breakdown) from g_consistency",
    "q_gold_community": "select * from g_community",
    "q_gold_community_by_event": "select * from g_community_by_event",
    "q_gold_profile": f"select user_id, {ATTRS} from last_profile",
    "q_overtraining_flagged": f'select * exclude (hrv) replace (cast("date" as varchar) as "date", {", ".join(f"{rnd(c, 6)} as {c}" for c in ("recovery_score", "stress_score", "total_sleep_hours", "sleep_debt_hours"))}) from g_fatigue where overtraining_flag',
    "q_unprofiled_users": "select count(distinct user_id) as unprofiled_users from sv_wearable where user_id not in (select user_id from sv_profile)",
    "q_quarantine_rate": f"""select record_type, count(*) filter (where is_valid) as silver_rows, count(*) filter (where not is_valid) as quarantine_rows,
        {rnd('cast(count(*) filter (where not is_valid) as double) / count(*) * 100')} as pct_quarantined from all_jd group by 1""",
    "q_failure_reasons": "select record_type, failure_reason, count(*) as n_rows from all_jd group by 1, 2",
    "q_gold_fatigue_stats": """select min(fatigue_score) as min_fatigue_score, max(fatigue_score) as max_fatigue_score,
        count(*) filter (where overtraining_flag) as flagged_rows, count(*) as n_rows from g_fatigue""",
    "q_table_counts": per_type("select 'bronze_{s}' as table_name, count(*) as n_rows from fx_{s} union all select 'silver_{s}', count(*) from sv_{s}"),
    "q_dedup_removed": """select record_type, count(*) as rows_before, count(distinct user_id || '/' || "timestamp") as rows_after,
        count(*) - count(distinct user_id || '/' || "timestamp") as rows_removed from fx_all group by 1""",
    "q_latest_profile": f"""select record_type, user_id, {TS}, {", ".join(BODY["profile"])}, failure_reason, cast("date" as varchar) as "date"
        from (select *, row_number() over (partition by user_id order by "timestamp" desc) as rn from sv_profile) where rn = 1""",
    "q_stg_dim_user": """select * replace (cast(effective_date as varchar) as effective_date, cast(end_date as varchar) as end_date,
        cast(effective_date_for_join as varchar) as effective_date_for_join) from stg_dim""",
    "q_dim_user_scd2": "select * replace (cast(effective_date as varchar) as effective_date, cast(end_date as varchar) as end_date) from dim_user",
    "q_top_fatigue": """select user_id, cast("date" as varchar) as "date", fatigue_score, recovery_readiness, overtraining_flag
        from (select * from g_fatigue order by fatigue_score desc nulls last, user_id, "date" limit 10)""",
    "q_sample_dim": """select user_id, cast(effective_date as varchar) as effective_date, cast(end_date as varchar) as end_date, is_current
        from (select * from dim_user order by user_id, effective_date limit 5)""",
    "q_sample_fact": "select user_id, cast(event_date as varchar) as event_date from (select * from f_fatigue order by user_id, event_date limit 5)",
    "q_user_bmi": f"""select *, case when bmi < 18.5 then 'underweight' when bmi < 25 then 'normal' when bmi < 30 then 'overweight'
        when bmi is not null then 'obese' end as bmi_category from (
        select user_id, {TS}, weight_kg, height_cm,
               {rnd('weight_kg / ((cast(height_cm as double) / 100) * (cast(height_cm as double) / 100))', 1)} as bmi from sv_profile)""",
    "q_date_dimension": """select strftime(d, '%Y%m%d') as date_id, cast(cast(d as date) as varchar) as full_date, cast(year(d) as int) as "year",
        cast(quarter(d) as int) as quarter, cast(month(d) as int) as "month", monthname(d) as month_name, cast(weekofyear(d) as int) as week_of_year,
        cast(isodow(d) - 1 as int) as day_of_week, dayname(d) as day_name, isodow(d) >= 6 as is_weekend,
        cast(dayofmonth(d) as int) as day_of_month, cast(dayofyear(d) as int) as day_of_year
        from (select unnest(generate_series(date_trunc('year', min(ts)), date_trunc('year', max(ts)) + interval 1 year - interval 1 day, interval 1 day)) as d from events)""",
    "q_mart_health_score": f"select {ROUND5[:-1]}, cast(event_date as varchar) as event_date) from m_health",
    "q_mart_health_score_unmatched": """select f.user_id, cast(f.event_date as varchar) as event_date, u.job_type, f.fatigue_score,
        f.fatigue_score * coalesce(u.medical_risk_modifier, 1.0) as risk_adjusted_fatigue_score
        from f_fatigue f left join stg_dim u on u.user_id = f.user_id and f.event_date >= u.effective_date_for_join
             and f.event_date < coalesce(u.end_date, date '9999-12-31')""",
    "q_mart_coach": "select * replace (cast(muscle_group_breakdown as varchar) as muscle_group_breakdown) from m_coach",
    "q_mart_community": "select * from m_community",
    "q_reconcile": """select user_id, cast("date" as varchar) as event_date, fatigue_score as landing_fatigue_score,
        overtraining_flag as landing_overtraining_flag, case when day("date") = 20 then fatigue_score + 1 end as final_fatigue_score,
        case when day("date") = 20 then overtraining_flag end as final_overtraining_flag,
        case when day("date") = 10 then 'missing_in_final' else 'value_differs' end as difference
        from g_fatigue where "date" = date '2024-01-10' or (day("date") = 20 and fatigue_score is not null)""",
    "q_profile_scd2_ranges": """select cast(min(effective_date) as varchar) as min_effective_date, cast(max(effective_date) as varchar) as max_effective_date,
        cast(min(end_date) as varchar) as min_end_date, cast(max(end_date) as varchar) as max_end_date,
        count(*) filter (where end_date is null) as null_end_date_count,
        (select cast(min("date") as varchar) from g_fatigue) as min_event_date, (select cast(max("date") as varchar) from g_fatigue) as max_event_date
        from dim_user""",
    "q_dq_not_null": "select * from nn",
    "q_dq_unique": "select * from uq",
    "q_dq_relationships": "select * from orphan",
    "q_dq_completion_range": "select 'completion_rate_in_range' as check_name, count(*) as violations from m_coach where completion_rate_pct < 0 or completion_rate_pct > 100",
    "q_dq_fatigue_nonneg": "select 'fatigue_score_non_negative' as check_name, count(*) as violations from m_health where fatigue_score < 0 or risk_adjusted_fatigue_score < 0",
    "q_dq_no_dropped_rows": """select * from (select (select count(*) from f_fatigue) as raw_fact_rows, (select count(*) from m_health) as mart_rows)
        where raw_fact_rows <> mart_rows""",
    "q_dq_conservation": """select record_type, silver_rows, quarantine_rows, rows_after, silver_rows + quarantine_rows = rows_after as conserved from (
        select record_type, count(*) filter (where is_valid) as silver_rows, count(*) filter (where not is_valid) as quarantine_rows from all_pj group by 1)
        join (select record_type, count(distinct user_id || '/' || "timestamp") as rows_after from fx_all group by 1) using (record_type)""",
    "q_dq_grain": """select *, table_rows = anchor_keys as passes from (
        select 'gold_fatigue_recovery' as table_name, (select count(*) from g_fatigue) as table_rows,
               (select count(*) from (select distinct user_id, "date" from sv_wearable)) as anchor_keys
        union all select 'gold_workout_consistency', (select count(*) from g_consistency), (select count(distinct user_id) from sv_workout)
        union all select 'gold_community_analytics', (select count(*) from g_community), (select count(*) from (select distinct jt, fg from co_wearable))
        union all select 'gold_user_profile_enriched', (select count(*) from last_profile), (select count(distinct user_id) from sv_profile))""",
    "q_dq_suite": """select * from nn union all select * from uq
        union all select 'relationships ' || t || '.user_id', (select count(*) from orphan where table_name = t)
            from (values ('stg_fact_fatigue_recovery'), ('stg_fact_workout_consistency')) v(t)
        union all select 'accepted_values mart_community_analytics.cohort_readiness_label', 0
        union all select 'completion_rate_in_range', (select count(*) from m_coach where completion_rate_pct < 0 or completion_rate_pct > 100)
        union all select 'fatigue_score_non_negative', (select count(*) from m_health where fatigue_score < 0 or risk_adjusted_fatigue_score < 0)
        union all select 'health_score_no_dropped_rows', (select cast((select count(*) from f_fatigue) <> (select count(*) from m_health) as bigint))""",
    "q_silver_summary": """select record_type, 'success' as status, count(*) filter (where is_valid) as silver_rows,
        count(*) filter (where not is_valid) as quarantine_rows from all_jd group by 1""",
    "q_gold_summary": """select 'gold_fatigue_recovery' as table_name, 'success' as status, (select count(*) from g_fatigue) as n_rows
        union all select 'gold_workout_consistency', 'success', (select count(*) from g_consistency)
        union all select 'gold_community_analytics', 'success', (select count(*) from g_community)
        union all select 'gold_user_profile_enriched', 'success', (select count(*) from last_profile)""",
    "q_stream_two_consumers": "select record_type, count(*) as n_archive, count(*) as n_alerts from bronze_types group by 1",
    "q_stream_dedup": '''select distinct record_type, user_id, "timestamp" from fx_all where user_id is not null and try_cast("timestamp" as timestamp) is not null
        union all select record_type, user_id, "timestamp" from (select distinct * from fx_all where user_id is null or try_cast("timestamp" as timestamp) is null)''',
    "q_stream_silver": f"select record_type, user_id, {TS}, failure_reason from all_jd",
    "q_stream_progress": "select count(*) as rows_consumed, count(*) as rows_held from fx_all",
}


ORACLE |= {
    "q_stream_redelivered": ORACLE["q_stream_dedup"],
    "q_merge_buckets": ORACLE["q_merge_upsert"],
    "q_scan_bronze": " union all by name ".join(f'select record_type, user_id, "timestamp", {", ".join(BODY[s])}, {PARTS} from fx_{s}' for s in BODY),
    "q_scan_silver": " union all by name ".join(shown(s, f"en_{s}", "* exclude (record_type, user_id, \"timestamp\", \"date\", " + ", ".join(BODY[s])
        + '), cast("date" as varchar) as "date"') for s in BODY),
    "q_append_idempotent": " union all by name ".join(
        shown(s, f"sv_{s}", 'cast("date" as varchar) as "date"') for s in BODY if s != "profile"),
    "q_cast_schema": " union all by name ".join(
        f'select record_type, user_id, cast(try_cast("timestamp" as timestamp) as varchar) as "timestamp", '
        + ", ".join(f"cast({c} as {CAST[c]}) as {c}" if c in CAST else c for c in BODY[s]) + f" from fx_{s}" for s in BODY),
    "q_dedup_events": " union all by name ".join(f"""select record_type, user_id, "timestamp", {", ".join(BODY[s])} from (
        select *, row_number() over (partition by user_id, "timestamp" order by {nulls_first(BODY[s])}) as rn from fx_{s}) where rn = 1""" for s in BODY),
    "q_audit_union": " union all ".join(f"""select record_type, user_id, {TS}, {sleep} as total_sleep_hours, failure_reason, job_type, fitness_goal, gym_id from en_{s}
        union all select record_type, user_id, {TS}, {sleep}, failure_reason, null, null, null from jd_{s} where failure_reason is not null"""
        for s, sleep in (("wearable", "cast(null as double)"), ("sleep", "total_sleep_hours"), ("nutrition", "cast(null as double)"))),
    "q_dq_accepted_values": """select job_type, fitness_goal, 'no_' || cohort_readiness_label as cohort_readiness_label from m_community
        where job_type = 'mixed' and cohort_readiness_label is not null""",
    "q_dq_conservation_written": """select *, silver_rows + quarantine_rows = rows_after as conserved from (
        select record_type, count(*) filter (where is_valid) as silver_rows, count(*) filter (where not is_valid) as quarantine_rows,
               count(*) as rows_after from all_jd group by 1)""",
    "q_read_files": ORACLE["q_union_by_name"],
    "q_catalog_marts": " union all ".join(f"select '{name}' as table_name, count(*) as n_rows from {view}" for name, view in (
        ("stg_dim_user", "stg_dim"), ("stg_fact_fatigue_recovery", "f_fatigue"), ("stg_fact_workout_consistency", "f_consistency"),
        ("stg_fact_community_analytics", "f_community"), ("mart_user_health_score", "m_health"), ("mart_coach_dashboard", "m_coach"),
        ("mart_community_analytics", "m_community"))),
    "q_reference_tables": """select 'user_profiles' as table_name, user_id as "key", job_type as label, weight_kg as number from fx_user_profiles
        union all select 'gym_master', gym_id, gym_type, null from fx_gym
        union all select 'workout_catalog', workout_type, category, met_value from fx_catalog
        union all select 'medical_conditions', condition, null, risk_modifier from fx_conditions
        union all select 'date_dimension', strftime(d, '%Y%m%d'), dayname(d), cast(dayofyear(d) as double) from (
            select unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day)) as d from events)""",
    "q_reconcile_profiles": """select coalesce(l.user_id, f.user_id) as user_id, cast(coalesce(l."timestamp", f.effective_date) as varchar) as effective_date,
        l.job_type as landing_job_type, l.fitness_goal as landing_fitness_goal, f.job_type as final_job_type, f.fitness_goal as final_fitness_goal,
        case when f.user_id is null then 'missing_in_final' when l.user_id is null then 'missing_in_landing' else 'value_differs' end as difference
        from sv_profile l full outer join dim_user f on f.user_id = l.user_id and f.effective_date = l."timestamp"
        where f.user_id is null or l.user_id is null or l.job_type is distinct from f.job_type or l.fitness_goal is distinct from f.fitness_goal""",
    "q_gold_incremental": ORACLE["q_gold_fatigue"],
    "q_gold_incremental_consistency": ORACLE["q_gold_consistency"],
    "q_gold_incremental_community": ORACLE["q_gold_community"],
    "q_bronze_fold": ORACLE["q_bronze_write"],
    "q_workload_ratio": f"""select user_id, cast(d as varchar) as "date", cast(acute as bigint) as acute_load, cast(chronic as bigint) as chronic_load,
        {rnd('case when chronic > 0 then acute / (cast(chronic as double) / 4) end')} as workload_ratio from (
        select user_id, d, sum(load) over (partition by user_id order by n range between 6 preceding and current row) as acute,
               sum(load) over (partition by user_id order by n range between 27 preceding and current row) as chronic
        from (select user_id, "date" as d, datediff('day', date '1970-01-01', "date") as n, sum(coalesce(duration_minutes * rpe, 0)) as load
              from sv_workout group by 1, 2, 3))""",
    "q_hrv_baseline": f"""select user_id, cast(d as varchar) as "date", {rnd('hrv')} as hrv, cast(coalesce(bn, 0) as bigint) as baseline_readings,
        {rnd('bs / bn')} as baseline_hrv, {rnd('case when bn > 1 then dev end')} as baseline_deviation,
        {rnd('case when bn > 1 and dev > 1e-6 then (hrv - bs / bn) / dev end')} as hrv_z from (
        select *, sqrt(greatest((bq - bs * (bs / bn)) / nullif(bn - 1, 0), 0.0)) as dev from (
        select user_id, d, s / nullif(c, 0) as hrv,
               sum(c) over w as bn, sum(s) over w as bs, sum(q) over w as bq
        from (select user_id, "date" as d, datediff('day', date '1970-01-01', "date") as n, count(hrv) as c, sum(hrv) as s, sum(hrv * hrv) as q
              from sv_wearable group by 1, 2, 3)
        window w as (partition by user_id order by n range between 28 preceding and 1 preceding)))""",
    "q_session_calories": f"""select w.user_id, cast(w."timestamp" as varchar) as "timestamp", w.workout_type, w.duration_minutes, c.met_value,
        {rnd('c.met_value * p.weight_kg * (cast(w.duration_minutes as double) / 60)')} as calories
        from sv_workout w left join fx_catalog c using (workout_type)
        left join (select user_id, weight_kg from (select *, row_number() over (partition by user_id order by "timestamp" desc, weight_kg nulls first) as rn
                   from sv_profile) where rn = 1) p on p.user_id = w.user_id""",
    "q_unprofiled_rate": f"""select * from (with a as (select distinct "date" as d, user_id from sv_wearable where "date" is not null and user_id is not null),
        r as (select d, count(*) as users, count(*) filter (where user_id not in (select user_id from sv_profile)) as unprofiled from a group by 1),
        t as (select *, {rnd('cast(unprofiled as double) / users * 100')} as pct from r),
        h as (select count(pct) as n, sum(pct) / count(pct) as m, stddev_samp(pct) as dev from t where d <= date '2024-01-20')
        select cast(d as varchar) as "date", users, unprofiled, pct as pct_unprofiled, {rnd('m')} as past_mean, {rnd('dev')} as past_deviation,
               coalesce(n >= 7 and pct > m + 3 * dev, false) as alert from t, h where d > date '2024-01-20')""",
}

def statement(body: str) -> str:
    """The query with just the views it needs, directly or indirectly, as common table expressions."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for word in set(re.findall(r"\b\w+\b", sql)):
            if word in VIEWS and word not in needed:
                needed.add(word)
                visit(VIEWS[word])

    visit(body)
    ctes = ",\n".join(f"{n} as ({sql})" for n, sql in VIEWS.items() if n in needed)
    return f"with {ctes}\n{body}" if ctes else body
