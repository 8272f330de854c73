"""Measures over the last days of each user, and what is watched from day to day.

Frames reach back a number of days. Each user-day is sent to its own period of that length and to the
next, so a frame lies within one (user, period) group and no user is ever sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.functions.numbers import percent, round_half_up
from pulselake.plans.gold import session_load

ACUTE, CHRONIC = 7, 28
MINUTES = 60


def rolling(daily: DataFrame, sums: Mapping[str, tuple[str, int, int]]) -> DataFrame:
    """``daily`` (one row per ``user_id`` and ``date``) with sums of a column over days around each row.

    ``sums`` maps a new name to a column, the first and the last day of its frame, relative to the
    row's own: ``("load", -6, 0)`` is the week that ends with it. No frame may end after its own day.
    """
    length = max(-first for _, first, _ in sums.values()) or 1
    period = F.floor(F.col("_day") / length)
    days = daily.withColumn("_day", F.unix_date("date")).withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False))))
    placed = days.withColumn("_period", F.when(F.col("_own"), period).otherwise(period + 1))
    order = Window.partitionBy("user_id", "_period").orderBy("_day")
    out = placed.withColumns({
        name: F.sum(column).over(order.rangeBetween(first, last)) for name, (column, first, last) in sums.items()
    })
    return out.filter("_own").drop("_day", "_own", "_period")


def workload_ratio(workout: DataFrame) -> DataFrame:
    """Acute to chronic training load: the last week's load against the weekly mean of the last four weeks."""
    keyed = workout.filter(F.col("user_id").isNotNull() & F.col("date").isNotNull())
    daily = keyed.groupBy("user_id", "date").agg(F.coalesce(F.sum(session_load()), F.lit(0)).alias("load"))
    found = rolling(daily, {"acute_load": ("load", 1 - ACUTE, 0), "chronic_load": ("load", 1 - CHRONIC, 0)})
    weekly = F.col("chronic_load").cast("double") / (CHRONIC // ACUTE)
    return found.select(
        "user_id", "date", "acute_load", "chronic_load",
        round_half_up(F.when(weekly > 0, F.col("acute_load") / weekly)).alias("workload_ratio"),
    )


def moments(values: Column, name: str) -> list[Column]:
    """Count, sum and sum of squares: all that mean and deviation need, and they add up."""
    return [F.count(values).alias(f"{name}_n"), F.sum(values).alias(f"{name}_sum"), F.sum(values * values).alias(f"{name}_squares")]


def hrv_baseline(wearable: DataFrame, days: int = CHRONIC) -> DataFrame:
    """Each user-day's mean HRV against the user's own mean and deviation over the ``days`` before."""
    keyed = wearable.filter(F.col("user_id").isNotNull() & F.col("date").isNotNull())
    daily = keyed.groupBy("user_id", "date").agg(*moments(F.col("hrv"), "hrv"))
    names = {f"before_{m}": (f"hrv_{m}", -days, -1) for m in ("n", "sum", "squares")}
    found = rolling(daily, names)
    n = F.coalesce("before_n", F.lit(0))
    mean = F.try_divide("before_sum", n)
    spread = F.sqrt(F.greatest(F.try_divide(F.col("before_squares") - F.col("before_sum") * mean, n - 1), F.lit(0.0)))
    today = F.try_divide("hrv_sum", "hrv_n")
    deviation = F.when(n > 1, spread)
    return found.select(
        "user_id", "date", round_half_up(today).alias("hrv"), n.alias("baseline_readings"),
        round_half_up(mean).alias("baseline_hrv"), round_half_up(deviation).alias("baseline_deviation"),
        round_half_up(F.when(deviation > 1e-6, (today - mean) / deviation)).alias("hrv_z"),
    )


def session_calories(workout: DataFrame, weights: DataFrame) -> DataFrame:
    """Sessions with calories = MET x kilograms x hours; ``weights`` holds ``user_id`` and ``weight_kg`` once per user.

    Without a MET value or a weight the calories are null.
    """
    hours = F.col("duration_minutes").cast("double") / MINUTES
    known = weights.select("user_id", "weight_kg")
    calories = round_half_up(F.col("met_value") * F.col("weight_kg") * hours)
    return workout.join(known, "user_id", "left").select(*workout.columns, calories.alias("calories"))


def unprofiled_rate(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per date the active users and the share of them that has no profile, in percent."""
    known = profiles.select("user_id", F.lit(1).alias("known")).distinct()
    active = events.filter("user_id is not null and date is not null").select("date", "user_id").distinct()
    joined = active.join(known, "user_id", "left")
    return joined.groupBy("date").agg(
        F.count(F.lit(1)).alias("users"), F.count_if(F.col("known").isNull()).alias("unprofiled")
    ).withColumn("pct_unprofiled", percent(F.col("unprofiled"), F.col("users")))


def against_history(daily: DataFrame, history: DataFrame, value: str = "pct_unprofiled", least: int = 7, width: float = 3.0) -> DataFrame:
    """Days of a run beside mean and deviation of the same measure in earlier runs; ``alert`` where it lies
    more than ``width`` deviations above. With fewer than ``least`` days of history nothing is alerted."""
    past = history.agg(*moments(F.col(value), "past"))
    mean = F.try_divide("past_sum", "past_n")
    spread = F.sqrt(F.greatest(F.try_divide(F.col("past_squares") - F.col("past_sum") * mean, F.col("past_n") - 1), F.lit(0.0)))
    usual = F.broadcast(past.select("past_n", mean.alias("past_mean"), spread.alias("past_deviation")))  # one row
    joined = daily.join(usual, F.lit(True), "left")
    over = (F.col("past_n") >= least) & (F.col(value) > F.col("past_mean") + width * F.col("past_deviation"))
    return joined.select(
        *daily.columns, round_half_up(F.col("past_mean")).alias("past_mean"),
        round_half_up(F.col("past_deviation")).alias("past_deviation"), F.coalesce(over, F.lit(False)).alias("alert"),
    )
