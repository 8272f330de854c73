"""Date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_dimension(bounds: DataFrame, first: str = "first_date", last: str = "last_date") -> DataFrame:
    """One row per day from ``first`` to ``last`` of a one-row table, with twelve attributes."""
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("full_date"))
    d = F.col("full_date")
    weekday = F.weekday(d)  # 0 = Monday
    return days.select(
        F.date_format(d, "yyyyMMdd").alias("date_id"), "full_date",
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week_of_year"),
        weekday.alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        (weekday >= 5).alias("is_weekend"), F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
    )
