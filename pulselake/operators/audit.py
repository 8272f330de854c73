"""Counts and comparisons that explain a run. Each is one aggregation over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions.numbers import percent


def counts_by_type(records: DataFrame) -> DataFrame:
    return records.groupBy("record_type").agg(F.count(F.lit(1)).alias("n_rows"))


def quarantine_rate(judged: DataFrame, by: Sequence[str] = ("record_type",)) -> DataFrame:
    """Silver and quarantine rows and the quarantined share in percent, per group."""
    bad = F.col("failure_reason").isNotNull()
    return (
        judged.groupBy(*by)
        .agg(F.count_if(~bad).alias("silver_rows"), F.count_if(bad).alias("quarantine_rows"))
        .withColumn(
            "pct_quarantined",
            percent(F.col("quarantine_rows"), F.col("silver_rows") + F.col("quarantine_rows")),
        )
    )


def failure_reasons(judged: DataFrame) -> DataFrame:
    """Rows per record type and reason; the null reason counts the valid rows."""
    return judged.groupBy("record_type", "failure_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def dedup_removed(
    records: DataFrame,
    keys: Sequence[str | Column] = ("user_id", "timestamp"),
    by: str = "record_type",
) -> DataFrame:
    """Rows a deduplication on ``keys`` removes, per type."""
    copies = records.groupBy(by, *keys).agg(F.count(F.lit(1)).alias("copies"))
    return copies.groupBy(by).agg(
        F.sum("copies").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.sum(F.col("copies") - 1).alias("rows_removed"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables side by side, one row per table."""
    counted = [
        t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        for n, t in tables.items()
    ]
    whole = counted[0]
    for one in counted[1:]:
        whole = whole.unionByName(one)
    return whole


def scd2_ranges(dim_user: DataFrame, facts: DataFrame) -> DataFrame:
    """Validity and event date ranges in one row, to spot a dimension that misses its facts."""
    versions = dim_user.select("effective_date", "end_date", F.lit(True).alias("is_version"))
    stacked = versions.unionByName(facts.select("event_date"), allowMissingColumns=True)
    return stacked.agg(
        F.min("effective_date").alias("min_effective_date"),
        F.max("effective_date").alias("max_effective_date"),
        F.min("end_date").alias("min_end_date"),
        F.max("end_date").alias("max_end_date"),
        F.count_if(F.col("is_version") & F.col("end_date").isNull()).alias("null_end_date_count"),
        F.min("event_date").alias("min_event_date"),
        F.max("event_date").alias("max_event_date"),
    )


def score_stats(fatigue: DataFrame) -> DataFrame:
    return fatigue.agg(
        F.min("fatigue_score").alias("min_fatigue_score"),
        F.max("fatigue_score").alias("max_fatigue_score"),
        F.count_if("overtraining_flag").alias("flagged_rows"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def reconcile(
    landing: DataFrame, final: DataFrame, keys: Mapping[str, str], values: Sequence[str]
) -> DataFrame:
    """Rows that differ between a landing table and the table loaded from it.

    ``keys`` maps landing to final key columns. A row is missing on one side or differs in one of
    ``values`` under null-safe comparison; equal tables give no rows.
    """
    left = landing.select(
        *[F.col(a).alias(f"_l_{b}") for a, b in keys.items()],
        *[F.col(v).alias(f"landing_{v}") for v in values], F.lit(True).alias("_l"),
    )
    right = final.select(
        *keys.values(), *[F.col(v).alias(f"final_{v}") for v in values], F.lit(True).alias("_r")
    )
    equal = F.lit(True)
    for v in values:
        equal = equal & F.col(f"landing_{v}").eqNullSafe(F.col(f"final_{v}"))
    difference = (
        F.when(F.col("_r").isNull(), "missing_in_final")
        .when(F.col("_l").isNull(), "missing_in_landing")
        .when(~equal, "value_differs")
    )
    same = F.lit(True)
    for k in keys.values():
        same = same & F.col(f"_l_{k}").eqNullSafe(F.col(k))
    found = [F.when(F.col("_l").isNotNull(), F.col(f"_l_{k}")).otherwise(F.col(k)).alias(k) for k in keys.values()]
    rest = [f"landing_{v}" for v in values] + [f"final_{v}" for v in values]
    return (
        left.join(right, same, "full_outer")
        .withColumn("difference", difference)
        .filter(F.col("difference").isNotNull())
        .select(*found, *rest, "difference")
    )
