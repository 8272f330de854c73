"""Data-quality expectations. Each returns the violating rows or one count; empty or 0 passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTS = ("check_name", "violations")


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Nulls per column that must not be null: all columns of a table in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], list(columns), "column", "violations").select(
        F.concat(F.lit(f"not_null {table}."), "column").alias("check_name"), "violations"
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def duplicate_count(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    counted = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations"))
    return counted.select(F.lit(f"unique {table}.{','.join(keys)}").alias("check_name"), "violations")


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Rows whose value is not accepted; a null is not judged."""
    return df.filter(~F.col(column).isin(*accepted))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null ``column`` has no parent row."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def outside_range(df: DataFrame, column: str, low: float, high: float | None = None) -> DataFrame:
    wrong = F.col(column) < low
    return df.filter(wrong | (F.col(column) > high) if high is not None else wrong)


def counts_side_by_side(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Row counts of two tables in one row, from one aggregation over both."""
    side = [t.select(F.lit(i).alias("side")) for i, t in enumerate((left, right))]
    return side[0].union(side[1]).agg(
        *[F.count_if(F.col("side") == i).alias(n) for i, n in enumerate(names)]
    )


def differing_counts(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """One row with both row counts if they differ, no row if they agree."""
    return counts_side_by_side(left, right, names).filter(F.col(names[0]) != F.col(names[1]))


def grain(df: DataFrame, anchor: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Row count of a table next to the distinct keys of the table it is anchored on."""
    counts = counts_side_by_side(df, anchor.select(*keys).distinct(), ("table_rows", "anchor_keys"))
    return counts.select(
        F.lit(name).alias("table_name"), "table_rows", "anchor_keys",
        (F.col("table_rows") == F.col("anchor_keys")).alias("passes"),
    )


def missing_types(
    expected: DataFrame, present: DataFrame, keys: Sequence[str] = ("record_type",)
) -> DataFrame:
    """Expected record types, overall or per further key, without any row."""
    return expected.select(*keys).distinct().exceptAll(present.select(*keys).distinct())


def count_of(violating: DataFrame, name: str) -> DataFrame:
    counted = violating.agg(F.count(F.lit(1)).alias("violations"))
    return counted.select(F.lit(name).alias("check_name"), "violations")
