"""One row per key: retry deduplication, latest state, surrogate keys.

Every ``row_number() = 1`` here is planned by Spark with a partial ``WindowGroupLimit`` below the
exchange: each map task keeps one row per key, so a key that holds most of the input still ships
at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def total_order(columns: Sequence[str]) -> list[Column]:
    """Ascending order over whole rows, so the surviving row never depends on arrival order."""
    return [F.col(c).asc_nulls_first() for c in columns]


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def deduplicate(df: DataFrame, keys: Sequence[str] = ("user_id", "timestamp")) -> DataFrame:
    """Absorb redelivered rows: one row per natural key, smallest row first.

    Rows of a table without these columns pass through.
    """
    if not set(keys) <= set(df.columns):
        return df
    payload = [c for c in df.columns if c not in keys]
    order = total_order(payload) or [F.lit(1)]
    return first_per_key(df, list(keys), order)


def deduplicate_events(df: DataFrame, parsed_timestamp: Column) -> DataFrame:
    """As ``deduplicate``, but a row without a usable key is never merged with a different row.

    Such rows are bound for quarantine; only exact copies of one of them collapse.
    """
    unusable = F.col("user_id").isNull() | F.col("_ts").isNull()
    keyed = df.withColumn("_ts", parsed_timestamp)
    own_key = F.when(unusable, F.struct(*df.columns))
    order = total_order([c for c in df.columns if c != "user_id"])
    return first_per_key(keyed, ["user_id", "_ts", own_key], order).drop("_ts")


def latest_per_key(
    df: DataFrame, keys: Sequence[str] = ("user_id",), by: str = "timestamp"
) -> DataFrame:
    """Current state per key; ties on ``by`` fall to the smallest remaining row."""
    rest = [c for c in df.columns if c not in (*keys, by)]
    return first_per_key(df, list(keys), [F.col(by).desc_nulls_last(), *total_order(rest)])


# A surrogate key is 56 bits of a digest of the natural key and 7 bits of ordinal among the keys
# that share the digest.
_DIGEST_HEX = 14
_ORDINALS = 128


def with_surrogate_key(df: DataFrame, natural_key: Sequence[str], name: str) -> DataFrame:
    """Add a unique, repeatable BIGINT key first in the table.

    The ordinal settles collisions between digests of different keys. A second row with the same
    natural key fails the job.
    """
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in natural_key])
    digest = F.conv(F.substring(F.md5(text), 1, _DIGEST_HEX), 16, 10).cast("bigint")
    window = Window.partitionBy("_digest").orderBy(*total_order(natural_key))
    ordinal = F.col("_ordinal")
    distinct = (F.col("_before").isNull() | (F.col("_before") != F.col("_text"))) & (ordinal <= _ORDINALS)
    key = F.when(distinct, F.col("_digest") * _ORDINALS + ordinal - 1).otherwise(
        F.raise_error(F.lit(f"{name}: natural key is not unique")).cast("bigint")
    )
    return (
        df.withColumns({"_digest": digest, "_text": text})
        .withColumns({"_ordinal": F.row_number().over(window), "_before": F.lag("_text").over(window)})
        .select(key.alias(name), *df.columns)
    )
