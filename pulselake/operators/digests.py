"""Comparison of two large tables by digests of key buckets.

Both sides are reduced to a count and two sums of row digests per bucket of keys, map-side and without
a join of rows. Only rows of buckets whose digests differ are compared one by one, so two tables that
agree almost everywhere cost one scan each and a join of a few buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.operators.audit import reconcile

BUCKETS = 1 << 14
_PLACE = "_bucket"


def _hashed(columns: Sequence[str]) -> Column:
    """A hash of values as text, so that equal values of different types are equal; nulls count."""
    return F.xxhash64(*[F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-")) for c in columns])


def placed(table: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    return table.withColumn(_PLACE, F.pmod(_hashed(keys), F.lit(buckets)))


def bucket_digests(table: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows, and the exclusive or and the sum of the rows' digests, of every bucket that has rows."""
    marked = placed(table, keys, buckets).withColumn("_mark", _hashed([*keys, *values]))
    return marked.groupBy(_PLACE).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_mark").alias("mixed"), F.sum(F.col("_mark").cast("decimal(20,0)")).alias("total")
    )


def differing_buckets(
    landing: DataFrame, final: DataFrame, keys: Mapping[str, str], values: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Buckets whose digests differ: at most ``buckets`` rows."""
    left = bucket_digests(landing, list(keys), values, buckets).withColumn("side", F.lit(1))
    right = bucket_digests(final, list(keys.values()), values, buckets).withColumn("side", F.lit(2))
    pairs = left.union(right).groupBy(_PLACE, "n", "mixed", "total").agg(F.count(F.lit(1)).alias("sides"))
    return pairs.filter("sides < 2").select(_PLACE).distinct()


def reconcile_by_digest(
    landing: DataFrame, final: DataFrame, keys: Mapping[str, str], values: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """The rows of ``reconcile``, of which only buckets with differing digests are compared."""
    open_buckets = F.broadcast(differing_buckets(landing, final, keys, values, buckets))  # at most ``buckets`` longs
    left = placed(landing, list(keys), buckets).join(open_buckets, _PLACE, "left_semi").drop(_PLACE)
    right = placed(final, list(keys.values()), buckets).join(open_buckets, _PLACE, "left_semi").drop(_PLACE)
    return reconcile(left, right, keys, values)
