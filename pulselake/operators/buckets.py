"""Update-or-insert into a table of key buckets that rewrites only the buckets it touches.

A manifest names the live folder of every bucket. A merge reads and rewrites the buckets in which its
rows fall, into fresh folders, and publishes them all by one new manifest: readers see the table
before or after, a failed merge changes nothing, and of two merges at once the later one starts over
on what the earlier has published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulselake.operators.upsert import ACTION, ACTIONS, INSERTED, KEPT, merge_upsert, one_per_key
from pulselake.sources.files import Conflict, commit_manifest, latest_manifest
from pulselake.sources.tables import read_parquet_or_empty

BUCKETS = 64
_BUCKET = "_bucket"


def _read(spark: SparkSession, root: str, live: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    if not live:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{folder}" for folder, _ in live])


def read_buckets(spark: SparkSession, root: str) -> DataFrame:
    """The table as of its newest manifest."""
    _, content = latest_manifest(spark, root)
    if not content:
        raise ValueError(f"{root} holds no table")
    return _read(spark, root, list(content["live"].values()), T.StructType.fromJson(content["schema"]))


def _merged(source: DataFrame, root: str, keys: Sequence[str], by: str | None, buckets: int) -> dict[str, int]:
    spark = source.sparkSession
    version, content = latest_manifest(spark, root)
    count, live = content.get("buckets", buckets), dict(content.get("live", {}))
    place = F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
    incoming = one_per_key(source, keys, by)
    hit = [str(r[0]) for r in incoming.select(place).distinct().collect()]  # at most the number of buckets
    if not hit and content:
        return {a: sum(rows for _, rows in live.values()) if a == KEPT else 0 for a in ACTIONS}
    if content:
        target = _read(spark, root, [live[b] for b in hit if b in live], T.StructType.fromJson(content["schema"]))
        merged = merge_upsert(target, incoming, keys)
    else:
        merged = incoming.withColumn(ACTION, F.lit(INSERTED))
    folder = f"data/{uuid.uuid4().hex[:16]}"
    merged.withColumn(_BUCKET, place).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET, ACTION).parquet(f"{root}/{folder}")
    schema = T.StructType([f for f in merged.schema if f.name != ACTION])
    written = read_parquet_or_empty(spark, f"{root}/{folder}", T.StructType([T.StructField(_BUCKET, T.IntegerType()), T.StructField(ACTION, T.StringType())]))
    counts = dict.fromkeys(ACTIONS, 0)
    rows = dict.fromkeys(hit, 0)
    for r in written.groupBy(_BUCKET, ACTION).count().collect():  # one per bucket and action
        counts[r[ACTION]] += r["count"]
        rows[str(r[_BUCKET])] += r["count"]
    counts[KEPT] += sum(n for b, (_, n) in live.items() if b not in hit)
    live |= {b: [f"{folder}/{_BUCKET}={b}/*", rows[b]] for b in hit}
    commit_manifest(spark, root, version + 1, {"buckets": count, "keys": list(keys), "schema": json.loads(schema.json()), "live": live})
    return counts


def upsert_buckets(
    source: DataFrame, root: str, keys: Sequence[str] = ("user_id",), by: str | None = None,
    buckets: int = BUCKETS, attempts: int = 5,
) -> dict[str, int]:
    """Merge into the table under ``root`` and return the row count per action; the first merge creates it.

    ``buckets`` counts at creation only. Rows in untouched buckets count as kept, from the manifest.
    """
    for attempt in range(attempts):
        try:
            return _merged(source, root, keys, by, buckets)
        except Conflict:
            if attempt == attempts - 1:
                raise
    raise ValueError("attempts must be positive")
