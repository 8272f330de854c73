"""Update-or-insert by key with schema evolution, without a transactional table format."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pulselake.operators.keys import first_per_key, latest_per_key, total_order

INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"
ACTIONS = (INSERTED, UPDATED, UNCHANGED, KEPT)
ACTION = "merge_action"


def one_per_key(source: DataFrame, keys: Sequence[str], by: str | None = None) -> DataFrame:
    """Newest row per key, or the smallest row where there is no time column."""
    if by is not None:
        return latest_per_key(source, tuple(keys), by)
    rest = [c for c in source.columns if c not in keys]
    return first_per_key(source, list(keys), total_order(rest) or [F.lit(1)])


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """The table after the merge, every row labelled with what happened to it.

    ``source`` must hold one row per key. A matched row takes all columns the source has and keeps
    the others; it counts as updated only if a value differs. Columns new in the source are null
    in rows it does not touch.
    """
    names = [*target.columns, *[c for c in source.columns if c not in target.columns]]
    shared = [c for c in source.columns if c not in keys]
    t = target.select(*keys, F.struct(*target.columns).alias("_t"))
    s = source.select(*keys, F.struct(*source.columns).alias("_s"))
    types = {**{f.name: f.dataType for f in target.schema}, **{f.name: f.dataType for f in source.schema}}

    def side(row: str, frame: DataFrame, column: str):
        return F.col(f"{row}.{column}") if column in frame.columns else F.lit(None)

    def old(column: str):
        return side("_t", target, column).cast(types[column])

    def new(column: str):
        return side("_s", source, column).cast(types[column])

    from_source, from_target = F.col("_s").isNotNull(), F.col("_t").isNotNull()
    same = F.lit(True)
    for column in shared:
        same = same & new(column).eqNullSafe(old(column))
    action = (
        F.when(~from_target, INSERTED)
        .when(~from_source, KEPT)
        .when(same, UNCHANGED)
        .otherwise(UPDATED)
    )
    values = [
        F.col(c) if c in keys
        else F.when(from_source, new(c)).otherwise(old(c)).alias(c) if c in source.columns
        else old(c).alias(c)
        for c in names
    ]
    return t.join(s, list(keys), "full_outer").select(*values, action.alias(ACTION))


def merge_metrics(merged: DataFrame) -> DataFrame:
    """One row with the number of rows per action."""
    return merged.agg(
        *[F.count_if(F.col(ACTION) == a).alias(f"rows_{a}") for a in ACTIONS]
    )


def upsert_table(
    source: DataFrame, name: str, root: str, keys: Sequence[str] = ("user_id",), by: str | None = None
) -> dict[str, int]:
    """Merge into the table published under ``name`` and return the row count per action.

    The result goes to a new folder under ``root`` and is published by replacing the view
    ``name`` in one step, so readers see the old or the new table and a failed job leaves the old
    one in place. The first run creates the table.
    """
    spark = source.sparkSession
    incoming = one_per_key(source, keys, by)
    if spark.catalog.tableExists(name):
        merged = merge_upsert(spark.table(name), incoming, keys)
    else:
        merged = incoming.withColumn(ACTION, F.lit(INSERTED))
    seen = Observation()
    counts = [F.count_if(F.col(ACTION) == a).alias(a) for a in ACTIONS]
    folder = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    merged.observe(seen, *counts).drop(ACTION).write.parquet(folder)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return {a: seen.get[a] for a in ACTIONS}
