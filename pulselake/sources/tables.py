"""Readers and writers for the Bronze, Silver, Quarantine, Gold and reference tables."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulselake import schemas
from pulselake.operators.enrich import LOOKUPS
from pulselake.sources.files import create_once, listed, partition_values, path_exists, read_text, remove

BRONZE_PARTITIONS = ("record_type", "year", "month", "day")
WRITER_PARTITIONS = ("writer", "batch")
FOLD, RETIRED = "fold", "_retired"
OWN_KEY = "_own_key"
SILVER, QUARANTINE = "silver", "quarantine"
ROWS_PER_FILE = 5_000_000


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one of that schema where nothing was written yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def bronze_partitions(spark: SparkSession, root: str, record_type: str = "*") -> dict[str, tuple[str | None, ...]]:
    """The live partitions of Bronze by path: type, year, month, day, writer and batch, from names alone."""
    names = (*BRONZE_PARTITIONS, *WRITER_PARTITIONS)
    folders = "/".join(f"{c}=*" for c in names[1:])
    paths = listed(spark, f"{root}/{names[0]}={record_type}/{folders}")
    marks = [json.loads(read_text(spark, m)) for m in listed(spark, f"{root}/{RETIRED}/*.json")]
    gone, folds = {p for m in marks for p in m["retired"]}, {p for m in marks for p in m["live"]}
    found = {}
    for path in paths:
        inner = path[path.index(f"/{names[0]}=") + 1 :]
        values = partition_values(path, names)
        if inner not in gone and (values[4] != FOLD or inner in folds):
            found[inner] = values
    return found


def read_bronze(
    spark: SparkSession, root: str, record_type: str, days: Iterable[tuple[str | None, ...]] | None = None
) -> DataFrame:
    """One type's Bronze rows with their ``year``, ``month`` and ``day`` partition columns.

    ``days`` (year, month, day) limits the folders that are read; so does ``fold_bronze``, whose
    marks say which folders no longer count.
    """
    parts = [T.StructField(c, T.StringType()) for c in (*BRONZE_PARTITIONS[1:], *WRITER_PARTITIONS)]
    schema = T.StructType([*schemas.BRONZE[record_type], *parts])
    if days is None and not path_exists(spark, f"{root}/{RETIRED}"):
        table = read_parquet_or_empty(spark, root, schema)
        return table.filter(F.col("record_type") == record_type).drop(*WRITER_PARTITIONS)
    wanted = None if days is None else set(days)
    paths = [f"{root}/{p}" for p, v in bronze_partitions(spark, root, record_type).items() if wanted is None or v[1:4] in wanted]
    if not paths:
        return spark.createDataFrame([], schema).drop(*WRITER_PARTITIONS)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).drop(*WRITER_PARTITIONS)


def retire(spark: SparkSession, root: str, name: str, retired: Sequence[str], live: Sequence[str] = ()) -> None:
    """From now on the partitions ``retired`` do not count and the folds ``live`` do, all in one step."""
    create_once(spark, f"{root}/{RETIRED}/{name}.json", json.dumps({"retired": sorted(retired), "live": sorted(live)}))


def retire_writer(spark: SparkSession, root: str, writer: str) -> int:
    """Take back all that a writer has written, as after a replay by another; returns its partitions."""
    own = [p for p, v in bronze_partitions(spark, root).items() if v[4] == writer]
    if own:
        retire(spark, root, f"writer-{writer}", own)
    return len(own)


def fold_bronze(spark: SparkSession, root: str, record_type: str) -> int:
    """Fold the batches of each day of a type into one folder; returns how many folders went into it.

    The fold is named after what goes into it, so a repeat writes the same folder again, and counts
    only once the mark is written that retires its parts. Readers see either. ``clear_retired``
    removes the retired folders when no reader uses them any more.
    """
    if not path_exists(spark, f"{root}/{RETIRED}"):
        retire(spark, root, "none", [])  # from here on readers leave out folds without a mark
    days: dict[tuple, list[str]] = {}
    for path, values in bronze_partitions(spark, root, record_type).items():
        days.setdefault(values[1:4], []).append(path)
    parts = sorted(p for own in days.values() if len(own) > 1 for p in own)
    if not parts:
        return 0
    name = hashlib.md5("\n".join(parts).encode()).hexdigest()[:16]
    rows = spark.read.option("mergeSchema", True).option("basePath", root).parquet(*[f"{root}/{p}" for p in parts])
    padded = {c: F.lpad(F.col(c).cast("string"), width, "0") for c, width in zip(BRONZE_PARTITIONS[1:], (4, 2, 2))}
    write_bronze(rows.drop(*WRITER_PARTITIONS).withColumns(padded), root, FOLD, name)
    live = listed(spark, f"{root}/record_type={record_type}/year=*/month=*/day=*/writer={FOLD}/batch={name}")
    retire(spark, root, f"{FOLD}-{record_type}-{name}", parts, [p[p.index("/record_type=") + 1 :] for p in live])
    return len(parts)


def clear_retired(spark: SparkSession, root: str) -> None:
    """Remove the folders that no longer count."""
    for mark in listed(spark, f"{root}/{RETIRED}/*.json"):
        for path in json.loads(read_text(spark, mark))["retired"]:
            remove(spark, f"{root}/{path}")


def read_zone(spark: SparkSession, root: str, record_type: str, zone: str) -> DataFrame:
    table = read_parquet_or_empty(
        spark, f"{root}/{record_type}", silver_layout(record_type)
    )
    return table.filter(F.col("zone") == zone).drop("zone")


def read_silver(spark: SparkSession, root: str, record_type: str) -> DataFrame:
    return read_zone(spark, root, record_type, SILVER)


def read_quarantine(spark: SparkSession, root: str, record_type: str) -> DataFrame:
    return read_zone(spark, root, record_type, QUARANTINE)


def read_reference(spark: SparkSession, folder: str) -> dict[str, DataFrame | None]:
    """The reference CSVs under ``folder``; a missing file gives ``None``."""
    reader = spark.read.option("header", True)
    return {
        name: reader.schema(schema).csv(f"{folder}/{name}.csv")
        if path_exists(spark, f"{folder}/{name}.csv") else None
        for name, schema in schemas.REFERENCE.items()
    }


def write_reference(table: DataFrame, folder: str, name: str) -> None:
    layout = schemas.REFERENCE[name]
    table.select(*layout.names).write.mode("overwrite").option("header", True).csv(
        f"{folder}/{name}.csv"
    )


def read_files(spark: SparkSession, paths: str | Sequence[str], file_format: str = "parquet") -> DataFrame:
    """Files, folders or patterns of one logical table, stacked by column name; missing columns are null."""
    listing = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format(file_format).option("mergeSchema", True).load(listing)


def read_many(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack files or tables of one logical table by column name; missing columns are null."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def silver_layout(record_type: str) -> T.StructType:
    """Columns of a Silver table with those of the lookups in force, in file order.

    A looked-up column that the fixed layout lacks has the type of its reference table, or is text
    where that table is not a known one.
    """
    layout = schemas.silver_schema(record_type)
    added = []
    for lookup in LOOKUPS.get(record_type, ()):
        known = {f.name: f.dataType for f in schemas.REFERENCE.get(lookup.table, ())}
        added += [T.StructField(n, known.get(c, T.StringType())) for n, c in lookup.take.items()
                  if n not in layout.names and n not in [f.name for f in added]]
    return T.StructType([*layout[:-2], *added, *layout[-2:]])


def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("timestamp")) if "timestamp" in df.columns else df


def write_bronze(records: DataFrame, root: str, writer: str = "load", batch: str | None = None) -> None:
    """Add a batch of decoded records, each row under the date of its own timestamp.

    Within a date, rows lie under who wrote them and in which batch. The same writer and batch
    again replaces what it wrote, which makes a repeat harmless; a load without a batch name is new.
    """
    named = records.withColumns({"writer": F.lit(writer), "batch": F.lit(batch or f"u{uuid.uuid4().hex}")})
    named.hint("rebalance", *BRONZE_PARTITIONS).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*BRONZE_PARTITIONS, *WRITER_PARTITIONS).parquet(root)


def zoned(judged: DataFrame) -> DataFrame:
    """Name the target zone and date of each judged row."""
    zone = F.when(F.col("failure_reason").isNull(), SILVER).otherwise(QUARANTINE)
    return with_date(judged.drop("is_valid")).withColumn("zone", zone)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``; one the table lacks, as after a missing reference, is null."""
    return df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def zone_counts() -> list:
    return [
        F.count_if(F.col("zone") == SILVER).alias("silver_rows"),
        F.count_if(F.col("zone") == QUARANTINE).alias("quarantine_rows"),
    ]


def write_judged(judged: DataFrame, root: str, record_type: str) -> dict[str, int]:
    """Replace one type's Silver and Quarantine in a single job and return their row counts.

    Both zones are partitions of one table, so the judged plan runs once for both and a
    quarantine that became empty leaves nothing stale behind. ``rebalance`` gathers each date's
    rows into few files, yet cuts a date too large for one task into several.
    """
    seen = Observation()
    rows = conform(zoned(judged), silver_layout(record_type))
    # counted in the writing stage: tasks of an earlier stage may run again and count twice
    laid_out = rows.hint("rebalance", "zone", "date").observe(seen, *zone_counts())
    laid_out.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(
        "zone", "date"
    ).parquet(f"{root}/{record_type}")
    return {name: seen.get[name] for name in ("silver_rows", "quarantine_rows")}


def write_gold(table: DataFrame, root: str, name: str) -> int:
    """Recompute one Gold table in full, with whatever columns it now has; returns its rows."""
    seen = Observation()
    table.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
        f"{root}/{name}"
    )
    return seen.get["rows"]


def store(table: DataFrame, root: str, name: str) -> DataFrame:
    """Write a table in full and read it back, so that later uses do not compute it again."""
    write_gold(table, root, name)
    return table.sparkSession.read.schema(table.schema).parquet(f"{root}/{name}")


def among(column: str, values: Iterable) -> Column:
    """Whether a column holds one of the values, null included: a filter that prunes partitions."""
    values = list(values)
    found = F.col(column).isin([v for v in values if v is not None])
    return F.coalesce(found, F.lit(None in values))


def touched(table: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The rows of ``table`` in partitions that occur in ``rows``.

    Their values, one per partition, become a filter on the partition column, so that only files of
    these partitions are read.
    """
    return table.filter(among(column, [r[0] for r in rows.select(column).distinct().collect()]))


def write_dates(rows: DataFrame, path: str, dates: Iterable, partitions: Sequence[str] = ("date",)) -> None:
    """Replace the given dates of a table by ``rows`` and leave the files of all others as they are.

    A partition of these dates that gets no rows any more is removed after the others are written.
    """
    spark, wanted = rows.sparkSession, {None if d is None else str(d) for d in dates}
    folders = "/".join(f"{c}=*" for c in partitions)
    before = {p: listed(spark, f"{p}/part-*") for p in listed(spark, f"{path}/{folders}")
              if partition_values(p, tuple(partitions))[list(partitions).index("date")] in wanted}
    rows.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*partitions).parquet(path)
    for folder, files in before.items():
        if files and path_exists(spark, files[0]):  # an overwritten partition has lost its old files
            remove(spark, folder)


def append_new_rows(
    rows: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str] = ("date",),
    prune_by: str = "date",
) -> int:
    """Append the rows whose key is not in the table yet; running it again appends nothing.

    ``rows`` must be unique on ``keys``, and a key must lie in one ``prune_by`` partition; keys
    compare null-safe. Of the table, only the partitions that occur in ``rows`` are read. ``rows`` is
    used more than once and therefore persisted.
    """
    seen = Observation()
    rows = rows.persist()
    try:
        table = touched(read_parquet_or_empty(rows.sparkSession, path, rows.schema), rows, prune_by)
        known = table.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_known_{k}"))
        fresh = rows.join(known, same, "left_anti").hint("rebalance", *partitions)
        fresh.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy(
            *partitions
        ).parquet(path)
    finally:
        rows.unpersist()
    return seen.get["rows"]


def append_audit(rows: DataFrame, path: str, run_id: str) -> None:
    """Add a run's rows to an audit log. Repeating a run replaces its own entries only, also by none."""
    rows.write.mode("overwrite").parquet(f"{path}/run_id={quote(run_id, safe='-_.~')}")
