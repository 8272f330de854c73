"""Slowly changing (type 2) user dimension and joins against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulselake import schemas
from pulselake.operators.keys import first_per_key, total_order, with_surrogate_key

TRACKED = ("job_type", "fitness_goal", "medical_history")
BUCKET = "minute"
OPEN_START = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"


def change_rows(
    events: DataFrame,
    tracked: Sequence[str] = TRACKED,
    key: str = "user_id",
    by: str = "timestamp",
    bucket: str = BUCKET,
) -> DataFrame:
    """Rows that open a new version of their key, with ``end_date`` = start of the next version.

    ``lag`` and ``lead`` over a whole key would sort one busy key in a single task. Here each key
    is cut into time buckets: neighbours inside a bucket come from a window over (key, bucket),
    and only the last state and the first change of each bucket travel through the small window
    over the key. Events are unique per key and microsecond, so a bucket is bounded by its length
    and the window over the key by the number of buckets in the history.
    """
    events = events.filter(F.col(key).isNotNull() & F.col(by).isNotNull())
    rest = [c for c in events.columns if c not in (key, by)]
    order = [F.col(by).asc_nulls_first(), *total_order(rest)]
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    across = Window.partitionBy(key).orderBy("_bucket")

    # one exchange on (key, bucket) serves the window and the bucket summary alike
    bucketed = events.withColumn("_bucket", F.date_trunc(bucket, by)).repartition(key, "_bucket")
    rows = (
        bucketed.withColumn("_state", F.struct(*tracked))
        .withColumns({
            "_prev": F.lag("_state").over(inside),
            "_opens": F.row_number().over(inside) == 1,
        })
    )
    # max_by over the same total order as the window: state at the end of each bucket
    last_state = (
        bucketed.groupBy(key, "_bucket")
        .agg(F.max_by(F.struct(*tracked), F.struct(by, *rest)).alias("_state"))
        .select(key, "_bucket", F.lag("_state").over(across).alias("_carried"))
    )
    changes = (
        rows.join(last_state, [key, "_bucket"], "left")
        .withColumn("_before", F.when(F.col("_opens"), F.col("_carried")).otherwise(F.col("_prev")))
        .filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_state")))
        .select(*events.columns, "_bucket")
    )
    first_change = (
        changes.groupBy(key, "_bucket")
        .agg(F.min(by).alias("_first"))
        .select(key, "_bucket", F.lead("_first").over(across).alias("_next_bucket_start"))
    )
    return (
        changes.withColumn("_next", F.lead(by).over(inside))
        .join(first_change, [key, "_bucket"], "left")
        .withColumn("end_date", F.coalesce("_next", "_next_bucket_start"))
        .drop("_next", "_next_bucket_start", "_bucket")
    )


def build_dim_user(
    profiles: DataFrame, tracked: Sequence[str] = TRACKED, bucket: str = BUCKET
) -> DataFrame:
    """Type 2 dimension from profile events: one row per user and period of equal attributes."""
    wanted = profiles.select("user_id", "timestamp", *schemas.PROFILE_COLUMNS)
    versions = change_rows(wanted, tracked, bucket=bucket)
    dated = versions.select(
        "user_id", *schemas.PROFILE_COLUMNS,
        F.col("timestamp").alias("effective_date"), "end_date",
        F.col("end_date").isNull().alias("is_current"),
    )
    return with_surrogate_key(dated, ["user_id", "effective_date"], "user_sk")


def stage_dim_user(dim_user: DataFrame) -> DataFrame:
    """Add ``effective_date_for_join``: open for a user's first version, else ``effective_date``.

    The first versions are found by a top-one per user, which is reduced map-side, and marked by
    a join on the unique ``user_sk``, so a user with many versions is not gathered anywhere.
    """
    firsts = first_per_key(
        dim_user.select("user_id", "effective_date", "user_sk"),
        ["user_id"],
        [F.col("effective_date").asc_nulls_last(), F.col("user_sk").asc()],
    ).select("user_sk", F.lit(True).alias("_first"))
    start = F.when(F.col("_first"), F.lit(OPEN_START).cast("timestamp")).otherwise(
        F.col("effective_date")
    )
    return dim_user.join(firsts, "user_sk", "left").select(
        *dim_user.columns, start.alias("effective_date_for_join")
    )


def point_in_time_join(
    facts: DataFrame, versions: DataFrame, keep_unmatched: bool = False
) -> DataFrame:
    """Facts with the dimension version valid at the start of ``event_date``.

    Validity is ``[effective_date_for_join, end_date)``. An event date is a midnight, so versions
    that contain no midnight match nothing and are dropped by a row-local filter first. That
    leaves at most one version per user and day, whatever the number of changes, and bounds the
    rows that meet inside one user.
    """
    start = F.col("effective_date_for_join")
    end = F.coalesce("end_date", F.lit(OPEN_END).cast("timestamp"))
    day = F.to_date(start)
    first_midnight = F.when(start == day.cast("timestamp"), day).otherwise(F.date_add(day, 1))
    spans = (
        versions.filter(first_midnight.cast("timestamp") < end)
        .withColumnsRenamed({"user_id": "_user_id"})
        .withColumns({"_start": start, "_end": end})
    )
    at = F.col("event_date").cast("timestamp")
    return facts.join(
        spans,
        (F.col("user_id") == F.col("_user_id")) & (at >= F.col("_start")) & (at < F.col("_end")),
        "left" if keep_unmatched else "inner",
    ).drop("_user_id", "_start", "_end")


def as_of_join(
    facts: DataFrame, versions: DataFrame, keep_unmatched: bool = False, period: str = "month"
) -> DataFrame:
    """As ``point_in_time_join`` for versions of a user that do not overlap, in linear time.

    Facts and versions form one stream per user and period in order of time, through which the last
    version is carried; each period starts with the last version of the periods before. So rows
    that meet are never multiplied, and a user with a long history is sorted period by period.
    """
    taken = [c for c in versions.columns if c != "user_id"]
    stream = facts.select(
        "user_id", F.col("event_date").cast("timestamp").alias("_at"), F.struct(*facts.columns).alias("_fact"),
        F.lit(None).cast(versions.select(F.struct(*taken).alias("v")).schema["v"].dataType).alias("_version"),
    )
    known = versions.filter(F.col("user_id").isNotNull()).select(
        "user_id", F.col("effective_date_for_join").alias("_at"),
        F.lit(None).cast(stream.schema["_fact"].dataType).alias("_fact"), F.struct(*taken).alias("_version"),
    )
    placed = stream.union(known).withColumn("_period", F.date_trunc(period, "_at")).repartition("user_id", "_period")
    inside = Window.partitionBy("user_id", "_period").orderBy("_at", F.col("_fact").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.partitionBy("_user").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy(F.col("user_id").alias("_user"), F.col("_period").alias("_start")).agg(
        F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_at"))).alias("_last")
    )
    carried = ends.select("_user", "_start", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    found = placed.withColumn("_here", F.last("_version", ignorenulls=True).over(inside)).filter(F.col("_fact").isNotNull())
    joined = found.join(carried, (F.col("user_id") == F.col("_user")) & (F.col("_period") == F.col("_start")), "left")
    version = F.coalesce("_here", "_carried")
    at = F.col("_at")
    valid = version.isNotNull() & (at < F.coalesce(version["end_date"], F.lit(OPEN_END).cast("timestamp")))
    out = joined if keep_unmatched else joined.filter(valid)
    return out.select("_fact.*", *[F.when(valid, version[c]).alias(c) for c in taken])
