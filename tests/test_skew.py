from pyspark.sql import functions as F

from conftest import rows
from pulselake.operators.enrich import add_cohort


def test_cohort_join_reads_the_events_once_and_keeps_every_row(spark, folder):
    user = F.when(F.col("id") % 3 == 0, F.lit("U0")).when(F.col("id") % 50 == 1, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("U"), (F.col("id") % 977).cast("string")))
    spark.range(0, 30_000).select(user.alias("user_id"), F.col("id").alias("timestamp")).write.parquet(folder)
    events = spark.read.parquet(folder)
    users = spark.range(0, 900).select(
        F.concat(F.lit("U"), F.col("id").cast("string")).alias("user_id"), (F.col("id") % 3).alias("job_type"))
    joined = add_cohort(events, {"user_profiles": users})
    assert joined.columns == ["user_id", "timestamp", "job_type"]
    assert rows(joined) == rows(events.join(users, "user_id", "left"))
    assert joined._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
